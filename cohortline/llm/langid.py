"""Language identification: multinomial naive Bayes over hashed character n-grams.

Characters are lower-cased one by one, everything but letters becomes a space, and runs of spaces
become one; n-grams of one to ``LONGEST`` characters are hashed to ``BINS`` bins. Counting is a sum over
all training rows; the matrix of log probabilities (languages x bins, at most ``MOST_LANGUAGES``
rows) is broadcast, and each batch is scored as a sparse product with it: the bins of a text select
matrix rows, which are added up.

Defined cases: a text that is null or has no letter is ``und`` with score 0; rows without language
are not learned from; if nothing can be learned, every text is ``und``; ties go to the language
that sorts first. Texts are read whole, in segments.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortline.llm import text

UNKNOWN = "und"
BINS = 1 << 15
LONGEST = 3
MOST_LANGUAGES = 1024
_SEGMENT = 1 << 19
_SPACE = 0x20
_U64 = np.uint64


@cache
def _folding() -> np.ndarray:
    """For each code point its lower-case letter, or a space."""
    table = np.full(0x110000, _SPACE, np.uint32)
    for code in range(0x110000):
        c = chr(code)
        if unicodedata.category(c)[0] == "L":
            low = c.lower()
            table[code] = ord(low) if len(low) == 1 else code
    return table


def _segments(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """Pieces of a batch: letters and single spaces, the row of each, which are letters, and how many
    at the start are repeated from the piece before."""
    rows = [t or "" for t in texts.to_pylist()]
    at = 0
    while at < len(rows):
        size, to = len(rows[at]), at + 1
        while to < len(rows) and size + len(rows[to]) <= _SEGMENT:
            size += len(rows[to])
            to += 1
        whole = rows[at:to]
        # Only a row on its own is longer than a segment; its pieces go on from the last letters.
        last = np.zeros(0, np.uint32)
        for low in range(0, max(1, size), _SEGMENT):
            pieces = [t[low:low + _SEGMENT] for t in whole]
            codes = np.frombuffer("".join(pieces).encode("utf-32-le", "replace"), np.uint32)
            row = np.repeat(np.arange(at, to), [len(p) for p in pieces])
            letters = np.concatenate([last, _folding()[codes]])
            row = np.concatenate([np.full(len(last), at), row])
            blank = letters == _SPACE
            keep = np.ones(len(letters), bool)
            keep[1:] = ~(blank[1:] & blank[:-1] & (row[1:] == row[:-1]))
            letters = letters[keep]
            yield letters, row[keep], ~blank[keep], len(last)
            last = letters[len(letters) - min(len(letters), LONGEST - 1):]
        at = to


def _grams(letters: np.ndarray, row: np.ndarray,
           known: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bins, rows) for each n-gram length; n-grams inside the first ``known`` letters are left out."""
    letters_code = letters.astype(_U64)
    for n in range(1, LONGEST + 1):
        if len(letters_code) < n:
            return
        skip = max(0, known - n + 1)
        code, whose = letters_code[skip:], row[skip:]
        if len(code) < n:
            continue
        size = len(code) - n + 1
        packed = np.full(size, n, _U64)
        for k in range(n):
            packed = (packed << _U64(21)) ^ code[k:k + size]
        bins = ((packed * _U64(0x9E3779B97F4A7C15)) >> _U64(49)).astype(np.int64)
        inside = whose[:size] == whose[n - 1:]
        yield bins[inside], whose[:size][inside]


class Model:
    """Languages, log probabilities (bins x languages) and log priors."""

    def __init__(self, languages: list[str], counts: np.ndarray, rows: np.ndarray,
                 smoothing: float = 1.0):
        self.languages = languages
        smooth = counts + smoothing
        self.matrix = np.ascontiguousarray(
            np.log(smooth / smooth.sum(axis=1, keepdims=True)).T.astype(np.float32))
        self.prior = np.log(rows / rows.sum()) if len(languages) else np.zeros(0)


def fit(docs: DataFrame, language: str = "lang", column: str = "text") -> Model:
    """Count n-grams of all rows with a language; the totals have one row per language and bin."""
    rows = docs.select(F.col(f"`{language}`").alias("lang"), F.col(f"`{column}`").alias("text"))
    rows = rows.filter("lang IS NOT NULL")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in text.parts(batch):
                names = np.array(part.column("lang").to_pylist(), object)
                own = sorted(set(names.tolist()))
                code = np.searchsorted(np.array(own, object), names) if own else names
                sums = np.zeros(len(own) * (BINS + 1), np.int64)
                for letters, row, _, known in _segments(part.column("text")):
                    for bins, whose in _grams(letters, row, known):
                        sums += np.bincount(
                            code[whose] * (BINS + 1) + bins, minlength=len(sums))
                # The extra bin counts the language's rows.
                for i, name in enumerate(own):
                    mine = sums[i * (BINS + 1):(i + 1) * (BINS + 1)]
                    mine[BINS] = (code == i).sum()
                    totals[name] = totals.get(name, 0) + mine
        for name, mine in totals.items():
            seen = np.flatnonzero(mine)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(seen)), pa.array(seen, pa.int32()), pa.array(mine[seen])],
                ["lang", "bin", "n"])

    found = rows.mapInArrow(work, "lang string, bin int, n long")
    sums = found.groupBy("lang", "bin").agg(F.sum("n").alias("n"))
    # One row for each language and bin that occurs: bounded by the check on languages.
    names = [r[0] for r in rows.select("lang").distinct().orderBy("lang")
             .limit(MOST_LANGUAGES + 1).collect()]
    if len(names) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    names.sort()
    counts = np.zeros((len(names), BINS + 1))
    table = sums.toPandas()
    counts[np.searchsorted(np.array(names, object), table["lang"].to_numpy(object))
           if len(table) else [], table["bin"].to_numpy(np.int64)] = table["n"]
    return Model(names, counts[:, :BINS], counts[:, BINS])


def classify(model: Model, texts: pa.Array) -> tuple[list[str], np.ndarray]:
    """Language and posterior probability of each text."""
    n = len(texts)
    if not model.languages:
        return [UNKNOWN] * n, np.zeros(n)
    total, letter = np.zeros((n, len(model.languages))), np.zeros(n, bool)
    for letters, row, is_letter, known in _segments(texts):
        letter[row[is_letter]] = True
        for bins, whose in _grams(letters, row, known):
            if not len(bins):
                continue
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(whose)) + 1])
            sums = np.stack([np.add.reduceat(model.matrix[:, k][bins], cuts, dtype=np.float64)
                             for k in range(len(model.languages))], axis=1)
            total[whose[cuts]] += sums
    total += model.prior
    best = total.argmax(axis=1)
    score = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
    names = [model.languages[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), letter.tolist())]
    return names, np.where(letter, score, 0.0)


def with_language(docs: DataFrame, model: Model, column: str = "text",
                  prefix: str = "") -> DataFrame:
    """``docs`` with columns lang_pred and score, their names behind a prefix."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [f"{prefix}lang_pred", f"{prefix}score"]
    schema = docs.select("*", F.lit("").alias(names[0]), F.lit(0.0).alias(names[1])).schema
    at = docs.columns.index(column)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            renamed = pa.RecordBatch.from_arrays(
                batch.columns, [f"c{i}" for i in range(batch.num_columns)])
            for part in text.parts(renamed, f"c{at}"):
                found, score = classify(shared.value, part.column(at))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(found, pa.string()), pa.array(score, pa.float64())],
                    [*batch.schema.names, *names])

    return docs.mapInArrow(work, schema)


def keep_identified(docs: DataFrame, model: Model, least: float = 0.5,
                    column: str = "text") -> DataFrame:
    """Documents whose language is known with at least the given probability."""
    prefix = "_"
    while f"{prefix}lang_pred" in docs.columns or f"{prefix}score" in docs.columns:
        prefix += "_"
    marked = with_language(docs, model, column, prefix)
    return marked.filter(
        (F.col(f"{prefix}lang_pred") != UNKNOWN) & (F.col(f"{prefix}score") >= least)).select(
            *[F.col(f"`{c}`") for c in docs.columns])
