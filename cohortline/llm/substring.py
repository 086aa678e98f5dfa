"""Substring dedup with fixed-block anchors.

A run of ``WINDOW`` words that occurs twice contains, at each occurrence, a whole block of the grid
of non-overlapping ``BLOCK``-word blocks, because ``2 * BLOCK - 1 <= WINDOW``.

1. Anchors: all grid blocks are indexed, and every rolling window of ``BLOCK`` words probes them.
   Blocks and probes meet in hash buckets; a probe travels as 32 bits inside its bucket. A block
   whose sequence occurs at a second place is an anchor. (Unequal sequences that share those bits
   only make an anchor too many.)
2. Extension: every window of ``WINDOW`` words around an anchor is compared with all others by a
   96-bit hash; neighbouring windows that occur elsewhere grow together to maximal repeats.
3. The words of those repeats are removed. All windows are judged on the input.

Nothing is paired, and each part of the input sends a sequence once, however often it holds it: the
records of a passage are bounded by the number of parts, not of copies. Both rounds send back only numbers of records, which the part's own table of
documents turns into positions. Documents without anchors or repeats pass a Bloom filter of bounded
size and do not shuffle their text; documents that do shuffle are joined on (id, hash of id and
text), so rows without id or with a repeated id keep their own result.

Defined cases: null has no words; a repeated row repeats all its windows; fewer words than a window
are never removed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortline.llm import bloom, buckets, text
from cohortline.session import stage

WINDOW = 35
_U64 = np.uint64
_ROWS = "bucket int, part long, kind int, payload binary"
_ONCE, _OFTEN, _ASK, _DOCS, _FOUND = range(5)
_PART = 8 << 20
_KEY = ["id0", "mark"]


def _rows(part: int, kind: int, bucket, payload) -> pa.RecordBatch:
    n = len(payload)
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket, pa.int32()), pa.array(np.full(n, part), pa.int64()),
         pa.array(np.full(n, kind), pa.int32()), pa.array(payload, pa.binary())],
        ["bucket", "part", "kind", "payload"])


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Parts of a task's input with a number that a repeated attempt gives again."""
    at = TaskContext.get().partitionId() << 32
    for batch in batches:
        for part in text.parts(batch, size=_PART):
            yield at, part
            at += 1


def _docs_row(number: int, part: pa.RecordBatch, counts: np.ndarray, n: int) -> pa.RecordBatch:
    ids, marks = (part.column(c).to_numpy(zero_copy_only=False) for c in _KEY)
    table = ids.tobytes() + marks.tobytes() + counts.astype(np.int64).tobytes()
    return _rows(number, _DOCS, [number % n], [table])


def _as_before(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Whether a pair equals the one before it."""
    same = np.zeros(len(first), bool)
    same[1:] = (first[1:] == first[:-1]) & (second[1:] == second[:-1])
    return same


def _probe_anchors(block: int, n: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, part in _numbered(batches):
            words = text.Words(part.column("text"))
            start = words.window_starts(block)
            hashes = text.run_hashes(words.hashes(), start, block)
            values, place, times = np.unique(hashes, return_inverse=True, return_counts=True)
            grid = np.flatnonzero((start - words.first[words.row_of_word()[start]]) % block == 0)
            # Grid blocks are numbered through the part, row by row.
            blocks_of_row = np.bincount(
                words.row_of_word()[start[grid]], minlength=part.num_rows)
            often = times[place[grid]] > 1
            yield _docs_row(number, part, blocks_of_row, n)
            yield _rows(number, _FOUND, [number % n],
                        [np.flatnonzero(often).astype(np.uint32).tobytes()])
            for kind, chosen in ((_ONCE, values[times == 1]), (_OFTEN, values[times > 1])):
                yield _rows(number, kind, *buckets.pack(
                    buckets.bucket_of(chosen, n), chosen.astype(np.uint32)))
            ask = np.flatnonzero(~often)
            chosen = hashes[grid[ask]]
            yield _rows(number, _ASK, *buckets.pack(
                buckets.bucket_of(chosen, n), chosen.astype(np.uint32), ask.astype(np.uint32)))
    return work


def _probe_windows(window: int, block: int, n: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, part in _numbered(batches):
            words = text.Words(part.column("text"))
            near = np.zeros(len(words) + 1, np.int64)
            for row, blocks in enumerate(part.column("found").to_pylist()):
                at = np.frombuffer(blocks, np.uint32).astype(np.int64) * block
                low, high = words.first[row], words.first[row + 1] - window
                np.add.at(near, np.clip(low + at - (window - block), low, None), 1)
                np.subtract.at(near, np.maximum(np.minimum(low + at, high), low - 1) + 1, 1)
            start = np.flatnonzero(np.cumsum(near[:-1]) > 0)
            ends = np.repeat(words.first[1:], words.counts)
            start = start[start + window <= ends[start]]
            hashes = words.hashes()
            first = text.run_hashes(hashes, start, window)
            second = (text.run_hashes(hashes, start, window, 11) >> _U64(32)).astype(np.uint32)
            order = np.lexsort((second, first))
            fresh = ~_as_before(first[order], second[order])
            times = np.diff(np.flatnonzero(np.append(fresh, True)))
            often = np.repeat(times > 1, times)
            yield _docs_row(number, part, words.counts, n)
            yield _rows(number, _FOUND, [number % n],
                        [start[order[often]].astype(np.uint32).tobytes()])
            told, ask = order[often & fresh], order[~often]
            yield _rows(number, _OFTEN, *buckets.pack(
                buckets.bucket_of(first[told], n), first[told], second[told]))
            yield _rows(number, _ASK, *buckets.pack(
                buckets.bucket_of(first[ask], n), first[ask], second[ask],
                start[ask].astype(np.uint32)))
    return work


def _answer_anchors(table: pa.Table) -> pa.Table:
    kind = table.column("kind").to_numpy()
    payload = table.column("payload").to_pylist()
    part = table.column("part").to_numpy()
    once, often = (
        buckets.unpack_all([payload[i] for i in np.flatnonzero(kind == k)], "u4")[0]
        for k in (_ONCE, _OFTEN))
    values, times = np.unique(once, return_counts=True)
    known = np.union1d(values[times > 1], often)
    asks = np.flatnonzero(kind == _ASK)
    out = []
    for i in asks:
        value, number = buckets.unpack(payload[i], "u4", "u4")
        at = np.minimum(np.searchsorted(known, value), max(len(known) - 1, 0))
        out.append(number[known[at] == value].tobytes() if len(known) else b"")
    return _passed(table, kind, part[asks], out)


def _answer_windows(table: pa.Table) -> pa.Table:
    kind = table.column("kind").to_numpy()
    payload = table.column("payload").to_pylist()
    asks = np.flatnonzero(kind == _ASK)
    rows = [buckets.unpack(payload[i], "u8", "u4", "u4") for i in asks]
    # A window that one part holds several times stands here once for that part, as do all others.
    told = [buckets.unpack(payload[i], "u8", "u4") for i in np.flatnonzero(kind == _OFTEN)]
    if not rows:
        return _passed(table, kind, table.column("part").to_numpy()[asks], [])
    first, second = (np.concatenate([r[i] for r in [*rows, *told]]) for i in (0, 1))
    order = np.lexsort((second, first))
    same = _as_before(first[order], second[order])
    again = np.zeros(len(first), bool)
    again[order] = same | np.append(same[1:], False)
    cuts = np.cumsum([0] + [len(r[0]) for r in rows])
    out = [r[2][again[i:j]].tobytes() for r, i, j in zip(rows, cuts[:-1], cuts[1:])]
    return _passed(table, kind, table.column("part").to_numpy()[asks], out)


def _passed(table: pa.Table, kind: np.ndarray, parts: np.ndarray, found: list[bytes]) -> pa.Table:
    """Answers, and what only passes through to the part it came from."""
    through = table.filter(pa.array((kind == _DOCS) | (kind == _FOUND))).select(
        ["part", "kind", "payload"])
    answers = pa.table({
        "part": pa.array(parts, pa.int64()), "kind": pa.array(np.full(len(parts), _FOUND), pa.int32()),
        "payload": pa.array(found, pa.binary())})
    return pa.concat_tables([through.cast(answers.schema), answers])


def _resolve(shape):
    """Turn the numbers that came back to a part into one row for each document with any."""
    def work(table: pa.Table) -> pa.Table:
        kind = table.column("kind").to_numpy()
        payload = table.column("payload").to_pylist()
        ids, marks, counts = buckets.unpack(
            payload[int(np.flatnonzero(kind == _DOCS)[0])], "i8", "i8", "i8")
        found = np.sort(buckets.unpack_all(
            [payload[i] for i in np.flatnonzero(kind == _FOUND)], "u4")[0]).astype(np.int64)
        edges = np.concatenate([[0], np.cumsum(counts)])
        at = np.searchsorted(found, edges)
        rows = np.flatnonzero(np.diff(at))
        return pa.table({
            "id0": ids[rows], "mark": marks[rows],
            "found": pa.array([shape(found[at[r]:at[r + 1]] - edges[r]) for r in rows],
                              pa.binary())})
    return work


def _ask(docs: DataFrame, probe, answer, shape, name: str) -> DataFrame:
    """(id0, mark, found), once for each document that has anything to report; stored."""
    # The part's number and its records must come out alike if a task is repeated.
    rows = docs.mapInArrow(probe, _ROWS)
    answers = rows.groupBy("bucket").applyInArrow(answer, "part long, kind int, payload binary")
    back = answers.groupBy("part").applyInArrow(
        _resolve(shape), "id0 long, mark long, found binary")
    return stage(back.groupBy(*_KEY).agg(F.max("found").alias("found")), name)


def _spans(window: int):
    def shape(starts: np.ndarray) -> bytes:
        cut = np.flatnonzero(np.diff(starts) > window)
        low = starts[np.concatenate([[0], cut + 1])]
        high = starts[np.concatenate([cut, [len(starts) - 1]])] + window
        return np.stack([low, high], axis=1).tobytes()
    return shape


def _joined(docs: DataFrame, found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents that ``found`` may name, with its rows; and those it surely does not."""
    bits = bloom.cell_bits(found.count())
    words = stage(bloom.present(found, "mark", bits), "filter")
    seen = bloom.flagged(docs, F.col("mark"), words, bits, "maybe")
    return (seen.filter("maybe").drop("maybe").join(found.hint("shuffle_merge"), _KEY, "left"),
            seen.filter(~F.col("maybe")).drop("maybe"))


def repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(id0, mark, found) of documents with repeats: word bounds of the maximal repeats.

    ``docs`` comes from ``keyed``. The bounds are pairs of signed 64-bit integers, as bytes;
    repeats that touch are one.
    """
    block = (window + 1) // 2
    n = buckets.bucket_count(buckets.text_bytes(docs))
    anchors = _ask(docs, _probe_anchors(block, n), _answer_anchors,
                   lambda blocks: blocks.astype(np.uint32).tobytes(), "anchors")
    near = _joined(docs, anchors)[0].filter(F.col("found").isNotNull())
    near = near.sortWithinPartitions(*_KEY)
    return _ask(near, _probe_windows(window, block, n), _answer_windows, _spans(window), "repeats")


def keyed(docs: DataFrame, id_column: str = "doc_id", column: str = "text") -> DataFrame:
    rows = docs.select(F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{column}`").alias("text"))
    return rows.select(
        "*", F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id0"),
        F.xxhash64("doc_id", "text").alias("mark"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in text.parts(batch):
            words = text.Words(part.column("text"))
            cover = np.zeros(len(words) + 1, np.int64)
            for row, spans in enumerate(part.column("found").to_pylist()):
                if spans:
                    low, high = np.frombuffer(spans, np.int64).reshape(-1, 2).T + words.first[row]
                    np.add.at(cover, low, 1)
                    np.subtract.at(cover, high, 1)
            kept = np.cumsum(cover[:-1]) == 0
            joined, begin, stop = words.joined()
            use = np.repeat(kept, stop - begin + 1)
            rest = np.frombuffer(joined, np.uint8)[use]
            ends = text.per_row(np.where(kept, stop - begin + 1, 0), words.first)
            bounds = np.concatenate([[0], np.cumsum(ends)])
            raw = rest.tobytes()
            texts = [raw[a:max(a, b - 1)] for a, b in zip(bounds[:-1], bounds[1:])]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(words.counts, pa.int64()),
                 pa.array(words.counts - text.per_row(kept, words.first), pa.int64()),
                 pa.array(texts, pa.binary()).cast(pa.string()), part.column("found")],
                ["doc_id", "n_words", "n_removed", "kept_text", "repeats"])


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_column: str = "doc_id",
                   column: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text, repeats) of every document.

    ``kept_text`` has the words outside all repeats, joined by one space; ``repeats`` the word
    bounds as pairs of 64-bit integers (null: none).
    """
    rows = keyed(docs, id_column, column)
    maybe, alone = _joined(rows, repeats(rows, window))
    schema = rows.select(
        "doc_id", F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_removed"),
        F.col("text").alias("kept_text"), F.lit(None).cast("binary").alias("repeats")).schema
    ready = [df.select("doc_id", "text", "found") for df in
             (maybe, alone.withColumn("found", F.lit(None).cast("binary")))]
    return ready[0].union(ready[1]).mapInArrow(_cut, schema)
