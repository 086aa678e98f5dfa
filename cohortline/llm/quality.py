"""Quality scores by attention over the passages of a document.

A document is a bag of passages of ``PASSAGE`` words. A passage becomes a vector of surface
measures; one hidden layer encodes it. Gated attention, softmax(w . (tanh(V h) * sigmoid(U h))),
weighs the encoded passages, and a logistic layer scores their weighted mean. Everything is
learned from document labels alone.

Learning reads a sample of at most ``MOST_LABELLED`` labelled documents, chosen by the hash of their
id, and every passage of each. ``MOST_PASSAGES`` bounds the passages of the whole sample: documents
are taken whole, in hash order, until it is reached. Scoring reads every passage of every text.

Defined cases: null and texts without words are one empty passage; contradictory labels of one id
are averaged; with no labels every score is 0.5, with one kind of label the smoothed share.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortline.llm import text
from cohortline.session import stage

PASSAGE = 100
MOST_LABELLED = 12_000
MOST_PASSAGES = 64 * MOST_LABELLED
HIDDEN = 24
ATTENTION = 12
EPOCHS = 40
_U64 = np.uint64
_PUNCT = [b for b in range(0x21, 0x7F) if not chr(b).isalnum()]
_KINDS = np.zeros(256, np.int64)          # 0: anything else
_KINDS[0x41:0x5B] = 1                      # upper case
_KINDS[0x61:0x7B] = 2                      # lower case
_KINDS[0x30:0x3A] = 3                      # digits
_KINDS[0x80:] = 4                          # outside ASCII
_KINDS[0x0A] = 5                           # line ends
for _i, _b in enumerate(_PUNCT):
    _KINDS[_b] = 6 + _i
_N_KINDS = 6 + len(_PUNCT)
N_FEATURES = _N_KINDS + 9


def passages(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(features of all passages, row of each)."""
    words = text.Words(texts)
    hashes = text.byte_hashes(text.LOWER[words.data], words.start, words.end)
    counts = words.counts
    per_row = np.maximum(1, -(-counts // PASSAGE))
    row = np.repeat(np.arange(len(counts)), per_row)
    turn = np.arange(len(row)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
    low = words.first[row] + turn * PASSAGE
    high = np.minimum(low + PASSAGE, words.first[row + 1])
    n = np.maximum(high - low, 0)
    which = np.repeat(np.arange(len(row)), n)
    # Bytes from a passage's first word to the next passage's, so that line ends count too.
    begin = np.append(words.start, len(words.data))[low]
    begin = np.where(n > 0, begin, words.rows[row])
    stop = np.where(turn == per_row[row] - 1, words.rows[row + 1], np.append(begin[1:], 0))
    size = np.maximum(stop - begin, 0)
    kinds = np.zeros((len(row), _N_KINDS))
    for k in range(0, len(row), 4096):
        of = np.arange(k, min(k + 4096, len(row)))
        piece = np.repeat(of - k, size[of])
        at = np.arange(len(piece)) - np.repeat(np.cumsum(size[of]) - size[of], size[of])
        at += np.repeat(begin[of], size[of])
        kinds[of] = np.bincount(piece * _N_KINDS + _KINDS[words.data[at]],
                                minlength=len(of) * _N_KINDS).reshape(len(of), -1)

    def share_distinct(values: np.ndarray, owner: np.ndarray) -> np.ndarray:
        keys = text.mix(values ^ (owner.astype(_U64) * _U64(0x9E3779B97F4A7C15)))
        _, first = np.unique(keys, return_index=True)
        total = np.maximum(1, np.bincount(owner, minlength=len(row)))
        return np.bincount(owner[first], minlength=len(row)) / total

    def mean(values: np.ndarray) -> np.ndarray:
        return np.bincount(which, values, minlength=len(row)) / np.maximum(n, 1)

    length = (words.end - words.start).astype(float)
    letters = np.isin(_KINDS[words.data], (1, 2, 4)).cumsum() if len(words.data) else np.zeros(0)
    letters = np.concatenate([[0], letters])
    bare = (letters[words.end] - letters[words.start]) == 0
    upper = np.concatenate([[0], (_KINDS[words.data] == 1).cumsum()])
    shout = (upper[words.end] - upper[words.start]) * 2 > length
    odd = _KINDS[words.data[words.end - 1]] >= 6 if len(words) else np.zeros(0, bool)
    pair = which[1:] == which[:-1] if len(words) else np.zeros(0, bool)
    doubles = np.bincount(which[1:][pair & (hashes[1:] == hashes[:-1])] if len(words) else which,
                          minlength=len(row))
    two = text.mix(hashes[:-1] + text.mix(hashes[1:])) if len(words) else hashes
    features = np.column_stack([
        np.sqrt(kinds / np.maximum(1, size)[:, None]),
        mean(length) / 10, mean(bare), mean(shout), mean(odd), doubles / np.maximum(1, n),
        share_distinct(hashes, which), share_distinct(two[pair], which[1:][pair])
        if len(words) else np.zeros(len(row)),
        np.minimum(n, PASSAGE) / PASSAGE, n == 0])
    return features.astype(np.float32), row


class Model:
    """Scaling, encoder, gated attention and output layer."""

    def __init__(self, share: float = 0.5, seed: int = 7):
        rng = np.random.default_rng(seed)
        draw = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape)
        self.center, self.scale = np.zeros(N_FEATURES), np.ones(N_FEATURES)
        self.weights = {
            "W": draw(N_FEATURES, HIDDEN), "b": np.zeros(HIDDEN),
            "V": draw(HIDDEN, ATTENTION), "U": draw(HIDDEN, ATTENTION),
            "w": draw(ATTENTION), "c": np.zeros(HIDDEN), "d": np.log(share / (1 - share))}

    def forward(self, x: np.ndarray, row: np.ndarray) -> tuple:
        """Scores of the bags that ``row`` numbers without gaps; and what the gradient needs."""
        p = self.weights
        h = np.tanh(((x - self.center) / self.scale) @ p["W"] + p["b"])
        gate, side = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        raw = (gate * side) @ p["w"]
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(row)) + 1])
        raw = np.exp(raw - np.maximum.reduceat(raw, cuts)[row])
        attention = raw / np.add.reduceat(raw, cuts)[row]
        bag = np.add.reduceat(attention[:, None] * h, cuts)
        score = 1 / (1 + np.exp(-np.clip(bag @ p["c"] + p["d"], -40, 40)))
        return score, (h, gate, side, attention, bag, cuts)

    def gradient(self, x: np.ndarray, row: np.ndarray, y: np.ndarray) -> dict:
        """Of the mean log loss."""
        p = self.weights
        score, (h, gate, side, attention, bag, cuts) = self.forward(x, row)
        out = (score - y) / len(y)
        to_bag = np.outer(out, p["c"])[row]
        to_attention = (to_bag * h).sum(axis=1)
        mean = np.add.reduceat(attention * to_attention, cuts)[row]
        to_raw = attention * (to_attention - mean)
        to_gate = np.outer(to_raw, p["w"]) * side * (1 - gate ** 2)
        to_side = np.outer(to_raw, p["w"]) * gate * side * (1 - side)
        to_h = attention[:, None] * to_bag + to_gate @ p["V"].T + to_side @ p["U"].T
        to_in = to_h * (1 - h ** 2)
        return {
            "W": ((x - self.center) / self.scale).T @ to_in, "b": to_in.sum(axis=0),
            "V": h.T @ to_gate, "U": h.T @ to_side, "w": (gate * side).T @ to_raw,
            "c": bag.T @ out, "d": out.sum()}

    def score(self, texts: pa.Array) -> np.ndarray:
        if not len(texts):
            return np.zeros(0)
        return self.forward(*passages(texts))[0]


def train(bags: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, batch: int = 64,
          rate: float = 0.01, decay: float = 1e-4, seed: int = 11) -> Model:
    """Adam over mini-batches of bags."""
    share = (labels.sum() + 1) / (len(labels) + 2)
    model = Model(share)
    if len(set((labels >= 0.5).tolist())) < 2:
        return model
    every = np.concatenate(bags)
    model.center, model.scale = every.mean(axis=0), every.std(axis=0) + 1e-3
    first = {k: np.zeros_like(v) for k, v in model.weights.items()}
    second = {k: np.zeros_like(v) for k, v in model.weights.items()}
    rng, step = np.random.default_rng(seed), 0
    for epoch in range(epochs):
        order = rng.permutation(len(bags))
        for low in range(0, len(order), batch):
            chosen = order[low:low + batch]
            x = np.concatenate([bags[i] for i in chosen])
            row = np.repeat(np.arange(len(chosen)), [len(bags[i]) for i in chosen])
            step += 1
            for k, g in model.gradient(x, row, labels[chosen]).items():
                g = g + decay * model.weights[k] * (k not in "bd")
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                move = first[k] / (1 - 0.9 ** step) / (
                    np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
                model.weights[k] = model.weights[k] - rate * (1 - epoch / epochs) * move
    return model


def last_place(sizes: list[tuple[int, int]], most: int) -> int:
    """Last place whose documents still fit into ``most`` passages; ``sizes`` are (place, passages).

    Documents are taken whole in order of place; one that is larger than ``most`` is left out.
    """
    total, last = 0, -(1 << 63)
    for place, n in sorted(tuple(r) for r in sizes):
        if n > most:
            continue
        total += n
        if total > most:
            break
        last = place
    return last


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", id_column: str = "doc_id",
        column: str = "text", most: int = MOST_LABELLED) -> Model:
    """Learn from at most ``most`` labelled documents, ``MOST_PASSAGES`` passages in all."""
    wanted = labels.select(
        F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{label}`").cast("double").alias("y")
    ).filter("y IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.avg("y").alias("y"))
    wanted = wanted.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    texts = docs.select(
        F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{column}`").alias("text"))
    # Bounded by ``most`` rows of 16 bytes.
    rows = texts.join(F.broadcast(wanted), "doc_id").select(
        "doc_id", "y", F.xxhash64("doc_id").alias("place"), "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text.parts(batch):
                x, row = passages(part.column("text"))
                cuts = np.searchsorted(row, np.arange(part.num_rows + 1))
                bags = [x[i:j].tobytes() for i, j in zip(cuts[:-1], cuts[1:])]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(pa.string()), part.column("y"),
                     part.column("place"), pa.array(np.diff(cuts), pa.int64()),
                     pa.array(bags, pa.binary())],
                    ["doc_id", "y", "place", "n", "bag"])

    bagged = stage(rows.mapInArrow(
        work, "doc_id string, y double, place long, n long, bag binary"), "bags")
    last = last_place(bagged.select("place", "n").collect(), MOST_PASSAGES)
    sample = bagged.filter((F.col("place") <= last) & (F.col("n") <= MOST_PASSAGES)).select(
        "doc_id", "y", "bag").collect()
    sample.sort(key=lambda r: (r[0], r[2]))
    bags = [np.frombuffer(r[2], np.float32).reshape(-1, N_FEATURES) for r in sample]
    return train(bags, np.array([r[1] for r in sample])) if bags else Model()


def with_quality(docs: DataFrame, model: Model, id_column: str = "doc_id",
                 column: str = "text") -> DataFrame:
    """(doc_id, score) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{column}`").alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text.parts(batch):
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(shared.value.score(part.column("text")))],
                    ["doc_id", "score"])

    return rows.mapInArrow(work, rows.select("doc_id", F.lit(0.0).alias("score")).schema)
