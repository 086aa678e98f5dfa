"""Benchmark decontamination by a prefix-filtered set join.

Every benchmark item is cut into windows of ``WINDOW`` words (a shorter item is one window). A
window is a set of word shingles, and a document contains it only if it contains all of them, so
with a required containment of one the prefix is a single shingle: the window's rarest one. Rarity
is counted over all documents. Documents probe the prefix index with every shingle; a match at
document position p and window offset o can only start at p - o, which must lie in the document
(positional bound) and leave room for the window (length bound). What passes is verified by the
hash of the whole window and then by its bytes.

The benchmark is read in slices of about ``SLICE_BYTES`` of text, one after the other: only one slice
is on the driver and broadcast at a time. Every slice but the last stores the texts it hits (their
SHA-256, a bit for each word, the items); the last one adds them to its own. So a benchmark within one
slice costs two reads of the documents and no shuffle, and a larger one costs time, not memory.

Defined cases: null has no words; an item without words has no window; equal windows of several items
count for each of them; equal item ids count once, and so do all items without id, which stand as a
null at the end of the list.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortline.llm import text
from cohortline.session import stage

WINDOW = 10
SHINGLE = 3
SLICE_BYTES = 2 << 20
_U64 = np.uint64


class Index:
    """Windows of one slice of the benchmark: their texts, shingles and items."""

    def __init__(self, items: list[tuple[str | None, str]], window: int = WINDOW):
        words = text.Words(pa.array([t for _, t in items], pa.string()), text.ALNUM, lower=True)
        self.text, begin, stop = words.joined()
        first = words.window_starts(window)
        short = np.flatnonzero((words.counts > 0) & (words.counts < window))
        size = np.concatenate([np.full(len(first), window), words.counts[short]])
        first = np.concatenate([first, words.first[short]])
        by = np.argsort(first, kind="stable")
        first, size = first[by], size[by]
        hashes = words.hashes()
        once = text.run_hashes(hashes, first, size)
        # Windows are one if 128 bits of hash are; documents are compared with the bytes of one of them.
        twice = text.run_hashes(hashes, first, size, 11)
        order = np.lexsort((twice, once))
        new = np.ones(len(order), bool)
        new[1:] = (once[order][1:] != once[order][:-1]) | (
            twice[order][1:] != twice[order][:-1])
        lead = order[new]
        spots, self.size, self.hash = first[lead], size[lead], once[lead]
        self.low, self.high = begin[spots], stop[spots + self.size - 1]
        self.names = [i for i, _ in items]
        pairs = np.unique(
            (np.cumsum(new) - 1) * len(items) + words.row_of_word()[first[order]])
        owned, self.owner = np.divmod(pairs, max(1, len(items)))
        self.owners = np.searchsorted(owned, np.arange(len(lead) + 1))
        # Every shingle of every window, with its offset there.
        width = np.minimum(self.size, SHINGLE)
        per = self.size - width + 1
        self._window = np.repeat(np.arange(len(per)), per)
        self._offset = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
        place = spots[self._window] + self._offset
        by = np.argsort(place, kind="stable")
        self._shingle = np.empty(len(by), _U64)
        self._shingle[by] = text.run_hashes(hashes, place[by], width[self._window][by])
        self.widths = np.unique(width).tolist()
        self.shingles = np.unique(self._shingle)

    def __len__(self) -> int:
        return len(self.size)

    def items_of(self, window: int) -> list[str | None]:
        return [self.names[o] for o in self.owner[self.owners[window]:self.owners[window + 1]]]

    def choose_prefix(self, counts: np.ndarray) -> None:
        """Keep the rarest shingle of each window; ties go to the smaller hash."""
        rarity = counts[np.searchsorted(self.shingles, self._shingle)]
        order = np.lexsort((self._offset, self._shingle, rarity, self._window))
        lead = order[np.concatenate([[True], np.diff(self._window[order]) > 0])] if len(order) \
            else order
        lead = lead[np.argsort(self._shingle[lead], kind="stable")]
        self.prefix, cuts = np.unique(self._shingle[lead], return_index=True)
        self.cuts = np.append(cuts, len(lead))
        self.lead_window, self.lead_offset = self._window[lead], self._offset[lead]
        del self._shingle, self._window, self._offset


class Lookup:
    """Finds values in a sorted array; a bit table turns most of the others away first."""

    def __init__(self, values: np.ndarray):
        self.values = values
        self.shift = _U64(64 - max(12, int(len(values)).bit_length() + 5))
        self.maybe = np.zeros(1 << (64 - int(self.shift)), bool)
        self.maybe[values >> self.shift] = True

    def find(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``wanted`` that occur, and where in the sorted values."""
        near = np.flatnonzero(self.maybe[wanted >> self.shift])
        if not len(near):
            return near, near
        at = np.minimum(np.searchsorted(self.values, wanted[near]), len(self.values) - 1)
        hit = self.values[at] == wanted[near]
        return near[hit], at[hit]


def _shingles(words: text.Words, hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    first = words.window_starts(width)
    return first, text.run_hashes(hashes, first, width)


def _count(docs: DataFrame, index: Index) -> np.ndarray:
    """How often each shingle of the index occurs in all documents."""
    shared = docs.sparkSession.sparkContext.broadcast((index.shingles, index.widths))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, widths = shared.value
        lookup, counts = Lookup(shingles), np.zeros(len(shingles), np.int64)
        for batch in batches:
            for part in text.parts(batch):
                words = text.Words(part.column("text"), text.ALNUM, lower=True)
                hashes = words.hashes()
                for width in widths:
                    at = lookup.find(_shingles(words, hashes, width)[1])[1]
                    counts += np.bincount(at, minlength=len(counts))
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen, pa.int64()), pa.array(counts[seen])], ["place", "n"])

    found = docs.select("text").mapInArrow(work, "place long, n long")
    # At most one row for each shingle of the slice.
    totals = found.groupBy("place").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(len(index.shingles), np.int64)
    out[totals["place"].to_numpy(np.int64)] = totals["n"].to_numpy(np.int64)
    return out


def _occurrences(words: text.Words, index: Index,
                 lookup: Lookup) -> tuple[np.ndarray, np.ndarray]:
    """(first word, window) of every window that occurs."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not len(words) or not len(index):
        return none
    hashes = words.hashes()
    starts, windows = [], []
    for width in index.widths:
        first, shingles = _shingles(words, hashes, width)
        at, place = lookup.find(shingles)
        many = index.cuts[place + 1] - index.cuts[place]
        position = np.repeat(first[at], many)
        lead = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        lead += np.repeat(index.cuts[place], many)
        window = index.lead_window[lead]
        fits = np.minimum(index.size[window], SHINGLE) == width
        starts.append(position[fits] - index.lead_offset[lead][fits])
        windows.append(window[fits])
    start, window = np.concatenate(starts), np.concatenate(windows)
    inside = (start >= 0) & (start < len(words))
    start, window = start[inside], window[inside]
    ends = np.repeat(words.first[1:], words.counts)
    # The start must also lie in the row that the matched shingle lies in.
    fits = start + index.size[window] <= ends[start]
    start, window = start[fits], window[fits]
    if not len(start):
        return none
    by = np.argsort(start, kind="stable")
    start, window = start[by], window[by]
    same = text.run_hashes(hashes, start, index.size[window]) == index.hash[window]
    start, window = start[same], window[same]
    joined, begin, stop = words.joined()
    low, high = begin[start], stop[start + index.size[window] - 1]
    true = np.fromiter(
        (joined[a:b] == index.text[c:d]
         for a, b, c, d in zip(low.tolist(), high.tolist(), index.low[window].tolist(),
                               index.high[window].tolist())), bool, len(start))
    return start[true], window[true]


def _slices(benchmark: DataFrame, item: str, column: str) -> list[DataFrame]:
    rows = benchmark.select(
        F.col(f"`{item}`").cast("string").alias("item"), F.col(f"`{column}`").alias("text"))
    rows = rows.filter(F.col("text").isNotNull()).distinct()
    n = max(1, -(-(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // SLICE_BYTES))
    return [rows.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k) for k in range(n)]


def _index(texts: DataFrame, part: DataFrame, window: int) -> Index:
    """Prefix index of one slice, with shingle counts over all ``texts``."""
    index = Index([tuple(r) for r in part.orderBy("item", "text").collect()], window)
    index.choose_prefix(
        _count(texts, index) if len(index) else np.zeros(len(index.shingles), np.int64))
    return index


def _listed(items: set[str | None]) -> list[str | None]:
    return sorted(items, key=lambda item: (item is None, item or ""))


def _hits(words: text.Words, index: Index,
          lookup: Lookup) -> tuple[np.ndarray, list[set[str | None]]]:
    """(is each word hit, items of each row)."""
    cover = np.zeros(len(words) + 1, np.int64)
    items: list[set[str | None]] = [set() for _ in words.counts]
    row = words.row_of_word()
    start, window = _occurrences(words, index, lookup)
    np.add.at(cover, start, 1)
    np.subtract.at(cover, start + index.size[window], 1)
    for r, w in set(zip(row[start].tolist(), window.tolist())):
        items[r].update(index.items_of(w))
    return np.cumsum(cover[:-1]) > 0, items


def _hit_texts(texts: DataFrame, index: Index) -> DataFrame:
    """(mark, mask, items) of each text that the index hits, once; stored."""
    shared = texts.sparkSession.sparkContext.broadcast(index)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(shared.value.prefix)
        for batch in batches:
            for part in text.parts(batch):
                words = text.Words(part.column("text"), text.ALNUM, lower=True)
                hit, items = _hits(words, shared.value, lookup)
                rows = [r for r, found in enumerate(items) if found]
                masks = [np.packbits(hit[words.first[r]:words.first[r + 1]]).tobytes()
                         for r in rows]
                yield pa.RecordBatch.from_arrays(
                    [part.column("mark").take(pa.array(rows, pa.int64())),
                     pa.array(masks, pa.binary()),
                     pa.array([_listed(items[r]) for r in rows], pa.list_(pa.string()))],
                    ["mark", "mask", "items"])

    found = texts.mapInArrow(work, "mark string, mask binary, items array<string>")
    out = stage(found.dropDuplicates(["mark"]), "hits")
    shared.unpersist()
    return out


FOUND = ["n_words", "n_hit", "items"]
_EARLIER = ["mark", "masks", "earlier"]


def with_hits(docs: DataFrame, benchmark: DataFrame, column: str = "text", prefix: str = "",
              window: int = WINDOW) -> DataFrame:
    """``docs`` with columns n_words, n_hit and the sorted item ids, their names behind a prefix."""
    mark, masks, earlier = (f"{prefix}{n}" for n in _EARLIER)
    names = [f"{prefix}{n}" for n in FOUND]
    schema = docs.select("*", F.lit(0).cast("long").alias(names[0]),
                         F.lit(0).cast("long").alias(names[1]),
                         F.array().cast("array<string>").alias(names[2])).schema
    width, at = len(docs.columns), docs.columns.index(column)
    key = F.sha2(F.col(f"`{column}`").cast("binary"), 256)
    texts = docs.select(F.col(f"`{column}`").alias("text"), key.alias("mark"))
    *before, last = _slices(benchmark, "item_id", "text")
    stored = [_hit_texts(texts, _index(texts, part, window)) for part in before]
    if stored:
        # One row for each text that is hit, with at most one entry for each slice.
        lists = reduce(DataFrame.union, stored).groupBy(F.col("mark").alias(mark)).agg(
            F.collect_list("mask").alias(masks), F.collect_list("items").alias(earlier))
        own = [F.col(f"`{c}`") for c in docs.columns]
        docs = docs.select(*own, key.alias(mark)).join(lists, mark, "left").select(
            *own, masks, earlier)
    shared = docs.sparkSession.sparkContext.broadcast(_index(texts, last, window))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(shared.value.prefix)
        for batch in batches:
            renamed = pa.RecordBatch.from_arrays(
                batch.columns, [f"c{i}" for i in range(batch.num_columns)])
            for part in text.parts(renamed, f"c{at}"):
                words = text.Words(part.column(at), text.ALNUM, lower=True)
                hit, items = _hits(words, shared.value, lookup)
                if part.num_columns > width:
                    for r, (masks_of, items_of) in enumerate(zip(
                            part.column(width).to_pylist(), part.column(width + 1).to_pylist())):
                        low, high = words.first[r:r + 2]
                        for mask, more in zip(masks_of or [], items_of or []):
                            hit[low:high] |= np.unpackbits(
                                np.frombuffer(mask, np.uint8), count=high - low).astype(bool)
                            items[r].update(more)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:width], pa.array(words.counts, pa.int64()),
                     pa.array(text.per_row(hit, words.first), pa.int64()),
                     pa.array([_listed(s) for s in items], pa.list_(pa.string()))],
                    [*batch.schema.names[:width], *names])

    return docs.mapInArrow(work, schema)


def contamination(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id",
                  column: str = "text", window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_hit, items) of every document; items are sorted as strings."""
    rows = docs.select(F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{column}`").alias("text"))
    return with_hits(rows, benchmark, window=window).drop("text")


def decontaminate(docs: DataFrame, benchmark: DataFrame, column: str = "text",
                  window: int = WINDOW) -> DataFrame:
    """The documents without any benchmark window, with all their columns."""
    prefix = "_"
    while any(f"{prefix}{n}" in docs.columns for n in FOUND + _EARLIER):
        prefix += "_"
    marked = with_hits(docs, benchmark, column, prefix, window)
    return marked.filter(F.col(f"{prefix}n_hit") == 0).select(
        *[F.col(f"`{c}`") for c in docs.columns])
