"""SimHash near-dedup by multi-index hashing.

A fingerprint is cut into two 32-bit segments. Two fingerprints that differ in at most two bits
differ in at most one bit of one of the segments, so every fingerprint enters one table for each
segment, probes each table with the Hamming ball of radius one around its own segment, and every
match is verified on all 64 bits. Of two neighbouring segment values one has the differing bit
unset; only that one probes, which halves the ball.

A segment value may be shared by very many fingerprints. Such a group is not compared pair by pair:
each probe enumerates the ball that is left to the other segment and looks it up, so the work is
linear in the group. A group of more than ``CROWDED`` is also spread over buckets by three pieces of
the other segment, since two segments that differ in at most two bits agree in one of them. A bucket
returns a spanning forest of its links, never all pairs, and components follow from those forests by
tables in Spark.

Defined cases: a text without words has fingerprint zero and is linked like any other; null counts
as empty; fewer words than a shingle make one shingle; equal fingerprints are one node; rows that
repeat id and text are one document. Of rows with one id, or without any, that with the smallest hash
of its text comes first.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortline.llm import buckets, text
from cohortline.llm.components import components, connect
from cohortline.session import stage

SHINGLE = 3
SEED = 42
_U64 = np.uint64
_FEW = 512
CROWDED = 1 << 16
_MOST_CROWDED = 1 << 16
#: (shift, mask) of the pieces that a segment is cut into.
_PIECES = [(0, 0x7FF), (11, 0x7FF), (22, 0x3FF)]


def simhash(texts: pa.Array, shingle: int = SHINGLE) -> np.ndarray:
    """64-bit fingerprints: a bit is set if it is in more than half of the shingle hashes."""
    words = text.Words(texts, lower=True)
    joined, begin, stop = words.joined()
    first = words.window_starts(shingle)
    last = first + shingle - 1
    short = np.flatnonzero((words.counts > 0) & (words.counts < shingle))
    first = np.concatenate([first, words.first[short]])
    last = np.concatenate([last, words.first[short + 1] - 1])
    order = np.argsort(first, kind="stable")
    first, last = first[order], last[order]
    out = np.zeros(len(words.counts), _U64)
    edges = np.searchsorted(first, words.first)
    # Rows in runs, so that the unpacked bits of a batch stay small; a long text adds up its runs.
    tally = np.zeros((len(out), 64), np.int64)
    digest, step = xxhash.xxh64_intdigest, 1 << 17
    for low in range(0, len(first), step):
        high = min(len(first), low + step)
        hashes = np.fromiter(
            (digest(joined[a:b], SEED) for a, b in
             zip(begin[first[low:high]].tolist(), stop[last[low:high]].tolist())),
            _U64, high - low)
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        rows = np.flatnonzero((edges[:-1] < high) & (edges[1:] > low))
        at = np.maximum(edges[rows], low) - low
        tally[rows] += np.add.reduceat(bits, at, axis=0, dtype=np.int32)
    have = np.flatnonzero(np.diff(edges))
    set_bits = 2 * tally[have] > np.diff(edges)[have, None]
    out[have] = np.packbits(set_bits, axis=1).view(">u8").ravel().astype(_U64)
    return out


def with_fingerprints(docs: DataFrame, column: str = "text",
                      name: str = "fingerprint") -> DataFrame:
    """``docs`` with a signed 64-bit fingerprint column; all columns are carried along."""
    schema = docs.select("*", F.lit(0).cast("long").alias(name)).schema
    at = docs.columns.index(column)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            renamed = pa.RecordBatch.from_arrays(
                batch.columns, [f"c{i}" for i in range(batch.num_columns)])
            for part in text.parts(renamed, f"c{at}"):
                found = pa.array(simhash(part.column(at)).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, found], [*batch.schema.names, name])

    return docs.mapInArrow(work, schema)


def _masks(radius: int) -> np.ndarray:
    bits = [1 << b for b in range(32)]
    return np.array(
        [sum(c) for r in range(radius + 1) for c in itertools.combinations(bits, r)], _U64)


_NONE = np.zeros(0, _U64)
_BALLS = {2: _masks(2), 1: _masks(1)}


def _entries(prints: np.ndarray, n: int, crowded: np.ndarray = _NONE) -> pa.RecordBatch:
    """Table rows and probes of fingerprints, as (segment key, fingerprint) records by bucket.

    Records of ``crowded`` keys (ascending) go to one bucket for each piece of the other segment.
    """
    keys, whose = [], []
    for half in (0, 1):
        value = (prints >> _U64(32)) if half else (prints & _U64(0xFFFFFFFF))
        ball = [value] + [np.where(value & _U64(1 << b), _U64(0), value | _U64(1 << b))
                          for b in range(32)]
        for i, near in enumerate(ball):
            use = np.ones(len(prints), bool) if i == 0 else near != 0
            keys.append(near[use] | _U64(half << 32))
            whose.append(prints[use])
    key, who = np.concatenate(keys), np.concatenate(whose)
    place = text.mix(key)
    if len(crowded):
        hot = crowded[np.minimum(np.searchsorted(crowded, key), len(crowded) - 1)] == key
        other = np.where(key >> _U64(32), who, who >> _U64(32))[hot]
        pieces = [(other >> _U64(shift)) & _U64(mask) | _U64((k + 1) << 16)
                  for k, (shift, mask) in enumerate(_PIECES)]
        place = np.concatenate([place[~hot], *[text.mix(place[hot] ^ text.mix(p)) for p in pieces]])
        key, who = (np.concatenate([x[~hot], *[x[hot]] * len(pieces)]) for x in (key, who))
    return buckets.packed_batch(buckets.bucket_of(place, n), key, who)


def _crowded(prints: DataFrame, n_prints: int) -> np.ndarray:
    """Segment keys of very many fingerprints, ascending; at most ``_MOST_CROWDED``."""
    low = F.col("fingerprint").bitwiseAND(F.lit(0xFFFFFFFF))
    high = F.shiftrightunsigned("fingerprint", 32).bitwiseOR(F.lit(1 << 32))
    counts = prints.select(F.explode(F.array(low, high)).alias("key")).groupBy("key").count()
    # Fewer than 2 * n_prints / least keys can have more than ``least`` of the 2 * n_prints entries.
    least = max(CROWDED, 2 * n_prints // _MOST_CROWDED)
    rows = counts.filter(F.col("count") > least).select("key").collect()
    return np.sort(np.array([r[0] for r in rows], np.int64).view(_U64))


def _links(key: np.ndarray, who: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the verified links of one bucket."""
    order = np.lexsort((who, key))
    key, who = key[order], who[order]
    half = (key >> _U64(32)).astype(bool)
    own = np.where(half, who >> _U64(32), who & _U64(0xFFFFFFFF)) == (key & _U64(0xFFFFFFFF))
    other = np.where(half, who & _U64(0xFFFFFFFF), who >> _U64(32))
    nodes, node = np.unique(who, return_inverse=True)
    parent = np.arange(len(nodes))
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1, [len(key)]])
    for i, j in zip(cuts[:-1], cuts[1:]):
        if j - i < 2 or not own[i:j].any():
            continue
        table = np.flatnonzero(own[i:j]) + i
        for left, probes in ((2, table), (1, np.flatnonzero(~own[i:j]) + i)):
            if len(table) <= _FEW:
                for t in table:
                    near = probes[np.bitwise_count(other[probes] ^ other[t]) <= left]
                    parent = connect(parent, node[near], np.full(len(near), node[t]))
            elif len(probes):
                by = table[np.argsort(other[table])]
                values = other[by]
                for mask in _BALLS[left]:
                    want = other[probes] ^ mask
                    at = np.minimum(np.searchsorted(values, want), len(values) - 1)
                    hit = values[at] == want
                    parent = connect(parent, node[probes[hit]], node[by[at[hit]]])
    hung = np.flatnonzero(parent != np.arange(len(nodes)))
    return nodes[hung], nodes[parent[hung]]


def near_groups(prints: DataFrame) -> DataFrame:
    """(fingerprint, root) of all distinct fingerprints that have a neighbour within two bits.

    ``prints`` has a column ``fingerprint`` of distinct signed 64-bit values.
    """
    # 35 records of 16 bytes for each fingerprint, on average.
    n_prints = prints.count()
    n = buckets.bucket_count(n_prints * 35 * 16)
    crowded = _crowded(prints, n_prints)

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).view(_U64)
            for low in range(0, len(values), 20_000):
                yield _entries(values[low:low + 20_000], n, crowded)

    def match(table: pa.Table) -> pa.Table:
        key, who = buckets.unpack_all(table.column("payload").to_pylist(), "u8", "u8")
        a, b = _links(key, who)
        a, b = a.view(np.int64), b.view(np.int64)
        return pa.table({"u": np.maximum(a, b), "v": np.minimum(a, b)})

    entries = prints.select("fingerprint").mapInArrow(scatter, buckets.SCHEMA)
    links = entries.groupBy("bucket").applyInArrow(match, "u long, v long")
    return components(links).select(F.col("node").alias("fingerprint"), "root")


def _prints(docs: DataFrame, id_column: str, column: str, name: str) -> DataFrame:
    """(doc_id, fingerprint, mark) of documents with fingerprints under ``name``; stored."""
    return stage(docs.select(
        F.col(f"`{id_column}`").alias("doc_id"), F.col(name).alias("fingerprint"),
        F.xxhash64(F.col(f"`{column}`")).alias("mark")), "prints")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", column: str = "text") -> DataFrame:
    """(doc_id, fingerprint as signed long, component_id) of every document."""
    rows = docs.select(F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{column}`").alias("text"))
    prints = _prints(with_fingerprints(rows), "doc_id", "text", "fingerprint")
    return prints.join(first_documents(prints), "fingerprint").select(
        "doc_id", "fingerprint", F.col("first.doc_id").alias("component_id"))


def first_documents(prints: DataFrame) -> DataFrame:
    """(fingerprint, first) of all fingerprints: the first document reachable from it.

    ``first`` has fields doc_id and mark; the smallest doc_id comes first, then the smallest mark, and
    documents without id last.
    """
    order = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "mark")
    least = stage(
        prints.groupBy("fingerprint").agg(F.min(order).alias("least")), "distinct-prints")
    placed = least.join(stage(near_groups(least), "groups"), "fingerprint", "left").withColumn(
        "root", F.coalesce("root", "fingerprint"))
    first = placed.groupBy("root").agg(F.min("least").alias("first"))
    return placed.join(first, "root").select("fingerprint", "first")


def near_dedup(docs: DataFrame, id_column: str = "doc_id", column: str = "text") -> DataFrame:
    """The documents that stay, the first one of each component, with all their columns."""
    name = "fingerprint"
    while name in docs.columns or f"{name}_first" in docs.columns:
        name = f"_{name}"
    marked = with_fingerprints(docs, column, name)
    first = first_documents(_prints(marked, id_column, column, name)).select(
        F.col("fingerprint").alias(name), F.col("first").alias(f"{name}_first"))
    return marked.join(first, name).filter(
        F.col(f"`{id_column}`").eqNullSafe(F.col(f"{name}_first.doc_id"))
        & (F.xxhash64(F.col(f"`{column}`")) == F.col(f"{name}_first.mark"))).select(
            *[F.col(f"`{c}`") for c in docs.columns])
