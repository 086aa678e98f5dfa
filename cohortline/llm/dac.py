"""Token files of directly addressable codes.

Ids are split into chunks of ``CHUNK`` bits. Level 0 holds the lowest chunk of every id and a
continuation bitmap; the ids that go on have their next chunk in level 1, and so on. A rank
directory counts the set bits before every ``RANK`` bits, so the place of an id's next chunk is one
addition and one population count, and any token is read without decoding its neighbours.

A file holds whole documents in order of their id: a header, the document table (ids and first
tokens), and segments of ``SEGMENT`` tokens with their levels. Files follow the order of documents;
a manifest has one row for each. Files are bounded by their range of documents, and a task holds one
segment at a time.

Defined cases: null text has only the end id; null ids come first; rows with equal id follow one
another in an order that their text decides; an empty table makes no tokens.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortline.llm import store, text, tokenise
from cohortline.session import stage

CHUNK = 8
RANK = 512
SEGMENT = 1 << 18
_MANIFEST = "part int, file string, docs long, tokens long"


def _rank_directory(bits: np.ndarray) -> np.ndarray:
    """Set bits before each run of RANK bits."""
    packed = np.zeros(-(-len(bits) // RANK) * RANK // 8, np.uint8)
    packed[:-(-len(bits) // 8)] = np.packbits(bits, bitorder="little")
    runs = np.bitwise_count(packed).reshape(-1, RANK // 8).sum(axis=1)
    return (np.cumsum(runs) - runs).astype(np.uint32)


def encode(ids: np.ndarray) -> list[np.ndarray]:
    """Levels of ids below 2^32: chunks, continuation bitmap and rank directory of each."""
    out, rest = [], ids.astype(np.uint32)
    while True:
        more = rest >> CHUNK
        bits = more > 0
        out += [(rest & ((1 << CHUNK) - 1)).astype(np.uint8),
                np.packbits(bits, bitorder="little"), _rank_directory(bits)]
        rest = more[bits]
        if not len(rest):
            return out


class Codes:
    """Random access to encoded ids."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = [tuple(levels[i:i + 3]) for i in range(0, len(levels), 3)]

    def __len__(self) -> int:
        return len(self.levels[0][0])

    def _rank(self, level: int, at: np.ndarray) -> np.ndarray:
        """Set continuation bits before each position."""
        _, bits, directory = self.levels[level]
        run = at // RANK
        byte = run * (RANK // 8)
        counts = directory[run].astype(np.int64)
        for k in range(RANK // 8):
            here = byte + k
            full = here < at // 8
            if not full.any():
                break
            counts[full] += np.bitwise_count(bits[here[full]])
        last = at % 8 > 0
        mask = ((1 << (at[last] % 8)) - 1).astype(np.uint8)
        counts[last] += np.bitwise_count(bits[at[last] // 8] & mask)
        return counts

    def get(self, at: np.ndarray) -> np.ndarray:
        """Ids at any positions, without touching other ids."""
        at = np.asarray(at, np.int64)
        out, whose = np.zeros(len(at), np.uint32), np.arange(len(at))
        for level, (chunks, bits, _) in enumerate(self.levels):
            out[whose] |= chunks[at].astype(np.uint32) << (CHUNK * level)
            more = (bits[at // 8] >> (at % 8).astype(np.uint8)) & 1 == 1
            whose, at = whose[more], at[more]
            if not len(at):
                break
            at = self._rank(level, at)
        return out

    def all(self) -> np.ndarray:
        """Every id; levels in whole."""
        out = np.zeros(len(self), np.uint32)
        whose = np.arange(len(self))
        for level, (chunks, bits, _) in enumerate(self.levels):
            out[whose] |= chunks.astype(np.uint32) << (CHUNK * level)
            whose = whose[np.unpackbits(bits, count=len(chunks), bitorder="little") == 1]
        return out


class File:
    """A token file: document table at its end, segments before it."""

    def __init__(self, uri: str):
        self.raw = store.mapped(uri)
        at, size = struct.unpack("<qq", self.raw[-16:])
        ids, self.known, self.first, self.segments = store.load(self.raw[at:at + size])
        self.ids = ids
        self.tokens = int(self.first[-1])

    def codes(self, segment: int) -> Codes:
        low, high = self.segments[segment:segment + 2]
        return Codes(store.load(self.raw[low:high]))

    def get(self, at: np.ndarray) -> np.ndarray:
        """Tokens at positions of the whole file."""
        at = np.asarray(at, np.int64)
        out = np.zeros(len(at), np.uint32)
        for s in np.unique(at // SEGMENT).tolist():
            mine = at // SEGMENT == s
            out[mine] = self.codes(s).get(at[mine] % SEGMENT)
        return out


class _Writer:
    def __init__(self, folder: str, part: int):
        self.uri, self.out = store.create(folder, f"tokens-{part:08d}")
        self.part, self.held, self.size = part, [], 0
        self.at, self.segments = 0, []
        self.ids, self.known, self.counts = [], [], []

    def _segment(self, ids: np.ndarray) -> None:
        raw = store.dump(*encode(ids))
        self.segments.append(self.at)
        self.out.write(raw)
        self.at += len(raw)

    def add(self, ids: np.ndarray) -> None:
        self.held.append(ids)
        self.size += len(ids)
        if self.size >= SEGMENT:
            every = np.concatenate(self.held)
            whole = len(every) // SEGMENT * SEGMENT
            for low in range(0, whole, SEGMENT):
                self._segment(every[low:low + SEGMENT])
            self.held, self.size = [every[whole:].copy()], len(every) - whole

    def close(self) -> pa.RecordBatch:
        if self.size:
            self._segment(np.concatenate(self.held))
        counts = np.concatenate(self.counts)
        first = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        table = store.dump(np.concatenate(self.ids), np.concatenate(self.known), first,
                           np.array([*self.segments, self.at], np.int64))
        self.out.write(table + struct.pack("<qq", self.at, len(table)))
        self.out.close()
        return pa.RecordBatch.from_arrays(
            [pa.array([self.part], pa.int32()), pa.array([self.uri]), pa.array([len(counts)]),
             pa.array([int(first[-1])])], ["part", "file", "docs", "tokens"])


def write_tokens(docs: DataFrame, tokenizer: str, end: int, id_column: str = "doc_id",
                 column: str = "text") -> DataFrame:
    """Write all documents as token files in order of id; returns their manifest, stored.

    Manifest: part (files in order), file, docs, tokens.
    """
    folder = store.new_folder(docs.sparkSession, "tokens")
    rows = docs.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{column}`").alias("text"))
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text").withColumn(
        "part", F.spark_partition_id())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, encoder = None, tokenise.encoder(tokenizer)
        for batch in batches:
            for part in text.parts(batch, size=tokenise.PART_BYTES):
                writer = writer or _Writer(folder, part.column("part")[0].as_py())
                ids, counts = encoder.encode(part.column("text"))
                writer.add(tokenise.with_end(ids, counts, end))
                own = part.column("doc_id")
                writer.ids.append(own.fill_null(0).to_numpy(zero_copy_only=False))
                writer.known.append(own.is_valid().to_numpy(zero_copy_only=False))
                writer.counts.append(counts + 1)
        if writer:
            yield writer.close()

    return stage(rows.mapInArrow(work, _MANIFEST), "manifest")


def read_documents(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read from the files.

    ``start`` counts the tokens of all documents before it; the running sum is over one row for
    each file.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, base in zip(batch.column("file").to_pylist(), batch.column("base").to_pylist()):
                file = File(uri)
                crc = np.zeros(len(file.ids), np.int64)
                for s in range(len(file.segments) - 1):
                    ids = file.codes(s).all().astype("<u4")
                    low = s * SEGMENT
                    d = int(np.searchsorted(file.first, low, "right")) - 1
                    while d < len(crc) and file.first[d] < low + len(ids):
                        a, b = max(0, file.first[d] - low), file.first[d + 1] - low
                        crc[d] = zlib.crc32(ids[a:b], int(crc[d]))
                        d += 1
                for low in range(0, len(crc), 10_000):
                    use = slice(low, low + 10_000)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(file.ids[use], mask=~file.known[use]),
                         pa.array(file.first[:-1][use] + base),
                         pa.array(np.diff(file.first)[use]), pa.array(crc[use])],
                        ["doc_id", "start", "n_tokens", "ids_crc32"])

    return placed.repartitionByRange(max(1, manifest.count()), "part").mapInArrow(
        work, "doc_id long, start long, n_tokens long, ids_crc32 long")
