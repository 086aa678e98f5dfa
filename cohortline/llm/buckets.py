"""Hash buckets of packed arrays: many small records travel as few binary rows.

Each map task sorts its records by bucket and writes one row per bucket and part of the input; a
bucket is read by one task. Buckets are sized from the input.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = "bucket int, payload binary"
BUCKET_BYTES = 2 << 20
MOST_BUCKETS = 1 << 16


def bucket_count(items_bytes: int, per_bucket: int = BUCKET_BYTES) -> int:
    return int(min(MOST_BUCKETS, max(16, -(-int(items_bytes) // per_bucket))))


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    return docs.agg(F.sum(F.octet_length(column))).first()[0] or 0


def bucket_of(hashes: np.ndarray, n: int) -> np.ndarray:
    """By the hash's upper half, so that buckets in order hold ascending hashes."""
    return ((hashes >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int32)


def pack(bucket: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Bucket numbers and, for each, its records with columns one after the other."""
    if not len(bucket):
        return np.zeros(0, np.int32), []
    order = np.argsort(bucket, kind="stable")
    bucket, columns = bucket[order], [c[order] for c in columns]
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]])
    return bucket[cuts[:-1]], [
        b"".join(c[i:j].tobytes() for c in columns) for i, j in zip(cuts[:-1], cuts[1:])]


def packed_batch(bucket: np.ndarray, *columns: np.ndarray) -> pa.RecordBatch:
    numbers, payload = pack(bucket, *columns)
    return pa.RecordBatch.from_arrays(
        [pa.array(numbers, pa.int32()), pa.array(payload, pa.binary())], ["bucket", "payload"])


def unpack(payload: bytes, *types: str) -> list[np.ndarray]:
    n = len(payload) // sum(np.dtype(t).itemsize for t in types)
    out, at = [], 0
    for t in types:
        out.append(np.frombuffer(payload, t, n, at))
        at += n * np.dtype(t).itemsize
    return out


def unpack_all(payloads: list[bytes], *types: str) -> list[np.ndarray]:
    rows = [unpack(p, *types) for p in payloads]
    return [np.concatenate([r[i] for r in rows]) if rows else np.zeros(0, t)
            for i, t in enumerate(types)]
