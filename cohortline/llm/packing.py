"""Packing into length buckets that minimise padding.

Lengths are counted into one global histogram, which has at most ``LONGEST`` rows because longer
texts are cut into pieces of that length. Dynamic programming over the histogram chooses the
``BUCKETS`` boundaries with the least padding; every piece is padded to the boundary of its bucket.
Inside a bucket, pieces in order of (id, piece) fill batches of at most ``BUDGET`` padded tokens.

Ranks inside a bucket come from slices: pieces are range-partitioned by id and stored with their
slice, ranked within (bucket, slice), and shifted by the pieces of earlier slices, so a bucket
that holds most rows is spread like any other, and the batches do not depend on the slices.

Defined cases: an empty or null text has its end mark only; null ids come first; an empty table has
no batch; a length above the budget makes batches of one piece.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortline.llm import text
from cohortline.session import stage

LONGEST = 4096
BUCKETS = 16
BUDGET = 65_536


def boundaries(lengths: np.ndarray, counts: np.ndarray, most: int) -> list[int]:
    """At most ``most`` upper bounds of buckets, those with the least total padding.

    ``lengths`` are distinct and ascending. Of equally good choices, each bucket, from the last one
    down, begins at the smallest length.
    """
    n = len(lengths)
    if not n:
        return []
    rows = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
    tokens = np.concatenate([[0], np.cumsum(counts * lengths, dtype=np.int64)])
    best = np.full(n + 1, np.iinfo(np.int64).max // 4)
    best[0] = 0
    picks = []
    for _ in range(min(most, n)):
        now, pick = best.copy(), np.full(n + 1, -1)
        for j in range(1, n + 1):
            cost = best[:j] + lengths[j - 1] * (rows[j] - rows[:j]) - (tokens[j] - tokens[:j])
            i = int(cost.argmin())
            if cost[i] < now[j]:
                now[j], pick[j] = cost[i], i
        picks.append(pick)
        best = now
    out, j = [], n
    for pick in reversed(picks):
        if j and pick[j] >= 0:
            out.append(int(lengths[j - 1]))
            j = int(pick[j])
    return out[::-1]


def word_lengths(docs: DataFrame, id_column: str = "doc_id", column: str = "text") -> DataFrame:
    """(doc_id, n): words between ASCII white space, and one for the end of the document."""
    rows = docs.select(F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{column}`").alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text.parts(batch):
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"),
                     pa.array(text.Words(part.column("text")).counts + 1, pa.int64())],
                    ["doc_id", "n"])

    return rows.mapInArrow(work, rows.select("doc_id", F.lit(0).cast("long").alias("n")).schema)


def pack(lengths: DataFrame, longest: int = LONGEST, most: int = BUCKETS,
         budget: int = BUDGET) -> DataFrame:
    """(doc_id, piece, n_tokens, bucket, batch, slot) of every piece of every document.

    ``lengths`` has columns doc_id and n > 0. ``bucket`` is the padded length, ``batch`` counts
    within it, ``slot`` within the batch.
    """
    piece = F.posexplode(F.expr(
        f"transform(sequence(0L, (n - 1) div {longest}), "
        f"i -> least({longest}L, n - i * {longest}L))"))
    pieces = lengths.select("doc_id", piece.alias("piece", "n_tokens"))
    sliced = stage(
        pieces.repartitionByRange("doc_id", "piece").withColumn("slice", F.spark_partition_id()),
        "pieces")
    # At most one row for each length up to the longest.
    histogram = sorted(tuple(r) for r in sliced.groupBy("n_tokens").count().collect())
    bounds = boundaries(np.array([h[0] for h in histogram], np.int64),
                        np.array([h[1] for h in histogram], np.int64), most)
    bucket = F.lit(None).cast("long")
    for bound in reversed(bounds):
        bucket = F.when(F.col("n_tokens") <= bound, F.lit(bound).cast("long")).otherwise(bucket)
    placed = sliced.withColumn("bucket", bucket)
    inside = Window.partitionBy("bucket", "slice").orderBy("doc_id", "piece", "n_tokens")
    earlier = Window.partitionBy("bucket").orderBy("slice").rowsBetween(
        Window.unboundedPreceding, -1)
    # One row for each bucket and slice.
    offsets = placed.groupBy("bucket", "slice").agg(F.count("*").alias("rows")).select(
        "bucket", "slice", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"))
    ranked = placed.withColumn("turn", F.row_number().over(inside)).join(
        offsets, ["bucket", "slice"]).withColumn(
            "rank", F.col("before") + F.col("turn") - 1)
    per_batch = F.greatest(F.lit(1), F.expr(f"{budget}L div bucket"))
    return ranked.select(
        "doc_id", F.col("piece").cast("long").alias("piece"), "n_tokens", "bucket",
        F.floor(F.col("rank") / per_batch).cast("long").alias("batch"),
        F.pmod("rank", per_batch).alias("slot"))
