"""Exact, seeded, stratified splits and folds.

Rows are ordered within a class by a seeded hash of their key, so membership depends on
nothing but seed and key. Ranks are taken inside hash-prefix buckets and shifted by the
buckets before them; no class is ranked by a single task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortline.config import RetentionConfig

# Hash prefix length: at most 16**4 buckets per class, whatever the number of rows.
PREFIX_DIGITS = 4


def ranked_within_class(keys: DataFrame, seed: int) -> DataFrame:
    """(customer_id, y, rank): 1-based rank by seeded hash within ``y``.

    ``keys`` is read twice, so pass a stored table.
    """
    drawn = keys.select("customer_id", "y").withColumn(
        "draw", F.md5(F.concat(F.lit(f"{seed}:"), F.col("customer_id").cast("string")))
    ).withColumn("bucket", F.substring("draw", 1, PREFIX_DIGITS))
    earlier = Window.partitionBy("y").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = drawn.groupBy("y", "bucket").agg(F.count("*").alias("n")).select(
        "y", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("y", "bucket").orderBy("draw", "customer_id")
    # Null-safe: rows without a class are a class of their own.
    offsets = offsets.withColumnsRenamed({"y": "of_class", "bucket": "of_bucket"})
    same = F.col("y").eqNullSafe(F.col("of_class")) & (F.col("bucket") == F.col("of_bucket"))
    return drawn.join(offsets, same).select(
        "customer_id", "y", (F.col("before") + F.row_number().over(inside)).alias("rank"))


def test_quotas(keys: DataFrame, cfg: RetentionConfig) -> DataFrame:
    """Test rows per class: ceil(share * n) in total, by largest remainder. One row per class."""
    everything = Window.partitionBy(F.lit(0))
    n_test = F.ceil(F.lit(cfg.test_size) * F.col("n"))
    by_remainder = everything.orderBy(F.col("remainder").desc(), F.col("y"))
    return (
        keys.groupBy("y").agg(F.count("*").alias("n_class"))
        .withColumn("n", F.sum("n_class").over(everything))
        .withColumn("n_test", n_test)
        .withColumn("base", F.floor(F.col("n_test") * F.col("n_class") / F.col("n")))
        .withColumn("remainder", (F.col("n_test") * F.col("n_class")) % F.col("n"))
        .withColumn("left_over", F.col("n_test") - F.sum("base").over(everything))
        .withColumn("place", F.row_number().over(by_remainder))
        .select("y", (F.col("base") + (F.col("place") <= F.col("left_over")).cast("bigint"))
                .alias("quota"))
    )


def assign_split(keys: DataFrame, cfg: RetentionConfig) -> DataFrame:
    """(customer_id, y, split) with exact class shares."""
    # Quotas hold one row per class, so sending them to every task is safe.
    quotas = test_quotas(keys, cfg).withColumnRenamed("y", "of_class")
    ranked = ranked_within_class(keys, cfg.seed).join(
        F.broadcast(quotas), F.col("y").eqNullSafe(F.col("of_class")))
    split = F.when(F.col("rank") <= F.col("quota"), "test").otherwise("train")
    return ranked.select("customer_id", "y", split.alias("split"))


def assign_folds(train: DataFrame, cfg: RetentionConfig) -> DataFrame:
    """(customer_id, y, fold): folds 0..n-1, class counts within one row of each other."""
    fold = ((F.col("rank") - 1) % cfg.n_folds).cast("int")
    return ranked_within_class(train, cfg.seed).select("customer_id", "y", fold.alias("fold"))


def fold_summary(folds: DataFrame) -> DataFrame:
    return folds.groupBy("fold").agg(
        F.count("*").alias("n_rows"), F.avg("y").alias("base_rate"))
