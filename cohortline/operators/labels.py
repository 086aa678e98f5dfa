"""Population and label: two disjoint windows of real purchases."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortline.config import RetentionConfig
from cohortline.functions import timestamp


def real_purchases(tx: DataFrame, start: datetime | None, end: datetime | None) -> DataFrame:
    """Attributed, non-cancelled rows in ``[start, end)``; either bound may be open."""
    rows = tx.filter(~F.col("is_cancellation") & F.col("customer_id").isNotNull())
    if start is not None:
        rows = rows.filter(F.col("invoice_date") >= timestamp(start))
    if end is not None:
        rows = rows.filter(F.col("invoice_date") < timestamp(end))
    return rows


def build_population(tx: DataFrame, cfg: RetentionConfig) -> DataFrame:
    return real_purchases(tx, None, cfg.cutoff).select("customer_id").distinct()


def build_labels(tx: DataFrame, cfg: RetentionConfig) -> DataFrame:
    """(customer_id, y): bought before the cutoff, and whether they bought again after it.

    Both windows are flags of one aggregate, so the log is shuffled once, pre-combined.
    """
    observed = F.col("invoice_date") < timestamp(cfg.cutoff)
    return (
        real_purchases(tx, None, cfg.prediction_end)
        .groupBy("customer_id")
        .agg(F.max(observed).alias("in_population"), F.max(~observed).alias("repeats"))
        .filter("in_population")
        .select("customer_id", F.col("repeats").cast("tinyint").alias("y"))
    )
