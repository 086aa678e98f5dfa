"""Encoded feature matrix with a pinned vocabulary and column order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortline.config import RetentionConfig


def one_hot_country(features: DataFrame, cfg: RetentionConfig) -> DataFrame:
    """Indicators come from the vocabulary, never from the batch at hand."""
    return features.withColumns({
        name: (F.col("country") == value).cast("tinyint")
        for name, value in zip(cfg.country_columns, cfg.country_vocab)
    }).drop("country")


def encode_features(features: DataFrame, cfg: RetentionConfig) -> DataFrame:
    """Fixed columns in fixed order; pinned columns that are absent become 0."""
    encoded = one_hot_country(features, cfg)
    if "is_single_order_customer" in encoded.columns:
        encoded = encoded.withColumn(
            "is_single_order_customer", F.col("is_single_order_customer").cast("tinyint"))
    keys = [c for c in ("customer_id", "y") if c in encoded.columns]
    return encoded.select(*keys, *[
        F.col(f"`{c}`") if c in encoded.columns else F.lit(0).cast("tinyint").alias(c)
        for c in cfg.feature_columns
    ])


def labelled_matrix(labels: DataFrame, encoded: DataFrame, cfg: RetentionConfig) -> DataFrame:
    return labels.join(encoded, "customer_id").select(
        "customer_id", "y", *[F.col(f"`{c}`") for c in cfg.feature_columns])


def standardise(df: DataFrame, train: DataFrame, columns: list[str]) -> DataFrame:
    """Columns scaled by the population mean and deviation of ``train``; the rest unchanged.

    A column that is constant in ``train`` is centred only. The statistics are one row.
    """
    stats = train.agg(
        *[F.avg(c).alias(f"{c}__mean") for c in columns],
        *[F.stddev_pop(c).alias(f"{c}__std") for c in columns],
    )
    packed = stats.select(F.struct("*").alias("stats"))
    scaled = {
        c: (F.col(c) - F.col(f"stats.{c}__mean"))
        / F.when(F.col(f"stats.{c}__std") == 0, 1.0).otherwise(F.col(f"stats.{c}__std"))
        for c in columns
    }
    return df.withColumn("stats", packed.scalar()).withColumns(scaled).drop("stats")
