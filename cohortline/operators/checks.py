"""Data contracts. Each is one fused aggregate; the ``validate_*`` forms raise on a violation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortline.config import RetentionConfig
from cohortline.functions import is_cancelled_invoice, timestamp
from cohortline.operators.duplicates import row_hashes

# Columns with a required type in the raw table, and columns of the clean table
# that may not hold nulls.
RAW_TYPES = {"invoice": T.StringType(), "stock_code": T.StringType(), "quantity": T.LongType()}
CLEAN_NOT_NULL = ("invoice", "stock_code", "quantity", "price", "line_revenue")


class ContractViolation(ValueError):
    """Raised when a table breaks its contract."""


def raw_counts() -> list[Column]:
    """Aggregates of the raw contract; they can be observed while the table is written."""
    return [
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("invoice").isNull()).alias("null_invoices"),
        F.count_if(is_cancelled_invoice()).alias("cancellation_rows"),
    ]


def raw_contract(raw: DataFrame) -> DataFrame:
    return raw.agg(*raw_counts())


def require_raw_types(raw: DataFrame) -> None:
    for column, wanted in RAW_TYPES.items():
        found = raw.schema[column].dataType
        if found != wanted:
            raise TypeError(f"{column} must be {wanted.simpleString()}, not {found.simpleString()}")


def require_raw(counts: dict) -> None:
    if counts["null_invoices"]:
        raise ContractViolation(f"{counts['null_invoices']} rows without an invoice")
    if not counts["cancellation_rows"]:
        raise ContractViolation("no cancellation invoice (prefix C) in the whole table")


def validate_raw(raw: DataFrame) -> None:
    require_raw_types(raw)
    require_raw(raw_contract(raw).first().asDict())


def clean_counts() -> list[Column]:
    """Aggregates of the clean contract; they can be observed while the table is written."""
    sign_disagrees = (F.col("quantity") < 0) != F.col("is_cancellation")
    return [
        F.count_if(F.col("invoice").startswith("A")).alias("adjustment_rows"),
        F.count_if(F.col("price") <= 0).alias("unpriced_rows"),
        F.count_if(sign_disagrees).alias("sign_disagreements"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in CLEAN_NOT_NULL],
    ]


def clean_contract(clean: DataFrame) -> DataFrame:
    return clean.agg(*clean_counts())


def require_clean(counts: dict) -> None:
    broken = {k: n for k, n in counts.items() if n}
    if broken:
        raise ContractViolation(f"clean table: {broken}")


def validate_clean(clean: DataFrame) -> None:
    require_clean(clean_contract(clean).first().asDict())


def _per_column(df: DataFrame, columns: list[str], test, value_name: str) -> DataFrame:
    """(column, count of rows for which ``test`` holds), from one scan."""
    counts = df.agg(*[F.count_if(test(F.col(f"`{c}`"))).alias(c) for c in columns])
    return counts.unpivot([], [F.col(f"`{c}`") for c in columns], "column", value_name)


def null_counts(df: DataFrame) -> DataFrame:
    return _per_column(df, df.columns, Column.isNull, "n_null")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def infinite_counts(df: DataFrame) -> DataFrame:
    return _per_column(
        df, numeric_columns(df),
        lambda c: F.abs(c.cast("double")) == float("inf"), "n_infinite")


def validate_features(features: DataFrame) -> None:
    """No null anywhere and no infinity in a numeric column, checked in a single pass."""
    nulls = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"null {c}") for c in features.columns]
    infinities = [
        F.count_if(F.abs(F.col(f"`{c}`").cast("double")) == float("inf")).alias(f"infinite {c}")
        for c in numeric_columns(features)
    ]
    broken = {k: n for k, n in features.agg(*nulls, *infinities).first().asDict().items() if n}
    if broken:
        raise ContractViolation(f"customer features: {broken}")


def temporal_guard(observed: DataFrame, predicted: DataFrame, cfg: RetentionConfig) -> DataFrame:
    """Half-open windows of the rows that features and labels are made of.

    Observed rows end before the cutoff, predicted ones lie between it and the horizon.
    """
    date, cutoff, end = F.col("invoice_date"), timestamp(cfg.cutoff), timestamp(cfg.prediction_end)
    sides = observed.select(date, F.lit(True).alias("past")).unionByName(
        predicted.select(date, F.lit(False).alias("past")))
    return sides.agg(
        F.max(F.when(F.col("past"), date)).alias("last_observation"),
        F.min(F.when(~F.col("past"), date)).alias("first_prediction"),
        F.count_if(~F.col("past") & (date >= end)).alias("rows_beyond_horizon"),
    ).withColumn(
        "holds",
        (F.col("last_observation") < cutoff)
        & (F.col("first_prediction") >= cutoff)
        & (F.col("rows_beyond_horizon") == 0),
    )


def validate_windows(observed: DataFrame, predicted: DataFrame, cfg: RetentionConfig) -> None:
    guard = temporal_guard(observed, predicted, cfg).first()
    if not guard.holds:
        raise ContractViolation(f"time windows: {guard.asDict()}")


def frame_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows whose multiplicity differs, with ``surplus`` > 0 where ``left`` has more.

    Both directions of a multiset difference from one shuffle. Empty means equal.
    """
    signed = left.withColumn("surplus", F.lit(1)).unionByName(
        right.withColumn("surplus", F.lit(-1)))
    columns = [F.col(f"`{c}`") for c in left.columns]
    return signed.groupBy(*columns).agg(F.sum("surplus").alias("surplus")).filter("surplus <> 0")


def fingerprint_sums(df: DataFrame) -> list[Column]:
    """Row count and sums of two row hashes: equal for equal rows in any order, without a shuffle.

    A null counts by its place, so it cannot be mistaken for an absent value of another column, and
    negative zero equals zero. Sums are wide decimals, which do not overflow.
    """
    return [F.count(F.lit(1)).alias("n_rows"), *[
        F.sum(h.cast("decimal(38,0)")).alias(f"hash_sum_{i}") for i, h in enumerate(row_hashes(df))]]


def fingerprint(df: DataFrame) -> DataFrame:
    """One row that depends on the rows of ``df`` and how often each occurs, and on nothing else."""
    return df.agg(*fingerprint_sums(df))


def frames_match(left: DataFrame, right: DataFrame) -> bool:
    """Same columns and same fingerprint; reads each side once and shuffles no row."""
    return left.dtypes == right.dtypes and fingerprint(left).first() == fingerprint(right).first()


def frames_equal(left: DataFrame, right: DataFrame) -> bool:
    same_columns = left.dtypes == right.dtypes
    return same_columns and frame_difference(left, right).isEmpty()


def key_overlap(train: DataFrame, test: DataFrame, key: str = "customer_id") -> DataFrame:
    """Keys that occur on both sides; each side is counted once per key."""
    sides = train.select(key, F.lit(1).alias("side")).unionByName(
        test.select(key, F.lit(2).alias("side")))
    return (
        sides.groupBy(key).agg(F.min("side").alias("low"), F.max("side").alias("high"))
        .agg(
            F.count_if(F.col("low") == 1).alias("train_keys"),
            F.count_if(F.col("high") == 2).alias("test_keys"),
            F.count_if(F.col("low") != F.col("high")).alias("shared_keys"),
        )
    )


def join_row_counts(left: DataFrame, right: DataFrame, key: str = "customer_id") -> DataFrame:
    """Rows on each side and after the inner join on ``key``; equal counts mean nothing was lost.

    Counted from per-key multiplicities, so repeated keys are not multiplied out.
    """
    sides = left.select(key, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        right.select(key, F.lit(0).alias("l"), F.lit(1).alias("r")))
    per_key = sides.groupBy(key).agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
    matched = F.when(F.col(key).isNotNull(), F.col("l") * F.col("r")).otherwise(0)
    return per_key.agg(
        F.sum("l").alias("left_rows"),
        F.sum("r").alias("right_rows"),
        F.sum(matched).alias("joined_rows"),
    )


def unmatched_keys(scored: DataFrame, expected: DataFrame, key: str = "customer_id") -> DataFrame:
    """Predictions line up with their rows when no key is left over on either side."""
    joined = scored.select(key, F.lit(1).alias("scored")).join(
        expected.select(key, F.lit(1).alias("expected")), key, "full_outer")
    return joined.agg(
        F.count("scored").alias("scored_rows"),
        F.count("expected").alias("expected_rows"),
        F.count_if(F.col("scored").isNull() | F.col("expected").isNull()).alias("unmatched_rows"),
    )
