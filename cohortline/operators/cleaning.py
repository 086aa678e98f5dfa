"""Turns the raw log into the typed, filtered table every later stage reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortline.config import RetentionConfig
from cohortline.functions import STRING_COLUMNS, is_cancelled_invoice, line_value, stripped


def trim_text(df: DataFrame) -> DataFrame:
    present = [c for c in STRING_COLUMNS if c in df.columns]
    return df.withColumns({c: stripped(c) for c in present})


def flag_cancellations(df: DataFrame) -> DataFrame:
    """A cancellation is marked by its invoice prefix; negative quantities also occur elsewhere."""
    return df.withColumn("is_cancellation", is_cancelled_invoice())


def not_adjustment() -> Column:
    return ~F.col("invoice").startswith("A")


def is_product(cfg: RetentionConfig) -> Column:
    return ~F.col("stock_code").isin(*cfg.non_product_codes)


def is_priced() -> Column:
    return F.col("price") > 0


def has_valid_sign() -> Column:
    return (F.col("quantity") > 0) | F.col("is_cancellation")


def normalise(raw: DataFrame) -> DataFrame:
    """Trimmed text and the cancellation flag: what every filter below relies on."""
    return flag_cancellations(trim_text(raw))


def keep_rules(cfg: RetentionConfig) -> list[tuple[str, Column]]:
    """The filters in the order in which they are applied and audited."""
    # Names and order of the steps.
    return [
        ("drop A-prefix invoices", not_adjustment()),
        ("drop non-product codes", is_product(cfg)),
        ("drop price <= 0", is_priced()),
        ("drop non-cancellation negatives", has_valid_sign()),
    ]


def finish(df: DataFrame) -> DataFrame:
    """Types, revenue, and the columns that are dropped when present."""
    return (
        df.withColumn("customer_id", F.col("customer_id").cast("bigint"))
        .withColumn("line_revenue", line_value())
        .drop("description", "source_sheet")
    )


def clean_transactions(raw: DataFrame, cfg: RetentionConfig) -> DataFrame:
    """Rows without a customer are kept: who can be modelled is decided later."""
    return clean_normalised(normalise(raw), cfg)


def clean_normalised(kept: DataFrame, cfg: RetentionConfig) -> DataFrame:
    """The filters and what follows them, for rows that are normalised already."""
    for _, keep in keep_rules(cfg):
        kept = kept.filter(keep)
    return finish(kept)


def cleaning_summary(raw: DataFrame, cfg: RetentionConfig) -> DataFrame:
    keep = F.lit(True)
    for _, rule in keep_rules(cfg):
        keep = keep & rule
    return normalise(raw).agg(
        F.count("*").alias("rows_in"), F.count_if(keep).alias("rows_out")
    ).withColumn("pct_removed", 100 * (F.col("rows_in") - F.col("rows_out")) / F.col("rows_in"))
