"""What each cleaning step removes, measured against the original table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from cohortline.config import RetentionConfig
from cohortline.functions import (
    STRING_COLUMNS,
    gross_value,
    invoice_kind,
    is_standard_code,
    stripped,
)
from cohortline.operators.checks import ContractViolation
from cohortline.operators.cleaning import keep_rules, normalise
from cohortline.operators.duplicates import surplus_rows


def _dropped_by(cfg: RetentionConfig) -> Column:
    """Number of the first rule that drops the row, 0 when it is kept.

    A rule that evaluates to null drops the row, as a filter would.
    """
    rules = keep_rules(cfg)
    tag = F.lit(0)
    for number, (_, keep) in reversed(list(enumerate(rules, start=1))):
        tag = F.when(F.coalesce(keep, F.lit(False)), tag).otherwise(number)
    return tag


def _by_step(raw: DataFrame, cfg: RetentionConfig) -> DataFrame:
    """At most five rows: rows and gross revenue by dropping step, from one pass."""
    return (
        normalise(raw).withColumn("step_no", _dropped_by(cfg))
        .groupBy("step_no")
        .agg(F.count("*").alias("n"), F.coalesce(F.sum(gross_value()), F.lit(0.0)).alias("gross"))
    )


def filter_audit(raw: DataFrame, cfg: RetentionConfig) -> DataFrame:
    names = [name for name, _ in keep_rules(cfg)]
    totals = _by_step(raw, cfg).agg(
        F.sum("n").alias("start_rows"),
        F.sum("gross").alias("start_gross"),
        *[F.coalesce(F.sum(F.when(F.col("step_no") == i, F.col("n"))), F.lit(0)).alias(f"n{i}")
          for i in range(1, len(names) + 1)],
        *[F.coalesce(F.sum(F.when(F.col("step_no") == i, F.col("gross"))), F.lit(0.0)).alias(f"g{i}")
          for i in range(1, len(names) + 1)],
    )

    def entry(i: int, name: str) -> Column:
        removed_before = reduce(
            lambda a, b: a + b, [F.col(f"n{j}") for j in range(1, i)], F.lit(0))
        return F.struct(
            F.lit(i).alias("step_no"),
            F.lit(name).alias("step"),
            (F.col("start_rows") - removed_before).alias("rows_before"),
            F.col(f"n{i}").alias("rows_removed"),
            (100 * F.col(f"n{i}") / F.col("start_rows")).alias("pct_rows"),
            (100 * F.col(f"g{i}") / F.col("start_gross")).alias("pct_gross_revenue"),
        )

    return totals.select(
        F.inline(F.array(*[entry(i, name) for i, name in enumerate(names, start=1)])))


def audit_totals(raw: DataFrame, cfg: RetentionConfig) -> DataFrame:
    dropped = F.col("step_no") > 0
    return _by_step(raw, cfg).agg(
        F.sum("n").alias("rows_before"),
        F.coalesce(F.sum(F.when(~dropped, F.col("n"))), F.lit(0)).alias("rows_after"),
        F.coalesce(F.sum(F.when(dropped, F.col("n"))), F.lit(0)).alias("rows_removed"),
        (100 * F.coalesce(F.sum(F.when(dropped, F.col("n"))), F.lit(0)) / F.sum("n")).alias("pct_rows"),
        (100 * F.coalesce(F.sum(F.when(dropped, F.col("gross"))), F.lit(0.0)) / F.sum("gross"))
        .alias("pct_gross_revenue"),
    )


def trim_changes(raw: DataFrame) -> DataFrame:
    """Rows that trimming changes, per text column."""
    present = [c for c in STRING_COLUMNS if c in raw.columns]
    return raw.agg(
        *[F.count_if(F.col(c) != stripped(c)).alias(c) for c in present]
    ).unpivot([], present, "column", "rows_changed")


def trim_samples(raw: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` distinct before/after pairs per text column, in text order."""
    present = [c for c in STRING_COLUMNS if c in raw.columns]
    changed = (
        raw.unpivot([], present, "column", "before")
        .withColumn("after", stripped("before"))
        .filter(F.col("before") != F.col("after"))
        .distinct()
    )
    # A rank filter over a small n is cut to n rows per column before the shuffle.
    order = Window.partitionBy("column").orderBy("before")
    return changed.withColumn("position", F.row_number().over(order)).filter(
        F.col("position") <= n)


def code_identity(raw: DataFrame) -> DataFrame:
    """Distinct codes before and after trimming, and trimmed codes that already existed."""
    codes = raw.select("stock_code").filter(F.col("stock_code").isNotNull()).distinct()
    per_trimmed = codes.groupBy(stripped("stock_code").alias("trimmed")).agg(
        F.count("*").alias("spellings"),
        F.count_if(F.col("stock_code") == stripped("stock_code")).alias("exact"),
    )
    return per_trimmed.agg(
        F.coalesce(F.sum("spellings"), F.lit(0)).alias("codes_before"),
        F.count("*").alias("codes_after"),
        F.coalesce(F.sum(F.col("spellings") - F.col("exact")), F.lit(0)).alias("codes_trimmed"),
        F.coalesce(
            F.sum(F.when(F.col("exact") > 0, F.col("spellings") - F.col("exact"))), F.lit(0)
        ).alias("trimmed_already_present"),
    )


def drop_list_coverage(raw: DataFrame, cfg: RetentionConfig) -> DataFrame:
    listed = normalise(raw).filter(F.col("stock_code").isin(*cfg.non_product_codes))
    return listed.agg(F.count_distinct("stock_code").alias("codes_present")).withColumn(
        "codes_listed", F.lit(len(cfg.non_product_codes)))


def odd_survivors(raw: DataFrame, cfg: RetentionConfig) -> DataFrame:
    """Codes that do not look like products but pass the first two filters."""
    survivors = normalise(raw)
    for _, keep in keep_rules(cfg)[:2]:
        survivors = survivors.filter(keep)
    return (
        survivors.filter(~is_standard_code())
        .groupBy("stock_code")
        .agg(F.count("*").alias("n_rows"), F.min("description").alias("example_description"))
    )


def invoice_kinds_left(raw: DataFrame, cfg: RetentionConfig) -> DataFrame:
    """Kinds of invoice after adjustments are dropped; UNCLASSIFIED must not be among them."""
    (_, not_adjusted), *_ = keep_rules(cfg)
    kept = normalise(raw).filter(not_adjusted)
    return kept.groupBy(invoice_kind().alias("kind")).agg(F.count("*").alias("n_rows"))


def price_filter_losses(raw: DataFrame, cfg: RetentionConfig) -> DataFrame:
    """What the price rule removes; it must never remove a real cancellation."""
    _, _, (_, priced), _ = keep_rules(cfg)
    before = normalise(raw)
    for _, keep in keep_rules(cfg)[:2]:
        before = before.filter(keep)
    return before.filter(~priced).agg(
        F.count("*").alias("rows_removed"),
        F.count_if("is_cancellation").alias("cancellations_removed"),
        F.count_if(F.col("customer_id").isNull()).alias("unattributed_removed"),
    )


def filter_counts(cfg: RetentionConfig) -> list[Column]:
    """Aggregates over normalised rows that show what the filters do; can be observed on the way.

    Rows in and out, rows that each rule drops, lost cancellations, invoices of unknown kind.
    """
    rules = keep_rules(cfg)
    dropped = _dropped_by(cfg)
    not_adjusted, priced_rule = rules[0][1], 3
    return [
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(dropped == 0).alias("rows_out"),
        *[F.count_if(dropped == i).alias(f"dropped_{i}") for i in range(1, len(rules) + 1)],
        # A null price is dropped without being at or below zero, which is not the price rule's doing.
        F.count_if((dropped == priced_rule) & ~rules[priced_rule - 1][1] & F.col("is_cancellation")).alias(
            "lost_cancellations"),
        F.count_if(not_adjusted & (invoice_kind() == "UNCLASSIFIED")).alias("unknown_invoices"),
    ]


def require_filters(counts: dict) -> None:
    """The price rule loses no real cancellation, and every invoice left has a known kind."""
    if counts["lost_cancellations"]:
        raise ContractViolation(f"the price rule removes {counts['lost_cancellations']} cancellations")
    if counts["unknown_invoices"]:
        raise ContractViolation(f"{counts['unknown_invoices']} rows with an unknown kind of invoice")


def validate_filters(raw: DataFrame, cfg: RetentionConfig) -> None:
    require_filters(normalise(raw).agg(*filter_counts(cfg)).first().asDict())


def clean_profile(clean: DataFrame) -> DataFrame:
    """Nulls, distinct keys, revenue range and kept duplicates of the clean table.

    Only duplicates travel as whole rows; each distinct count reads its own column.
    """
    repeated = surplus_rows(clean)
    customers, invoices = (
        clean.select(c).distinct().agg(F.count(c)).scalar() for c in ("customer_id", "invoice"))
    return clean.agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("customer_id").isNull()).alias("null_customer_rows"),
        F.min("line_revenue").alias("min_revenue"),
        F.max("line_revenue").alias("max_revenue"),
        F.sum("line_revenue").alias("sum_revenue"),
    ).withColumns({"distinct_customers": customers, "distinct_invoices": invoices,
                   "duplicate_rows": repeated})
