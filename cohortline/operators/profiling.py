"""Exploratory aggregates over the raw log and the customer table.

Every profile is a whole-table aggregate; limits appear only where the result is a top-k list.
Ties in top-k lists are broken by the listed key so that results repeat.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortline.config import RetentionConfig
from cohortline.functions import (
    STRING_COLUMNS,
    invoice_kind,
    is_cancelled_invoice,
    is_standard_code,
    line_value,
    stripped,
    timestamp,
    whole_days,
)
from cohortline.operators.checks import null_counts
from cohortline.operators.duplicates import repeated_rows, surplus_rows
from cohortline.operators.labels import real_purchases
from cohortline.operators.ordered import exact_quantiles, medians

# ISO weekday numbers.
WEEKDAYS = {1: "Monday", 2: "Tuesday", 3: "Wednesday", 4: "Thursday", 5: "Friday",
            6: "Saturday", 7: "Sunday"}
# Caps and number of bins of the label histograms.
HISTOGRAM_CAPS = {"recency_days": 730, "frequency": 30, "monetary": 10_000}
HISTOGRAM_BINS = 40

IS_UNATTRIBUTED = "customer_id IS NULL"


def _pct(part: Column, whole: Column) -> Column:
    return F.when(whole != 0, 100 * part / whole)


def _rows() -> Column:
    return F.count("*").alias("n_rows")


# ---- shape and missing values --------------------------------------------------------------

def shape_by_part(raw: DataFrame) -> DataFrame:
    return raw.groupBy("source_sheet").agg(
        _rows(), F.min("invoice_date").alias("first_date"), F.max("invoice_date").alias("last_date"))


def head(raw: DataFrame, n: int = 3) -> DataFrame:
    """The first rows in a stable order."""
    return raw.orderBy("invoice_date", "invoice", "stock_code", "quantity", "price").limit(n)


def null_profile(raw: DataFrame) -> DataFrame:
    n_rows = raw.agg(F.count("*")).scalar()
    return null_counts(raw).withColumn("pct", _pct(F.col("n_null"), n_rows))


def blank_counts(raw: DataFrame) -> DataFrame:
    columns = [c for c in STRING_COLUMNS if c in raw.columns]
    return raw.agg(
        *[F.count_if(F.length(stripped(c)) == 0).alias(c) for c in columns]
    ).unpivot([], columns, "column", "n_blank")


# The defaults of the operators below are the figures reported for the log.

def short_descriptions(raw: DataFrame, longest: int = 3) -> DataFrame:
    """Notes typed in place of a product name."""
    return raw.filter(F.length(stripped("description")) <= longest).groupBy("description").agg(
        _rows())


def unattributed_share(raw: DataFrame) -> DataFrame:
    """Rows, revenue and invoices without a customer; invoices are reduced to one row first."""
    missing = F.expr(IS_UNATTRIBUTED)
    per_invoice = raw.groupBy("invoice").agg(
        F.count_if(missing).alias("n_null"), _rows(), F.sum(line_value()).alias("revenue"),
        F.sum(F.when(missing, line_value())).alias("null_revenue"))
    known = F.col("invoice").isNotNull()
    return per_invoice.agg(
        F.sum("n_null").alias("null_rows"),
        _pct(F.sum("n_null"), F.sum("n_rows")).alias("pct_rows"),
        _pct(F.coalesce(F.sum("null_revenue"), F.lit(0.0)), F.sum("revenue")).alias("pct_revenue"),
        F.count_if(known & (F.col("n_null") > 0)).alias("null_invoices"),
        F.count_if(known).alias("all_invoices"),
    )


def mixed_invoices(raw: DataFrame) -> DataFrame:
    """Invoices with both attributed and unattributed rows."""
    return raw.groupBy("invoice").agg(
        F.count_if(F.expr(IS_UNATTRIBUTED)).alias("n_null"), _rows()
    ).filter((F.col("n_null") > 0) & (F.col("n_null") < F.col("n_rows")))


def distinct_customers(raw: DataFrame) -> DataFrame:
    """Distinct keys without nulls, and with null counted as one more value."""
    return raw.agg(
        F.count_distinct("customer_id").alias("without_null"),
        F.max(F.expr(IS_UNATTRIBUTED).cast("int")).alias("has_null"),
    ).select("without_null", (F.col("without_null") + F.col("has_null")).alias("null_as_value"))


# ---- what kinds of rows there are ----------------------------------------------------------

def sign_crosstab(raw: DataFrame) -> DataFrame:
    c, negative = is_cancelled_invoice(), F.col("quantity") < 0
    return raw.agg(
        F.count_if(c).alias("c_prefix"),
        F.count_if(negative).alias("negative"),
        F.count_if(c & negative).alias("both"),
        F.count_if(c & ~negative).alias("c_not_negative"),
        F.count_if(negative & ~c).alias("negative_not_c"),
    )


def _gap_rows(raw: DataFrame) -> DataFrame:
    return raw.filter((F.col("quantity") < 0) & ~is_cancelled_invoice())


def gap_profile(raw: DataFrame) -> DataFrame:
    """Negative rows that are not cancellations."""
    return _gap_rows(raw).agg(
        _rows(),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        _pct(F.count_if(F.expr(IS_UNATTRIBUTED)), F.count("*")).alias("pct_unattributed"),
    )


def gap_descriptions(raw: DataFrame, k: int = 12) -> DataFrame:
    return _gap_rows(raw).groupBy("description").agg(_rows()).orderBy(
        F.col("n_rows").desc(), F.col("description").asc_nulls_first()).limit(k)


def invoice_kinds(raw: DataFrame) -> DataFrame:
    return raw.groupBy(invoice_kind().alias("kind")).agg(
        _rows(),
        F.count_distinct("invoice").alias("invoices"),
        F.sum(line_value()).alias("revenue"),
    )


def code_shapes(raw: DataFrame) -> DataFrame:
    standard = is_standard_code()
    return raw.agg(
        F.count_if(standard).alias("standard_rows"),
        _pct(F.count_if(standard), F.count("*")).alias("pct_standard"),
        F.count_if(~standard).alias("other_rows"),
        F.count_distinct(F.when(~standard, F.col("stock_code"))).alias("other_codes"),
    )


def code_taxonomy(raw: DataFrame) -> DataFrame:
    return raw.filter(~is_standard_code()).groupBy("stock_code").agg(
        _rows(), F.min("description").alias("example_description"))


# ---- price, quantity, duplicates -----------------------------------------------------------

def price_anomalies(raw: DataFrame) -> DataFrame:
    zero = F.col("price") == 0
    return raw.agg(
        F.count_if(zero).alias("zero_price_rows"),
        _pct(F.count_if(zero & F.expr(IS_UNATTRIBUTED)), F.count_if(zero))
        .alias("pct_zero_unattributed"),
        F.count_if(F.col("price") < 0).alias("negative_price_rows"),
    )


def quantity_summary(raw: DataFrame) -> DataFrame:
    """Median by interpolation, 99th percentile by nearest rank, and the range."""
    ranked = exact_quantiles(raw, ["quantity"], [0.5, 0.99], nearest=[0.99]).select("quantiles")
    return raw.agg(
        F.min("quantity").alias("min_quantity"), F.max("quantity").alias("max_quantity")
    ).withColumn("ranked", ranked.scalar()).select(
        F.col("ranked")[0].alias("median_quantity"), F.col("ranked")[1].alias("p99_quantity"),
        "min_quantity", "max_quantity")


def extreme_quantities(raw: DataFrame, above: int = 70_000) -> DataFrame:
    return raw.filter(F.abs("quantity") > above).select(
        "invoice", "stock_code", "description", "quantity", "price", "customer_id", "invoice_date")


def duplicate_rows(raw: DataFrame) -> DataFrame:
    counted = raw.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("duplicate_rows", surplus_rows(raw))
    return counted.select("duplicate_rows", _pct(
        F.col("duplicate_rows"), F.nullif(F.col("n_rows"), F.lit(0))).alias("pct"))


def most_repeated(raw: DataFrame, k: int = 5) -> DataFrame:
    order = [F.col("copies").desc(), "invoice", "stock_code", "quantity", "price",
             F.col("description").asc_nulls_first()]
    return repeated_rows(raw).orderBy(*order).limit(k).select(
        "invoice", "stock_code", "description", "quantity", "price", "copies")


# ---- country -------------------------------------------------------------------------------

def customers_per_country(raw: DataFrame) -> DataFrame:
    return raw.filter(~F.expr(IS_UNATTRIBUTED)).groupBy("country").agg(
        F.count_distinct("customer_id").alias("customers"))


def top_country_coverage(per_country: DataFrame, sizes=(1, 5, 10, 15)) -> DataFrame:
    """Share of customers in the N largest countries, for several N.

    Only the largest N rows are ranked; the total is a scalar of its own.
    """
    total = per_country.agg(F.sum("customers")).scalar()
    order = [F.col("customers").desc(), F.col("country")]
    largest = per_country.orderBy(*order).limit(max(sizes))
    ranked = largest.withColumn(
        "place", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order)))
    shares = ranked.agg(
        *[F.sum(F.when(F.col("place") <= n, F.col("customers"))).alias(f"top_{n}") for n in sizes]
    ).withColumn("total", total)
    return shares.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("top_n"), _pct(F.col(f"top_{n}"), F.col("total")).alias("pct"))
        for n in sizes
    ])))


def rare_countries(per_country: DataFrame, cfg: RetentionConfig) -> DataFrame:
    rare = F.col("customers") < cfg.min_country_customers
    return per_country.agg(
        F.count("*").alias("countries"), F.count_if(rare).alias("rare_countries"))


def multi_country_customers(raw: DataFrame) -> DataFrame:
    return raw.filter(~F.expr(IS_UNATTRIBUTED)).groupBy("customer_id").agg(
        F.count_distinct("country").alias("n_countries")).filter("n_countries > 1")


# ---- population and label ------------------------------------------------------------------

def population_funnel(raw: DataFrame, cfg: RetentionConfig) -> DataFrame:
    """Customers with any activity before the cutoff, with a purchase, and with neither."""
    per_customer = raw.filter(
        ~F.expr(IS_UNATTRIBUTED) & (F.col("invoice_date") < timestamp(cfg.cutoff))
    ).groupBy("customer_id").agg(F.max(~is_cancelled_invoice()).alias("bought"))
    return per_customer.agg(
        F.count("*").alias("any_activity"),
        F.count_if("bought").alias("real_buyers"),
        F.count_if(~F.col("bought")).alias("cancel_only"),
    )


def base_rate(labels: DataFrame) -> DataFrame:
    y = F.col("y").cast("int")
    return labels.agg(
        F.count("*").alias("customers"), F.sum(y).alias("repeaters"),
        F.count_if(y == 0).alias("non_repeaters"), F.avg(y).alias("base_rate"))


RFM_FEATURES = ("recency_days", "frequency", "monetary", "tenure_days")


def medians_by_label(rfm: DataFrame) -> DataFrame:
    return medians(rfm, RFM_FEATURES, by=["y"])


def label_correlations(rfm: DataFrame) -> DataFrame:
    return rfm.agg(*[
        F.corr(F.col(c).cast("double"), F.col("y").cast("double")).alias(c) for c in RFM_FEATURES
    ]).unpivot([], list(RFM_FEATURES), "feature", "correlation")


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """All pairs of a short column list, from one scan; one output row per column."""
    def pair(a: str, b: str) -> Column:
        return F.corr(F.col(a).cast("double"), F.col(b).cast("double"))

    flat = df.agg(*[
        pair(a, b).alias(f"{i}_{j}")
        for i, a in enumerate(columns) for j, b in enumerate(columns) if i < j
    ])
    rows = [
        F.struct(F.lit(a).alias("feature"), *[
            (F.lit(1.0) if i == j else F.col(f"{min(i, j)}_{max(i, j)}")).alias(b)
            for j, b in enumerate(columns)])
        for i, a in enumerate(columns)
    ]
    return flat.select(F.inline(F.array(*rows)))


def skewness_table(rfm: DataFrame) -> DataFrame:
    columns = list(RFM_FEATURES[:3])
    return rfm.agg(*[F.skewness(c).alias(c) for c in columns]).unpivot(
        [], columns, "feature", "skewness")


def label_histograms(rfm: DataFrame) -> DataFrame:
    """Clipped histograms per feature and label; each label has bins over its own range."""
    clipped = rfm.select(
        "y", *[F.least(F.col(c), F.lit(cap)).cast("double").alias(c)
               for c, cap in HISTOGRAM_CAPS.items()]
    ).unpivot(["y"], list(HISTOGRAM_CAPS), "feature", "value")
    values = clipped.groupBy("y", "feature", "value").agg(F.count("*").alias("n"))
    ranges = clipped.groupBy("y", "feature").agg(
        F.min("value").alias("low"), F.max("value").alias("high"))
    # One row per label and feature, so sending the ranges to every task is safe.
    placed = values.join(F.broadcast(ranges), ["y", "feature"])
    width = F.col("high") - F.col("low")
    bin_no = F.when(width == 0, F.lit(HISTOGRAM_BINS // 2)).otherwise(F.least(
        F.floor((F.col("value") - F.col("low")) * HISTOGRAM_BINS / width),
        F.lit(HISTOGRAM_BINS - 1)))
    return placed.groupBy("feature", "y", bin_no.cast("int").alias("bin")).agg(
        F.sum("n").alias("customers"))


def summary_statistics(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, deviation and range per column, with exact quartiles."""
    plain = df.agg(F.struct(*[
        F.struct(
            F.count(c).alias("n"), F.avg(c).alias("mean"), F.stddev(c).alias("std"),
            F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max"),
        ).alias(c) for c in columns
    ]).alias("s")).select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), *[
            F.col(f"s.{c}.{k}").alias(k) for k in ("n", "mean", "std", "min", "max")])
        for c in columns
    ])))
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75]).select(
        "column", *[F.col("quantiles")[i].alias(name)
                    for i, name in enumerate(("p25", "p50", "p75"))])
    return plain.join(quartiles, "column")


def single_order_cohorts(rfm: DataFrame) -> DataFrame:
    total = rfm.agg(F.count("*")).scalar()
    return rfm.groupBy((F.col("frequency") == 1).alias("single_order")).agg(
        F.count("*").alias("customers"), F.avg("y").alias("repeat_rate")
    ).withColumn("pct", _pct(F.col("customers"), total))


def cancellation_cohorts(raw: DataFrame, rfm: DataFrame, cfg: RetentionConfig) -> DataFrame:
    cancels = raw.filter(
        is_cancelled_invoice() & ~F.expr(IS_UNATTRIBUTED)
        & (F.col("invoice_date") < timestamp(cfg.cutoff))
    ).select("customer_id").distinct().withColumn("cancelled", F.lit(True))
    flagged = rfm.join(cancels, "customer_id", "left").withColumn(
        "has_cancelled", F.coalesce("cancelled", F.lit(False)))
    total = rfm.agg(F.count("*")).scalar()
    rates = flagged.groupBy("has_cancelled").agg(
        F.count("*").alias("customers"), F.avg("y").alias("repeat_rate")
    ).withColumn("pct", _pct(F.col("customers"), total))
    middle = medians(flagged, ["frequency"], by=["has_cancelled"], suffix="_median")
    return rates.join(middle, "has_cancelled")


# ---- time ----------------------------------------------------------------------------------

def rows_per_weekday(raw: DataFrame) -> DataFrame:
    names = F.create_map(*[F.lit(v) for pair in WEEKDAYS.items() for v in pair])
    number = F.weekday("invoice_date") + 1
    named_day = F.coalesce(names[F.col("weekday_no")], F.raise_error(F.lit("no such weekday")))
    return raw.groupBy(number.alias("weekday_no")).agg(_rows()).select(
        "weekday_no", named_day.alias("weekday"), "n_rows")


def rows_on_day(raw: DataFrame, day: datetime) -> DataFrame:
    date = F.col("invoice_date")
    on_day = raw.filter((date >= timestamp(day)) & (date < timestamp(day + timedelta(days=1))))
    return on_day.agg(_rows())


def anchor_shift(raw: DataFrame, cfg: RetentionConfig) -> DataFrame:
    """Days by which recency would move if it were measured from the last row."""
    return raw.agg(F.max("invoice_date").alias("last_date")).select(
        "last_date", whole_days(timestamp(cfg.cutoff), F.col("last_date")).alias("shift_days"))


def window_sizes(tx: DataFrame, cfg: RetentionConfig) -> DataFrame:
    date, cutoff, end = F.col("invoice_date"), timestamp(cfg.cutoff), timestamp(cfg.prediction_end)
    window = (
        F.when(date < cutoff, "observation").when(date < end, "prediction")
        .otherwise("after horizon")
    )
    total = tx.agg(F.count("*")).scalar()
    return tx.groupBy(window.alias("window")).agg(_rows()).withColumn(
        "pct", _pct(F.col("n_rows"), total))


# ---- from raw to clean ---------------------------------------------------------------------

def lost_customers(raw: DataFrame, tx: DataFrame, cfg: RetentionConfig) -> DataFrame:
    """What customers bought who are buyers on raw rows but not on clean ones.

    Every row also has the number of such customers and of all their rows.
    """
    attributed = raw.filter(
        ~F.expr(IS_UNATTRIBUTED) & (F.col("invoice_date") < timestamp(cfg.cutoff)))
    raw_buyers = attributed.filter(~is_cancelled_invoice()).select("customer_id").distinct()
    clean_buyers = real_purchases(tx, None, cfg.cutoff).select("customer_id").distinct()
    lost = raw_buyers.join(clean_buyers, "customer_id", "left_anti")
    bought = attributed.join(lost, "customer_id", "left_semi")
    return bought.groupBy("stock_code").agg(_rows()).withColumns({
        "lost_customers": lost.agg(F.count("*")).scalar(),
        "lost_rows": bought.agg(F.count("*")).scalar(),
    })


def same_day_repeaters(tx: DataFrame, cfg: RetentionConfig) -> DataFrame:
    """Customers whose several orders all fall within one day."""
    orders = real_purchases(tx, None, cfg.cutoff).groupBy("customer_id", "invoice").agg(
        F.min("invoice_date").alias("first"), F.max("invoice_date").alias("last"))
    return orders.groupBy("customer_id").agg(
        F.count("*").alias("frequency"),
        whole_days(F.min("first"), F.max("last")).alias("span_days"),
    ).agg(
        F.count_if((F.col("span_days") == 0) & (F.col("frequency") > 1)).alias("same_day_repeaters"),
        F.count("*").alias("customers"))


def return_ratio_range(features: DataFrame) -> DataFrame:
    return features.agg(
        F.min("return_value_ratio").alias("min_return_value"),
        F.max("return_value_ratio").alias("max_return_value"),
        F.count_if(F.col("return_value_ratio") > 1.0).alias("above_one"),
        F.min("cancel_order_rate").alias("min_cancel_rate"),
        F.max("cancel_order_rate").alias("max_cancel_rate"),
    )


def customer_history(tx: DataFrame, customer_id: int, cfg: RetentionConfig) -> DataFrame:
    """One customer's rows before the cutoff, in time order."""
    return tx.filter(
        (F.col("customer_id") == customer_id) & (F.col("invoice_date") < timestamp(cfg.cutoff))
    ).select(
        "invoice", "is_cancellation", "quantity", "price", "line_revenue", "invoice_date"
    ).orderBy("invoice_date", "invoice")
