"""Point-in-time customer features, all measured against the cutoff.

The log is reduced twice. ``order_grain`` folds lines into orders, which map-side combining
makes cheap because an order's lines lie together, and yields every feature but the distinct
counts. ``product_variety`` takes those from narrow scans, one distinct count at a time. No reduction
sends one customer's lines to one task: all are keyed finer than the customer first.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortline.config import NUMERIC_FEATURES, OTHER, RetentionConfig
from cohortline.functions import (
    is_cancelled_invoice,
    line_value,
    micros_since_epoch,
    timestamp,
    whole_days,
)
from cohortline.operators.labels import real_purchases

# Fixed value: keeps the momentum ratio finite when a year's spend is zero.
EPSILON = 1e-6

ORDER_WINDOWS = (30, 90, 180)
SPEND_WINDOWS = (90, 365)


def _since(days: int, cfg: RetentionConfig) -> Column:
    return timestamp(cfg.cutoff - timedelta(days=days))


def mapped_country(cfg: RetentionConfig) -> Column:
    return F.when(F.col("country").isin(*cfg.country_vocab), F.col("country")).otherwise(OTHER)


def _country_names(cfg: RetentionConfig) -> list[str]:
    return sorted({*cfg.country_vocab, OTHER})


def _dated_country(cfg: RetentionConfig) -> Column:
    """Time and country as one long, so the latest country is a plain ``max``.

    Unlike a struct or a string this keeps the aggregate hashed. Rows at the same instant are
    decided by the country's place in the sorted vocabulary: a total order on all inputs.
    """
    names = _country_names(cfg)
    place = F.array_position(F.array(*map(F.lit, names)), mapped_country(cfg)) - 1
    return micros_since_epoch(F.col("invoice_date")) * len(names) + place


def _country_of(dated: Column, cfg: RetentionConfig) -> Column:
    names = _country_names(cfg)
    return F.element_at(
        F.array(*map(F.lit, names)), (F.pmod(dated, F.lit(len(names))) + 1).cast("int"))


def order_grain(tx: DataFrame, cfg: RetentionConfig) -> DataFrame:
    """One row per order of an identified customer before the cutoff, cancelled ones included."""
    date = F.col("invoice_date")
    observed = tx.filter(F.col("customer_id").isNotNull() & (date < timestamp(cfg.cutoff)))
    return observed.groupBy("customer_id", "invoice", "is_cancellation").agg(
        F.min(date).alias("first_line"),
        F.max(date).alias("last_line"),
        F.count("price").alias("n_prices"),
        F.sum("price").alias("price_sum"),
        F.sum("quantity").alias("items"),
        F.sum("line_revenue").alias("revenue"),
        F.max(_dated_country(cfg)).alias("dated_country"),
        *[F.sum(F.when(date >= _since(d, cfg), F.col("line_revenue"))).alias(f"revenue_{d}d")
          for d in SPEND_WINDOWS],
    )


def customer_totals(orders: DataFrame, cfg: RetentionConfig) -> DataFrame:
    """Plain sums, extremes and counts per customer; customers who only cancelled are left out."""
    bought = ~F.col("is_cancellation")

    def of_bought(column: str) -> Column:
        return F.when(bought, F.col(column))

    return (
        orders.groupBy("customer_id")
        .agg(
            F.count_if(bought).alias("frequency"),
            F.min(of_bought("first_line")).alias("first_order"),
            F.max(of_bought("last_line")).alias("last_order"),
            F.sum(of_bought("revenue")).alias("monetary_total"),
            F.sum(of_bought("items")).alias("total_quantity"),
            (F.sum(of_bought("price_sum")) / F.sum(of_bought("n_prices"))).alias("avg_unit_price"),
            F.count_if(~bought).alias("cancel_order_count"),
            F.abs(F.coalesce(F.sum(F.when(~bought, F.col("revenue"))), F.lit(0.0)))
            .alias("cancel_value"),
            *[F.count_if(bought & (F.col("last_line") >= _since(d, cfg))).alias(f"orders_last_{d}d")
              for d in ORDER_WINDOWS],
            *[F.coalesce(F.sum(of_bought(f"revenue_{d}d")), F.lit(0.0)).alias(f"spend_last_{d}d")
              for d in SPEND_WINDOWS],
            _country_of(F.max(of_bought("dated_country")), cfg).alias("country"),
        )
        .filter(F.col("frequency") > 0)
    )


def product_counts(tx: DataFrame, cfg: RetentionConfig) -> DataFrame:
    """Distinct products and (order, product) pairs per customer.

    Lines are reduced to pairs, pairs to products and products to customers, each step on the
    output of the one before; a row is never multiplied for several distinct counts.
    """
    return (
        real_purchases(tx, None, cfg.cutoff)
        .groupBy("customer_id", "stock_code", "invoice").agg(F.lit(1).alias("one"))
        .groupBy("customer_id", "stock_code").agg(F.count("*").alias("orders"))
        .groupBy("customer_id").agg(
            F.count("stock_code").alias("distinct_products"),
            F.sum(F.when(F.col("stock_code").isNotNull(), F.col("orders"))).alias("order_products"))
    )


def active_months(tx: DataFrame, cfg: RetentionConfig) -> DataFrame:
    """Calendar months with a purchase per customer."""
    month = F.trunc(F.col("invoice_date").cast("date"), "month").alias("month")
    return (
        real_purchases(tx, None, cfg.cutoff).select("customer_id", month).distinct()
        .groupBy("customer_id").agg(F.count("month").alias("distinct_active_months"))
    )


def product_variety(tx: DataFrame, cfg: RetentionConfig) -> DataFrame:
    """Distinct products, (order, product) pairs and active months per customer."""
    return product_counts(tx, cfg).join(active_months(tx, cfg), "customer_id")


def add_lifecycle(totals: DataFrame, cfg: RetentionConfig) -> DataFrame:
    """Recency, tenure, order value and the customer's own rhythm.

    A single order has no gap, so the whole observation window stands in; several orders
    within a day get a gap of one day, which keeps the ratio finite.
    """
    cutoff = timestamp(cfg.cutoff)
    span = whole_days(F.col("first_order"), F.col("last_order"))
    gap = F.when(
        F.col("frequency") > 1, F.greatest(span / (F.col("frequency") - 1), F.lit(1.0))
    ).otherwise(F.lit(float(cfg.observation_days)))
    return (
        totals.withColumns({
            "recency_days": whole_days(F.col("last_order"), cutoff),
            "tenure_days": whole_days(F.col("first_order"), cutoff),
            "monetary_avg_per_order": F.col("monetary_total") / F.col("frequency"),
            "is_single_order_customer": F.col("frequency") == 1,
            "avg_days_between_orders": gap,
            "avg_items_per_order": F.col("total_quantity") / F.col("frequency"),
        })
        .withColumn(
            "recency_over_avg_gap", F.col("recency_days") / F.col("avg_days_between_orders"))
    )


def add_ratios(totals: DataFrame) -> DataFrame:
    """Returns and momentum. Neither return ratio is clipped; both may exceed one."""
    return totals.withColumns({
        "cancel_order_rate": F.col("cancel_order_count") / F.col("frequency"),
        "return_value_ratio": F.col("cancel_value") / F.col("monetary_total"),
        "spend_momentum":
            F.col("spend_last_90d") / (F.col("spend_last_365d") / 4 + F.lit(EPSILON)),
    })


def order_features(tx: DataFrame, cfg: RetentionConfig) -> DataFrame:
    """Every feature that follows from orders alone."""
    return add_ratios(add_lifecycle(customer_totals(order_grain(tx, cfg), cfg), cfg))


def build_customer_features(tx: DataFrame, cfg: RetentionConfig) -> DataFrame:
    """One row per customer: the numeric features in matrix order, then the country.

    Both inputs of the join hold each customer once and are already partitioned by customer.
    """
    variety = product_variety(tx, cfg)
    return (
        order_features(tx, cfg).join(variety, "customer_id")
        .withColumn(
            "avg_distinct_products_per_order", F.col("order_products") / F.col("frequency"))
        .select("customer_id", *NUMERIC_FEATURES, "country")
    )


def country_vocabulary(tx: DataFrame, cfg: RetentionConfig) -> DataFrame:
    """Customers per country before the cutoff and whether the country earns a column."""
    per_country = real_purchases(tx, None, cfg.cutoff).groupBy("country").agg(
        F.count_distinct("customer_id").alias("customers"))
    return per_country.withColumn(
        "in_vocabulary", F.col("customers") >= cfg.min_country_customers)


def vocabulary_coverage(vocabulary: DataFrame) -> DataFrame:
    covered = F.sum(F.when(F.col("in_vocabulary"), F.col("customers")).otherwise(0))
    return vocabulary.agg(
        F.count_if("in_vocabulary").alias("countries_kept"),
        (100 * covered / F.sum("customers")).alias("pct_covered"),
    )


def raw_rfm(raw: DataFrame, cfg: RetentionConfig) -> DataFrame:
    """Recency, frequency, monetary and label straight from the uncleaned log."""
    cutoff, end = timestamp(cfg.cutoff), timestamp(cfg.prediction_end)
    date = F.col("invoice_date")
    purchases = raw.filter(
        F.col("customer_id").isNotNull() & ~is_cancelled_invoice() & (date < end))
    orders = purchases.groupBy("customer_id", "invoice").agg(
        F.min(F.when(date < cutoff, date)).alias("first_line"),
        F.max(F.when(date < cutoff, date)).alias("last_line"),
        F.sum(F.when(date < cutoff, line_value())).alias("revenue"),
        F.max(date >= cutoff).alias("after"),
    )
    return (
        orders.groupBy("customer_id")
        .agg(
            F.count("last_line").alias("frequency"),
            F.max("last_line").alias("last_order"),
            F.min("first_line").alias("first_order"),
            F.sum("revenue").alias("monetary"),
            F.max("after").cast("int").alias("y"),
        )
        .filter(F.col("frequency") > 0)
        .select(
            "customer_id",
            whole_days(F.col("last_order"), cutoff).alias("recency_days"),
            "frequency", "monetary",
            whole_days(F.col("first_order"), cutoff).alias("tenure_days"),
            "y",
        )
    )
