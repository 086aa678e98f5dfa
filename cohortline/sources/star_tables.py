"""Reads the TPC-H-like tables as if they were a raw retail transaction log.

Irregularities are planted by arithmetic on the keys, so every engine that reads the tables sees
the same rows: cancellations (also positive ones, and customers who only cancel), adjustments,
write-offs with and without a price, blanks, padded text, non-products listed and unlisted,
duplicates, orders with and without customer in one, customers whose orders share a day or carry no
price, and a return of customers that depends on how recently they bought.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline.functions import timestamp
from cohortline.sources.ingest import COLUMN_RENAMES, concat_parts, rename_columns, tag_part

# Names of the two parts and the moment that separates them.
PARTS = ("Year 1995-1997", "Year 1998-2001")
SECOND_PART_FROM = datetime(1998, 1, 1)
# Dates that orders are moved to or by.
SAME_DAY = datetime(1997, 3, 3)
RETURNS_FROM = datetime(2001, 5, 4)
QUIET_FROM = datetime(1999, 12, 21)
ACTIVE_FROM = datetime(1996, 1, 1)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def _log_lines(spark: SparkSession, folder: str) -> DataFrame:
    lines = read_table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice")
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customers = read_table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    nations = read_table(spark, folder, "nation").select("n_nationkey", "n_name")

    # Country belongs to the order, so it is attached before the orders meet the lines.
    placed = (
        orders.join(customers, orders.o_custkey == customers.c_custkey)
        .join(nations, customers.c_nationkey == nations.n_nationkey)
        .select("o_orderkey", "o_custkey", "o_orderdate", "n_name")
    )
    parts = read_table(spark, folder, "part").select("p_partkey", "p_name")
    log = (
        lines.join(placed, lines.l_orderkey == placed.o_orderkey)
        .join(parts, lines.l_partkey == parts.p_partkey, "left")
    )
    # Planted exact duplicates: two copies of some lines, without a second pass over the joins.
    copies = F.when(F.col("l_partkey") % 211 == 0, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0)))
    return log.withColumn("copy", F.explode(copies))


def _order_date():
    """Odd customers fall silent long before the cutoff; even ones buy shortly before and after it."""
    order, customer, date = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderdate")
    zero, days = F.lit(0), F.make_dt_interval
    active = (customer % 2 == 0) & (date >= timestamp(ACTIVE_FROM)) & (date < timestamp(RETURNS_FROM))
    return (
        F.when(customer % 97 == 0, timestamp(SAME_DAY))
        .when((customer % 2 == 1) & (date >= timestamp(QUIET_FROM)), date - days(F.lit(900), zero))
        .when(active & (order % 2 == 0),
              timestamp(RETURNS_FROM) + days((order % 80).cast("int"), zero))
        .when(active & (order % 4 == 1),
              timestamp(RETURNS_FROM) - days((order % 89).cast("int") + 1, zero))
        .otherwise(date)
    )


def source_log(spark: SparkSession, folder: str) -> DataFrame:
    """The log under its original headings."""
    order, part, customer = F.col("o_orderkey"), F.col("l_partkey"), F.col("o_custkey")
    cancelled = ((order % 7 == 0) | (customer % 89 == 0)) & (order % 997 != 0)
    quantity = F.col("l_quantity").cast("bigint")
    code = (
        F.when(part % 101 == 0, "POST")
        .when(part % 103 == 0, "gift_0001_10")
        .when(part % 107 == 0, "DCGS0001")
        .otherwise(F.concat(
            # Left-pad to five digits without cutting longer keys, as lpad would.
            F.repeat(F.lit("0"), F.greatest(F.lit(0), 5 - F.length(part.cast("string")))),
            part.cast("string"),
            F.when((part % 67 == 0) & (order % 2 == 0), " ").otherwise("")))
    )
    unpriced = ((part % 53 == 0) | (customer % 61 == 0)) & ~cancelled
    price = (
        F.when(unpriced, 0.0)
        .when((part % 59 == 0) & (order % 3 == 0) & ~cancelled, -1.25)
        .otherwise(F.floor(F.col("l_extendedprice") / F.col("l_quantity")) + (part % 4) / 4)
    )
    # Cancelled lines are negative but for some of the shipping fees; write-offs are negative too.
    negative = (cancelled & (part % 101 != 0)) | (
        ~cancelled & ((part % 106 == 0) | (part % 109 == 0)))
    columns = {
        "Invoice": F.concat(
            F.when(order % 997 == 0, "A").when(cancelled, "C").otherwise(""),
            order.cast("string")),
        "StockCode": code,
        "Description":
            F.when(part % 97 == 0, None).when(part % 89 == 0, "?").when(part % 79 == 0, "   ")
            .when(part % 83 == 0, F.concat(F.lit("  "), F.col("p_name")))
            .otherwise(F.col("p_name")),
        "Quantity": F.when(negative, -quantity).otherwise(quantity),
        "InvoiceDate":
            _order_date() + F.make_dt_interval(F.lit(0), (order % 24).cast("int")),
        "Price": price.cast("double"),
        "Customer ID": F.when(
            (order % 5 != 0) & ~((order % 41 == 0) & (part % 2 == 0)), F.col("o_custkey")),
        "Country": F.when(order % 11 == 0, "NATION_0")
            .when(order % 13 == 0, F.concat(F.col("n_name"), F.lit(" "))).otherwise(F.col("n_name")),
    }
    log = _log_lines(spark, folder)
    return log.select(*[columns[name].alias(name) for name in COLUMN_RENAMES])


def source_part(log: DataFrame, name: str) -> DataFrame:
    """One yearly part of the log; the bare date column meets a literal, so scans prune."""
    boundary = timestamp(SECOND_PART_FROM)
    date = F.col("InvoiceDate")
    return log.filter(date >= boundary if name == PARTS[1] else date < boundary)


def raw_from_parts(log: DataFrame) -> DataFrame:
    """Raw table built part by part: rename, tag, concatenate. ``log`` is read once for each part."""
    return concat_parts(
        [tag_part(rename_columns(source_part(log, name)), name) for name in PARTS])


def transactions_raw(log: DataFrame) -> DataFrame:
    """The same rows as ``raw_from_parts``, tagged in one pass."""
    part = F.when(F.col("invoice_date") < timestamp(SECOND_PART_FROM), PARTS[0]).otherwise(PARTS[1])
    return rename_columns(log).withColumn("source_sheet", part)
