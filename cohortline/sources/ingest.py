"""Pinned-schema ingest of the yearly parts of a transaction log."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortline.operators import checks
from cohortline.sources import published, sinks

# Original headings with their types, and the names used everywhere else.
SOURCE_SCHEMA = T.StructType([
    T.StructField("Invoice", T.StringType()),
    T.StructField("StockCode", T.StringType()),
    T.StructField("Description", T.StringType()),
    T.StructField("Quantity", T.LongType()),
    T.StructField("InvoiceDate", T.TimestampNTZType()),
    T.StructField("Price", T.DoubleType()),
    T.StructField("Customer ID", T.LongType()),
    T.StructField("Country", T.StringType()),
])
COLUMN_RENAMES = {
    "Invoice": "invoice",
    "StockCode": "stock_code",
    "Description": "description",
    "Quantity": "quantity",
    "InvoiceDate": "invoice_date",
    "Price": "price",
    "Customer ID": "customer_id",
    "Country": "country",
}
# Time first, under the original headings and under the names of the raw table.
SOURCE_CLUSTER = ("InvoiceDate", "Invoice", "StockCode", "Quantity")
RAW_CLUSTER = tuple(COLUMN_RENAMES[c] for c in SOURCE_CLUSTER)


def require_columns(columns: list[str], part: str) -> None:
    missing = sorted(set(COLUMN_RENAMES) - set(columns))
    if missing:
        raise ValueError(f"part {part!r} lacks expected columns: {missing}")


def read_part(spark: SparkSession, path: str, part: str, fmt: str = "csv") -> DataFrame:
    """Read one part with the pinned schema; a value of the wrong type fails the read.

    Every file's own columns count, since a read with a given schema would turn a missing column
    into nulls and take values by position. CSV files of one part must share one heading: the
    reader compares each file's heading with the first one's and fails where they differ. Of other
    formats every file's own schema is looked up.
    """
    if fmt == "csv":
        headings = spark.read.option("header", True).csv(path).columns
        require_columns(headings, part)
        pinned = {field.name: field for field in SOURCE_SCHEMA}
        in_file_order = T.StructType(
            [pinned.get(name, T.StructField(name, T.StringType())) for name in headings])
        frame = (
            spark.read.schema(in_file_order).option("header", True).option("mode", "FAILFAST")
            .option("enforceSchema", False).csv(path)
        )
    else:
        files = spark.read.format(fmt).load(path).inputFiles()
        # Metadata only, a few files at a time.
        with ThreadPool(16) as pool:
            for columns in pool.imap_unordered(
                    lambda f: spark.read.format(fmt).load(f).columns, files):
                require_columns(columns, part)
        frame = spark.read.schema(SOURCE_SCHEMA).format(fmt).load(path)
    return frame.select(*[F.col(f"`{name}`") for name in COLUMN_RENAMES])


def rename_columns(part: DataFrame) -> DataFrame:
    return part.withColumnsRenamed(COLUMN_RENAMES)


def tag_part(part: DataFrame, name: str) -> DataFrame:
    return part.withColumn("source_sheet", F.lit(name))


def concat_parts(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def load_raw(spark: SparkSession, parts: dict[str, str], fmt: str = "csv") -> DataFrame:
    """All parts (name -> path) as one validated raw table."""
    raw = _parts(spark, parts, fmt)
    checks.validate_raw(raw)
    return raw


def _parts(spark: SparkSession, parts: dict[str, str], fmt: str) -> DataFrame:
    return concat_parts([
        tag_part(rename_columns(read_part(spark, path, name, fmt)), name)
        for name, path in parts.items()
    ])


def clustered(log: DataFrame, keys: Sequence[str] = RAW_CLUSTER) -> DataFrame:
    """Rows in ranges of time, so that date filters prune files and row groups.

    The further keys let a single day that holds many rows spread over several files.
    """
    return log.repartitionByRange(*keys).sortWithinPartitions(keys[0])


def lookup_filters(*columns: str) -> dict[str, str]:
    """Writer options for a Bloom filter of each column in every row group.

    The log lies in order of time, so the rows of one customer are spread over all of it and the bounds of a
    row group say nothing of customers. The filters let a lookup skip the row groups without that customer.
    Their size follows the values that a row group holds.
    """
    return {"parquet.bloom.filter.adaptive.enabled": "true",
            **{f"parquet.bloom.filter.enabled#{c}": "true" for c in columns}}


def build_raw_parquet(spark: SparkSession, parts: dict[str, str], target: str,
                      fmt: str = "csv", force: bool = False) -> DataFrame:
    """Materialise the raw table once; later calls read it unless ``force`` rebuilds it.

    Its contract is counted while it is written. A rebuild that fails leaves the old table in place.
    """
    if not force and published.exists(spark, target):
        return published.read(spark, target)
    raw = _parts(sinks.observing(spark), parts, fmt)
    checks.require_raw_types(raw)
    counts = Observation()
    sinks.write_checked(
        clustered(raw).observe(counts, *checks.raw_counts()), target,
        lambda: checks.require_raw(counts.get), once=True, options=lookup_filters("customer_id"))
    return published.read(spark, target)
