"""Customer tables stored in buckets of their key, so that joins on the key move nothing.

Tables with one key and one number of buckets hold a key's row in the same bucket, sorted. A join
of them reads bucket beside bucket: no exchange, whatever their sizes. Files lie in the shared
folder; the session's catalog only knows where.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortline.session import shared_folder

#: Rows of a bucket, at which a task still sorts in memory.
BUCKET_ROWS = 4 << 20
MOST_BUCKETS = 1 << 16


def bucket_count(df: DataFrame, n_rows: int) -> int:
    """Enough buckets for every core, and for the rows."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return min(MOST_BUCKETS, max(cores, -(-n_rows // BUCKET_ROWS)))


def buckets_for(df: DataFrame, key: str) -> int:
    """Buckets for one row of each key, which are estimated within a few percent in one narrow scan."""
    return bucket_count(df, df.agg(F.approx_count_distinct(key)).first()[0])


def stage_bucketed(df: DataFrame, name: str, key: str, n: int, placed: bool = False) -> DataFrame:
    """Write ``df`` in ``n`` buckets of ``key``, one sorted file each, and return the written table.

    ``placed`` says that ``df`` is already partitioned so, as a join of bucketed tables is; then its
    rows are written where they are. Rows without a key share a bucket. Like ``session.stage`` it
    cuts lineage. The catalog's entry ends with the session, or with the user of a shared catalog:
    ``drop`` removes it, never the files.
    """
    spark = df.sparkSession
    table = f"cohortline_{name.replace('-', '_')}_{uuid.uuid4().hex}"
    path = f"{shared_folder(spark).rstrip('/')}/cohortline/{table}"
    rows = df if placed else df.repartition(n, key)
    (rows.write.format("parquet").option("path", path).bucketBy(n, key).sortBy(key)
     .saveAsTable(table))
    return spark.table(table)


def drop(df: DataFrame) -> None:
    """Forget the catalog entries of the bucketed tables that a plan reads; their files stay."""
    spark = df.sparkSession
    paths = set(df.inputFiles())
    for found in spark.catalog.listTables():
        if found.name.startswith("cohortline_") and any(f"/{found.name}/" in p for p in paths):
            spark.sql(f"DROP TABLE IF EXISTS {found.name}")
