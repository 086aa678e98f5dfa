"""Session defaults and the shared folder that stage outputs are written to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "cohortline", master: str | None = None, **conf) -> SparkSession:
    """A session with adaptive execution on; sizes and parallelism stay the cluster's choice."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``.

    A local master may fall back to a temporary folder; a cluster may not, because a
    machine-local path would be lost with its executor.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="cohortline-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir() or folder


def stage(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` to the shared folder and return the written table; ``options`` go to the writer.

    Cuts lineage: later reads survive lost executors, prune columns, push filters and see
    real sizes, and nothing upstream is computed twice.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/cohortline/{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
