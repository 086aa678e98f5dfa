"""Sinks that prove what they wrote."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cohortline.operators.boosting import Ensemble
from cohortline.operators.checks import ContractViolation, fingerprint, fingerprint_sums
from cohortline.sources import published


def write_checked(df: DataFrame, path: str, require: Callable[[], None] | None = None,
                  once: bool = False, options: dict[str, str] | None = None) -> DataFrame:
    """Write Parquet, read it back, compare fingerprints, and only then publish it under ``path``.

    No row is shuffled. The comparison evaluates ``df`` a second time, or, with ``once``, takes its
    fingerprint while it is written. ``require`` runs after the write, when observations on ``df`` are known;
    if it, or the comparison, raises, readers keep the version they had.

    An observation leaves an object in its session that cannot be serialized, as fitted models of that
    session have to be. So ``once`` is for frames of a session of their own, see ``observing``.
    """
    spark = df.sparkSession
    version = published.new_version(path)
    if once:
        written = Observation()
        df.observe(written, *fingerprint_sums(df)).write.options(**options or {}).parquet(version)
        expected = written.get
    else:
        df.write.options(**options or {}).parquet(version)
        expected = fingerprint(df).first().asDict()
    reloaded = spark.read.parquet(version)
    if reloaded.dtypes != df.dtypes:
        raise ContractViolation(f"schema changed on reload: {df.dtypes} -> {reloaded.dtypes}")
    if fingerprint(reloaded).first().asDict() != expected:
        raise ContractViolation(f"rows changed on reload of {path}")
    if require:
        require()
    published.publish(spark, path, version)
    return reloaded


def observing(spark: SparkSession) -> SparkSession:
    """A session of its own over the same cluster, for frames that are observed."""
    return spark.newSession()


def write_predictions(oof: DataFrame, path: str) -> DataFrame:
    """Out-of-fold probabilities as (customer_id, y, oof_proba)."""
    table = oof.select("customer_id", "y", F.col("score").alias("oof_proba"))
    version = published.new_version(path)
    table.write.parquet(version)
    published.publish(oof.sparkSession, path, version)
    return published.read(oof.sparkSession, path)


def save_model(model: PipelineModel | Ensemble, path: str) -> PipelineModel | Ensemble:
    """Save a fitted model and return the reloaded one."""
    if isinstance(model, Ensemble):
        spark = SparkSession.active()
        model.save(spark, path)
        return Ensemble.load(spark, path)
    model.write().overwrite().save(path)
    return PipelineModel.load(path)


def write_record(record: DataFrame, path: str) -> DataFrame:
    """One nested row as JSON. The record is a single row, hence a single file."""
    record.coalesce(1).write.mode("overwrite").json(path)
    return record.sparkSession.read.schema(record.schema).json(path)
