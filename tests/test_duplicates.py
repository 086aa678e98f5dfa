"""Duplicates found by hash first, against a grouping of whole rows."""

import random

from pyspark.sql import functions as F

from cohortline.operators import duplicates, profiling

KIND = "first long, v string, x double, n long"


def rows():
    rng = random.Random(1)
    return [(rng.choice([1, 2, None]), rng.choice(["a", "b", None]), rng.choice([0.0, -0.0, 1.5, None]),
             rng.choice([7, 7, 7, None])) for _ in range(120)] + [(i, "u", 0.5, i) for i in range(300)]


def plain(df):
    return sorted(map(str, df.groupBy(*df.columns).agg(F.count("*").alias("copies")).filter(
        "copies > 1").collect()))


def test_repeated_rows(spark):
    df = spark.createDataFrame(rows(), KIND).repartition(5)
    assert sorted(map(str, duplicates.repeated_rows(df).collect())) == plain(df)
    total = df.count()
    assert spark.range(1).select(duplicates.surplus_rows(df)).first()[0] == total - df.distinct().count()


def test_equal_hashes_of_unlike_rows_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(duplicates, "row_hashes", lambda df: (F.lit(1), F.lit(2)))
    df = spark.createDataFrame(rows(), KIND)
    assert sorted(map(str, duplicates.repeated_rows(df).collect())) == plain(df)


def test_rows_that_occur_once_do_not_travel_whole(spark):
    df = spark.createDataFrame([(i, "u" * 500, 0.5, i) for i in range(200)], KIND)
    assert duplicates.repeated_rows(df).count() == 0
    assert profiling.duplicate_rows(df).first().pct == 0.0
    assert profiling.duplicate_rows(df.limit(0)).first().pct is None


def test_nulls_hash_by_their_place(spark):
    df = spark.createDataFrame([(None, "a", None, None), (None, None, None, 1), (1, None, None, None)], KIND)
    assert df.select(*duplicates.row_hashes(df)).distinct().count() == 3
