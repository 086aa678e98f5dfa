"""Bucketed customer tables: joins without exchange, same rows."""

import re

import pytest

from cohortline.operators import checks, encoding
from cohortline.plans.workspace import workspace
from cohortline.sources import bucketed

FOLDER = "/root/testdata/sf0.001"


def exchanges(df):
    """Exchanges of the physical plan before anything runs."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"\bExchange\b|BroadcastExchange", plan)


@pytest.fixture
def no_broadcast(spark):
    """Small tables would be broadcast; large ones are not."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def test_customer_joins_move_nothing(spark, no_broadcast):
    space = workspace(spark, FOLDER)
    assert exchanges(space.matrix_plan()) == []
    assert exchanges(space.split_matrix_plan()) == []
    plain = encoding.labelled_matrix(
        space.labels(), encoding.encode_features(space.features(), space.cfg), space.cfg)
    assert exchanges(plain)
    assert checks.frames_equal(plain, space.matrix())


def test_split_matrix_holds_every_customer_once(spark):
    space = workspace(spark, FOLDER)
    rows = space.split_matrix_plan().select("customer_id", "split", "fold").collect()
    assert len(rows) == len({r.customer_id for r in rows}) == space.matrix().count()
    assert all((r.fold is None) == (r.split == "test") for r in rows)


def test_rows_without_key_and_repeated_keys(spark, no_broadcast):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (7, None)], "k long, v string")
    right = spark.createDataFrame([(1, 10), (None, 11), (8, 12)], "k long, w int")
    a, b = (bucketed.stage_bucketed(df, name, "k", 3)
            for df, name in ((left, "left-side"), (right, "right")))
    assert checks.frames_equal(a, left) and checks.frames_equal(b, right)
    joined = a.join(b, "k", "left")
    assert exchanges(joined) == []
    assert {(r.k, r.v, r.w) for r in joined.collect()} == {
        (1, "a", 10), (1, "b", 10), (None, "c", None), (7, None, None)}
    # What a join left in its buckets is written without moving; the next join moves nothing either.
    again = bucketed.stage_bucketed(joined, "joined", "k", 3, placed=True)
    assert exchanges(again.join(b, "k")) == [] and again.count() == 4
    empty = bucketed.stage_bucketed(left.limit(0), "empty", "k", 3)
    assert empty.count() == 0 and a.join(empty, "k").count() == 0


def test_catalog_entries_can_be_dropped(spark):
    table = bucketed.stage_bucketed(spark.range(5).withColumnRenamed("id", "k"), "gone", "k", 2)
    names = {t.name for t in spark.catalog.listTables()}
    files = table.inputFiles()
    bucketed.drop(table)
    left = {t.name for t in spark.catalog.listTables()}
    assert len(names - left) == 1 and spark.read.parquet(*files).count() == 5


@pytest.mark.parametrize(("rows", "least"), [(0, 1), (10 * bucketed.BUCKET_ROWS, 10)])
def test_buckets_grow_with_the_rows(spark, rows, least):
    n = bucketed.bucket_count(spark.range(1), rows)
    assert n >= max(least, spark.sparkContext.defaultParallelism)
    assert bucketed.bucket_count(spark.range(1), 10 ** 15) == bucketed.MOST_BUCKETS
