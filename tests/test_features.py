from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cohortline.functions import micros_since_epoch, whole_days
from cohortline.operators import checks, encoding, features, labels, profiling
from cohortline.operators.cleaning import clean_transactions

CUTOFF = datetime(2021, 1, 1)
END = datetime(2021, 4, 1)


def build(log, cfg):
    return {r.customer_id: r for r in features.build_customer_features(
        clean_transactions(log.frame(), cfg), cfg).collect()}


def test_windows_are_half_open(log, cfg):
    second = timedelta(seconds=1)
    (log.add(1, CUTOFF - second, "1").add(2, CUTOFF, "2")
        .add(1, END - second, "3").add(3, CUTOFF - second, "4").add(3, END, "5"))
    tx = clean_transactions(log.frame(), cfg)
    assert {(r.customer_id, r.y) for r in labels.build_labels(tx, cfg).collect()} == {(1, 1), (3, 0)}
    assert {r.customer_id for r in labels.build_population(tx, cfg).collect()} == {1, 3}
    past, future = labels.real_purchases(tx, None, CUTOFF), labels.real_purchases(tx, CUTOFF, END)
    guard = checks.temporal_guard(past, future, cfg).first()
    assert guard.last_observation == CUTOFF - second and guard.first_prediction == CUTOFF
    assert guard.rows_beyond_horizon == 0 and guard.holds
    # Each side may break its window.
    for wrong in ((tx, future), (past, tx), (future, past),
                  (past, labels.real_purchases(tx, CUTOFF, None))):
        assert not checks.temporal_guard(*wrong, cfg).first().holds
        with pytest.raises(checks.ContractViolation):
            checks.validate_windows(*wrong, cfg)


def test_whole_days_do_not_depend_on_the_zone(spark, log, cfg):
    log.add(1, datetime(2021, 3, 14, 2, 30), "1").add(1, datetime(2021, 3, 15, 2, 45), "2")
    ends = log.frame().agg(F.min("invoice_date").alias("a"), F.max("invoice_date").alias("b"))
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for name in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", name)
            row = ends.select(whole_days(F.col("a"), F.col("b")).alias("days"),
                              micros_since_epoch(F.col("a")).alias("at")).first()
            assert row.days == 1 and row.at == 1_615_689_000_000_000
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_gaps_truncate_to_whole_days(log, cfg):
    day = datetime(2020, 6, 1, 9)
    (log.add(1, day, "1").add(1, day.replace(hour=15), "2")          # one day, two orders
        .add(2, day, "3")                                             # one order
        .add(3, day, "4").add(3, day + timedelta(hours=47, minutes=59), "5")
        .add(4, day, "6").add(4, day + timedelta(days=2), "7")
        .add(5, datetime(2020, 12, 30, 16, 36), "8"))
    rows = build(log, cfg)
    assert rows[1].avg_days_between_orders == 1.0
    assert rows[1].recency_over_avg_gap == rows[1].recency_days
    assert rows[2].avg_days_between_orders == cfg.observation_days == 366
    assert rows[2].is_single_order_customer and not rows[1].is_single_order_customer
    assert rows[3].avg_days_between_orders == 1.0 and rows[4].avg_days_between_orders == 2.0
    assert rows[5].recency_days == 1  # 31 h 24 min, although two calendar dates apart
    same_day = profiling.same_day_repeaters(clean_transactions(log.frame(), cfg), cfg).first()
    assert same_day.same_day_repeaters == 1


def test_returns(log, cfg):
    day = datetime(2020, 6, 1)
    (log.add(1, day, "C1", qty=-5)                                    # cancellation only
        .add(2, day, "2", qty=1).add(2, day, "C3", qty=-3).add(2, day, "C4", qty=-1)
        .add(3, day, "5"))
    rows = build(log, cfg)
    assert set(rows) == {2, 3}
    assert rows[2].cancel_order_count == 2 and rows[2].cancel_order_rate == 2.0
    assert rows[2].return_value_ratio == 4.0
    assert rows[3].cancel_order_count == 0 and rows[3].return_value_ratio == 0.0


def test_momentum(log, cfg):
    (log.add(1, CUTOFF - timedelta(days=90), "1", qty=10)
        .add(2, CUTOFF - timedelta(days=366), "2")
        .add(3, CUTOFF - timedelta(days=91), "3").add(3, CUTOFF - timedelta(days=30), "4"))
    rows = build(log, cfg)
    assert 3.99 < rows[1].spend_momentum < 4.0
    assert rows[2].spend_momentum == 0.0 and rows[2].spend_last_365d == 0.0
    assert (rows[3].orders_last_30d, rows[3].orders_last_90d, rows[3].orders_last_180d) == (1, 1, 2)
    assert rows[1].orders_last_90d == 1


def test_orders_and_variety(log, cfg):
    # One order whose lines fall in two months, bought twice over as exact duplicates.
    (log.add(1, datetime(2020, 6, 30, 23), "1", "20001").add(1, datetime(2020, 7, 1, 1), "1", "20002")
        .add(1, datetime(2020, 6, 30, 23), "1", "20001")
        .add(1, datetime(2020, 7, 5), "2", "20001", price=5.0))
    row = build(log, cfg)[1]
    assert row.frequency == 2 and row.distinct_products == 2 and row.distinct_active_months == 2
    assert row.avg_distinct_products_per_order == 1.5
    assert row.total_quantity == 4 and row.avg_items_per_order == 2.0
    assert row.avg_unit_price == 11.0 / 4 and row.monetary_total == 11.0


def test_latest_country(log, cfg):
    day = datetime(2020, 6, 1)
    (log.add(1, day, "1", country="France").add(1, day, "2", country="Spain")
        .add(2, day, "3", country="Spain").add(2, day + timedelta(microseconds=1), "4", country="Peru")
        .add(3, day, "5", country="Other").add(4, day, "6", country=None)
        .add(5, datetime(1969, 5, 1), "7", country="Spain"))
    rows = build(log, cfg)
    assert rows[1].country == "Spain"      # a tie goes to the later name
    assert rows[2].country == rows[3].country == rows[4].country == "Other"
    assert rows[5].country == "Spain"      # before the epoch


def test_vocabulary(log, cfg):
    day = datetime(2020, 6, 1)
    (log.add(1, day, "1").add(2, day, "2").add(3, day, "3", country="Peru")
        .add(3, day, "4", country="Peru"))
    vocabulary = features.country_vocabulary(clean_transactions(log.frame(), cfg), cfg)
    assert {(r.country, r.customers, r.in_vocabulary) for r in vocabulary.collect()} == {
        ("France", 2, True), ("Peru", 1, False)}
    coverage = features.vocabulary_coverage(vocabulary).first()
    assert coverage.countries_kept == 1 and coverage.pct_covered == pytest.approx(200 / 3)


@pytest.fixture
def busy(log):
    """Many customers, with one that owns a third of all rows."""
    for i in range(300):
        customer = 1 if i % 3 == 0 else 2 + i % 40
        when = datetime(2020, 1, 1) + timedelta(days=i % 400, hours=i % 24)
        prefix = "C" if i % 11 == 0 else ""
        log.add(customer, when, f"{prefix}{i // 2}", code=f"{20000 + i % 17}",
                qty=-2 if prefix else 1 + i % 5, price=1 + (i % 4) / 4,
                country=("France", "Spain", "Peru")[i % 3])
    return log


def test_row_order_and_partitioning_do_not_matter(busy, cfg):
    raw = busy.frame()
    shuffled = raw.repartition(7, "stock_code").orderBy(F.xxhash64("invoice"))
    one, other = (features.build_customer_features(clean_transactions(r, cfg), cfg)
                  for r in (raw, shuffled))
    assert checks.frames_equal(one, other)


def test_later_rows_change_no_feature(busy, cfg):
    before = features.build_customer_features(clean_transactions(busy.frame(), cfg), cfg).collect()
    busy.add(1, CUTOFF, "9001", qty=500).add(2, CUTOFF + timedelta(days=5), "C9002", qty=-1)
    after = features.build_customer_features(clean_transactions(busy.frame(), cfg), cfg).collect()
    assert sorted(before) == sorted(after)


def test_feature_contract(busy, cfg):
    built = features.build_customer_features(clean_transactions(busy.frame(), cfg), cfg)
    checks.validate_features(built)
    assert built.columns == ["customer_id", *cfg.feature_columns[:23], "country"]
    with pytest.raises(checks.ContractViolation, match="null country"):
        checks.validate_features(built.withColumn("country", F.lit(None).cast("string")))
    with pytest.raises(checks.ContractViolation, match="infinite spend_momentum"):
        checks.validate_features(built.withColumn("spend_momentum", F.lit(float("-inf"))))


def test_one_row_encodes_like_the_batch(busy, cfg):
    built = features.build_customer_features(clean_transactions(busy.frame(), cfg), cfg)
    batch = encoding.encode_features(built, cfg)
    assert tuple(batch.columns) == ("customer_id", *cfg.feature_columns)
    one = built.filter("country = 'Other'").orderBy("customer_id").limit(1)
    single = encoding.encode_features(one, cfg)
    assert checks.frames_equal(
        single, batch.join(one.select("customer_id"), "customer_id", "left_semi"))
    assert single.first().country_Other == 1


def test_unknown_country_encodes_to_zeros(spark, cfg):
    row = spark.createDataFrame([(1, "Peru")], "customer_id long, country string")
    encoded = encoding.encode_features(row, cfg).first()
    assert [encoded[c] for c in cfg.country_columns] == [0, 0, 0]
    assert encoded.frequency == 0


def test_standardise_uses_train_statistics(spark):
    train = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    scaled = encoding.standardise(train.limit(10), train, ["a", "b"]).collect()
    assert sorted(r.a for r in scaled) == [-1.0, 1.0]
    assert {r.b for r in scaled} == {0.0}  # constant: centred only


def test_join_row_counts(spark):
    left = spark.createDataFrame([(1,), (1,), (2,)], "customer_id long")
    right = spark.createDataFrame([(1,), (1,), (3,)], "customer_id long")
    counts = checks.join_row_counts(left, right).first()
    assert (counts.left_rows, counts.right_rows, counts.joined_rows) == (3, 3, 4)
