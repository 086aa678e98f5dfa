import json
import os
from multiprocessing.pool import ThreadPool
from time import sleep
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortline.config import STAR_CONFIG
from cohortline.operators import audit, checks, models
from cohortline.plans import jobs
from cohortline.plans.workspace import LEAF_BOUND, DEPTH_BOUND, LOGISTIC, RULE, workspace
from cohortline.session import shared_folder, stage
from cohortline.sources import ingest, published, sinks, star_tables

FOLDER = "/root/testdata/sf0.001"
TINY = models.SearchSpace(trees=(2, 3), depth=(2, 2))
TINY_LEAVES = models.SearchSpace(trees=(2, 3), leaves=(3, 4), min_rows=(5, 5))


@pytest.fixture(scope="module")
def space(spark):
    return workspace(spark, FOLDER)


# ---- models

def test_logistic_is_at_the_penalised_optimum(space):
    """The gradient of sum(loss) + w'w / 2 vanishes: unit-strength L2, free intercept."""
    model = space.logistic()
    rows = model.transform(space.train()).select("features", "y", "probability").collect()
    x = np.array([r.features.toArray() for r in rows])
    y = np.array([float(r.y) for r in rows])
    p = np.array([r.probability[1] for r in rows])
    gradient = x.T @ (p - y) + model.stages[-1].coefficients.toArray()
    assert np.abs(gradient).max() < 1e-2
    assert abs((p - y).sum()) < 1e-2


def _few_columns(spark, n, seed=3):
    """Rows whose columns hardly differ, which quasi-Newton steps end early on."""
    rng = np.random.default_rng(seed)
    base = rng.normal(size=n)
    x = np.column_stack([base, base + 0.01 * rng.normal(size=n), 0.001 * rng.normal(size=n) + base,
                         rng.exponential(size=n) ** 3])
    y = (rng.uniform(size=n) < 1 / (1 + np.exp(-2 * base + 40 * (x[:, 1] - base) - 1))).astype(int)
    rows = [(*map(float, r), int(label)) for r, label in zip(x, y)]
    return spark.createDataFrame(rows, "a double, b double, c double, d double, y int")


def test_optimum_is_reached_on_many_rows_in_few_passes(spark, monkeypatch):
    passes, curves = [], models._curves
    monkeypatch.setattr(models, "_curves", lambda at: passes.append(1) or curves(at))
    df, copies = _few_columns(spark, 20000), 50
    fitted = models.logistic(copies * 20000, STAR_CONFIG, ["a", "b", "c", "d"]).fit(
        df.crossJoin(spark.range(copies)))
    rows = fitted.transform(df).select("features", "y", "probability").collect()
    x = np.array([r.features.toArray() for r in rows])
    miss = copies * np.array([r.probability[1] - r.y for r in rows])
    slope = x.T @ miss + fitted.stages[-1].coefficients.toArray()
    assert np.abs(slope).max() < 1e-4 and abs(miss.sum()) < 1e-4
    assert 1 < len(passes) < 10


def test_fits_without_a_slope_stay_as_they_are(spark):
    rng = np.random.default_rng(4)
    rows = [(float(a), float(b), int(a + c > 0)) for a, b, c in rng.normal(size=(300, 3))]
    df = models.VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(
        spark.createDataFrame(rows, "a double, b double, y int"))
    options = {"labelCol": "y", "regParam": 1 / 300, "standardization": False, "tol": 1e-9}
    plain = models.LogisticRegression(**options).fit(df)
    assert models.NewtonLogistic(**options).fit(df).coefficients == plain.coefficients


@pytest.mark.parametrize("labels", [(0, 1, 2), (1, 1, 1), (0, 0, 0)])
def test_other_labels_are_left_to_spark(spark, labels):
    rows = [(float(i % 7), float(i % 5), labels[i % 3]) for i in range(60)]
    df = models.VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(
        spark.createDataFrame(rows, "a double, b double, y int"))
    options = {"labelCol": "y", "regParam": 0.1, "standardization": False}
    plain = models.LogisticRegression(**options).fit(df)
    found = models.NewtonLogistic(**options).fit(df)
    assert found.coefficientMatrix == plain.coefficientMatrix
    assert found.interceptVector == plain.interceptVector


def test_coefficients_carry_their_names(space, cfg):
    table = models.coefficients(space.logistic(), STAR_CONFIG)
    values = dict(zip(models.feature_names(STAR_CONFIG),
                      space.logistic().stages[-1].coefficients.toArray()))
    got = {r.feature: r.coefficient for r in table.collect()}
    assert got == pytest.approx(values) and len(got) == len(STAR_CONFIG.feature_columns)
    assert models.strongest(table, 5).count() == 10


def test_subset_preprocessing_drops_the_rest(space):
    subset = models.logistic(space.n_train(), STAR_CONFIG, ["frequency", "monetary_total"])
    model = subset.fit(space.train())
    assert model.stages[-1].numFeatures == 2
    scaled = model.transform(space.train()).select("features").collect()
    assert np.abs(np.mean([r.features.toArray() for r in scaled], axis=0)).max() < 1e-9


def test_out_of_fold_covers_every_training_row_once(space):
    oof = models.out_of_fold(
        space.train(), lambda n: models.logistic(n, STAR_CONFIG), LOGISTIC, STAR_CONFIG)
    lined_up = checks.unmatched_keys(oof, space.train()).first()
    assert lined_up.unmatched_rows == 0 and lined_up.scored_rows == space.n_train()
    held_out = space.train().filter("fold = 2")
    other = models.logistic(space.train().filter("fold <> 2").count(), STAR_CONFIG).fit(
        space.train().filter("fold <> 2"))
    expected = {r.customer_id: r.score for r in models.scored(other, held_out, "x").collect()}
    got = {r.customer_id: r.score for r in oof.filter("fold = 2").collect()}
    assert got == pytest.approx(expected)


def test_search_samples_the_space_and_marks_the_best(space):
    samples = models.DEPTH_BOUND.sample(40, 42)
    assert len(samples) == 40 and samples == models.DEPTH_BOUND.sample(40, 42)
    assert all(50 <= s.trees <= 399 and 2 <= s.depth <= 6 and s.leaves is None for s in samples)
    assert all(s.min_rows >= 5 and 7 <= s.leaves <= 62 for s in models.LEAF_BOUND.sample(40, 42))
    found = models.random_search(space.train(), TINY, STAR_CONFIG.with_(search_settings=2))
    rows = found.table.collect()
    assert [r.is_best for r in rows].count(True) == 1
    best = max(rows, key=lambda r: r.cv_roc_auc)
    assert best.is_best and best.parameters == str(found.best)
    # The scores left behind are those of the best setting, fitted without the row's fold.
    model = models.boosted(space.train(), [(found.best, 2)], STAR_CONFIG).models[0]
    lined_up = checks.unmatched_keys(found.held_out, space.train()).first()
    assert lined_up.unmatched_rows == 0
    if found.best == TINY.sample(2, STAR_CONFIG.seed)[0]:
        want = models.scored(model, space.train().filter("fold = 2"), "x").collect()
        got = {r.customer_id: r.score for r in found.held_out.filter("fold = 2").collect()}
        assert got == pytest.approx({r.customer_id: r.score for r in want})


def test_saved_model_predicts_the_same(space, tmp_path):
    again = sinks.save_model(space.logistic(), str(tmp_path / "model"))
    one = models.scored(space.logistic(), space.test(), LOGISTIC)
    assert checks.frames_equal(one, models.scored(again, space.test(), LOGISTIC))


# ---- sources and sinks

HEADER = "Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country\n"


def write_csv(path, rows, header=HEADER):
    path.write_text(header + "".join(rows))
    return str(path)


def test_csv_parts_keep_prefixed_invoices(spark, tmp_path):
    one = write_csv(tmp_path / "one.csv", [
        "489434,85048,LIGHTS,12,2009-12-01 07:45:00,6.95,13085,United Kingdom\n"])
    # The second part has its columns in another order.
    two = write_csv(tmp_path / "two.csv", [
        "United Kingdom,C489449,22087,BUNTING,-12,2009-12-01 10:33:00,2.95,\n"],
        "Country,Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID\n")
    raw = ingest.load_raw(spark, {"first": one, "second": two})
    rows = {r.source_sheet: r for r in raw.collect()}
    assert rows["second"].invoice == "C489449" and rows["second"].customer_id is None
    assert rows["first"].invoice_date == datetime(2009, 12, 1, 7, 45)
    assert dict(raw.dtypes)["invoice_date"] == "timestamp_ntz"


def test_files_of_one_part_must_share_a_heading(spark, tmp_path):
    folder = tmp_path / "part"
    folder.mkdir()
    write_csv(folder / "a.csv", ["489434,85048,LIGHTS,12,2009-12-01 07:45:00,6.95,13085,France\n"])
    write_csv(folder / "b.csv", ["85048,489435,LIGHTS,12,2009-12-01 07:45:00,6.95,13085,France\n"],
              "StockCode,Invoice,Description,Quantity,InvoiceDate,Price,Customer ID,Country\n")
    with pytest.raises(Exception, match="header|heading|schema"):
        ingest.read_part(spark, str(folder), "part").collect()


def test_every_parquet_file_must_have_all_columns(spark, tmp_path):
    whole = star_tables.source_log(spark, FOLDER).limit(5)
    path = str(tmp_path / "part")
    whole.write.parquet(path)
    assert ingest.read_part(spark, path, "part", "parquet").count() == 5
    whole.drop("Country").write.mode("append").parquet(path)
    with pytest.raises(ValueError, match="Country"):
        ingest.read_part(spark, path, "part", "parquet")


def test_missing_column_and_bad_value_raise(spark, tmp_path):
    short = write_csv(tmp_path / "short.csv", ["1,2\n"], "Invoice,StockCode\n")
    with pytest.raises(ValueError, match="Customer ID"):
        ingest.read_part(spark, short, "short")
    bad = write_csv(tmp_path / "bad.csv", ["C1,2,x,many,2009-12-01 07:45:00,1.0,1,France\n"])
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|FAILED_READ"):
        ingest.read_part(spark, bad, "bad").collect()


def test_raw_parquet_is_built_once(spark, tmp_path):
    line = "C1,2,x,-1,2009-12-01 07:45:00,1.0,1,France\n"
    source = write_csv(tmp_path / "p.csv", [line])
    target = str(tmp_path / "raw")
    assert ingest.build_raw_parquet(spark, {"p": source}, target).count() == 1
    source = write_csv(tmp_path / "q.csv", [line, line])
    assert ingest.build_raw_parquet(spark, {"p": source}, target).count() == 1
    assert ingest.build_raw_parquet(spark, {"p": source}, target, force=True).count() == 2


def test_parquet_sink_checks_its_reload(spark, tmp_path):
    frame = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "k long, v string")
    assert checks.frames_equal(sinks.write_checked(frame, str(tmp_path / "t")), frame)
    # Evaluated anew for the comparison, hence different from what was written.
    unstable = frame.withColumn("at", F.current_timestamp())
    with pytest.raises(checks.ContractViolation, match="rows changed"):
        sinks.write_checked(unstable, str(tmp_path / "u"))


def test_a_frame_that_is_written_once_is_not_evaluated_again(spark, tmp_path):
    own = sinks.observing(spark).range(50).withColumn("at", F.rand())
    assert sinks.write_checked(own, str(tmp_path / "t"), once=True).count() == 50


@pytest.mark.parametrize("harm", ["lost", "changed", "doubled", "swapped nulls"])
def test_parquet_sink_finds_every_harm(spark, tmp_path, monkeypatch, harm):
    """The files are harmed between the write and the reload; the old version stays."""
    path = str(tmp_path / "t")
    frame = spark.createDataFrame(
        [(1, "a", None), (1, "a", None), (2, None, "b"), (3, "c", "d")], "k long, v string, w string")
    sinks.write_checked(frame.limit(1), path)
    harmed = {"lost": frame.filter("k < 3"), "changed": frame.withColumn("v", F.lit("a")),
              "doubled": frame.union(frame.filter("k = 3")),
              "swapped nulls": frame.withColumns({"v": F.col("w"), "w": F.col("v")})}[harm]
    own = sinks.observing(spark)
    reload = checks.fingerprint
    monkeypatch.setattr(sinks, "fingerprint", lambda df: reload(harmed))
    whole = own.createDataFrame(frame.collect(), frame.schema)
    with pytest.raises(checks.ContractViolation, match="rows changed"):
        sinks.write_checked(whole, path, once=True)
    assert published.read(spark, path).count() == 1


def test_fingerprints_compare_rows_in_any_order(spark):
    rows = [(1, 0.0, "a"), (1, 0.0, "a"), (None, 2.5, None), (2, None, "a")]
    one = spark.createDataFrame(rows, "k long, x double, v string")
    other = spark.createDataFrame([(k, -0.0 if x == 0 else x, v) for k, x, v in rows[::-1]], one.schema)
    assert checks.frames_match(one, other.repartition(3))
    assert not checks.frames_match(one, one.distinct())
    assert not checks.frames_match(one, one.withColumn("k", F.col("k").cast("int")))
    assert checks.frames_match(one.limit(0), other.limit(0))


def test_the_reload_check_shuffles_no_row(spark):
    plan = checks.fingerprint(spark.range(100).repartition(4)).filter("n_rows > 0")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange SinglePartition") == 1 and "hashpartitioning" not in text


def test_a_failed_write_leaves_the_old_version(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_checked(spark.range(5), path)
    held = published.read(spark, path)
    broken = spark.range(100).repartition(4).select(
        F.when(F.col("id") < 90, F.col("id")).otherwise(F.raise_error(F.lit("midway"))).alias("id"))
    with pytest.raises(Exception, match="midway"):
        sinks.write_checked(broken, path)
    assert published.read(spark, path).count() == 5
    with pytest.raises(checks.ContractViolation, match="no"):
        sinks.write_checked(spark.range(7), path, lambda: (_ for _ in ()).throw(checks.ContractViolation("no")))
    assert published.read(spark, path).count() == 5
    # A reader keeps the version it opened while the next one is published.
    sinks.write_checked(spark.range(8), path)
    assert (held.count(), published.read(spark, path).count()) == (5, 8)
    sinks.write_checked(spark.range(9), path)
    assert len(published.versions(spark, path)) == 2
    kept = [d for d in os.listdir(path) if d in published.versions(spark, path)]
    assert len(kept) == 2 and published.read(spark, path).count() == 9


def test_a_rebuild_that_breaks_the_contract_changes_nothing(spark, tmp_path):
    good = write_csv(tmp_path / "g.csv", ["C1,2,x,-1,2009-12-01 07:45:00,1.0,1,France\n"])
    bad = write_csv(tmp_path / "b.csv", ["1,2,x,1,2009-12-01 07:45:00,1.0,1,France\n"] * 2)
    target = str(tmp_path / "raw")
    ingest.build_raw_parquet(spark, {"p": good}, target)
    with pytest.raises(checks.ContractViolation, match="cancellation"):
        ingest.build_raw_parquet(spark, {"p": bad}, target, force=True)
    assert ingest.build_raw_parquet(spark, {"p": bad}, target).count() == 1


def test_cleaning_counts_what_the_filters_do(spark, tmp_path, log, cfg):
    day = datetime(2020, 5, 1)
    log.add(1, day, "1").add(1, day, "C2", qty=-1).add(1, day, "A3").add(2, day, "4", price=0.0)
    out = jobs.Layout(str(tmp_path / "once"))
    log.frame().write.parquet(out.raw)
    assert jobs.cleaning_job(spark, cfg, out).count() == 2
    tracker = audit.normalise(spark.read.parquet(out.raw)).agg(*audit.filter_counts(cfg)).first()
    assert (tracker.rows_in, tracker.rows_out, tracker.dropped_1, tracker.dropped_3) == (4, 2, 1, 1)


def _rows_scanned(df):
    """Rows that the scan itself gave out, after whole row groups were skipped."""
    df.sparkSession.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = df.select(*df.columns)
        plan._jdf.collect()
        leaf = plan._jdf.queryExecution().executedPlan().collectLeaves().head()
        return leaf.metrics().apply("numOutputRows").value()
    finally:
        df.sparkSession.conf.set("spark.sql.adaptive.enabled", "true")


def test_a_lookup_skips_row_groups_without_the_customer(spark, tmp_path):
    # Customers alternate between eight files, so every file spans nearly all ids.
    rows = spark.range(0, 8000, 1, 1).select(
        F.col("id").alias("customer_id"), (F.col("id") % 8).alias("part"))
    paths = {}
    for name, options in (("plain", {}), ("filtered", ingest.lookup_filters("customer_id"))):
        paths[name] = str(tmp_path / name)
        rows.repartitionByRange(8, "part").drop("part").write.options(**options).parquet(paths[name])
    one = {n: spark.read.parquet(p).filter("customer_id = 4003") for n, p in paths.items()}
    assert [df.count() for df in one.values()] == [1, 1]
    assert _rows_scanned(one["plain"]) >= 7000
    assert _rows_scanned(one["filtered"]) <= 2000


def test_stage_writes_to_the_shared_folder(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    frame = stage(spark.range(5), "numbers")
    assert frame.count() == 5
    assert all(shared_folder(spark) in f for f in frame.inputFiles())


def test_cleaning_job_stops_on_a_lost_cancellation_or_an_unknown_invoice(spark, tmp_path, log, cfg):
    day = datetime(2020, 5, 1)
    for name, bad in (("lost", dict(invoice="C9", price=0.0, qty=-1)), ("odd", dict(invoice="X9"))):
        log.rows.clear()
        log.add(1, day, "1").add(1, day, "C2", qty=-1).add(1, day, **bad)
        out = jobs.Layout(str(tmp_path / name))
        log.frame().write.parquet(out.raw)
        with pytest.raises(checks.ContractViolation, match="cancellations|unknown kind"):
            jobs.cleaning_job(spark, cfg, out)
    log.rows.clear()
    log.add(1, day, "1").add(1, day, "C2", qty=-1)
    out = jobs.Layout(str(tmp_path / "good"))
    log.frame().write.parquet(out.raw)
    assert jobs.cleaning_job(spark, cfg, out).count() == 2


def test_stages_are_built_once_by_many_threads(spark):
    built = []
    space = workspace(spark, FOLDER)
    with ThreadPool(8) as pool:
        pool.map(lambda _: space._once("threads", lambda: built.append(1) or sleep(0.05)), range(8))
    assert built == [1]


# ---- from source files to the record

def test_all_jobs_from_csv_to_record(spark, tmp_path):
    parts = {}
    for i, name in enumerate(star_tables.PARTS):
        parts[name] = str(tmp_path / f"part{i}")
        star_tables.source_part(star_tables.source_log(spark, FOLDER), name).write.options(
            header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(parts[name])
    quick = STAR_CONFIG.with_(search_settings=1)
    record = jobs.run_all(spark, parts, quick, str(tmp_path / "out"),
                          depth_bound=TINY, leaf_bound=TINY_LEAVES).first()
    out = jobs.Layout(str(tmp_path / "out"))
    assert checks.frames_equal(published.read(spark, out.raw),
                               star_tables.transactions_raw(star_tables.source_log(spark, FOLDER)))
    matrix = published.read(spark, out.matrix)
    n = matrix.count()
    assert n > 100 and len(matrix.columns) == 2 + len(STAR_CONFIG.feature_columns)
    assert published.read(spark, out.train).count() == n - -(-n // 5)
    assert published.read(spark, out.predictions(LOGISTIC)).columns == ["customer_id", "y", "oof_proba"]
    assert record.selected_model in (LOGISTIC, DEPTH_BOUND, LEAF_BOUND)
    assert record.model_path == out.model(record.selected_model)
    files = [f for f in os.listdir(out.record) if f.endswith(".json")]
    assert len(files) == 1
    text = json.loads(open(os.path.join(out.record, files[0])).read())
    assert text["decision_parameters"]["cost_wasted_offer"] == 0.15
    assert RULE.lower().replace(" ", "_") in text["metrics"]["test_cost_per_customer"]


def test_the_raw_log_is_the_stored_source(space):
    """One shuffle and one written table serve both headings; its files are narrow in time."""
    assert space.raw().inputFiles() == space.source().inputFiles()
    parts = star_tables.raw_from_parts(space.source())
    assert checks.frames_equal(space.raw(), parts.select(*space.raw().columns))
    spans = (space.source().groupBy(F.input_file_name().alias("file"))
             .agg(F.min("InvoiceDate").alias("low"), F.max("InvoiceDate").alias("high"))
             .orderBy("low", "high").collect())
    assert all(a.high <= b.low for a, b in zip(spans, spans[1:]))
