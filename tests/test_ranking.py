"""Quantiles, splits, the quintile rule, metrics and decisions on small frames."""

import math
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from cohortline.config import RetentionConfig
from cohortline.operators import checks, decision, metrics, ordered, rfm, splits

CFG = RetentionConfig()
RULE = "rule"


def scores_frame(spark, rows):
    return spark.createDataFrame(rows, "candidate string, y int, score double")


def brute_auc(pairs):
    pos = [s for y, s in pairs if y == 1]
    neg = [s for y, s in pairs if y == 0]
    if not pos or not neg:
        return None
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def brute_precision(pairs):
    pos = sum(y for y, _ in pairs)
    if not pos:
        return None
    total = 0.0
    for y, s in pairs:
        if y == 1:
            chosen = [v for v, o in pairs if o >= s]
            total += sum(chosen) / len(chosen)
    return total / pos


def brute_sweep(pairs, cfg):
    best = None
    for t in sorted({s for _, s in pairs}):
        cost = (cfg.cost_missed_churner * sum(1 for y, s in pairs if s >= t and y == 0)
                + cfg.cost_wasted_offer * sum(1 for y, s in pairs if s < t and y == 1))
        if best is None or cost < best[1]:
            best = (t, cost)
    return best


# ---- running totals and quantiles

@pytest.fixture(params=["merged slices", "many slices"])
def slicing(spark, request):
    """Small inputs end up in one slice; without merging they fill several."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, str(request.param == "merged slices").lower())
    yield request.param
    spark.conf.unset(key)


def test_running_totals_equal_a_plain_window(spark, slicing, monkeypatch):
    stored = []
    keep = ordered.stage
    monkeypatch.setattr(
        ordered, "stage", lambda df, name: stored.append(keep(df, name)) or stored[-1])
    # Rows without a group are a group of their own.
    rows = [(g, float(i), random.Random(i).randint(0, 9)) for g in ("a", "b", None) for i in range(200)]
    counts = spark.createDataFrame(rows, "g string, v double, w long")
    plain = counts.withColumns({
        "w_upto": F.sum("w").over(Window.partitionBy("g").orderBy("v")),
        "w_total": F.sum("w").over(Window.partitionBy("g"))})
    sliced = ordered.running_totals(counts, ["g"], "v", ["w"])
    assert checks.frames_equal(plain, sliced.select(plain.columns))
    slices = stored[0].groupBy("slice").agg(F.count("*").alias("n")).collect()
    assert (len(slices) > 1) == (slicing == "many slices")


def test_medians_of_rows_without_a_group(spark, slicing):
    frame = spark.createDataFrame([("a", 1.0), ("a", 2.0), (None, 5.0), (None, 9.0)], "g string, v double")
    got = {r.g: r.v for r in ordered.medians(frame, ["v"], by=["g"]).collect()}
    assert got == {"a": 1.5, None: 7.0}


def test_ranks_of_rows_without_a_class(spark):
    keys = spark.createDataFrame([(i, None if i % 3 else 1) for i in range(30)], "customer_id long, y int")
    ranks = splits.ranked_within_class(keys, 1).collect()
    assert sorted(r["rank"] for r in ranks if r.y is None) == list(range(1, 21))
    assert splits.assign_split(keys, CFG).filter("split = 'test'").count() == 6


@pytest.mark.parametrize("n", [1, 2, 7, 101])
def test_quantiles_match_numpy(spark, slicing, n):
    draw = random.Random(n)
    values = [float(draw.choice([1, 2, 2, 5, draw.uniform(0, 50)])) for _ in range(n)]
    frame = spark.createDataFrame([(v, i % 2) for i, v in enumerate(values)], "v double, half int")
    probs = [0.0, 0.2, 0.5, 0.99, 1.0]
    result = {r.fit: r for r in ordered.exact_quantiles(
        frame, ["v"], probs, fits={"all": F.lit(True), "even": F.col("half") == 0}).collect()}
    assert result["all"].quantiles == pytest.approx(np.quantile(values, probs).tolist())
    assert result["even"].quantiles == pytest.approx(np.quantile(values[::2], probs).tolist())
    nearest = ordered.exact_quantiles(frame, ["v"], [0.99], nearest=[0.99]).first().quantiles[0]
    assert nearest == sorted(values)[math.floor(0.99 * (n - 1) + 0.5)]


@pytest.mark.parametrize(("grid", "cuts", "crowded"), [(1 << 12, 1 << 16, 1), (1, 4, 1)])
@pytest.mark.parametrize("shape", ["narrow", "tails", "hot", "negative", "outlier"])
def test_quantiles_of_crowded_cells(spark, monkeypatch, grid, cuts, crowded, shape):
    for name, value in (("GRID", grid), ("CUTS", cuts), ("CROWDED", crowded)):
        monkeypatch.setattr(ordered, name, value)
    rng = random.Random(shape)
    draw = {
        "narrow": lambda: 1.0 + rng.random() * 1e-9,
        "tails": lambda: rng.choice([-1, 1]) * math.exp(rng.uniform(-30, 300)),
        "hot": lambda: 5.0 if rng.random() < 0.4 else float(rng.randint(4, 6)),
        "negative": lambda: -rng.random() * 100,
        "outlier": lambda: 1e15 + rng.randint(0, 40) if rng.random() < 0.95 else 1e300,
    }[shape]
    values = [draw() for _ in range(240)]
    probs = [0.0, 0.1, 0.5, 0.9, 1.0]
    frame = spark.createDataFrame(
        [(v, i % 3, None if i % 2 else "g") for i, v in enumerate(values)],
        "v double, third int, g string")
    found = ordered.exact_quantiles(
        frame, ["v"], probs, by=["g"], nearest=probs,
        fits={"all": F.lit(True), "some": F.col("third") != 0, "none": F.col("third") > 5}).collect()
    got = {(r.g, r.fit): (r.n, r.quantiles) for r in found}
    want = {}
    for g, odd in (("g", 0), (None, 1)):
        for fit, skip in (("all", None), ("some", 0)):
            own = sorted(v for i, v in enumerate(values) if i % 2 == odd and i % 3 != skip)
            want[g, fit] = (len(own), [own[math.floor(p * (len(own) - 1) + 0.5)] for p in probs])
    assert got == want


def test_quantiles_of_values_without_end(spark, monkeypatch):
    monkeypatch.setattr(ordered, "CROWDED", 1)
    values = [float("-inf"), -2.0, 0.0, 1.7e308, 1.7e308, float("inf"), float("inf"), float("nan")]
    found = ordered.exact_quantiles(
        spark.createDataFrame([(v,) for v in values], "v double"), ["v"],
        [k / 7 for k in range(8)], nearest=[k / 7 for k in range(8)]).first().quantiles
    assert found[:7] == values[:7] and math.isnan(found[7])
    nothing = spark.createDataFrame([(None,)], "v double")
    assert ordered.exact_quantiles(nothing, ["v"], [0.5]).count() == 0


def test_quantiles_move_cells_not_rows(spark, monkeypatch):
    stored = []
    keep = ordered.stage
    monkeypatch.setattr(
        ordered, "stage", lambda df, name: stored.append(keep(df, name)) or stored[-1])
    frame = spark.range(20_000).selectExpr("cast(id % 5000 as double) AS v")
    found = ordered.exact_quantiles(frame, ["v"], [0.25, 0.5])
    assert found.first().quantiles == np.quantile(np.arange(20_000) % 5000, [0.25, 0.5]).tolist()
    assert len(stored) == 1 and stored[0].count() <= 4
    assert "rangepartitioning" not in found._jdf.queryExecution().toString().lower()


def test_medians_ignore_nulls_and_follow_groups(spark):
    frame = spark.createDataFrame(
        [(0, 1.0), (0, None), (0, 3.0), (1, 7.0)], "y int, v double")
    assert {(r.y, r.v) for r in ordered.medians(frame, ["v"], by=["y"]).collect()} == {
        (0, 2.0), (1, 7.0)}


# ---- splits

def keys_frame(spark, positives, negatives):
    rows = [(i, 1) for i in range(positives)] + [(1000 + i, 0) for i in range(negatives)]
    return spark.createDataFrame(rows, "customer_id long, y int")


@pytest.mark.parametrize("positives, negatives, test_pos, test_neg", [
    (7, 13, 1, 3), (5, 5, 1, 1), (3, 8, 1, 2), (0, 10, 0, 2)])
def test_split_quotas_are_exact(spark, positives, negatives, test_pos, test_neg):
    split = splits.assign_split(keys_frame(spark, positives, negatives), CFG)
    got = {(r.y, r.split): r["count"] for r in split.groupBy("y", "split").count().collect()}
    assert got.get((1, "test"), 0) == test_pos and got.get((0, "test"), 0) == test_neg
    assert sum(got.values()) == positives + negatives


def test_split_depends_on_keys_only(spark):
    keys = keys_frame(spark, 40, 60)
    one = splits.assign_split(keys, CFG)
    assert checks.frames_equal(one, splits.assign_split(keys.repartition(7), CFG))
    other = splits.assign_split(keys, CFG.with_(seed=7))
    assert not checks.frames_equal(one, other)
    overlap = checks.key_overlap(one.filter("split='train'"), one.filter("split='test'")).first()
    assert (overlap.train_keys, overlap.test_keys, overlap.shared_keys) == (80, 20, 0)


def test_folds_are_balanced(spark):
    folds = splits.assign_folds(keys_frame(spark, 23, 51), CFG)
    per_class = folds.groupBy("y", "fold").count().collect()
    for y in (0, 1):
        sizes = [r["count"] for r in per_class if r.y == y]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_overlap_is_found(spark):
    a = keys_frame(spark, 3, 0)
    assert checks.key_overlap(a, a.limit(1)).first().shared_keys == 1


# ---- the rule

FREQUENCY = [1, 1, 1, 2, 2, 4, 4, 8, 8, 20]


def test_tied_frequency_gives_five_or_four_groups(spark):
    population = spark.createDataFrame(
        [(i, i * 10, f, float(i), i % 2) for i, f in enumerate(FREQUENCY)],
        "customer_id long, recency_days long, frequency long, monetary double, y int")
    quintiles = np.quantile(FREQUENCY, [0, .2, .4, .6, .8, 1]).tolist()
    assert quintiles == [1.0, 1.0, 2.0, 4.0, 8.0, 20.0]
    scored = {r.customer_id: r for r in rfm.population_scores(population).collect()}
    assert [scored[i].f_score for i in range(10)] == [1, 1, 1, 2, 2, 3, 3, 4, 4, 5]
    assert scored[0].r_score == 5 and scored[9].r_score == 1

    train = population.select(
        "customer_id", "recency_days", "frequency", F.col("monetary").alias("monetary_total"), "y",
        (F.col("customer_id") % 5).cast("int").alias("fold"))
    edges = rfm.fit_edges(train, CFG)
    whole = edges.filter("fold IS NULL AND column = 'frequency'").first()
    assert whole.n_groups == 4
    assert whole.edges == [-math.inf, 2.0, 4.0, 8.0, math.inf]
    trained = {r.customer_id: r for r in rfm.score_with_train_edges(train, edges).collect()}
    # Right-closed: a value on an edge belongs to the group below it.
    assert [trained[i].frequency_score for i in range(10)] == [1, 1, 1, 1, 1, 2, 2, 3, 3, 4]
    assert trained[0].recency_days_score == 5

    outside = train.limit(1).withColumn("frequency", F.lit(10_000)).withColumn(
        "recency_days", F.lit(-5))
    far = rfm.score_with_train_edges(outside, edges).first()
    assert far.frequency_score == 4 and far.recency_days_score == 5


def test_out_of_fold_edges_come_from_other_folds(spark):
    draw = random.Random(3)
    rows = [(i, draw.randint(0, 300), draw.randint(1, 9), draw.uniform(1, 999), i % 5)
            for i in range(60)]
    train = spark.createDataFrame(
        rows, "customer_id long, recency_days long, frequency long, monetary_total double, fold int")
    edges = rfm.fit_edges(train, CFG)
    for fold in range(5):
        rest = [r[3] for r in rows if r[4] != fold]
        found = edges.filter(f"fold = {fold} AND column = 'monetary_total'").first().edges
        assert found[1:-1] == pytest.approx(np.quantile(rest, [.2, .4, .6, .8]).tolist())
    scored = {r.customer_id: r for r in rfm.score_out_of_fold(train, edges).collect()}
    assert len(scored) == 60
    for cid, _, _, money, fold in rows:
        cuts = np.quantile([r[3] for r in rows if r[4] != fold], [.2, .4, .6, .8])
        assert scored[cid].monetary_total_score == 1 + sum(money > c for c in cuts)


# ---- metrics

def test_known_scores(spark):
    frame = scores_frame(spark, [
        *[("a", y, s) for y, s in zip([0, 0, 1, 1], [.1, .4, .35, .8])],
        *[("tied", y, 0.5) for y in (0, 0, 0, 1)]])
    got = {r.candidate: r for r in metrics.ranking_metrics(metrics.score_levels(frame)).collect()}
    assert got["a"].roc_auc == 0.75 and got["a"].pr_auc == pytest.approx(0.8333333333)
    assert got["tied"].roc_auc == 0.5 and got["tied"].pr_auc == 0.25
    points = [(r.threshold, r.fpr, r.tpr) for r in
              metrics.roc_points(metrics.score_levels(frame)).filter("candidate='tied'").collect()]
    assert sorted(points, key=str) == sorted([(0.5, 1.0, 1.0), (None, 0.0, 0.0)], key=str)


def test_one_class_has_no_auc(spark):
    frame = scores_frame(spark, [("a", 1, .1), ("a", 1, .2)])
    row = metrics.ranking_metrics(metrics.score_levels(frame)).first()
    assert row.roc_auc is None and row.pr_auc == 1.0


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 1), st.sampled_from([0.1, 0.25, 0.5, 0.75, 0.9, 1.0])),
                min_size=2, max_size=40))
def test_metrics_and_sweep_match_brute_force(spark, pairs):
    frame = scores_frame(spark, [("a", y, s) for y, s in pairs])
    levels = metrics.score_levels(frame)
    row = metrics.ranking_metrics(levels).first()
    assert row.roc_auc == (None if brute_auc(pairs) is None else pytest.approx(brute_auc(pairs)))
    assert row.pr_auc == (
        None if brute_precision(pairs) is None else pytest.approx(brute_precision(pairs)))
    best = decision.best_thresholds(decision.threshold_curve(levels, CFG)).first()
    threshold, cost = brute_sweep(pairs, CFG)
    assert best.threshold == threshold and best.cost == pytest.approx(cost)


def test_constant_baseline(spark):
    train = spark.createDataFrame([(1,), (0,), (0,)], "y int")
    row = metrics.constant_baseline(train, spark.createDataFrame([(0,), (1,)], "y int")).first()
    assert (row.majority_class, row.accuracy, row.n_rows) == (0, 0.5, 2)
    assert row.constant_score == pytest.approx(1 / 3)


def test_noise_and_selection_tables(spark):
    pooled = spark.createDataFrame(
        [(RULE, .78, .7), ("good", .80, .7), ("close", .785, .7)],
        "candidate string, roc_auc double, pr_auc double")
    spread = spark.createDataFrame(
        [("good", .80, .01), ("close", .785, .01)],
        "candidate string, cv_roc_auc double, cv_std double")
    noise = {r.candidate: r.beats_rule for r in metrics.noise_test(pooled, spread, RULE).collect()}
    assert noise == {"good": True, "close": False}
    table = {r.candidate: r for r in metrics.selection_table(spread, pooled, RULE).collect()}
    assert set(table) == {RULE, "good", "close"}
    assert table["good"].best_by_cv and not table["close"].best_by_cv and not table[RULE].best_by_cv
    assert table["good"].beats_rule_beyond_noise and not table[RULE].beats_rule_beyond_noise
    assert table[RULE].cv_roc_auc is None


def test_fold_spread_is_population_deviation(spark):
    folds = spark.createDataFrame([("a", .5), ("a", .7)], "candidate string, roc_auc double")
    row = metrics.fold_spread(folds).first()
    assert row.cv_roc_auc == pytest.approx(.6) and row.cv_std == pytest.approx(.1)


# ---- decisions

def test_sweep_edges(spark):
    frame = scores_frame(spark, [
        ("all zero", 0, .2), ("all zero", 0, .6),
        ("all one", 1, .2), ("all one", 1, .6),
        ("tie", 1, .1), ("tie", 1, .2)])
    best = {r.candidate: r for r in decision.sweep(frame, CFG).collect()}
    # The highest observed score is the last cut, so its owner never gets an offer.
    assert best["all zero"].threshold == .6 and best["all zero"].cost == 1.0
    assert best["all one"].threshold == .2 and best["all one"].cost == 0.0
    equal = scores_frame(spark, [("e", 0, .1), ("e", 0, .2), ("e", 1, .1)])
    cheap = decision.sweep(equal, CFG.with_(cost_wasted_offer=1.0)).first()
    assert cheap.threshold == .1  # both cuts cost 2; the lower one wins


def test_policies_report_and_acceptance(spark):
    rows = [(RULE, y, float(s)) for y, s in [(0, 3), (0, 5), (1, 9), (1, 12)]]
    rows += [("model", y, s) for y, s in [(0, .1), (0, .2), (1, .7), (1, .9)]]
    test = scores_frame(spark, rows)
    thresholds = spark.createDataFrame(
        [(RULE, 5.0), ("model", .7)], "candidate string, threshold double")
    policies = {r.policy: r for r in decision.trivial_policies(test, thresholds, RULE, CFG).collect()}
    assert policies["Contact nobody"].cost == 2.0
    assert policies["Contact everybody"].cost == pytest.approx(.3)
    assert policies[RULE].cost == 1.0
    assert [p for p, r in policies.items() if r.is_best] == ["Contact everybody"]
    saving = decision.cost_reduction(test, thresholds, "model", RULE, CFG).first()
    assert saving.cost == 0.0 and saving.cost_reduction == 1.0 and saving.meets_bar
    report = {r.candidate: r for r in decision.campaign_report(test, thresholds).collect()}
    assert (report[RULE].offers, report[RULE].caught, report[RULE].missed) == (1, 1, 1)
    f2 = {r.candidate: r.f2 for r in decision.f2_on_churners(
        decision.campaign_report(test, thresholds)).collect()}
    assert f2["model"] == 1.0 and f2[RULE] == pytest.approx(5 * .5 / 4.5)
    noise = spark.createDataFrame(
        [("model", .9, .01, .1, True)],
        "candidate string, roc_auc double, cv_std double, gap double, beats_rule boolean")
    verdict = decision.acceptance(
        noise, decision.cost_reduction(test, thresholds, "model", RULE, CFG), CFG).first()
    assert verdict.accepted


def test_ratio_sensitivity_matches_single_sweeps(spark):
    draw = random.Random(5)
    pairs = [(draw.randint(0, 1), round(draw.random(), 2)) for _ in range(60)]
    frame = scores_frame(spark, [("a", y, s) for y, s in pairs])
    curve = decision.threshold_curve(metrics.score_levels(frame), CFG)
    for row in decision.ratio_sensitivity(curve, [0.05, 0.5, 2.0], CFG).collect():
        threshold, cost = brute_sweep(pairs, CFG.with_(cost_wasted_offer=row.wasted_cost))
        assert row.threshold == threshold and row.cost == pytest.approx(cost)


def test_record_words_follow_the_bar(spark):
    rows = [(RULE, y, float(s)) for y, s in [(0, 3), (0, 5), (1, 9), (1, 12)]]
    rows += [("model", y, s) for y, s in [(0, .1), (0, .2), (1, .7), (1, .9)]]
    test = scores_frame(spark, rows)
    pooled = spark.createDataFrame([(RULE, .7), ("model", .9)], "candidate string, roc_auc double")

    def record(threshold):
        cuts = spark.createDataFrame(
            [(RULE, 5.0), ("model", threshold)], "candidate string, threshold double")
        return decision.selection_record(
            "model", "models/model", RULE, [RULE, "model"], pooled, cuts, test, CFG).first()

    good, bad = record(.7), record(.1)
    assert good.meets_cost_reduction_bar and good.recommendation == "Use model with offers below a score of 0.7000."
    assert not bad.meets_cost_reduction_bar and bad.recommendation.startswith("Stay with the rule")
    assert good.metrics.oof_roc_auc.model == .9
    assert good.metrics.test_cost_per_customer.contact_nobody == .5


# ---- corners of the curve ------------------------------------------------------------------

def corners_by_hand(rows):
    """Second differences of the counts, as the plotted curve is thinned."""
    out = []
    for name in {c for c, _, _ in rows}:
        mine = [(s, y) for c, y, s in rows if c == name]
        levels = sorted({s for s, _ in mine}, reverse=True)
        fp = np.array([sum(1 for s, y in mine if s >= t and y == 0) for t in levels])
        tp = np.array([sum(1 for s, y in mine if s >= t and y == 1) for t in levels])
        keep = np.ones(len(levels), bool)
        if len(levels) > 2:
            keep[1:-1] = (np.diff(fp, 2) != 0) | (np.diff(tp, 2) != 0)
        out += [(name, levels[i], fp[i], tp[i]) for i in np.flatnonzero(keep)] + [(name, None, 0, 0)]
    return sorted(map(repr, ((n, t, float(f), float(p)) for n, t, f, p in out)))


@pytest.mark.parametrize("slices", [1, 5])
def test_corners_follow_from_slices(spark, slices):
    rng = np.random.default_rng(3)
    rows = [(c, int(y), float(s)) for c in "ab" for y, s in zip(
        rng.integers(0, 2, 60), rng.integers(0, 40, 60) if c == "a" else np.arange(60) // 2)]
    rows += [("one", 1, 3.0), ("one", 0, 3.0)] + [("line", 0, float(i)) for i in range(20)] + [("line", 1, 99.0)]
    scores = spark.createDataFrame(rows, "candidate string, y int, score double")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", slices)
    try:
        levels = metrics.score_levels(scores, previous=True)
        got = metrics.roc_corners(levels).join(
            levels.groupBy("candidate").agg(F.max("pos_total").alias("p"), F.max("neg_total").alias("n")),
            "candidate").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sorted(repr((r.candidate, r.threshold, float(round(r.fpr * r.n)), float(round(r.tpr * r.p))))
                  for r in got) == corners_by_hand(rows)
    assert metrics.roc_points(levels).count() > len(got)
