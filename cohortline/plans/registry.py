"""Registered queries: one per operator, each over whole tables.

Doubles are rounded to six digits here, and only here, so that results compare across engines
that add in different orders.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import timedelta

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortline.operators import (
    audit,
    boosting,
    checks,
    cleaning,
    decision,
    encoding,
    features,
    labels,
    metrics,
    models,
    profiling,
    rfm,
    splits,
)
from cohortline.plans import jobs
from cohortline.plans.workspace import (
    DEPTH_BOUND,
    LEAF_BOUND,
    LOGISTIC,
    RULE,
    Workspace,
    workspace,
)
from cohortline.session import shared_folder, stage
from cohortline.sources import ingest, sinks, star_tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

DIGITS = 6
DRILL_DOWN_CUSTOMER = 37
FIXED_THRESHOLD = 9.0
SENSITIVITY_COSTS = (0.05, 0.1, 0.15, 0.3, 0.6)
EXTREME_QUANTITY = 49
SELECTED = "Recency"


def rounded(df: DataFrame) -> DataFrame:
    """Doubles at six digits; adding zero turns a negative zero into zero."""
    return df.select(*[
        (F.round(F.col(f"`{f.name}`"), DIGITS) + F.lit(0.0)).alias(f.name)
        if isinstance(f.dataType, T.DoubleType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def query(key: str):
    def register(build: Callable[[Workspace], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return rounded(build(workspace(spark, folder)))
        QUERIES[key] = run
        return build
    return register


def tickets(df: DataFrame, *columns: str) -> DataFrame:
    """The columns by which single log lines are compared."""
    return df.select("invoice", "stock_code", "quantity", "price", *columns)


# ---- sources and sinks ---------------------------------------------------------------------

@query("s3_rename_columns")
def _(w: Workspace):
    return ingest.rename_columns(w.source())


@query("s4_tag_part")
def _(w: Workspace):
    first, second = (
        ingest.tag_part(ingest.rename_columns(star_tables.source_part(w.source(), name)), name)
        for name in star_tables.PARTS)
    return first.unionByName(second)


@query("s5_concat_parts")
def _(w: Workspace):
    return star_tables.raw_from_parts(w.source())


def _path(w: Workspace, name: str) -> str:
    return f"{shared_folder(w.spark)}/cohortline/{name}-{uuid.uuid4().hex}"


def _csv_parts(w: Workspace) -> dict[str, str]:
    """The parts of the log as CSV folders with headings."""
    def write(name: str) -> str:
        path = _path(w, "csv")
        star_tables.source_part(w.source(), name).write.option("header", True).option(
            "ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
        return path
    return w._once("csv parts", lambda: {name: write(name) for name in star_tables.PARTS})


@query("s1_read_parts")
def _(w: Workspace):
    first, second = (ingest.tag_part(ingest.rename_columns(
        ingest.read_part(w.spark, path, name)), name) for name, path in _csv_parts(w).items())
    return first.unionByName(second)


@query("s2_required_columns")
def _(w: Workspace):
    return ingest.load_raw(w.spark, _csv_parts(w))


@query("s6_build_raw_parquet")
def _(w: Workspace):
    target = _path(w, "raw-built")
    ingest.build_raw_parquet(w.spark, _csv_parts(w), target)
    return ingest.build_raw_parquet(w.spark, {}, target)


@query("s7_parquet_scan")
def _(w: Workspace):
    return star_tables.read_table(w.spark, w.folder, "lineitem")


@query("s8_checked_sink")
def _(w: Workspace):
    return sinks.write_checked(w.matrix(), _path(w, "checked"))


@query("s9_prediction_sink")
def _(w: Workspace):
    scores = w.plain_train_scores().filter(F.col("candidate") == SELECTED)
    return sinks.write_predictions(scores, _path(w, "predictions"))


@query("s10_reloaded_model")
def _(w: Workspace):
    """Rows per split, and how many of them score differently after saving and loading."""
    both = w.train().withColumn("split", F.lit("train")).unionByName(
        w.test().withColumn("split", F.lit("test")), allowMissingColumns=True)
    one, two = (
        models.scored(m, both, LOGISTIC, "split") for m in (w.fitted(LOGISTIC), w.reloaded(LOGISTIC)))
    pairs = one.join(two.select("customer_id", F.col("score").alias("again")), "customer_id")
    return pairs.groupBy("split").agg(
        F.count("*").alias("n_rows"),
        F.count_if(~F.col("score").eqNullSafe(F.col("again"))).alias("changed"))


# ---- contracts -----------------------------------------------------------------------------

@query("v1_raw_contract")
def _(w: Workspace):
    return checks.raw_contract(w.raw())


@query("v2_clean_contract")
def _(w: Workspace):
    return checks.clean_contract(w.clean())


@query("v3_feature_nulls")
def _(w: Workspace):
    return checks.null_counts(w.features())


@query("v4_feature_infinities")
def _(w: Workspace):
    return checks.infinite_counts(w.features())


@query("v5_temporal_guard")
def _(w: Workspace):
    return checks.temporal_guard(
        labels.real_purchases(w.clean(), None, w.cfg.cutoff),
        labels.real_purchases(w.clean(), w.cfg.cutoff, w.cfg.prediction_end), w.cfg)


@query("v6_frame_difference")
def _(w: Workspace):
    """The labelled matrix against itself without some customers and with others doubled."""
    labelled = w.labels().withColumn("y", F.col("y").cast("int"))
    changed = labelled.filter("customer_id % 10 <> 3").unionByName(
        labelled.filter("customer_id % 10 = 4"))
    return checks.frame_difference(labelled, changed)


@query("v7_single_rows_encode_alike")
def _(w: Workspace):
    """Every customer encoded with all others and within one of many small batches."""
    features_ = w.features()
    batch = encoding.encode_features(features_, w.cfg)
    parts = [encoding.encode_features(features_.filter(
        F.pmod("customer_id", F.lit(4)) == k), w.cfg) for k in range(4)]
    small = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    both = batch.withColumn("side", F.lit(1)).unionByName(small.withColumn("side", F.lit(-1)))
    left = both.groupBy(*batch.columns).agg(F.sum("side").alias("surplus"))
    return left.agg(
        F.count("*").alias("customers"), F.count_if(F.col("surplus") != 0).alias("different"))


@query("v8_key_overlap")
def _(w: Workspace):
    return checks.key_overlap(w.train(), w.test())


@query("v9_join_row_counts")
def _(w: Workspace):
    return checks.join_row_counts(w.labels(), w.features())


@query("v10_price_filter_losses")
def _(w: Workspace):
    return audit.price_filter_losses(w.raw(), w.cfg)


@query("v11_prediction_alignment")
def _(w: Workspace):
    return checks.unmatched_keys(w.rule_oof(), w.train())


@query("v12_invoice_kinds_left")
def _(w: Workspace):
    return audit.invoice_kinds_left(w.raw(), w.cfg)


# ---- cleaning ------------------------------------------------------------------------------

@query("c0_clean_transactions")
def _(w: Workspace):
    return w.clean_plan()


@query("c1_trim_text")
def _(w: Workspace):
    return tickets(cleaning.trim_text(w.raw()), "description", "country")


@query("c2_cancellation_flag")
def _(w: Workspace):
    return tickets(cleaning.flag_cancellations(w.raw()), "is_cancellation")


@query("c3_drop_adjustments")
def _(w: Workspace):
    return tickets(w.raw().filter(cleaning.not_adjustment()))


@query("c4_drop_non_products")
def _(w: Workspace):
    kept = cleaning.trim_text(w.raw()).filter(cleaning.is_product(w.cfg))
    return tickets(kept)


@query("c5_keep_priced")
def _(w: Workspace):
    return tickets(w.raw().filter(cleaning.is_priced()))


@query("c6_sign_backstop")
def _(w: Workspace):
    kept = cleaning.normalise(w.raw()).filter(cleaning.has_valid_sign())
    return tickets(kept, "is_cancellation")


@query("c7_cast_customer")
def _(w: Workspace):
    as_text = w.raw().withColumn("customer_id", F.col("customer_id").cast("string"))
    return tickets(cleaning.finish(as_text), "customer_id")


@query("c8_line_revenue")
def _(w: Workspace):
    finished = cleaning.finish(cleaning.normalise(w.raw()))
    return tickets(finished, "line_revenue")


@query("c9_tolerant_drop")
def _(w: Workspace):
    return w.raw().drop("description", "source_sheet", "never_there")


@query("c11_cleaning_job")
def _(w: Workspace):
    out = jobs.Layout(_path(w, "job"))
    w.raw().write.parquet(out.raw)
    return jobs.cleaning_job(w.spark, w.cfg, out)


@query("c10_cleaning_summary")
def _(w: Workspace):
    return cleaning.cleaning_summary(w.raw(), w.cfg)


# ---- audit ---------------------------------------------------------------------------------

@query("a1_filter_audit")
def _(w: Workspace):
    return audit.filter_audit(w.raw(), w.cfg)


@query("a2_audit_totals")
def _(w: Workspace):
    return audit.audit_totals(w.raw(), w.cfg)


@query("a3_trim_changes")
def _(w: Workspace):
    return audit.trim_changes(w.raw())


@query("a3_trim_samples")
def _(w: Workspace):
    return audit.trim_samples(w.raw())


@query("a4_code_identity")
def _(w: Workspace):
    return audit.code_identity(w.raw())


@query("a5_drop_list_coverage")
def _(w: Workspace):
    return audit.drop_list_coverage(w.raw(), w.cfg)


@query("a6_odd_survivors")
def _(w: Workspace):
    return audit.odd_survivors(w.raw(), w.cfg)


@query("a7_clean_profile")
def _(w: Workspace):
    return audit.clean_profile(w.clean())


# ---- profiling -----------------------------------------------------------------------------

@query("p1_shape_by_part")
def _(w: Workspace):
    return profiling.shape_by_part(w.raw())


@query("p1_head")
def _(w: Workspace):
    return profiling.head(w.raw())


@query("p2_null_profile")
def _(w: Workspace):
    return profiling.null_profile(w.raw())


@query("p3_blank_counts")
def _(w: Workspace):
    return profiling.blank_counts(w.raw())


@query("p4_short_descriptions")
def _(w: Workspace):
    return profiling.short_descriptions(w.raw())


@query("p5_unattributed_share")
def _(w: Workspace):
    return profiling.unattributed_share(w.raw())


@query("p6_mixed_invoices")
def _(w: Workspace):
    return profiling.mixed_invoices(w.raw())


@query("p7_distinct_customers")
def _(w: Workspace):
    return profiling.distinct_customers(w.raw())


@query("p8_sign_crosstab")
def _(w: Workspace):
    return profiling.sign_crosstab(w.raw())


@query("p9_gap_profile")
def _(w: Workspace):
    return profiling.gap_profile(w.raw())


@query("p9_gap_descriptions")
def _(w: Workspace):
    return profiling.gap_descriptions(w.raw())


@query("p10_invoice_kinds")
def _(w: Workspace):
    return profiling.invoice_kinds(w.raw())


@query("p11_code_shapes")
def _(w: Workspace):
    return profiling.code_shapes(w.raw())


@query("p12_code_taxonomy")
def _(w: Workspace):
    return profiling.code_taxonomy(w.raw())


@query("p13_price_anomalies")
def _(w: Workspace):
    return profiling.price_anomalies(w.raw())


@query("p14_quantity_summary")
def _(w: Workspace):
    return profiling.quantity_summary(w.raw())


@query("p15_extreme_quantities")
def _(w: Workspace):
    return profiling.extreme_quantities(w.raw(), EXTREME_QUANTITY)


@query("p16_duplicate_rows")
def _(w: Workspace):
    return profiling.duplicate_rows(w.raw())


@query("p17_most_repeated")
def _(w: Workspace):
    return profiling.most_repeated(w.raw())


@query("p18_customers_per_country")
def _(w: Workspace):
    return profiling.customers_per_country(w.raw())


@query("p19_top_country_coverage")
def _(w: Workspace):
    return profiling.top_country_coverage(
        profiling.customers_per_country(w.raw()))


@query("p20_rare_countries")
def _(w: Workspace):
    return profiling.rare_countries(
        profiling.customers_per_country(w.raw()), w.cfg)


@query("p21_multi_country_customers")
def _(w: Workspace):
    return profiling.multi_country_customers(w.raw())


@query("p22_population_funnel")
def _(w: Workspace):
    return profiling.population_funnel(w.raw(), w.cfg)


@query("p23_base_rate")
def _(w: Workspace):
    return profiling.base_rate(w.labels())


@query("p24_medians_by_label")
def _(w: Workspace):
    return profiling.medians_by_label(w.rfm_from_raw())


@query("p25_label_correlations")
def _(w: Workspace):
    return profiling.label_correlations(w.rfm_from_raw())


@query("p26_correlation_matrix")
def _(w: Workspace):
    return profiling.correlation_matrix(w.train(), list(models.VOLUME_COLUMNS))


@query("p26_recency_correlations")
def _(w: Workspace):
    return profiling.correlation_matrix(w.train(), list(models.RECENCY_COLUMNS))


@query("p27_skewness")
def _(w: Workspace):
    return profiling.skewness_table(w.rfm_from_raw())


@query("p28_label_histograms")
def _(w: Workspace):
    return profiling.label_histograms(w.rfm_from_raw())


@query("p29_summary_statistics")
def _(w: Workspace):
    return profiling.summary_statistics(
        w.matrix(), ["orders_last_30d", "orders_last_90d", "orders_last_180d",
                     "spend_last_90d", "spend_last_365d", "spend_momentum"])


@query("p30_single_order_cohorts")
def _(w: Workspace):
    return profiling.single_order_cohorts(w.rfm_from_raw())


@query("p31_cancellation_cohorts")
def _(w: Workspace):
    return profiling.cancellation_cohorts(w.raw(), w.rfm_from_raw(), w.cfg)


@query("p32_rows_per_weekday")
def _(w: Workspace):
    return profiling.rows_per_weekday(w.raw())


@query("p33_rows_on_day")
def _(w: Workspace):
    return profiling.rows_on_day(w.raw(), w.cfg.cutoff - timedelta(days=1))


@query("p34_anchor_shift")
def _(w: Workspace):
    return profiling.anchor_shift(w.raw(), w.cfg)


@query("p35_window_sizes")
def _(w: Workspace):
    return profiling.window_sizes(w.clean(), w.cfg)


@query("p36_lost_customers")
def _(w: Workspace):
    return profiling.lost_customers(w.raw(), w.clean(), w.cfg)


@query("p37_same_day_repeaters")
def _(w: Workspace):
    return profiling.same_day_repeaters(w.clean(), w.cfg)


@query("p38_return_ratio_range")
def _(w: Workspace):
    return profiling.return_ratio_range(features.order_features(w.clean(), w.cfg))


@query("p39_customer_history")
def _(w: Workspace):
    return profiling.customer_history(w.clean(), DRILL_DOWN_CUSTOMER, w.cfg)


# ---- population, label, features -----------------------------------------------------------

@query("l1_real_purchases")
def _(w: Workspace):
    return labels.real_purchases(w.clean(), w.cfg.cutoff, w.cfg.prediction_end)


@query("l2_population")
def _(w: Workspace):
    return labels.build_population(w.clean(), w.cfg)


@query("l3_labels")
def _(w: Workspace):
    return w.labels()


FROM_ORDERS = {
    "f1_recency_days": ["recency_days"],
    "f2_tenure_days": ["tenure_days"],
    "f3_frequency": ["frequency"],
    "f4_monetary_total": ["monetary_total"],
    "f5_monetary_avg_per_order": ["monetary_avg_per_order"],
    "f6_is_single_order_customer": ["is_single_order_customer"],
    "f7_avg_days_between_orders": ["avg_days_between_orders"],
    "f8_recency_over_avg_gap": ["recency_over_avg_gap"],
    "f9_total_quantity": ["total_quantity"],
    "f11_avg_items_per_order": ["avg_items_per_order"],
    "f12_avg_unit_price": ["avg_unit_price"],
    "f15_cancel_order_count": ["cancel_order_count"],
    "f16_cancel_order_rate": ["cancel_order_rate"],
    "f17_return_value_ratio": ["return_value_ratio"],
    "f18_orders_last_n_days": ["orders_last_30d", "orders_last_90d", "orders_last_180d"],
    "f19_spend_last_n_days": ["spend_last_90d", "spend_last_365d"],
    "f20_spend_momentum": ["spend_momentum"],
    "f21_latest_country": ["country"],
}

for _key, _columns in FROM_ORDERS.items():
    query(_key)(lambda w, columns=_columns: features.order_features(
        w.clean(), w.cfg).select("customer_id", *columns))


@query("f10_distinct_products")
def _(w: Workspace):
    return features.product_counts(w.clean(), w.cfg).select("customer_id", "distinct_products")


@query("f13_distinct_active_months")
def _(w: Workspace):
    return features.active_months(w.clean(), w.cfg)


@query("f14_avg_distinct_products_per_order")
def _(w: Workspace):
    return w.features().select("customer_id", "avg_distinct_products_per_order")


@query("f22_customer_features")
def _(w: Workspace):
    return w.features()


@query("f23_country_vocabulary")
def _(w: Workspace):
    return features.country_vocabulary(w.clean(), w.cfg)


@query("f23_vocabulary_coverage")
def _(w: Workspace):
    return features.vocabulary_coverage(features.country_vocabulary(w.clean(), w.cfg))


@query("f24_raw_rfm")
def _(w: Workspace):
    return w.rfm_from_raw()


# ---- encoding ------------------------------------------------------------------------------

@query("e1_one_hot_country")
def _(w: Workspace):
    hot = encoding.one_hot_country(features.order_features(w.clean(), w.cfg), w.cfg)
    return hot.select("customer_id", *w.cfg.country_columns)


@query("e2_encode_features")
def _(w: Workspace):
    # A batch that lacks one pinned column still gets the full, ordered set.
    return encoding.encode_features(w.features().drop("distinct_products"), w.cfg)


@query("e3_labelled_matrix")
def _(w: Workspace):
    return w.matrix_plan()


@query("e4_standardise")
def _(w: Workspace):
    return encoding.standardise(w.test(), w.train(), list(w.cfg.continuous_columns))


@query("e5_standardise_subset")
def _(w: Workspace):
    """Only the given columns, scaled by the statistics of the training rows."""
    scaled = encoding.standardise(w.test(), w.train(), list(models.VOLUME_COLUMNS))
    return scaled.select("customer_id", "y", *models.VOLUME_COLUMNS)


# ---- splits --------------------------------------------------------------------------------

@query("k1_stratified_split")
def _(w: Workspace):
    return w.split()


@query("k2_stratified_folds")
def _(w: Workspace):
    return splits.assign_folds(w.train(), w.cfg)


@query("k3_fold_summary")
def _(w: Workspace):
    return splits.fold_summary(w.train())


# ---- rule ----------------------------------------------------------------------------------

@query("r1_population_scores")
def _(w: Workspace):
    return rfm.population_scores(w.rfm_from_raw()).select(
        "customer_id", "r_score", "f_score", "m_score", "rfm_score")


@query("r2_rates_per_score")
def _(w: Workspace):
    return rfm.repeat_rates(
        rfm.population_scores(w.rfm_from_raw()), ["r_score", "f_score", "m_score"])


@query("r3_rates_combined")
def _(w: Workspace):
    return rfm.repeat_rates(rfm.population_scores(w.rfm_from_raw()), ["rfm_score"])


@query("r4_fit_edges")
def _(w: Workspace):
    # Interior edges one per row; the outer ones are infinite by definition.
    return w.edges().filter(F.col("fold").isNull()).select(
        "column", "n_groups", F.posexplode_outer(F.expr("slice(edges, 2, size(edges) - 2)"))
    ).select("column", "n_groups", F.col("pos").alias("edge_no"), F.col("col").alias("edge"))


@query("r5_apply_edges")
def _(w: Workspace):
    return w.rule_train().select(
        "customer_id", "recency_days_score", "frequency_score", "monetary_total_score")


def _rule_totals(w: Workspace) -> DataFrame:
    columns = ["customer_id", "y", "recency_days_score", "frequency_score",
               "monetary_total_score", "rfm_total"]
    train = w.rule_train().select(F.lit("train").alias("split"), *columns)
    test = w.rule_test().select(F.lit("test").alias("split"), *columns)
    return train.unionByName(test)


@query("r6_rule_totals")
def _(w: Workspace):
    return _rule_totals(w).select("split", "customer_id", "rfm_total")


@query("r7_rates_on_split")
def _(w: Workspace):
    scores = ["recency_days_score", "frequency_score", "monetary_total_score"]
    on_train = rfm.repeat_rates(w.rule_train(), scores)
    on_test = rfm.repeat_rates(w.rule_test(), ["rfm_total"])
    return on_train.unionByName(on_test)


@query("r8_out_of_fold_scores")
def _(w: Workspace):
    return w.rule_oof().select("customer_id", "fold", "rfm_total")


@query("r9_fold_diagnostics")
def _(w: Workspace):
    groups = w.edges().groupBy("fold").agg(*[
        F.max(F.when(F.col("column") == c, F.col("n_groups"))).alias(f"{c}_groups")
        for c in rfm.RFM_COLUMNS])
    by = ("candidate", "fold")
    in_fold = metrics.as_candidate(w.rule_oof(), RULE, "rfm_total", "fold")
    in_sample = metrics.as_candidate(
        w.rule_train().withColumn("fold", F.lit(-1)), RULE, "rfm_total", "fold")
    aucs = metrics.ranking_metrics(
        metrics.score_levels(in_fold.unionByName(in_sample), by), by)
    # Fold -1 is the fit on, and score of, all training rows.
    return aucs.join(
        groups.withColumn("fold", F.coalesce("fold", F.lit(-1))), "fold"
    ).select("fold", *[f"{c}_groups" for c in rfm.RFM_COLUMNS], "roc_auc")


# ---- metrics -------------------------------------------------------------------------------

@query("m1_roc_auc")
def _(w: Workspace):
    return metrics.ranking_metrics(metrics.score_levels(w.plain_test_scores())).select(
        "candidate", "roc_auc", "n_rows")


@query("m2_average_precision")
def _(w: Workspace):
    return metrics.ranking_metrics(metrics.score_levels(w.plain_test_scores())).select(
        "candidate", "pr_auc")


@query("m3_roc_points")
def _(w: Workspace):
    return metrics.roc_points(metrics.score_levels(w.plain_test_scores()))


@query("m3_roc_corners")
def _(w: Workspace):
    return metrics.roc_corners(metrics.score_levels(w.plain_test_scores(), previous=True))


@query("m4_univariate_auc")
def _(w: Workspace):
    train = w.train()
    scores = metrics.as_candidate(train, "frequency", "frequency").unionByName(
        metrics.as_candidate(train, "monetary_total", "monetary_total"))
    return metrics.ranking_metrics(metrics.score_levels(scores)).select("candidate", "roc_auc")


def _constant_scores(w: Workspace) -> DataFrame:
    rate = w.train().agg(F.avg("y")).scalar()
    return metrics.as_candidate(w.test(), "Majority class", rate)


@query("m5_comparison")
def _(w: Workspace):
    rule = metrics.as_candidate(w.rule_test(), RULE, "rfm_total")
    scores = rule.unionByName(_constant_scores(w))
    measured = metrics.ranking_metrics(metrics.score_levels(scores))
    return metrics.clears_bar(metrics.comparison_table(measured, RULE), w.cfg)


@query("m6_selection_of_plain_scores")
def _(w: Workspace):
    measured = metrics.ranking_metrics(metrics.score_levels(w.plain_test_scores()))
    return metrics.selection_table(
        w.plain_spread().filter(F.col("candidate") != RULE), measured, RULE)


@query("m7_noise_test_of_plain_scores")
def _(w: Workspace):
    pooled = w.plain_pooled()
    return metrics.noise_test(pooled, w.plain_spread(), RULE)


# ---- decisions -----------------------------------------------------------------------------

@query("x1_cost_at_threshold")
def _(w: Workspace):
    return decision.cost_at(
        metrics.as_candidate(w.rule_oof(), RULE, "rfm_total"), FIXED_THRESHOLD, w.cfg)


@query("x2_sweep_rule")
def _(w: Workspace):
    scores = metrics.as_candidate(w.rule_oof(), RULE, "rfm_total")
    return decision.sweep(scores, w.cfg)


@query("x3_sweep_candidates")
def _(w: Workspace):
    return decision.sweep(w.plain_train_scores(), w.cfg)


@query("x4_trivial_policies")
def _(w: Workspace):
    return decision.trivial_policies(w.plain_test_scores(), w.plain_thresholds(), RULE, w.cfg)


@query("x5_cost_reduction")
def _(w: Workspace):
    return decision.cost_reduction(w.plain_test_scores(), w.plain_thresholds(), SELECTED, RULE, w.cfg)


@query("x6_campaign_report")
def _(w: Workspace):
    return decision.campaign_report(w.plain_test_scores(), w.plain_thresholds())


@query("x7_record_of_plain_scores")
def _(w: Workspace):
    """The record's fields, flattened, with a raw feature as the selected candidate."""
    pooled = w.plain_pooled()
    record = decision.selection_record(
        SELECTED, "models/selected", RULE, [RULE, "Frequency", "Monetary", SELECTED], pooled,
        w.plain_thresholds(), stage(w.plain_test_scores(), "plain-test"), w.cfg)
    return flat_record(record)


@query("s11_json_record_of_plain_scores")
def _(w: Workspace):
    """The same record, written as JSON and read back."""
    record = decision.selection_record(
        SELECTED, "models/selected", RULE, [RULE, "Frequency", "Monetary", SELECTED],
        w.plain_pooled(), w.plain_thresholds(), stage(w.plain_test_scores(), "plain-test"), w.cfg)
    return flat_record(sinks.write_record(record, _path(w, "record")))


def flat_record(record: DataFrame) -> DataFrame:
    return record.select(
        "selected_model", "model_path", "threshold", "decision_parameters.*",
        F.col("metrics.oof_roc_auc.rfm_heuristic").alias("oof_rule"),
        F.col("metrics.oof_roc_auc.recency").alias("oof_selected"),
        F.col("metrics.test_cost_per_customer.contact_nobody").alias("cost_nobody"),
        F.col("metrics.test_cost_per_customer.contact_everybody").alias("cost_everybody"),
        F.col("metrics.test_cost_per_customer.rfm_heuristic").alias("cost_rule"),
        F.col("metrics.test_cost_per_customer.selected").alias("cost_selected"),
        "metrics.cost_reduction_vs_best_trivial_policy", "metrics.best_trivial_policy",
        "metrics.test_offers_sent_pct", "metrics.test_churners_caught_pct",
        "metrics.test_offer_precision_pct", "meets_cost_reduction_bar", "recommendation")


@query("x8_acceptance")
def _(w: Workspace):
    pooled = w.plain_pooled()
    noise = metrics.noise_test(pooled, w.plain_spread(), RULE)
    reduction = decision.cost_reduction(
        w.plain_test_scores(), w.plain_thresholds(), SELECTED, RULE, w.cfg)
    return decision.acceptance(noise, reduction, w.cfg)


@query("x9_campaign_list")
def _(w: Workspace):
    return decision.campaign_list(w.plain_test_scores(), w.plain_thresholds())


@query("x10_f2_on_churners")
def _(w: Workspace):
    return decision.f2_on_churners(
        decision.campaign_report(w.plain_test_scores(), w.plain_thresholds()))


@query("x11_ratio_sensitivity")
def _(w: Workspace):
    curve = decision.threshold_curve(w.plain_levels(), w.cfg)
    return decision.ratio_sensitivity(curve, SENSITIVITY_COSTS, w.cfg)


# ---- models --------------------------------------------------------------------------------

@query("d1_majority_baseline")
def _(w: Workspace):
    return metrics.constant_baseline(w.train(), w.test())


@query("d7_fold_spread_of_plain_scores")
def _(w: Workspace):
    return w.plain_spread()


@query("d2_logistic_regression")
def _(w: Workspace):
    return models.scored(w.logistic(), w.test(), LOGISTIC)


@query("d3_coefficients")
def _(w: Workspace):
    return models.strongest(models.coefficients(w.logistic(), w.cfg))


@query("d4_volume_subset")
def _(w: Workspace):
    subset = models.logistic(w.n_train(), w.cfg, models.VOLUME_COLUMNS).fit(w.train())
    return models.coefficients(subset, w.cfg, models.VOLUME_COLUMNS)


def _zero_gradient(w: Workspace, model, columns=None) -> DataFrame:
    """Per feature the slope of the penalised loss at the fitted point, which must vanish.

    Taken from the scored training rows: sum of (probability - y) * x, plus the coefficient.
    """
    names = models.feature_names(w.cfg, columns)
    rows = model.transform(w.train()).select(
        (vector_to_array("probability")[1] - F.col("y")).alias("miss"),
        vector_to_array("features").alias("x"))
    slopes = rows.agg(*[F.sum(F.col("miss") * F.col("x")[i]).alias(n) for i, n in enumerate(names)])
    values = model.stages[-1].coefficients.toArray().tolist()
    return slopes.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("feature"),
                 (F.abs(F.col(f"`{n}`") + F.lit(float(v))) < 0.01).alias("vanishes"))
        for n, v in zip(names, values)])))


@query("d2_optimum")
def _(w: Workspace):
    return _zero_gradient(w, w.logistic())


@query("d4_optimum")
def _(w: Workspace):
    subset = models.logistic(w.n_train(), w.cfg, models.VOLUME_COLUMNS).fit(w.train())
    return _zero_gradient(w, subset, models.VOLUME_COLUMNS)


# The first tree of each kind on all rows and columns, so that SQL can follow every split.
FIRST_BY_DEPTH = boosting.Setting(trees=1, l1=0.5, l2=1.0, depth=3, min_curvature=1.0)
FIRST_BY_LEAVES = boosting.Setting(trees=1, l1=0.5, l2=1.0, leaves=7, min_rows=20)


def _first_tree(w: Workspace, setting: boosting.Setting) -> DataFrame:
    """(node, feature, threshold, gain, value, n_rows); node p has the nodes 2p and 2p + 1 below it."""
    table = models.boosted(w.train(), [(setting, models.ALL)], w.cfg).models[0].table(w.spark)
    nodes = {r.node: r for r in table.filter("tree = 0").collect()}
    paths, rows = {0: 1}, []
    for i in sorted(nodes):
        r = nodes[i]
        rows.append((paths[i], r["column"], r.threshold, r.gain, r.value, r["rows"]))
        if r.left is not None:
            paths[r.left], paths[r.right] = 2 * paths[i], 2 * paths[i] + 1
    return w.spark.createDataFrame(
        rows, "node long, feature string, threshold double, gain double, value double, n_rows long")


@query("d5_first_tree")
def _(w: Workspace):
    return _first_tree(w, FIRST_BY_DEPTH)


@query("d6_first_tree")
def _(w: Workspace):
    return _first_tree(w, FIRST_BY_LEAVES)


def _coverage(scores: DataFrame, *by: str) -> DataFrame:
    """Rows, customers and scores that are no probability."""
    per_customer = scores.groupBy("candidate", *by, "customer_id").agg(
        F.count("*").alias("n"), F.count_if(~F.col("score").between(0, 1)).alias("odd"))
    return per_customer.groupBy("candidate", *by).agg(
        F.sum("n").alias("n_rows"), F.count("*").alias("customers"), F.sum("odd").alias("outside"))


@query("d8_out_of_fold_coverage")
def _(w: Workspace):
    return _coverage(w.model_oof(), "fold")


@query("d9_test_coverage")
def _(w: Workspace):
    return _coverage(w.model_test())


@query("d7_cross_validated_scores")
def _(w: Workspace):
    return w.cv_spread()


@query("d8_out_of_fold_probabilities")
def _(w: Workspace):
    return w.model_oof()


@query("d9_test_scores")
def _(w: Workspace):
    return w.model_test()


# ---- comparison of fitted models, and the record -------------------------------------------

@query("m6_selection_table")
def _(w: Workspace):
    measured = metrics.ranking_metrics(metrics.score_levels(w.all_test()))
    return metrics.selection_table(w.cv_spread(), measured, RULE)


@query("m7_noise_test")
def _(w: Workspace):
    return metrics.noise_test(w.pooled_oof_metrics(), w.cv_spread(), RULE)


def _selection_record(w: Workspace) -> DataFrame:
    best = metrics.best_by_folds(w.cv_spread())
    thresholds = stage(decision.sweep(w.all_oof(), w.cfg, w.oof_levels()), "thresholds")
    return decision.selection_record(
        best, "models/selected", RULE, [RULE, LOGISTIC, DEPTH_BOUND, LEAF_BOUND],
        w.pooled_oof_metrics(), thresholds, stage(w.all_test(), "all-test"), w.cfg)


@query("x7_selection_record")
def _(w: Workspace):
    return _selection_record(w)


@query("s11_json_record")
def _(w: Workspace):
    return sinks.write_record(_selection_record(w), _path(w, "selection-record"))
