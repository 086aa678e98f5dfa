"""The stages as jobs over paths, each reading what the one before it wrote.

``spark-submit`` can run them one at a time; ``run_all`` chains them. Paths follow ``Layout``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cohortline.config import RetentionConfig
from cohortline.operators import audit, checks, decision, encoding, features, labels, metrics, models, rfm, splits
from cohortline.operators.boosting import Ensemble
from cohortline.operators.cleaning import clean_normalised, normalise
from cohortline.plans.workspace import LEAF_BOUND, DEPTH_BOUND, LOGISTIC, RULE, TREES
from cohortline.session import stage
from cohortline.sources import ingest, published, sinks
from cohortline.sources.bucketed import buckets_for, stage_bucketed

SLUGS = {LOGISTIC: "logistic", DEPTH_BOUND: "depth_bound", LEAF_BOUND: "leaf_bound"}


@dataclass(frozen=True)
class Layout:
    """Where each stage writes, under one root that all executors can reach."""

    root: str

    def path(self, *names: str) -> str:
        return "/".join([self.root.rstrip("/"), *names])

    @property
    def raw(self) -> str:
        return self.path("transactions_raw")

    @property
    def clean(self) -> str:
        return self.path("transactions_clean")

    @property
    def matrix(self) -> str:
        return self.path("customer_features")

    @property
    def train(self) -> str:
        return self.path("train")

    @property
    def test(self) -> str:
        return self.path("test")

    @property
    def record(self) -> str:
        return self.path("selection_record")

    def model(self, candidate: str) -> str:
        return self.path("models", SLUGS[candidate])

    def predictions(self, candidate: str) -> str:
        return self.path("oof", SLUGS[candidate])


def ingest_job(spark: SparkSession, parts: dict[str, str], out: Layout, fmt: str = "csv",
               force: bool = False) -> DataFrame:
    return ingest.build_raw_parquet(spark, parts, out.raw, fmt, force)


def cleaning_job(spark: SparkSession, cfg: RetentionConfig, out: Layout) -> DataFrame:
    """Clean the raw table in one read of it; it lies in order of time, and so does the result.

    What the filters do, the contract of the clean rows and their fingerprint are counted on the way
    to the files. Nothing is published before all three hold.
    """
    filters, contract = Observation(), Observation()
    raw = published.read(sinks.observing(spark), out.raw)
    rows = normalise(raw).observe(filters, *audit.filter_counts(cfg))
    clean = clean_normalised(rows, cfg).observe(contract, *checks.clean_counts())

    def require() -> None:
        audit.require_filters(filters.get)
        checks.require_clean(contract.get)

    sinks.write_checked(
        clean, out.clean, require, once=True, options=ingest.lookup_filters("customer_id"))
    return published.read(spark, out.clean)


def features_job(spark: SparkSession, cfg: RetentionConfig, out: Layout) -> DataFrame:
    """The labelled matrix in customer order, with its contracts and its reload checked."""
    clean = published.read(spark, out.clean)
    checks.validate_windows(
        labels.real_purchases(clean, None, cfg.cutoff),
        labels.real_purchases(clean, cfg.cutoff, cfg.prediction_end), cfg)
    n = buckets_for(clean, "customer_id")
    built = stage_bucketed(features.build_customer_features(clean, cfg), "features", "customer_id", n)
    checks.validate_features(built)
    labelled = stage_bucketed(labels.build_labels(clean, cfg), "labels", "customer_id", n)
    counts = checks.join_row_counts(labelled, built).first()
    if not counts.left_rows == counts.right_rows == counts.joined_rows:
        raise checks.ContractViolation(f"labels and features do not line up: {counts.asDict()}")
    matrix = encoding.labelled_matrix(labelled, encoding.encode_features(built, cfg), cfg)
    return sinks.write_checked(stage(matrix.orderBy("customer_id"), "matrix"), out.matrix)


def split_job(spark: SparkSession, cfg: RetentionConfig, out: Layout) -> None:
    """Split once; every later stage reads the two files. Folds travel with the training rows."""
    n = buckets_for(published.read(spark, out.matrix), "customer_id")
    matrix = stage_bucketed(published.read(spark, out.matrix), "matrix", "customer_id", n)
    assigned = stage_bucketed(splits.assign_split(matrix, cfg), "split", "customer_id", n)
    folds = stage_bucketed(
        splits.assign_folds(assigned.filter("split = 'train'"), cfg), "folds", "customer_id", n)
    train = matrix.join(folds.select("customer_id", "fold"), "customer_id")
    test = matrix.join(assigned.filter("split = 'test'").select("customer_id"), "customer_id")
    overlap = checks.key_overlap(
        sinks.write_checked(stage(train, "train"), out.train),
        sinks.write_checked(stage(test, "test"), out.test)).first()
    if overlap.shared_keys:
        raise checks.ContractViolation(f"{overlap.shared_keys} customers in both splits")


def training_job(spark: SparkSession, cfg: RetentionConfig, out: Layout,
                 depth_bound: models.SearchSpace = models.DEPTH_BOUND,
                 leaf_bound: models.SearchSpace = models.LEAF_BOUND) -> None:
    """Fit every candidate, save it with its out-of-fold probabilities.

    A search leaves the fold scores of its best setting behind, so only the fit on all rows is to be done.
    """
    train = published.read(spark, out.train)
    n_train = train.count()
    found = {name: models.random_search(train, space, cfg)
             for name, space in ((DEPTH_BOUND, depth_bound), (LEAF_BOUND, leaf_bound))}
    whole = models.boosted(train, [(found[name].best, models.ALL) for name in found], cfg).models
    fitted = {LOGISTIC: models.logistic(n_train, cfg).fit(train), **dict(zip(found, whole))}
    for name, model in fitted.items():
        reloaded = sinks.save_model(model, out.model(name))
        if not checks.frames_match(
                models.scored(model, train, name), models.scored(reloaded, train, name)):
            raise checks.ContractViolation(f"{name}: predictions changed on reload")
        held_out = found[name].held_out if name in found else models.out_of_fold(
            train, lambda n: models.logistic(n, cfg), name, cfg)
        sinks.write_predictions(held_out, out.predictions(name))


def decision_job(spark: SparkSession, cfg: RetentionConfig, out: Layout) -> DataFrame:
    """Choose a candidate by its mean fold score, cost it on test once, and write the record."""
    train, test = published.read(spark, out.train), published.read(spark, out.test)
    edges = stage(rfm.fit_edges(train, cfg), "edges")
    oof = metrics.as_candidate(
        rfm.score_out_of_fold(train, edges), RULE, "rfm_total", "customer_id", "fold")
    folds = train.select("customer_id", "fold")
    on_test = metrics.as_candidate(
        rfm.score_with_train_edges(test, edges), RULE, "rfm_total", "customer_id")
    for name in SLUGS:
        saved = published.read(spark, out.predictions(name))
        lined_up = checks.unmatched_keys(saved, train).first()
        if lined_up.unmatched_rows:
            raise checks.ContractViolation(f"{name}: {lined_up.unmatched_rows} unmatched rows")
        oof = oof.unionByName(metrics.as_candidate(
            saved.join(folds, "customer_id"), name, "oof_proba", "customer_id", "fold"))
        saved = (Ensemble.load(spark, out.model(name)) if name in TREES
                 else PipelineModel.load(out.model(name)))
        on_test = on_test.unionByName(models.scored(saved, test, name))
    oof = stage(oof, "oof")
    by = ("candidate", "fold")
    spread = metrics.fold_spread(metrics.ranking_metrics(metrics.score_levels(oof, by), by))
    selected = metrics.best_by_folds(spread.filter(F.col("candidate") != RULE))
    levels = stage(metrics.score_levels(oof), "levels")
    pooled = stage(metrics.ranking_metrics(levels), "pooled")
    thresholds = stage(decision.sweep(oof, cfg, levels), "thresholds")
    record = decision.selection_record(
        selected, out.model(selected), RULE, [RULE, *SLUGS], pooled, thresholds,
        stage(on_test, "test-scores"), cfg)
    return sinks.write_record(record, out.record)


def run_all(spark: SparkSession, parts: dict[str, str], cfg: RetentionConfig, root: str,
            fmt: str = "csv", **training) -> DataFrame:
    out = Layout(root)
    ingest_job(spark, parts, out, fmt)
    cleaning_job(spark, cfg, out)
    features_job(spark, cfg, out)
    split_job(spark, cfg, out)
    training_job(spark, cfg, out, **training)
    return decision_job(spark, cfg, out)
