"""Stage tables of one run, built on first use and kept in the shared folder.

Raw log, clean log, customer matrix with its split, and predictions are each read many times,
so each is written once per session and source folder. Everything between them is one lazy plan.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from threading import RLock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline.config import STAR_CONFIG, RetentionConfig
from cohortline.operators import decision, encoding, features, labels, metrics, models, rfm, splits
from cohortline.operators.cleaning import clean_transactions
from cohortline.session import shared_folder, stage
from cohortline.sources import ingest, sinks, star_tables
from cohortline.sources.bucketed import buckets_for, stage_bucketed

RULE = "RFM heuristic"
LOGISTIC = "Logistic Regression"
DEPTH_BOUND = "Boosted trees, depth-bound"
LEAF_BOUND = "Boosted trees, leaf-bound"
TREES = (DEPTH_BOUND, LEAF_BOUND)


class Workspace:
    def __init__(self, spark: SparkSession, folder: str, cfg: RetentionConfig = STAR_CONFIG):
        self.spark, self.folder, self.cfg = spark, folder, cfg
        self._built: dict[str, object] = {}
        self._lock = RLock()

    def _once(self, name: str, build: Callable):
        """Built by the first caller; others wait for it."""
        with self._lock:
            if name not in self._built:
                self._built[name] = build()
            return self._built[name]

    # ---- the log and its clean form

    def raw(self) -> DataFrame:
        """The raw log: names and tags over the stored source. Everything later starts from its files."""
        return self._once("raw", lambda: star_tables.transactions_raw(self.source()))

    def source(self) -> DataFrame:
        """The log under its original headings, stored once and clustered by time.

        The parts of a raw table are cut from it, and the raw log only renames and tags its rows, so that
        neither is shuffled or written a second time.
        """
        def build() -> DataFrame:
            log = star_tables.source_log(self.spark, self.folder)
            return stage(ingest.clustered(log, ingest.SOURCE_CLUSTER), "source",
                         **ingest.lookup_filters("Customer ID"))
        return self._once("source", build)

    def clean(self) -> DataFrame:
        """The clean log. The raw files it is made of lie in order of time, and so do its own."""
        return self._once("clean", lambda: stage(
            self.clean_plan(), "clean", **ingest.lookup_filters("customer_id")))

    # ---- lazy plans

    def clean_plan(self) -> DataFrame:
        return clean_transactions(self.raw(), self.cfg)

    def labels(self) -> DataFrame:
        return labels.build_labels(self.clean(), self.cfg)

    def features(self) -> DataFrame:
        return features.build_customer_features(self.clean(), self.cfg)

    def matrix_plan(self) -> DataFrame:
        """Labels beside features, bucket by bucket."""
        return encoding.labelled_matrix(
            self.stored_labels(), encoding.encode_features(self.stored_features(), self.cfg), self.cfg)

    def rfm_from_raw(self) -> DataFrame:
        """One row per customer, read by every profile of the label."""
        return self._once("raw rfm", lambda: stage(
            features.raw_rfm(self.raw(), self.cfg), "raw-rfm"))

    # ---- stored customer tables, all in the same buckets

    def _buckets(self) -> int:
        return self._once("buckets", lambda: buckets_for(self.clean(), "customer_id"))

    def _bucketed(self, df: DataFrame, name: str, placed: bool = False) -> DataFrame:
        return stage_bucketed(df, name, "customer_id", self._buckets(), placed)

    def stored_labels(self) -> DataFrame:
        return self._once("labels", lambda: self._bucketed(self.labels(), "labels"))

    def stored_features(self) -> DataFrame:
        return self._once("features", lambda: self._bucketed(self.features(), "features"))

    def matrix(self) -> DataFrame:
        return self._once("matrix", lambda: self._bucketed(
            self.matrix_plan(), "matrix", placed=True))

    def split(self) -> DataFrame:
        return splits.assign_split(self.matrix(), self.cfg)

    def split_matrix_plan(self) -> DataFrame:
        """The matrix with its split and, for training rows, their fold, bucket by bucket."""
        assigned = self._once("split", lambda: self._bucketed(self.split(), "split"))
        folds = self._once("folds", lambda: self._bucketed(
            splits.assign_folds(assigned.filter("split = 'train'"), self.cfg)
            .select("customer_id", "fold"), "folds"))
        placed = assigned.drop("y").join(folds, "customer_id", "left")
        return self.matrix().join(placed, "customer_id")

    def _split_matrix(self) -> DataFrame:
        return self._once("split matrix", lambda: self._bucketed(
            self.split_matrix_plan(), "split-matrix", placed=True))

    def train(self) -> DataFrame:
        return self._split_matrix().filter("split = 'train'").drop("split")

    def test(self) -> DataFrame:
        return self._split_matrix().filter("split = 'test'").drop("split", "fold")

    def edges(self) -> DataFrame:
        return self._once(
            "edges", lambda: stage(rfm.fit_edges(self.train(), self.cfg), "edges"))

    def rule_test(self) -> DataFrame:
        return rfm.score_with_train_edges(self.test(), self.edges())

    def rule_train(self) -> DataFrame:
        return rfm.score_with_train_edges(self.train(), self.edges())

    def rule_oof(self) -> DataFrame:
        return rfm.score_out_of_fold(self.train(), self.edges())

    # ---- candidates without a fitted model, for checks against SQL

    def plain_train_scores(self) -> DataFrame:
        """Out-of-fold rule score and three raw features as scores of the training rows."""
        keep = ("customer_id", "fold")
        return (
            metrics.as_candidate(self.rule_oof(), RULE, "rfm_total", *keep)
            .unionByName(metrics.as_candidate(self.train(), "Frequency", "frequency", *keep))
            .unionByName(metrics.as_candidate(self.train(), "Monetary", "monetary_total", *keep))
            .unionByName(metrics.as_candidate(self.train(), "Recency", -F.col("recency_days"), *keep))
        )

    def plain_test_scores(self) -> DataFrame:
        keep = ("customer_id",)
        return (
            metrics.as_candidate(self.rule_test(), RULE, "rfm_total", *keep)
            .unionByName(metrics.as_candidate(self.test(), "Frequency", "frequency", *keep))
            .unionByName(metrics.as_candidate(self.test(), "Monetary", "monetary_total", *keep))
            .unionByName(metrics.as_candidate(self.test(), "Recency", -F.col("recency_days"), *keep))
        )

    def plain_spread(self) -> DataFrame:
        """Mean and deviation of the plain candidates' scores over the folds."""
        by = ("candidate", "fold")
        levels = metrics.score_levels(self.plain_train_scores(), by=by)
        return metrics.fold_spread(metrics.ranking_metrics(levels, by))

    def plain_levels(self) -> DataFrame:
        """Sliced once for the pooled metrics and the sweep."""
        return self._once("plain levels", lambda: stage(
            metrics.score_levels(self.plain_train_scores()), "levels"))

    def plain_pooled(self) -> DataFrame:
        return self._once("plain pooled", lambda: stage(
            metrics.ranking_metrics(self.plain_levels()), "plain-pooled"))

    def plain_thresholds(self) -> DataFrame:
        return self._once("plain thresholds", lambda: stage(decision.sweep(
            self.plain_train_scores(), self.cfg, self.plain_levels()), "thresholds"))

    # ---- fitted models

    def n_train(self) -> int:
        return self._once("n_train", lambda: self.train().count())

    def logistic(self):
        return self._once(
            "logistic", lambda: models.logistic(self.n_train(), self.cfg).fit(self.train()))

    def boosted(self):
        """Both tree candidates at one full-size setting, on all rows and without each fold.

        All twelve models grow together; the search belongs to ``jobs.training_job``.
        """
        folds = [models.ALL, *range(self.cfg.n_folds)]
        jobs = [(s, k) for s in (models.DEPTH_BOUND_SETTING, models.LEAF_BOUND_SETTING) for k in folds]
        return self._once("boosted", lambda: models.boosted(self.train(), jobs, self.cfg))

    def fitted(self, candidate: str):
        if candidate == LOGISTIC:
            return self.logistic()
        whole = [m for m, (_, fold) in zip(self.boosted().models, self.boosted().jobs)
                 if fold == models.ALL]
        return whole[TREES.index(candidate)]

    def reloaded(self, candidate: str):
        """The fitted model, saved and loaded again."""
        path = f"{shared_folder(self.spark)}/cohortline/model-{uuid.uuid4().hex}"
        return self._once(
            f"reloaded {candidate}", lambda: sinks.save_model(self.fitted(candidate), path))

    def model_oof(self) -> DataFrame:
        def build() -> DataFrame:
            logistic = models.out_of_fold(
                self.train(), lambda n: models.logistic(n, self.cfg), LOGISTIC, self.cfg)
            names = F.array(*[F.lit(n) for n in TREES])
            trees = self.boosted().held_out().withColumn("candidate", names[F.col("setting")])
            return stage(logistic.unionByName(trees.drop("setting")), "oof")
        return self._once("oof", build)

    def all_oof(self) -> DataFrame:
        rule = metrics.as_candidate(self.rule_oof(), RULE, "rfm_total", "customer_id", "fold")
        return self.model_oof().unionByName(rule)

    def model_test(self) -> DataFrame:
        def build() -> DataFrame:
            parts = [models.scored(self.fitted(name), self.test(), name)
                     for name in (LOGISTIC, *TREES)]
            return stage(parts[0].unionByName(parts[1]).unionByName(parts[2]), "test-scores")
        return self._once("test scores", build)

    def all_test(self) -> DataFrame:
        rule = metrics.as_candidate(self.rule_test(), RULE, "rfm_total", "customer_id")
        return self.model_test().unionByName(rule)

    def cv_spread(self) -> DataFrame:
        """Mean and deviation of the fold scores of every fitted model."""
        def build() -> DataFrame:
            by = ("candidate", "fold")
            levels = metrics.score_levels(self.model_oof(), by=by)
            return stage(metrics.fold_spread(metrics.ranking_metrics(levels, by)), "cv")
        return self._once("cv spread", build)

    def oof_levels(self) -> DataFrame:
        return self._once("oof levels", lambda: stage(
            metrics.score_levels(self.all_oof()), "oof-levels"))

    def pooled_oof_metrics(self) -> DataFrame:
        return self._once("pooled", lambda: stage(
            metrics.ranking_metrics(self.oof_levels()), "pooled"))


_open: dict[tuple[str, str], Workspace] = {}


def workspace(spark: SparkSession, folder: str) -> Workspace:
    """The workspace of this session and source folder."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _open:
        _open[key] = Workspace(spark, folder)
    return _open[key]
