"""Classifiers on the encoded matrix, all behind the same preprocessing.

Preprocessing and the logistic model form one ML pipeline, so scaling statistics always come from the
rows a model is fitted on and travel with it when it is saved. Boosted trees read the columns as they are.
"""

from __future__ import annotations

import random
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseMatrix, DenseVector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline.config import RetentionConfig
from cohortline.operators import metrics
from cohortline.operators.boosting import Ensemble, Fitted, Setting, fit_many
from cohortline.session import stage

# Features that all measure how much a customer buys, and how recently.
VOLUME_COLUMNS = ("frequency", "monetary_total", "spend_last_365d", "distinct_active_months",
                  "total_quantity", "avg_items_per_order")
RECENCY_COLUMNS = ("recency_days", "avg_days_between_orders", "recency_over_avg_gap")


def preprocessing(cfg: RetentionConfig, columns: Sequence[str] | None = None) -> list:
    """Scale the continuous columns and pass the binary ones through.

    With ``columns`` only those are scaled and all others are dropped. Spark's scaler divides by
    the sample deviation, a factor of sqrt(n / (n - 1)) from the population deviation; trees do
    not notice and the logistic penalty changes by the same vanishing factor.
    """
    continuous = list(columns) if columns is not None else list(cfg.continuous_columns)
    binary = [] if columns is not None else list(cfg.binary_columns)
    return [
        VectorAssembler(inputCols=continuous, outputCol="continuous"),
        StandardScaler(inputCol="continuous", outputCol="scaled", withMean=True, withStd=True),
        VectorAssembler(inputCols=["scaled", *binary], outputCol="features"),
    ]


def feature_names(cfg: RetentionConfig, columns: Sequence[str] | None = None) -> list[str]:
    if columns is not None:
        return list(columns)
    return [*cfg.continuous_columns, *cfg.binary_columns]


#: Largest slope of the summed loss at which a fit counts as the optimum.
SLOPE_LEFT = 0.005
#: Twice the loss that a Newton step may still win, in units of one row's log-likelihood, for it to be the last.
LAST_STEP = 1e-9


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each batch of (y, x) as one row of bytes, so that every pass reads whole matrices."""
    for batch in batches:
        if batch.num_rows:
            y = batch.column("y").to_numpy(zero_copy_only=False)
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [pa.array([len(y)]), pa.array([y.tobytes()], pa.binary()),
                 pa.array([x.tobytes()], pa.binary())], ["n", "y", "x"])


def _curves(at: np.ndarray):
    """Sums over a part of the packed rows at the point ``at``: loss, slope and curvature, intercept last."""
    k = len(at)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 + k + k * k)
        for batch in batches:
            for own_y, own_x in zip(batch.column("y"), batch.column("x")):
                y = np.frombuffer(own_y.as_buffer())
                x = np.ones((len(y), k))
                x[:, :-1] = np.frombuffer(own_x.as_buffer()).reshape(-1, k - 1)
                score = x @ at
                chance, rest = (np.exp(-np.logaddexp(0, s)) for s in (-score, score))
                total[0] += (np.logaddexp(0, score) - y * score).sum()
                total[1:1 + k] += x.T @ (chance - y)
                total[1 + k:] += ((x * (chance * rest)[:, None]).T @ x).ravel()
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(total)), pa.int32()), pa.array(total)], ["place", "value"])
    return work


class NewtonLogistic(LogisticRegression):
    """Binary logistic regression with an L2 penalty, finished by Newton steps.

    Spark's quasi-Newton steps end where the mean loss hardly falls, which for many rows is not the
    optimum yet. A few Newton steps go on from there, whatever the number of rows; where no slope is
    left, Spark's fit stays as it is. Spark also makes the model of the point that is found, by bounds.
    """

    def _fit(self, dataset: DataFrame):
        model = super()._fit(dataset)
        at = self._optimum(dataset, model) if model.numClasses == 2 else None
        if at is None:
            return model
        row, last = DenseMatrix(1, len(at) - 1, at[:-1]), DenseVector(at[-1:])
        bound = self._copyValues(LogisticRegression())
        return (bound.setLowerBoundsOnCoefficients(row).setUpperBoundsOnCoefficients(row)
                .setLowerBoundsOnIntercepts(last).setUpperBoundsOnIntercepts(last).fit(dataset))

    def _optimum(self, dataset: DataFrame, model) -> np.ndarray | None:
        """Coefficients and, last, the intercept; nothing if ``model`` has them or lacks a class."""
        start = np.append(model.coefficients.toArray(), model.intercept)
        if not np.isfinite(start).all():
            return None
        rows = dataset.select(
            F.col(self.getLabelCol()).cast("double").alias("y"),
            vector_to_array(self.getFeaturesCol()).alias("x")).mapInArrow(
                _packed, "n long, y binary, x binary"
            ).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            n = rows.agg(F.sum("n")).first()[0]
            return self._descend(rows, start, self.getRegParam() * n)
        finally:
            rows.unpersist()

    def _descend(self, rows: DataFrame, at: np.ndarray, penalty: float) -> np.ndarray | None:
        k, best = len(at), np.inf
        step, weights = np.zeros(k), np.full(k, penalty)
        weights[-1] = 0.0
        for _ in range(self.getMaxIter()):
            sums = np.zeros(1 + k + k * k)
            for r in rows.mapInArrow(_curves(at + step), "place int, value double").groupBy(
                    "place").agg(F.sum("value").alias("value")).collect():
                sums[r.place] = r.value
            here = at + step
            loss = sums[0] + weights @ here ** 2 / 2
            if not np.isfinite(sums).all():
                return None
            # Rounding of the sum may hide what the last steps win.
            if loss > best + 1e-9 * abs(best):
                step = step / 2
                continue
            slope = sums[1:1 + k] + weights * here
            if np.isinf(best) and np.abs(slope).max() < SLOPE_LEFT:
                return None
            at, best = here, loss
            curve = sums[1 + k:].reshape(k, k) + np.diag(weights)
            step = -np.linalg.lstsq(curve, slope, rcond=None)[0]
            if -step @ slope < LAST_STEP:
                return at + step
        return None


def logistic(n_train: int, cfg: RetentionConfig, columns: Sequence[str] | None = None) -> Pipeline:
    """L2 logistic regression with unit strength: a mean loss needs lambda = 1 / n."""
    model = NewtonLogistic(
        labelCol="y", regParam=1.0 / n_train, elasticNetParam=0.0, standardization=False,
        maxIter=1000, tol=1e-6)
    return Pipeline(stages=[*preprocessing(cfg, columns), model])


@dataclass(frozen=True)
class SearchSpace:
    """Inclusive ranges of a random search over boosted trees, grown by ``depth`` or by ``leaves``."""

    # The ranges that the study searches.
    trees: tuple[int, int] = (50, 399)
    learning_rate: tuple[float, float] = (0.01, 0.30)
    row_share: tuple[float, float] = (0.6, 1.0)
    column_share: tuple[float, float] = (0.6, 1.0)
    l1: tuple[float, float] = (0.0, 1.0)
    l2: tuple[float, float] = (0.5, 2.5)
    depth: tuple[int, int] | None = None
    leaves: tuple[int, int] | None = None
    min_curvature: tuple[int, int] = (0, 0)
    min_rows: tuple[int, int] = (1, 1)

    def sample(self, n: int, seed: int) -> list[Setting]:
        draw = random.Random(seed)

        def whole(bounds: tuple[int, int] | None) -> int | None:
            return None if bounds is None else draw.randint(*bounds)

        def share(bounds: tuple[float, float]) -> float:
            return round(draw.uniform(*bounds), 4)

        return [
            Setting(trees=whole(self.trees), learning_rate=share(self.learning_rate),
                    row_share=share(self.row_share), column_share=share(self.column_share),
                    l1=share(self.l1), l2=share(self.l2), depth=whole(self.depth),
                    leaves=whole(self.leaves), min_curvature=float(whole(self.min_curvature)),
                    min_rows=whole(self.min_rows))
            for _ in range(n)
        ]


# What bounds the trees of the two candidates, level by level and leaf by leaf.
DEPTH_BOUND = SearchSpace(depth=(2, 6), min_curvature=(1, 9))
LEAF_BOUND = SearchSpace(leaves=(7, 62), min_rows=(5, 59))

# One setting inside each space, for fits without a search.
DEPTH_BOUND_SETTING = Setting(trees=50, learning_rate=0.1, row_share=0.8, column_share=0.8, l1=0.1,
                              l2=1.0, depth=3, min_curvature=1.0)
LEAF_BOUND_SETTING = Setting(trees=50, learning_rate=0.1, row_share=0.8, column_share=0.8, l1=0.1,
                             l2=1.0, leaves=8, min_rows=20)
#: All rows, with no fold left out.
ALL = -1


def boosted(train: DataFrame, jobs: Sequence[tuple[Setting, int]], cfg: RetentionConfig) -> Fitted:
    """One model for each (setting, fold left out), all grown in the same passes over ``train``.

    Columns are not scaled: trees only compare values of one column.
    """
    return fit_many(train, feature_names(cfg), jobs, cfg.seed)


@dataclass
class Search:
    """The best setting, the table of all, and the best one's scores of the folds it did not see."""

    best: Setting
    table: DataFrame
    held_out: DataFrame


def random_search(train: DataFrame, space: SearchSpace, cfg: RetentionConfig) -> Search:
    """Every sampled setting on every fold, in one set of passes; best by mean ROC-AUC over folds.

    ``train`` carries its ``fold`` column. Of settings with equal means the earlier one wins.
    """
    settings = list(dict.fromkeys(space.sample(cfg.search_settings, cfg.seed)))
    fitted = boosted(train, [(s, k) for s in settings for k in range(cfg.n_folds)], cfg)
    scores = stage(fitted.held_out().withColumnRenamed("setting", "candidate"), "search")
    by = ("candidate", "fold")
    spread = metrics.fold_spread(metrics.ranking_metrics(metrics.score_levels(scores, by), by))
    # One row for each setting.
    means = {r.candidate: (r.cv_roc_auc, r.cv_std) for r in spread.collect()}
    best = max(range(len(settings)), key=lambda i: (means[i][0] or 0.0, -i))
    table = train.sparkSession.createDataFrame(
        [(i, str(s), *means[i], i == best) for i, s in enumerate(settings)],
        "setting int, parameters string, cv_roc_auc double, cv_std double, is_best boolean")
    return Search(settings[best], table, scores.filter(F.col("candidate") == best).drop("candidate"))


def scored(model: PipelineModel | Ensemble, df: DataFrame, candidate: str, *keep: str) -> DataFrame:
    """(customer_id, y, candidate, score) with score the probability of a repeat purchase."""
    if isinstance(model, Ensemble):
        return model.scores(df, "customer_id", "y", *keep).select(
            "customer_id", F.col("y").cast("int").alias("y"), *keep,
            F.lit(candidate).alias("candidate"), "score")
    return model.transform(df).select(
        "customer_id", F.col("y").cast("int").alias("y"), *keep,
        F.lit(candidate).alias("candidate"),
        vector_to_array("probability")[1].alias("score"))


def out_of_fold(train: DataFrame, make: Callable[[int], Pipeline], candidate: str,
                cfg: RetentionConfig, parallelism: int = 5) -> DataFrame:
    """A score for every training row from the model that did not see its fold.

    ``make`` gets the number of rows it will be fitted on. The folds are independent, so their
    fits run as concurrent Spark jobs, as in ``CrossValidator``.
    """
    sizes = {r.fold: r["count"] for r in train.groupBy("fold").count().collect()}

    def score_fold(k: int) -> DataFrame:
        n_rest = sum(n for fold, n in sizes.items() if fold != k)
        model = make(n_rest).fit(train.filter(F.col("fold") != k))
        return scored(model, train.filter(F.col("fold") == k), candidate, "fold")

    with ThreadPool(min(parallelism, cfg.n_folds)) as pool:
        parts = pool.map(inheritable_thread_target(train.sparkSession)(score_fold),
                         range(cfg.n_folds))
    return reduce(DataFrame.unionByName, parts)


def coefficients(model: PipelineModel, cfg: RetentionConfig,
                 columns: Sequence[str] | None = None) -> DataFrame:
    """(feature, coefficient, place): place 1 is the strongest push towards a repeat purchase.

    One row per feature, so the table starts on the driver.
    """
    values = model.stages[-1].coefficients.toArray().tolist()
    ordered = sorted(zip(feature_names(cfg, columns), values), key=lambda pair: -pair[1])
    return SparkSession.active().createDataFrame(
        [(name, float(value), place) for place, (name, value) in enumerate(ordered, start=1)],
        "feature string, coefficient double, place int")


def strongest(table: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` largest coefficients of each sign's end of the ranking."""
    n = table.agg(F.max("place")).scalar()
    return table.withColumn("n", n).filter(
        (F.col("place") <= k) | (F.col("place") > F.col("n") - k)
    ).withColumn("direction", F.when(F.col("place") <= k, "repeat").otherwise("non-repeat")).drop("n")
