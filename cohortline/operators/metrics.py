"""Ranking metrics from counts per distinct score, exact under ties.

Input is ``scores``: candidate, y (0/1), score. All candidates are measured in one pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortline.config import RetentionConfig
from cohortline.operators.ordered import running_totals


def score_levels(scores: DataFrame, by: tuple[str, ...] = ("candidate",),
                 previous: bool = False) -> DataFrame:
    """Per distinct score: rows of each class, running sums and totals, and the counts one score lower.

    Slices ``scores`` at once and stores the slices; metrics and the threshold sweep can share them.
    """
    levels = scores.groupBy(*by, F.col("score").cast("double").alias("score")).agg(
        F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") == 0).alias("neg"))
    return running_totals(levels, by, "score", ["pos", "neg"], previous=previous)


def _ratio(numerator: Column, denominator: Column) -> Column:
    return F.when(denominator != 0, numerator / denominator)


def ranking_metrics(levels: DataFrame, by: tuple[str, ...] = ("candidate",)) -> DataFrame:
    """ROC-AUC (ties count half) and average precision (step sum) per candidate."""
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    neg_below = F.col("neg_upto") - F.col("neg")
    pos_from_here = F.col("pos_total") - F.col("pos_upto") + F.col("pos")
    neg_from_here = F.col("neg_total") - F.col("neg_upto") + F.col("neg")
    precision = pos_from_here / (pos_from_here + neg_from_here)
    return levels.groupBy(*by).agg(
        F.sum(pos * (neg_below + neg / 2)).alias("wins"),
        F.sum(pos * precision).alias("precision_sum"),
        F.sum("pos").alias("n_pos"),
        F.sum("neg").alias("n_neg"),
    ).select(
        *by,
        _ratio(F.col("wins"), F.col("n_pos").cast("double") * F.col("n_neg")).alias("roc_auc"),
        _ratio(F.col("precision_sum"), F.col("n_pos")).alias("pr_auc"),
        (F.col("n_pos") + F.col("n_neg")).alias("n_rows"),
    )


def roc_points(levels: DataFrame) -> DataFrame:
    """Every point of the curve, collinear ones included, and the origin (no threshold)."""
    pos_from_here = F.col("pos_total") - F.col("pos_upto") + F.col("pos")
    neg_from_here = F.col("neg_total") - F.col("neg_upto") + F.col("neg")
    points = levels.select(
        "candidate",
        F.col("score").alias("threshold"),
        _ratio(neg_from_here, F.col("neg_total")).alias("fpr"),
        _ratio(pos_from_here, F.col("pos_total")).alias("tpr"),
    )
    origin = levels.groupBy("candidate").agg(F.lit(None).cast("double").alias("threshold")).select(
        "candidate", "threshold", F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return points.unionByName(origin)


def roc_corners(levels: DataFrame) -> DataFrame:
    """The curve without the points inside a run of equal steps, as it is plotted.

    A step is what one score adds to both rates. A point between two equal steps lies on the line through its
    neighbours and goes; the first and the last point stay. ``levels`` knows the score before each.
    """
    highest = (F.col("pos_upto") == F.col("pos_total")) & (F.col("neg_upto") == F.col("neg_total"))
    turns = (F.col("pos_previous") != F.col("pos")) | (F.col("neg_previous") != F.col("neg"))
    return roc_points(levels.filter(highest | F.col("pos_previous").isNull() | turns))


def as_candidate(df: DataFrame, name: str, score: str | Column, *keep: str) -> DataFrame:
    column = F.col(score) if isinstance(score, str) else score
    return df.select(*keep, F.lit(name).alias("candidate"), F.col("y").cast("int").alias("y"),
                     column.cast("double").alias("score"))


def constant_baseline(train: DataFrame, test: DataFrame) -> DataFrame:
    """Majority class of ``train``, its rate as a constant score, and accuracy on ``test``.

    Equal classes resolve to 0.
    """
    learned = train.agg(
        (F.avg("y") > 0.5).cast("int").alias("majority_class"), F.avg("y").alias("score"))
    packed = learned.select(F.struct("*").alias("learned")).scalar()
    return test.withColumn("learned", packed).agg(
        F.max("learned.majority_class").alias("majority_class"),
        F.max("learned.score").alias("constant_score"),
        F.avg((F.col("y") == F.col("learned.majority_class")).cast("double")).alias("accuracy"),
        F.count("*").alias("n_rows"),
    )


def comparison_table(metrics: DataFrame, rule: str) -> DataFrame:
    """Metrics per candidate with a flag for beating the rule on ROC-AUC."""
    rule_auc = metrics.filter(F.col("candidate") == rule).select("roc_auc").scalar()
    return metrics.withColumn("rule_auc", rule_auc).select(
        "candidate", "roc_auc", "pr_auc",
        (F.col("roc_auc") > F.col("rule_auc")).alias("beats_rule"))


def fold_spread(fold_metrics: DataFrame) -> DataFrame:
    """Mean and population deviation over folds per candidate."""
    return fold_metrics.groupBy("candidate").agg(
        F.avg("roc_auc").alias("cv_roc_auc"), F.stddev_pop("roc_auc").alias("cv_std"))


def best_by_folds(spread: DataFrame) -> str:
    """The one rule of choice: highest mean fold score, the later name among equals."""
    return spread.agg(F.max_by("candidate", F.struct("cv_roc_auc", "candidate"))).first()[0]


def noise_test(pooled: DataFrame, spread: DataFrame, rule: str) -> DataFrame:
    """Does the out-of-fold gap over the rule exceed the candidate's own fold deviation?"""
    rule_auc = pooled.filter(F.col("candidate") == rule).select("roc_auc").scalar()
    return (
        pooled.filter(F.col("candidate") != rule).withColumn("rule_auc", rule_auc)
        .join(spread, "candidate")
        .select(
            "candidate", "roc_auc", "cv_std",
            (F.col("roc_auc") - F.col("rule_auc")).alias("gap"),
            (F.col("roc_auc") - F.col("rule_auc") > F.col("cv_std")).alias("beats_rule"),
        )
    )


def selection_table(spread: DataFrame, test_metrics: DataFrame, rule: str) -> DataFrame:
    """Cross-validated and test scores side by side; ``best_by_cv`` marks the choice."""
    rule_auc = test_metrics.filter(F.col("candidate") == rule).select("roc_auc").scalar()
    best = spread.agg(F.max_by("candidate", F.struct("cv_roc_auc", "candidate"))).scalar()
    return (
        test_metrics.withColumns({"rule_auc": rule_auc, "best": best})
        .join(spread, "candidate", "left")
        .select(
            "candidate", "cv_roc_auc", "cv_std",
            F.col("roc_auc").alias("test_roc_auc"), F.col("pr_auc").alias("test_pr_auc"),
            F.coalesce(F.col("cv_roc_auc") - F.col("rule_auc") > F.col("cv_std"), F.lit(False))
            .alias("beats_rule_beyond_noise"),
            (F.col("candidate") == F.col("best")).alias("best_by_cv"),
        )
    )


def clears_bar(metrics: DataFrame, cfg: RetentionConfig) -> DataFrame:
    return metrics.withColumn("clears_bar", F.col("roc_auc") >= cfg.min_roc_auc)
