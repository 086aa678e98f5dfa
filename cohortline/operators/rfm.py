"""The quintile rule on recency, frequency and monetary value that every model must beat."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortline.config import RetentionConfig
from cohortline.operators.ordered import exact_quantiles

# Scored columns; recency is reversed, since fewer days are better.
RFM_COLUMNS = {"recency_days": False, "frequency": True, "monetary_total": True}
QUINTILES = (0.0, 0.2, 0.4, 0.6, 0.8, 1.0)
WHOLE_TRAIN = "all"


def right_closed_group(value: Column, breaks: Column, ascending: bool) -> Column:
    """Group number with intervals ``(a, b]``: one more than the breaks below the value."""
    above = F.size(F.filter(breaks, lambda edge: value > edge))
    return (F.lit(1) + above if ascending else F.size(breaks) + 1 - above).cast("int")


def population_scores(rfm: DataFrame) -> DataFrame:
    """Whole-population scores: the four interior quintiles, equal ones merged."""
    columns = {"recency_days": ("r_score", False), "frequency": ("f_score", True),
               "monetary": ("m_score", True)}
    quantiles = exact_quantiles(rfm, list(columns), QUINTILES[1:-1])
    breaks = quantiles.agg(F.struct(*[
        F.max(F.when(F.col("column") == c, F.array_distinct("quantiles"))).alias(c)
        for c in columns
    ]).alias("breaks"))
    return (
        rfm.withColumn("breaks", breaks.scalar())
        .withColumns({
            score: right_closed_group(F.col(c), F.col(f"breaks.{c}"), ascending)
            for c, (score, ascending) in columns.items()
        })
        .withColumn("rfm_score", F.col("r_score") + F.col("f_score") + F.col("m_score"))
        .drop("breaks")
    )


def repeat_rates(scored: DataFrame, scores: list[str]) -> DataFrame:
    """(score name, level, customers, repeat rate)."""
    return (
        scored.unpivot(["y"], scores, "score", "level")
        .groupBy("score", "level")
        .agg(F.count("*").alias("customers"), F.avg("y").alias("repeat_rate"))
    )


def fit_edges(train: DataFrame, cfg: RetentionConfig, folds: bool = True) -> DataFrame:
    """Quintile edges (column, fold, edges, n_groups), fitted on training rows only.

    ``fold`` null is the fit on all rows; fold k is the fit without fold k. Equal quantiles
    merge, and the outer edges become infinite so that no later value falls outside.
    """
    fits = {WHOLE_TRAIN: F.lit(True)}
    if folds:
        fits |= {str(k): F.col("fold") != k for k in range(cfg.n_folds)}
    quantiles = exact_quantiles(train, list(RFM_COLUMNS), QUINTILES, fits=fits)
    edges = F.array_distinct("quantiles")
    interior = F.slice(edges, F.lit(2), F.greatest(F.size(edges) - 2, F.lit(0)))
    infinity = float("inf")
    return quantiles.select(
        "column",
        F.when(F.col("fit") != WHOLE_TRAIN, F.col("fit")).cast("int").alias("fold"),
        F.concat(F.array(F.lit(-infinity)), interior, F.array(F.lit(infinity))).alias("edges"),
        F.greatest(F.size(edges) - 1, F.lit(1)).alias("n_groups"),
    )


def _breaks_per_fit(edges: DataFrame) -> DataFrame:
    inner = F.slice("edges", F.lit(2), F.size("edges") - 2)
    return edges.groupBy("fold").agg(*[
        F.max(F.when(F.col("column") == c, inner)).alias(f"{c}_breaks") for c in RFM_COLUMNS])


def _apply(df: DataFrame) -> DataFrame:
    scores = {
        f"{c}_score": right_closed_group(F.col(c), F.col(f"{c}_breaks"), ascending)
        for c, ascending in RFM_COLUMNS.items()
    }
    total = sum((F.col(s) for s in scores), F.lit(0))
    return (
        df.withColumns(scores).withColumn("rfm_total", total)
        .drop(*[f"{c}_breaks" for c in RFM_COLUMNS])
    )


def score_with_train_edges(df: DataFrame, edges: DataFrame) -> DataFrame:
    """Scores under the fit on all training rows; the edges enter as one scalar value."""
    breaks = _breaks_per_fit(edges.filter(F.col("fold").isNull())).drop("fold")
    packed = breaks.select(F.struct("*").alias("b")).scalar()
    return _apply(
        df.withColumn("b", packed)
        .withColumns({f"{c}_breaks": F.col(f"b.{c}_breaks") for c in RFM_COLUMNS})
        .drop("b"))


def score_out_of_fold(train: DataFrame, edges: DataFrame) -> DataFrame:
    """Every row scored with the edges fitted without its fold."""
    # One row per fold, so sending the edges to every task is safe.
    per_fold = _breaks_per_fit(edges.filter(F.col("fold").isNotNull()))
    return _apply(train.join(F.broadcast(per_fold), "fold"))
