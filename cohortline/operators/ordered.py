"""Exact running totals and quantiles without an ordered window over everything.

A window ordered over a whole table runs in one task. For running totals, equal values are first
counted together, the counted values are range-partitioned into slices and stored, and each slice
adds the totals of the slices before it. For quantiles no row moves: values are counted in the cells
of a grid, and only the cells that hold a wanted rank are looked into. Results are exact; a value
that holds a third of all rows is one counted row.
"""

from __future__ import annotations

import operator
from collections.abc import Callable, Collection, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortline.session import stage

# Cells of the first grid for each unit of the logarithm: neighbours are 0.03 percent apart.
GRID = 1 << 12
# Cells that a crowded cell is cut into, and the rows from which it counts as crowded.
CUTS = 1 << 16
CROWDED = 1 << 20


def _looked_up(rows: DataFrame, table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join on equal keys; rows without a group are a group of their own."""
    table = table.withColumnsRenamed({k: f"of_{k}" for k in keys})
    same = reduce(operator.and_, [F.col(k).eqNullSafe(F.col(f"of_{k}")) for k in keys])
    return rows.join(table, same).drop(*[f"of_{k}" for k in keys])


def running_totals(counts: DataFrame, by: Sequence[str], order: str, weights: Sequence[str],
                   previous: bool = False) -> DataFrame:
    """Add ``<weight>_upto`` (inclusive running sum) and ``<weight>_total`` within ``by``.

    ``counts`` holds each (by, order) pair once and is evaluated by this call, not later: its slices
    are stored in the shared folder. ``previous`` adds ``<weight>_previous``, the weight
    of the value before, null at the first one; a slice takes it from the end of the slice before.
    """
    by = list(by)
    # Adaptive execution may merge neighbouring ranges, never reorder them, so small inputs get
    # few slices. Stored, so that the slice numbers read below are those of one partitioning.
    sliced = stage(
        counts.repartitionByRange(*by, order).withColumn("slice", F.spark_partition_id()),
        "slices")
    earlier = Window.partitionBy(*by).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    # A few rows per slice: small enough for one ordered window.
    ends = [F.max_by(w, order).alias(f"{w}_end") for w in weights] if previous else []
    in_order = Window.partitionBy(*by).orderBy("slice")
    offsets = (
        sliced.groupBy(*by, "slice").agg(*[F.sum(w).alias(w) for w in weights], *ends)
        .select(
            *by, "slice", *weights,
            *[F.lag(f"{w}_end").over(in_order).alias(f"{w}_tail") for w in weights if previous],
            *[F.coalesce(F.sum(w).over(earlier), F.lit(0)).alias(f"{w}_before") for w in weights],
            *[F.sum(w).over(whole).alias(f"{w}_total") for w in weights],
        )
    )
    inside = Window.partitionBy(*by, "slice").orderBy(order).rowsBetween(
        Window.unboundedPreceding, 0)
    next_to = Window.partitionBy(*by, "slice").orderBy(order)
    before = {f"{w}_previous": F.coalesce(F.lag(w).over(next_to), F.col(f"{w}_tail"))
              for w in weights if previous}
    return (
        _looked_up(sliced, offsets.drop(*weights), [*by, "slice"])
        .withColumns({f"{w}_upto": F.sum(w).over(inside) + F.col(f"{w}_before") for w in weights} | before)
        .drop("slice", *[f"{w}_{x}" for w in weights for x in ("before", "tail")])
    )


def _positions(total: Column, prob: float, nearest: bool) -> tuple[Column, Column, Column]:
    """Zero-based ranks around a quantile and the weight of the upper one."""
    at = F.lit(float(prob)) * (total - 1)
    if nearest:
        rank = F.floor(at + 0.5)
        return rank, rank, F.lit(0.0)
    return F.floor(at), F.ceil(at), at - F.floor(at)


def _log(value: Column) -> Column:
    """Rises with the value; infinities lie outside the range of finite values, NaN with the upper."""
    logarithm = F.signum(value) * F.log1p(F.abs(value))
    return F.greatest(F.least(logarithm, F.lit(710.0)), F.lit(-710.0))


def _cut(value: Column, low: Column, high: Column) -> Column:
    """Number of the piece of a cell that a value lies in; both ends lie in different pieces."""
    share = F.when(_log(high) > _log(low), F.try_divide(
        _log(value) - _log(low), _log(high) - _log(low)))
    share = F.coalesce(share, F.try_divide(value - low, high - low), F.lit(0.0))
    return F.floor(F.nanvl(share, F.lit(0.0)) * (CUTS - 1))


def _wanted_cells(rows: DataFrame, parents: Sequence[str], cell: str, flags: Sequence[str],
                  places: Callable[[Column], Column], known: DataFrame | None) -> DataFrame:
    """(parents, cell, fit, total, before, rows, low, high) of cells that hold a wanted rank; stored.

    ``known`` has the totals and the rows before each parent, once it is a cell itself.
    """
    counts = rows.groupBy(*parents, cell).agg(
        *[F.count_if(f).alias(f) for f in flags], F.count("*").alias("rows"),
        F.min("value").alias("low"), F.max("value").alias("high"))
    # At most a few ten thousand cells, whatever the number of rows.
    each = counts.unpivot([*parents, cell, "rows", "low", "high"], list(flags), "fit", "w")
    whole = Window.partitionBy(*parents, "fit")
    earlier = whole.orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    each = each.withColumn("inside", F.coalesce(F.sum("w").over(earlier), F.lit(0)))
    if known is None:
        each = each.withColumns({"total": F.sum("w").over(whole), "before": F.col("inside")})
    else:
        each = _looked_up(each, known.select(*parents, "fit", "total", "before"), [*parents, "fit"])
        each = each.withColumn("before", F.col("before") + F.col("inside"))
    held = F.exists(places(F.col("total")), lambda r: (r >= F.col("before")) & (
        r < F.col("before") + F.col("w")))
    return stage(each.filter(held).drop("w", "inside"), "cells")


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
                    by: Sequence[str] = (), fits: dict[str, Column] | None = None,
                    nearest: Collection[float] = ()) -> DataFrame:
    """Exact quantiles of several columns, as (by, column, fit, n, quantiles).

    Linear interpolation between neighbours; probabilities in ``nearest`` take the nearest rank
    instead. Each entry of ``fits`` names a subset of the rows by a condition; all subsets and
    probabilities share the passes. Nulls are ignored; NaN is the largest value.

    A first pass counts values in the cells of a fixed logarithmic grid, a second looks at the values
    of the cells that hold a wanted rank. Cells with many rows between different bounds are cut again
    before that. ``df`` is read by each pass, so pass a stored table; all passes but the last run
    when the function is called.
    """
    by = list(by)
    fits = fits or {"all": F.lit(True)}
    flags = {name: f"in_{i}" for i, name in enumerate(fits)}
    long = (
        df.withColumns({flags[name]: cond.cast("boolean") for name, cond in fits.items()})
        .select(*by, *flags.values(), *[F.col(c).cast("double").alias(c) for c in columns])
        .unpivot([*by, *flags.values()], list(columns), "column", "value")
        .filter(F.col("value").isNotNull())
    )
    def ranks(total: Column) -> Column:
        """All wanted ranks among so many rows."""
        return F.array_distinct(F.array(*[
            r for p in probs for r in _positions(total, p, p in nearest)[:2]]))

    names = list(flags.values())
    parents, cell, known = [*by, "column"], "cell_0", None
    rows = long.withColumn(cell, F.floor(_log(F.col("value")) * GRID))
    while True:
        known = _wanted_cells(rows, parents, cell, names, ranks, known)
        parents = [*parents, cell]
        # Fits share cells; a few for each wanted rank.
        cells = known.groupBy(*parents).agg(*[F.max(c).alias(c) for c in ("low", "high", "rows")])
        rows = _looked_up(rows.select(*parents, "value", *names), cells, parents)
        finite = (F.abs("low") < float("inf")) & (F.abs("high") < float("inf"))
        crowd = known.filter((F.col("low") < F.col("high")) & finite).agg(F.max("rows")).first()[0]
        if (crowd or 0) <= CROWDED:
            break
        cell = f"cell_{len(parents)}"
        rows = rows.withColumn(cell, _cut(F.col("value"), F.col("low"), F.col("high")))

    counts = rows.groupBy(*parents, "value").agg(*[F.count_if(f).alias(f) for f in names])
    each = counts.unpivot([*parents, "value"], names, "fit", "w").filter("w > 0")
    upto = Window.partitionBy(*parents, "fit").orderBy("value").rowsBetween(
        Window.unboundedPreceding, 0)
    totals = _looked_up(
        each, known.select(*parents, "fit", "total", "before"), [*parents, "fit"]
    ).withColumn("upto", F.col("before") + F.sum("w").over(upto))

    places = [_positions(F.col("n"), p, p in nearest) for p in probs]
    # Only the few values that sit on a wanted rank leave this step.
    hits = totals.withColumnRenamed("total", "n").withColumn("rank", F.explode(F.filter(
        ranks(F.col("n")), lambda r: (r >= F.col("upto") - F.col("w")) & (r < F.col("upto")))))
    title = F.element_at(F.create_map(*[
        F.lit(x) for name, flag in flags.items() for x in (flag, name)]), F.col("fit"))
    hits = hits.withColumn("fit", title)
    found = hits.groupBy(*by, "column", "fit", "n").agg(
        F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("at"))

    def quantile(place: tuple[Column, Column, Column]) -> Column:
        low, high, share = place
        below, above = F.element_at("at", low), F.element_at("at", high)
        return F.when(share == 0, below).otherwise(below + (above - below) * share)

    return found.select(
        *by, "column", "fit", "n", F.array(*[quantile(p) for p in places]).alias("quantiles"))


def medians(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (),
            suffix: str = "") -> DataFrame:
    """Exact median of each column, as one row per group."""
    long = exact_quantiles(df, columns, [0.5], by=by)
    return long.groupBy(*by).agg(*[
        F.max(F.when(F.col("column") == c, F.col("quantiles")[0])).alias(f"{c}{suffix}")
        for c in columns
    ])
