"""Connected components of a link table, by alternating star contractions.

Every round hangs each node's neighbours on the smallest one, first those above the node, then
those at or below it, until nothing changes. Links stay in tables: a round reduces the smallest
neighbour before its shuffle and writes its links to the shared folder. The smallest neighbours are
stored before they meet the links, so that join has two plain sides, of which a small one is broadcast
by its size and a hot node of a large one is split.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortline.session import stage


def connect(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Union of the pairs (a, b) into ``parent``, whose entries point at roots."""
    while True:
        x, y = parent[a], parent[b]
        apart = x != y
        if not apart.any():
            return parent
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent = up


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select("v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = stage(least.select("u", F.least("u", "m").alias("m")), "least")
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    least = stage(links.groupBy("u").agg(F.min("v").alias("m")), "least")
    moved = links.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node with a link; ``links`` has columns u > v of one ordered type.

    The root is the smallest node of the component and belongs to it.
    """
    def stored(df: DataFrame) -> tuple[DataFrame, tuple]:
        table = stage(df.distinct(), "links")
        mark = table.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return table, tuple(mark)

    now, mark = stored(links.select("u", "v"))
    while True:
        after, changed = stored(_small_star(_large_star(now)))
        if changed == mark:
            break
        now, mark = after, changed
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(now.select(F.col("v"), F.col("v")).distinct())
