"""A two-pass Bloom filter made of DataFrame operations.

Pass one counts how many rows fall on each cell and keeps the cells that more than one row uses;
pass two asks for each row whether all of its cells are kept. A row that repeats always passes; few
others do. Cells lie in disjoint halves, one for each hash function, so that a row never meets
itself. The filter is sized from the number of rows up to ``MOST_CELLS`` cells, which is the bound
of what is broadcast; beyond it more rows pass, and no result changes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CELLS_PER_ROW = 16
MOST_CELLS = 1 << 26


def cell_bits(rows: int) -> int:
    """log2 of the cells of each half."""
    wanted = min(MOST_CELLS, max(1024, rows * CELLS_PER_ROW))
    return int(math.ceil(math.log2(wanted))) - 1


def _cells(key: Column, bits: int) -> list[Column]:
    mask = F.lit((1 << bits) - 1)
    first, second = F.xxhash64(key), F.xxhash64(key, F.lit("second half"))
    return [first.bitwiseAND(mask), second.bitwiseAND(mask) + F.lit(1 << bits)]


def _filter(cells: DataFrame) -> DataFrame:
    """Rows (word, mask) of 64 cells each."""
    return cells.groupBy((F.shiftright("cell", 6)).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(cell & 63 AS int))")).alias("mask"))


def repeated(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """Filter of the cells that two or more rows of ``keys`` use."""
    cells = keys.select(F.explode(F.array(*_cells(F.col(key), bits))).alias("cell"))
    return _filter(cells.groupBy("cell").count().filter("count > 1"))


def present(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """Filter of the cells that any row of ``keys`` uses."""
    return _filter(keys.select(F.explode(F.array(*_cells(F.col(key), bits))).alias("cell")))


def flagged(df: DataFrame, key: Column, words: DataFrame, bits: int, name: str) -> DataFrame:
    """``df`` with a boolean: may this row's key be in the filter?"""
    out, found = df, F.lit(True)
    for i, cell in enumerate(_cells(key, bits)):
        probe = F.broadcast(words.select(
            F.col("word").alias(f"{name}_word{i}"), F.col("mask").alias(f"{name}_mask{i}")))
        out = out.withColumn(f"{name}_cell{i}", cell)
        out = out.join(
            probe, F.shiftright(f"{name}_cell{i}", 6) == F.col(f"{name}_word{i}"), "left")
        bit = F.expr(f"shiftleft(1L, cast({name}_cell{i} & 63 AS int))")
        found = found & (F.coalesce(F.col(f"{name}_mask{i}"), F.lit(0)).bitwiseAND(bit) != 0)
    return out.withColumn(name, found).drop(
        *[f"{name}_{part}{i}" for i in range(2) for part in ("cell", "word", "mask")])
