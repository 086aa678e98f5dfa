"""Rows that occur more than once, found by their hashes first.

A row shuffles as 16 bytes until its hash is known to occur twice. Only rows with such a hash travel whole,
and they are then compared by value, so equal hashes of unlike rows change nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortline.session import stage


def row_hashes(df: DataFrame) -> tuple[Column, Column]:
    """Two hashes of a row; a null counts by its place, and negative zero equals zero."""
    parts: list[Column] = []
    for f in df.schema.fields:
        value = F.col(f"`{f.name}`")
        parts += [value + F.lit(0).cast(f.dataType) if isinstance(f.dataType, (T.DoubleType, T.FloatType))
                  else value, value.isNull()]
    return F.xxhash64(*parts), F.xxhash64(F.lit("second"), *parts)


def repeated_rows(df: DataFrame) -> DataFrame:
    """All columns and ``copies`` of every row that occurs at least twice. ``df`` is read twice."""
    first, second = row_hashes(df)
    named = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
                      first.alias("first"), second.alias("second"))
    # Stored, so that the join knows its size: few are broadcast, many are met by a filter on the scan.
    again = stage(named.groupBy("first", "second").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(
        "first", "second"), "repeated")
    suspects = named.join(again, ["first", "second"], "left_semi").select("row.*")
    return suspects.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(
        F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def surplus_rows(df: DataFrame) -> Column:
    """How many rows repeat an earlier one, as a scalar."""
    return repeated_rows(df).agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0))).scalar()
