"""Exact dedup by a two-pass Bloom filter, in DataFrame operations only.

Texts are equal when they are identical after each run of ASCII white space is replaced by one
space; null counts as empty. The filter finds the rows whose text may occur twice; only those
shuffle, the others pass straight through. What passes the filter is grouped by SHA-256, so the
filter decides cost and never the result. At most ``bloom.MOST_CELLS`` cells are broadcast.

Defined cases: null ids sort after all others; rows that repeat id and text are one group of which
one row stays; an empty table gives an empty result; other columns pass through untouched,
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortline.llm import bloom
from cohortline.session import stage

RESULT = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def text_key(text: Column) -> Column:
    """SHA-256 of the normalised text, as bytes."""
    plain = F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), "[\\x20\\x09-\\x0D]+", " ")
    return F.unhex(F.sha2(plain, 256))


def mark_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: the row that stays for it, its group's size, and whether it stays."""
    # Numbered before it is stored, so that rows which repeat both id and text can be told apart.
    hashed = stage(
        docs.select(F.col(id_column).alias("doc_id"), text_key(F.col(text)).alias("key"))
        .withColumn("row", F.monotonically_increasing_id()), "keys")
    bits = bloom.cell_bits(hashed.count())
    words = stage(bloom.repeated(hashed, "key", bits), "filter")
    seen = bloom.flagged(hashed, F.col("key"), words, bits, "maybe")
    sha = F.lower(F.hex("key")).alias("text_sha256")
    alone = seen.filter(~F.col("maybe")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), sha)

    maybe = seen.filter("maybe").select("doc_id", "key", "row")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    # Stored, so that the join below meets two plain sides: a small one is broadcast by its size, and
    # of a large one the hot key is split.
    groups = stage(maybe.groupBy("key").agg(
        F.min(order).alias("least"), F.count("*").alias("group_size")), "groups")
    together = maybe.join(groups, "key").select(
        "doc_id", F.col("least.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("least.row")).alias("kept"), sha)
    return alone.unionByName(together)


def exact_dedup(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with all their columns.

    Of equal texts the row with the smallest id stays. Rows that may repeat are reduced before
    their shuffle to one per task and text, so a text that fills a third of the table costs no
    more than any other.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    keyed = docs.select(row.alias("row"), text_key(F.col(text)).alias("key"))
    keys = stage(keyed.select("key"), "keys")
    bits = bloom.cell_bits(keys.count())
    words = stage(bloom.repeated(keys, "key", bits), "filter")
    seen = bloom.flagged(keyed, F.col("key"), words, bits, "maybe")
    id_of = F.col(f"row.`{id_column}`")
    first = seen.filter("maybe").groupBy("key").agg(
        F.min_by("row", F.struct(id_of.isNull(), id_of)).alias("row"))
    return seen.filter(~F.col("maybe")).select("row").union(first.select("row")).select("row.*")
