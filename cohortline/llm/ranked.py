"""Ranked search with a term-partitioned index: items visit the owners of their terms one after another.

Documents form segments of a few megabytes of text, the items bundles of ``BUNDLE`` items. A segment keeps
the postings of those terms that items ask for. Terms are owned by stages according to how many documents
hold them, rare ones first. A bundle visits the stages in order, for every segment by itself: a stage
cogroups the bundles with the postings of the terms it owns, adds the integer contributions of those terms
to the sparse accumulators (document, score) that a bundle carries, and hands the bundle on. The last stage
selects the best of each item and segment, and the best of these are the result.

An accumulator is not carried on if its document cannot reach the best of the segment any more: its score
and the most that the terms to come can add stay under the score that ``top`` documents of the segment have
already. Such documents cannot be in the result, so nothing is lost.

A segment sees only its own part of the postings of a frequent term, so no term is too hot. Which terms are
asked for, or owned by a stage, is broadcast as bits, at most ``MOST_BITS`` for each; a term that passes
by mistake costs some bytes and never adds to a score. Terms are told apart by 64-bit hashes.

Defined cases: null texts have no terms; items without a term that some document holds have no rows; rows
that repeat an id are items, or documents, of their own; documents without id come last among equal scores;
empty tables give an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from cohortline.llm import store, text
from cohortline.session import stage

TOP = 10
BUNDLE = 256
SEGMENT_BYTES = 8 << 20
MOST_BITS = 1 << 23
#: A stage owns the terms that at most one in so many documents hold, the last one all that remain.
RARITY = (256, 16, 4)
#: No term adds more to a score than this much of its weight.
MOST_IMPACT = 999_999
_SALTS = 64
_U64 = np.uint64


def _words(texts: pa.Array) -> text.Words:
    return text.Words(texts, text.ALNUM, lower=True)


def _bit(terms: Column, bits: int) -> Column:
    return F.shiftrightunsigned(terms, 17).bitwiseAND(F.lit(bits - 1))


def term_bits(terms: DataFrame, n: int) -> np.ndarray:
    """Bits, as bytes, of the terms in a table; about 32 for each of ``n`` and at most ``MOST_BITS``."""
    bits = min(MOST_BITS, 1 << max(10, (32 * n - 1).bit_length()))
    place = _bit(F.col("term"), bits)
    rows = terms.select(place.alias("p")).groupBy(F.expr("p >> 5").alias("at")).agg(
        F.expr("bit_or(shiftleft(1L, cast(p & 31 AS int)))").alias("x"))
    out = np.zeros(bits // 32, np.uint32)
    for at, x in rows.collect():
        out[at] = x
    return out


def _has(bits: np.ndarray, terms: np.ndarray) -> np.ndarray:
    place = (terms >> _U64(17)) & _U64(len(bits) * 32 - 1)
    return (bits[(place >> _U64(5)).astype(np.int64)] >> (place & _U64(31)).astype(np.uint32)) & 1 == 1


def item_terms(items: DataFrame, id_column: str, column: str) -> DataFrame:
    """(q, item_id, terms): a number for each item, and its distinct terms; stored."""
    rows = items.select(F.monotonically_increasing_id().alias("q"),
                        F.col(f"`{id_column}`").alias("item_id"), F.col(f"`{column}`").alias("text"))
    kind = rows.schema["item_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text.parts(batch):
                words = _words(part.column("text"))
                hashes = words.hashes().view(np.int64)
                terms = [np.unique(hashes[a:b]) for a, b in zip(words.first[:-1], words.first[1:])]
                yield pa.RecordBatch.from_arrays(
                    [part.column("q"), part.column("item_id"), pa.array(terms, pa.list_(pa.int64()))],
                    ["q", "item_id", "terms"])

    return stage(rows.mapInArrow(work, f"q long, item_id {kind}, terms array<long>"), "items")


def segments(docs: DataFrame, asked: np.ndarray, id_column: str, column: str) -> DataFrame:
    """(segment, ids, n_terms, postings) of runs of documents; stored.

    Documents of a segment lie in order of id. ``postings`` packs the asked terms, where each one's
    postings begin, and the documents and frequencies of the postings.
    """
    rows = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{column}`").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in text.parts(batch, size=SEGMENT_BYTES):
                part = pa.Table.from_batches([part]).sort_by("id").combine_chunks()
                words = _words(part.column("text").combine_chunks())
                hashes = words.hashes()
                use = np.flatnonzero(_has(asked, hashes))
                terms, which = np.unique(hashes[use], return_inverse=True)
                pairs, frequency = np.unique(
                    which * part.num_rows + words.row_of_word()[use], return_counts=True)
                term, document = np.divmod(pairs, part.num_rows)
                postings = store.dump(
                    terms, np.searchsorted(term, np.arange(len(terms) + 1)).astype(np.uint32),
                    store.narrow(document), store.narrow(frequency))
                ids = part.column("id").combine_chunks()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int64()),
                     pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                     pa.array([words.counts.tolist()], pa.list_(pa.int64())),
                     pa.array([postings], pa.binary())], ["segment", "ids", "n_terms", "postings"])
                number += 1

    return stage(rows.mapInArrow(
        work, f"segment long, ids array<{kind}>, n_terms array<long>, postings binary"), "segments")


def _holders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many documents of a segment hold each term."""
    for batch in batches:
        for packed in batch.column("postings").to_pylist():
            terms, begin = store.load(packed)[:2]
            yield pa.RecordBatch.from_arrays(
                [pa.array(terms.view(np.int64)), pa.array(np.diff(begin.astype(np.int64)))], ["term", "df"])


def weights(parts: DataFrame, asked: DataFrame, n_docs: int) -> DataFrame:
    """(term, weight, owner) of the asked terms that some document holds; stored."""
    held = parts.select("postings").mapInArrow(_holders, "term long, df long").groupBy("term").agg(
        F.sum("df").alias("df"))
    weight = F.floor(1000 * F.log((F.lit(2.0) * n_docs + 2) / (F.lit(2.0) * F.col("df") + 1)))
    owner = F.lit(len(RARITY))
    for k in reversed(range(len(RARITY))):
        owner = F.when(F.col("df") * RARITY[k] <= n_docs, k).otherwise(owner)
    return stage(held.join(asked, "term", "left_semi").select(
        "term", weight.cast("long").alias("weight"), owner.alias("owner")), "weights")


def bundles(items: DataFrame, weighted: DataFrame, n_items: int) -> DataFrame:
    """(bundle, wanted): which item wants which term, packed; stored."""
    count = -(-n_items // BUNDLE)
    wanted = items.select("q", F.explode("terms").alias("term")).join(weighted, "term").groupBy(
        F.pmod(F.xxhash64("q"), F.lit(count)).alias("bundle")).agg(
        F.collect_list(F.struct("q", "term", "weight", "owner")).alias("wanted"))
    return stage(wanted, "bundles")


def _owned(k: int, bits: np.ndarray, total: int, holding: int, kind: str, last: bool):
    """The postings of a stage's terms with their impacts, and for the last stage the ids."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                terms, begin, document, frequency = store.load(batch.column("postings")[i].as_py())
                own = np.flatnonzero(_has(bits, terms))
                sizes = np.diff(begin.astype(np.int64))[own]
                first = np.concatenate([[0], np.cumsum(sizes)])
                at = np.arange(first[-1]) + np.repeat(begin[own].astype(np.int64) - first[:-1], sizes)
                length = np.array(batch.column("n_terms")[i].as_py(), np.int64)
                document, tf = document[at], frequency[at].astype(np.int64)
                m = 10 + 90 * length * holding // max(1, total)
                impact = 1_000_000_000 * tf // (1000 * tf + 8 * m[document])
                columns = [batch.column("segment").slice(i, 1), pa.array([store.dump(
                    terms[own], first, document, impact.astype(np.int32))], pa.binary())]
                if last:
                    columns.append(batch.column("ids").slice(i, 1))
                yield pa.RecordBatch.from_arrays(
                    columns, ["segment", "postings", "ids"][:len(columns)])

    return work, "segment long, postings binary" + (f", ids array<{kind}>" if last else "")


class Carried:
    """A bundle at a segment: who wants what, and a table of scores (item, document)."""

    def __init__(self, left: pa.Table):
        row = left.slice(0, 1).to_pylist()[0]
        wanted = left.column("wanted").combine_chunks()[0].values
        self.q, self.term, self.weight, self.owner = (
            wanted.field(c).to_numpy(zero_copy_only=False) for c in ("q", "term", "weight", "owner"))
        self.term = self.term.view(_U64)
        self.items, self.item = np.unique(self.q, return_inverse=True)
        self.scores = np.zeros((len(self.items), row["n_docs"]), np.int64)
        if row["carried"] is not None:
            item, document, score = store.load(row["carried"])
            self.scores[item, document] = score

    def add(self, k: int, packed: bytes) -> None:
        """Contributions of the terms that stage k owns."""
        terms, first, document, impact = store.load(packed)
        mine = np.flatnonzero(self.owner == k)
        at = np.minimum(np.searchsorted(terms, self.term[mine]), max(0, len(terms) - 1))
        if not len(terms):
            return
        for j, t in zip(mine[terms[at] == self.term[mine]], at[terms[at] == self.term[mine]]):
            run = slice(first[t], first[t + 1])
            self.scores[self.item[j], document[run]] += self.weight[j] * impact[run].astype(np.int64)

    def reached(self, top: int) -> np.ndarray:
        """The score that ``top`` documents have at least, for each item."""
        n = self.scores.shape[1]
        return (np.partition(self.scores, n - top, axis=1)[:, n - top] if n >= top
                else np.zeros(len(self.items), np.int64))

    def carried(self, k: int, top: int) -> bytes:
        """What is worth carrying on behind stage k."""
        later = self.owner > k
        room = np.zeros(len(self.items), np.int64)
        np.add.at(room, self.item[later], self.weight[later] * MOST_IMPACT)
        keep = (self.scores > 0) & (self.scores + room[:, None] >= self.reached(top)[:, None])
        item, document = np.nonzero(keep)
        return store.dump(store.narrow(item), store.narrow(document), self.scores[item, document])

    def best(self, top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(q, document, score) of the best documents of each item; of equal ones the first."""
        item, document = np.nonzero(
            (self.scores > 0) & (self.scores >= self.reached(top)[:, None]))
        score = self.scores[item, document]
        order = np.lexsort((document, -score, item))
        item, document, score = item[order], document[order], score[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        some = place < top
        return self.items[item[some]], document[some], score[some]


def _visit(k: int, top: int, last: bool, kind: pa.DataType):
    out = pa.schema([("q", pa.int64()), ("doc_id", kind), ("score", pa.int64())])

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return out.empty_table() if last else left
        here = Carried(left)
        if right.num_rows:
            here.add(k, right.column("postings")[0].as_py())
        if last:
            q, document, score = here.best(top)
            ids = right.column("ids").combine_chunks()[0].values
            return pa.table([pa.array(q), ids.take(pa.array(document)), pa.array(score)], schema=out)
        return left.set_column(left.schema.get_field_index("carried"), "carried",
                               pa.array([here.carried(k, top)], pa.binary()))
    return work


def search(docs: DataFrame, items: DataFrame, top: int = TOP, id_column: str = "doc_id",
           column: str = "text", item_column: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of each item with a score above 0."""
    asked_by = item_terms(items, item_column, item_text)
    asked = stage(asked_by.select(F.explode("terms").alias("term")).distinct(), "asked")
    n_items = asked_by.count()
    parts = segments(docs, term_bits(asked, asked.count()), id_column, column)
    holding, total = parts.select(F.explode("n_terms").alias("n")).agg(
        F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    weighted = weights(parts, asked, holding)
    id_type = parts.schema["ids"].dataType.elementType
    kind = id_type.simpleString()

    groups = bundles(asked_by, weighted, max(1, n_items))
    every_bundle = F.sequence(F.lit(0), F.lit(max(0, -(-n_items // BUNDLE) - 1))).cast("array<long>")
    salted = groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    visits = parts.select("segment", F.size("ids").alias("n_docs")).select(
        "*", F.explode(every_bundle).alias("bundle"),
        F.pmod(F.xxhash64("segment"), F.lit(_SALTS)).cast("int").alias("salt"))
    now = visits.join(salted, ["bundle", "salt"]).select(
        "segment", "bundle", "n_docs", "wanted", F.lit(None).cast("binary").alias("carried"))
    carried = now.schema
    for k in range(len(RARITY) + 1):
        last = k == len(RARITY)
        own = weighted.filter(F.col("owner") == k)
        work, schema = _owned(k, term_bits(own, own.count()), total, holding, kind, last)
        needed = ["segment", "n_terms", "postings"] + ["ids"] * last
        owned = parts.select(*needed).mapInArrow(work, schema).withColumn(
            "bundle", F.explode(every_bundle))
        found = f"q long, doc_id {kind}, score long" if last else carried
        now = now.groupBy("segment", "bundle").cogroup(owned.groupBy("segment", "bundle")).applyInArrow(
            _visit(k, top, last, to_arrow_type(id_type)), found)

    order = Window.partitionBy("q").orderBy(F.desc("score"), F.col("doc_id").isNull(), "doc_id")
    best = now.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return best.join(asked_by.select("q", "item_id"), "q").select("item_id", "rank", "doc_id", "score")
