"""Token counts from flat token files that carry no index.

A flat file is nothing but ids of two or four bytes, with an end-of-document id behind each
document. It is read in blocks of fixed size that know nothing of documents. Each block is searched
for the end id in one vector operation and reports its tokens before the first end, the whole
documents inside, and the tokens after the last end. A prefix scan over the blocks of a file, then
over files, carries the open tail of what came before into each block, and so stitches documents
that cross blocks or files. Each scan orders one row for each block of a file, or for each file.

Defined cases: an empty file has no documents; tokens behind the last end of all files form one
last document without an end (``closed`` false); two ends in a row are a document of length 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortline.llm import store, text, tokenise
from cohortline.session import stage

BLOCK_BYTES = 4 << 20
FILE_TOKENS = 16 << 20
_FLAT = "part int, turn int, file string, bytes long"
_BLOCK = ("part int, turn int, block long, size long, ends long, head long, tail long, "
          "inner array<struct<at: long, n: long>>")


def write_flat(docs: DataFrame, tokenizer: str, end: int, width: int = 2,
               id_column: str = "doc_id", column: str = "text") -> tuple[DataFrame, DataFrame]:
    """Tokenise all documents into flat files of ``width``-byte ids, in the order they are read.

    Returns the files as (part, turn, file, bytes), in reading order, and beside them the ids of
    the documents of each file in order, as (part, turn, ordinal in the file, doc_id). The scan
    does not use the latter.
    """
    folder = store.new_folder(docs.sparkSession, "flat")
    rows = docs.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{column}`").alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, number, turn = tokenise.encoder(tokenizer, True), TaskContext.get().partitionId(), 0
        uri = out = None
        size, ids = 0, []

        def closed() -> pa.RecordBatch:
            out.close()
            known = pa.concat_arrays(ids)
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int32()), pa.array([turn], pa.int32()), pa.array([uri]),
                 pa.array([size * width]),
                 pa.ListArray.from_arrays(pa.array([0, len(known)], pa.int32()), known)],
                ["part", "turn", "file", "bytes", "ids"])

        for batch in batches:
            for part in text.parts(batch, size=tokenise.PART_BYTES):
                if out is None:
                    uri, out = store.create(folder, f"flat-{number:08d}-{turn:06d}")
                found, counts = encoder.encode(part.column("text"))
                whole = tokenise.with_end(found, counts, end)
                if len(whole) and int(whole.max()) >> (8 * width):
                    raise ValueError(f"an id of {int(whole.max())} does not fit {width} bytes")
                out.write(whole.astype(f"<u{width}").tobytes())
                size += len(whole)
                ids.append(part.column("doc_id"))
                if size >= FILE_TOKENS:
                    yield closed()
                    turn, uri, out, size, ids = turn + 1, None, None, 0, []
        if out is not None:
            yield closed()

    written = stage(rows.mapInArrow(work, _FLAT + ", ids array<long>"), "flat")
    names = written.select("part", "turn", F.posexplode("ids").alias("ordinal", "doc_id"))
    return written.drop("ids"), names


def _scan(end: int, width: int, block_bytes: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with store.opened(row["file"]) as f:
                    low = row["block"] * block_bytes
                    raw = f.read_at(min(block_bytes, row["bytes"] - low), low)
                ids = np.frombuffer(raw, f"<u{width}")
                ends = np.flatnonzero(ids == end)
                head = int(ends[0]) if len(ends) else len(ids)
                tail = len(ids) - int(ends[-1]) - 1 if len(ends) else len(ids)
                # Documents that begin behind the first end and end in this block.
                inner = pa.StructArray.from_arrays(
                    [pa.array(ends[:-1] + 1, pa.int64()),
                     pa.array(np.diff(ends) - 1, pa.int64())], ["at", "n"])
                numbers = (row["block"], len(ids), len(ends), head, tail)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["part"]], pa.int32()), pa.array([row["turn"]], pa.int32()),
                     *[pa.array([n], pa.int64()) for n in numbers],
                     pa.ListArray.from_arrays(pa.array([0, len(inner)], pa.int32()), inner)],
                    ["part", "turn", "block", "size", "ends", "head", "tail", "inner"])
    return work


def count_tokens(files: DataFrame, end: int, width: int = 2,
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(part, turn, ordinal, document, start, n_tokens, closed) of every document of flat files.

    A document belongs to the file that its end lies in; ``ordinal`` counts the documents of that
    file, ``document`` and ``start`` those of all files and the tokens before it. ``n_tokens`` leaves
    out the end.
    """
    blocks = files.select("*", F.explode(
        F.expr(f"sequence(0L, greatest(0L, (bytes - 1) div {block_bytes}))")).alias("block"))
    n = max(1, files.agg(F.sum(F.expr(f"1 + bytes div {block_bytes}"))).first()[0] or 0)
    # As many tasks as blocks, up to a few thousand.
    found = stage(blocks.repartition(min(n, 4096), "part", "turn", "block").mapInArrow(
        _scan(end, width, block_bytes), _BLOCK), "blocks")

    # What is open at the end of a block: its tail, or all of it on top of what was open before.
    order = Window.partitionBy("part", "turn").orderBy("block")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    scanned = found.select(
        "*", F.sum("size").over(upto).alias("upto"),
        F.coalesce(F.sum("ends").over(earlier), F.lit(0)).alias("ends_before"))
    scanned = scanned.withColumn(
        "last_end", F.when(F.col("ends") > 0, F.col("upto") - F.col("tail"))).withColumn(
        "closed_at", F.max("last_end").over(earlier)).withColumn(
        "before", F.col("upto") - F.col("size"))

    per_file = scanned.groupBy("part", "turn").agg(
        F.sum("size").alias("tokens"), F.sum("ends").alias("ends"),
        F.max("last_end").alias("last_end"))
    files_before = Window.orderBy("part", "turn").rowsBetween(Window.unboundedPreceding, -1)
    through = Window.orderBy("part", "turn").rowsBetween(Window.unboundedPreceding, 0)
    zero = F.lit(0)
    carried = per_file.select(
        "*", F.coalesce(F.sum("tokens").over(files_before), zero).alias("base"),
        F.coalesce(F.sum("ends").over(files_before), zero).alias("docs_before"),
        F.sum("tokens").over(through).alias("all_upto"))
    carried = carried.withColumn(
        "open_from", F.coalesce(F.max(
            F.col("all_upto") - F.col("tokens") + F.col("last_end")).over(files_before), zero))
    placed = scanned.join(
        carried.select("part", "turn", "base", "docs_before", "open_from"), ["part", "turn"])
    # Where the document that the block's first end closes began, over all files.
    began = F.coalesce(F.col("base") + F.col("closed_at"), F.col("open_from"))
    opening = F.col("base") + F.col("before")
    closing = placed.filter("ends > 0").select(
        "part", "turn", "ends_before", "docs_before", F.posexplode(F.concat(
            F.array(F.struct(began.alias("at"), (opening + F.col("head") - began).alias("n"))),
            F.transform("inner", lambda d: F.struct(
                (opening + d["at"]).alias("at"), d["n"].alias("n"))))).alias("k", "doc"))
    done = closing.select(
        "part", "turn", (F.col("ends_before") + F.col("k")).alias("ordinal"),
        (F.col("docs_before") + F.col("ends_before") + F.col("k")).alias("document"),
        F.col("doc.at").alias("start"), F.col("doc.n").alias("n_tokens"),
        F.lit(True).alias("closed"))
    last = carried.agg(
        F.max("all_upto").alias("total"), F.sum("ends").alias("docs"),
        F.max(F.col("base") + F.col("last_end")).alias("last"),
        F.max(F.struct("part", "turn")).alias("at")).select(
            F.col("at.part").alias("part"), F.col("at.turn").alias("turn"),
            F.lit(None).cast("long").alias("ordinal"), F.col("docs").alias("document"),
            F.coalesce("last", zero).alias("start"),
            (F.col("total") - F.coalesce("last", zero)).alias("n_tokens"),
            F.lit(False).alias("closed")).filter("n_tokens > 0")
    return done.union(last)
