"""Web archives: WARC files written by tasks, and read back without an index.

Writing: payloads of at least ``LEAST_BYTES`` are compared by SHA-256. Of equal ones the row with the
smallest id becomes a response and the others become revisits, which carry no payload; smaller payloads
are responses always. A Bloom filter finds the rows whose payload may occur twice: only those shuffle, and
reduce to one row for each task and payload before they do. All others go from the scan to the files.

Reading: a payload may hold anything, a whole archive too, so a place that looks like the start of a record
proves nothing. Each block of a file reports every such place and, from its length field, the place where
the next record must begin. Pointer jumping from the file's start then keeps what is reachable: the places
of a block are first chained inside the block up to the first place behind it, and these few pointers,
one for each way into a block, double their stride from round to round in stored tables. The records of a
block are read from its one reachable entry.

Defined cases: a null payload is empty; a null id is last in order and has no id field; rows that repeat id
and payload are records of their own, of which one is the response; an empty table gives no file and no
record; other columns are not read. An id is text in a file. URLs keep printable ASCII, other bytes are
percent-encoded. A file whose chain does not end where the file ends, or a payload that does not have its
digest, raises ``ValueError``. A revisit whose response is not among the files has null in the fields that the
response gives.
"""

from __future__ import annotations

import hashlib
import re
import string
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortline.llm import bloom, store, text
from cohortline.session import stage

#: Shorter payloads are never revisits.
LEAST_BYTES = 100
FILE_BYTES = 256 << 20
BLOCK_BYTES = 4 << 20
MOST_HEADER = 64 << 10
MOST_TASKS = 4096
# The file format.
MAGIC = b"WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
_END = b"\r\n\r\n"
_LENGTH = re.compile(rb"\r\nContent-Length:[ \t]*(\d{1,18})\r\n", re.IGNORECASE)
_PLAIN = "".join(c for c in string.punctuation if c != "%") + "%"
_FILES = "file string, bytes long, records long"
_CANDIDATE = "file string, bytes long, at long, next long, exit long"


def _header(kind: str, record_id: uuid.UUID, page: str | None, url: str | None, digest: bytes,
            refers: uuid.UUID | None, date: str, length: int) -> bytes:
    fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:uuid:{record_id}>"), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe=_PLAIN)))
    if page is not None:
        fields.append(("X-Page-Id", quote(page, safe="")))
    fields.append(("WARC-Payload-Digest", f"sha256:{digest.hex()}"))
    if refers is not None:
        fields += [("WARC-Refers-To", f"<urn:uuid:{refers}>"), ("WARC-Profile", PROFILE)]
    fields += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(length))]
    return MAGIC + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n"


def _writer(folder: str, crawl: uuid.UUID, date: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uri = out = None
        size = records = 0

        def closed() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pydict({"file": [uri], "bytes": [size], "records": [records]})

        for batch in batches:
            for part in text.parts(batch, "payload"):
                for row in part.to_pylist():
                    if out is None:
                        uri, out = store.create(folder, "pages")
                        size = records = 0
                    # One response for each larger payload, so its name follows from the payload.
                    first = uuid.uuid5(crawl, row["digest"].hex())
                    if row["payload"] is None:
                        block = b"HTTP/1.1 200 OK\r\n\r\n"
                        head = _header("revisit", uuid.uuid4(), row["id"], row["url"], row["digest"],
                                       first, date, len(block))
                    else:
                        body = row["payload"].encode()
                        block = _HTTP % len(body) + body
                        head = _header(
                            "response", first if len(body) >= LEAST_BYTES else uuid.uuid4(), row["id"],
                            row["url"], row["digest"], None, date, len(block))
                    out.write(head)
                    out.write(block)
                    out.write(_END)
                    size += len(head) + len(block) + len(_END)
                    records += 1
                    if size >= FILE_BYTES:
                        yield closed()
                        out = None
        if out is not None:
            yield closed()
    return work


def write_archives(pages: DataFrame, id_column: str = "page_id", url_column: str = "url",
                   column: str = "html", date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write one record per row; returns the files as (file, bytes, records)."""
    rows = pages.select(
        F.col(f"`{id_column}`").alias("id"), F.col(f"`{url_column}`").cast("string").alias("url"),
        F.coalesce(F.col(f"`{column}`").cast("string"), F.lit("")).alias("payload"))
    hashed = rows.withColumn("digest", F.unhex(F.sha2("payload", 256))).withColumn(
        "large", F.octet_length("payload") >= LEAST_BYTES)
    # Numbered before they are stored, so that rows which repeat id and payload can be told apart.
    keys = stage(hashed.filter("large").select("id", "url", "digest").withColumn(
        "row", F.monotonically_increasing_id()), "payloads")
    place = [F.col("id").isNull(), F.col("id"), F.col("url").isNull(), F.col("url")]
    groups = stage(keys.groupBy("digest").agg(
        F.min(F.struct(*place, "row")).alias("first"), F.count("*").alias("size")).filter("size > 1"),
        "repeats")
    again = keys.join(groups, "digest").filter(F.col("row") != F.col("first.row"))

    bits = bloom.cell_bits(keys.count())
    seen = bloom.flagged(hashed, F.col("digest"), stage(bloom.repeated(keys, "digest", bits), "filter"),
                         bits, "maybe")
    alone = ~F.col("large") | ~F.col("maybe")
    one = seen.filter(~alone).groupBy("digest").agg(
        F.min_by(F.struct("id", "url", "payload"), F.struct(*place)).alias("one"))
    records = seen.filter(alone).select("id", "url", "digest", "payload").unionByName(
        one.select("one.*", "digest")).unionByName(
        again.select("id", "url", "digest", F.lit(None).cast("string").alias("payload")))
    spark = pages.sparkSession
    return stage(records.withColumn("id", F.col("id").cast("string")).mapInArrow(
        _writer(store.new_folder(spark, "warc"), uuid.uuid4(), date), _FILES), "archives")


def _head_at(f, raw: bytes, low: int, at: int, size: int) -> tuple[int, int] | None:
    """(length of the header, length of its block) if there is a whole record at ``at``."""
    end = raw.find(_END, at - low, at - low + MOST_HEADER)
    if end >= 0:
        head = raw[at - low:end + 4]
    else:
        head = f.read_at(min(MOST_HEADER, size - at), at)
        head = head[:head.find(_END) + 4]
    length = _LENGTH.search(head)
    if not head.startswith(MAGIC) or not length:
        return None
    block = int(length[1])
    return (len(head), block) if at + len(head) + block + len(_END) <= size else None


def chained(at: list[int], following: list[int], end: int) -> list[int]:
    """For each place the first place at or behind ``end`` on its chain; -1 where the chain breaks."""
    out: dict[int, int] = {}
    for a, b in zip(reversed(at), reversed(following)):
        out[a] = b if b >= end else out.get(b, -1)
    return [out[a] for a in at]


def _candidates(block_bytes: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                low, size = row["block"] * block_bytes, row["bytes"]
                end = min(low + block_bytes, size)
                at, following = [], []
                with store.opened(row["file"]) as f:
                    raw = f.read_at(min(end + len(MAGIC) - 1, size) - low, low)
                    for match in re.finditer(re.escape(MAGIC), raw):
                        found = _head_at(f, raw, low, low + match.start(), size)
                        if found:
                            at.append(low + match.start())
                            following.append(at[-1] + sum(found) + len(_END))
                yield pa.RecordBatch.from_pydict(
                    {"file": pa.array([row["file"]] * len(at), pa.string()), "bytes": pa.array([size] * len(at), pa.int64()),
                     "at": pa.array(at, pa.int64()), "next": pa.array(following, pa.int64()),
                     "exit": pa.array(chained(at, following, end), pa.int64())})
    return work


def candidates(files: DataFrame, block_bytes: int | None = None) -> DataFrame:
    """(file, bytes, at, next, exit) of every place that looks like a record.

    ``next`` is where the following record would begin, ``exit`` the first such place behind the block.
    """
    size = block_bytes or BLOCK_BYTES
    blocks = files.filter("bytes > 0").select("file", "bytes", F.explode(F.sequence(
        F.lit(0), F.expr(f"(bytes - 1) div {size}"))).alias("block"))
    return blocks.repartition(_tasks(files, size), "file", "block").mapInArrow(
        _candidates(size), _CANDIDATE)


def _tasks(files: DataFrame, size: int) -> int:
    total = files.agg(F.sum("bytes")).first()[0] or 0
    return int(min(MOST_TASKS, max(1, -(-total // size))))


def entries(files: DataFrame, block_bytes: int | None = None) -> DataFrame:
    """(file, bytes, at): for each block of each file the one place where its first record begins.

    Raises if the records of a file do not lead from its start to its end.
    """
    hops = stage(candidates(files, block_bytes), "places").filter("exit >= 0").select(
        "file", "bytes", "at", F.col("exit").alias("to"))
    whole = files.filter("bytes > 0").select("file", "bytes", F.lit(0).cast("long").alias("at"))
    ways_in = hops.filter("to < bytes").select("file", F.col("to").alias("at")).union(
        whole.select("file", "at")).distinct()
    hops = stage(hops.join(ways_in, ["file", "at"], "left_semi"), "hops")
    reached, stride = whole, hops
    while stride.limit(1).count():
        more = reached.join(stride.select("file", "at", "to"), ["file", "at"]).filter("to < bytes")
        reached = stage(reached.union(
            more.select("file", "bytes", F.col("to").alias("at"))).distinct(), "reached")
        onward = stride.select("file", F.col("at").alias("to"), F.col("to").alias("then"))
        stride = stage(stride.join(onward, ["file", "to"]).select(
            "file", "bytes", "at", F.col("then").alias("to")), "strides")
    ended = reached.join(hops.filter("to = bytes").select("file", "at"), ["file", "at"])
    broken = whole.join(ended.select("file"), "file", "left_anti").select("file").limit(3).collect()
    if broken:
        raise ValueError(f"the records do not fill these files: {[r[0] for r in broken]}")
    return reached


_RECORD = ("file string, at long, record_type string, record_id string, page_id string, url string, "
           "payload_bytes long, payload_digest string, refers string")


def _record(uri: str, at: int, head: bytes, block: bytes) -> dict:
    fields = {}
    for line in head[len(MAGIC):].split(b"\r\n"):
        name, _, value = line.partition(b":")
        fields[name.decode().lower()] = value.strip().decode()
    page = fields.get("x-page-id")
    digest = fields.get("warc-payload-digest", "").removeprefix("sha256:")
    row = {"file": uri, "at": at, "record_type": fields["warc-type"],
           "record_id": fields["warc-record-id"], "page_id": page if page is None else unquote(page),
           "url": fields.get("warc-target-uri"), "payload_bytes": None, "payload_digest": digest,
           "refers": fields.get("warc-refers-to"), "payload": None}
    if row["record_type"] == "response":
        payload = block[block.index(_END) + len(_END):]
        if hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError(f"{uri} at {at}: the payload does not have its digest")
        row |= {"payload_bytes": len(payload), "payload": payload}
    return row


def _reader(block_bytes: int, payloads: bool):
    names = [f.split()[0] for f in _RECORD.split(", ")] + ["payload"] * payloads
    schema = pa.schema([(n, pa.binary() if n == "payload" else pa.int64() if n in (
        "at", "payload_bytes") else pa.string()) for n in names])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                low, size, found = row["at"], row["bytes"], []
                end = min((low // block_bytes + 1) * block_bytes, size)
                with store.opened(row["file"]) as f:
                    raw = f.read_at(min(end + MOST_HEADER, size) - low, low)
                    at = low
                    while at < end:
                        head, block = _head_at(f, raw, low, at, size)
                        begin, stop = at + head, at + head + block
                        whole = (raw[at - low:stop - low] if stop - low <= len(raw)
                                 else f.read_at(stop - at, at))
                        found.append(_record(row["file"], at, whole[:head], whole[head:]))
                        at = stop + len(_END)
                for i in range(0, len(found), 256):
                    yield pa.RecordBatch.from_pylist(
                        [{n: r[n] for n in names} for r in found[i:i + 256]], schema)
    return work


def read_records(files: DataFrame, block_bytes: int | None = None, payloads: bool = False) -> DataFrame:
    """The records as they lie in the files, responses with the size of their payload, or itself."""
    size = block_bytes or BLOCK_BYTES
    return entries(files, size).repartition(_tasks(files, size), "file", "at").mapInArrow(
        _reader(size, payloads), _RECORD + (", payload binary" if payloads else ""))


def read_archives(files: DataFrame, block_bytes: int | None = None) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to) of every record.

    A revisit has size and digest of the payload that it stands for, and in ``refers_to`` the page of the
    response that holds it.
    """
    records = stage(read_records(files, block_bytes), "records")
    out = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    responses = records.filter("record_type = 'response'")
    held = stage(responses.filter(F.col("payload_bytes") >= LEAST_BYTES).select(
        F.col("record_id").alias("refers"), F.col("page_id").alias("refers_to"), "payload_bytes"), "held")
    revisits = records.filter("record_type = 'revisit'").drop("payload_bytes").join(held, "refers", "left")
    return responses.withColumn("refers_to", F.lit(None).cast("string")).select(*out).unionByName(
        revisits.select(*out))
