"""Web archives: round trips, payloads that look like records, and damaged files."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from cohortline.llm import registry, store, warc

PAGES = "page_id bigint, url string, html string"


def archived(records):
    """A small archive as text, as someone might serve it."""
    out = ""
    for body in records:
        out += ("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:fake>\r\n"
                f"WARC-Payload-Digest: sha256:{'0' * 64}\r\nContent-Length: {len(body)}\r\n\r\n{body}\r\n\r\n")
    return out


def rows():
    rng = random.Random(5)
    long = "".join(rng.choice("abc <>\n") for _ in range(3000))
    out = [(5, "http://a/ä b\r\nX: y", long), (3, "u", long), (9, None, long), (None, "u", long),
           (3, "u", long), (7, "u", None), (8, "u", ""), (10, "u", "x" * 99), (11, "u", "x" * 99),
           (12, "u", "x" * 100), (13, "u", "x" * 100), (14, "u", "é" * 50), (15, "u", "é" * 50),
           (16, "u", archived(["one", "two" * 900, archived(["in"])])),
           (17, "u", "WARC/1.1\r\n" * 300), (18, "u", archived(["cut"])[:-9]), (None, None, None),
           (19, "u", "a\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n"), (20, "u", "y" * 70000)]
    for i in range(100, 160):
        out.append((i, f"u{i}", archived([str(i)] * rng.randint(0, 20)) + "z" * rng.randint(0, 400)))
    return out


def by_hand(pages):
    first = {}
    for i, _, html in pages:
        body = html or ""
        if len(body.encode()) >= 100:
            known = first.setdefault(body, [])
            known.append((i is None, i or 0))
    out = []
    taken = set()
    for i, _, html in sorted(pages, key=lambda p: (p[0] is None, p[0] or 0)):
        body = html or ""
        raw = body.encode()
        again = len(raw) >= 100 and body in taken
        taken.add(body)
        low = min(first[body]) if again else None
        out.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response",
                    (None if low[0] else low[1]) if again else None))
    return sorted(map(str, out))


@pytest.mark.parametrize("file_bytes, block", [(256 << 20, 4 << 20), (5000, 700), (1, 4096), (40000, 64)])
def test_round_trip(spark, monkeypatch, file_bytes, block):
    monkeypatch.setattr(warc, "FILE_BYTES", file_bytes)
    monkeypatch.setattr(warc, "BLOCK_BYTES", block)
    monkeypatch.setattr(warc, "MOST_TASKS", 8)
    pages = spark.createDataFrame(rows(), PAGES).repartition(3)
    for name in ("file", "row", "digest", "payload", "maybe", "large", "id", "one", "at", "bytes"):
        pages = pages.withColumn(name, F.lit("x"))
    files = warc.write_archives(pages)
    got = warc.read_archives(files).select(
        F.col("page_id").cast("long"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast("long")).collect()
    assert sorted(map(str, map(tuple, got))) == by_hand(rows())
    assert files.agg(F.sum("records")).first()[0] == len(rows())
    held = {bytes(r.payload).decode() for r in warc.read_records(files, payloads=True).filter(
        "record_type = 'response'").collect()}
    assert held == {h or "" for _, _, h in rows()}


def test_every_place_is_a_candidate_and_few_are_records(spark, monkeypatch):
    pages = spark.createDataFrame([(1, "u", archived(["a", "b"])), (2, "u", "plain")], PAGES).coalesce(1)
    files = warc.write_archives(pages)
    assert warc.candidates(files).count() == 4
    assert warc.read_records(files).count() == 2


def test_chains_inside_a_block():
    at, following = [0, 10, 12, 30, 50], [30, 20, 30, 50, 120]
    assert warc.chained(at, following, 100) == [120, -1, 120, 120, 120]
    assert warc.chained(at, following, 50) == [50, -1, 50, 50, 120]


@pytest.mark.parametrize("harm", ["tail", "head", "length", "payload"])
def test_damaged_files_raise(spark, monkeypatch, harm):
    monkeypatch.setattr(warc, "MOST_TASKS", 4)
    body = "".join(random.Random(1).choice("abcdef") for _ in range(500))
    files = warc.write_archives(spark.createDataFrame(
        [(i, "u", body + str(i)) for i in range(40)], PAGES).coalesce(1))
    row = files.first()
    with store.opened(row.file) as f:
        raw = f.read()
    middle = raw.index(b"WARC/1.1", len(raw) // 2)
    if harm == "tail":
        raw = raw[:-5]
    elif harm == "head":
        raw = raw[:middle] + b"w" + raw[middle + 1:]
    elif harm == "length":
        raw = raw[:middle] + re.sub(rb"(Content-Length: )\d", rb"\g<1>9", raw[middle:], count=1)
    else:
        at = raw.index(body[:40].encode(), middle)
        raw = raw[:at] + b"zz" + raw[at + 2:]
    uri, out = store.create(row.file.rpartition("/")[0], "harmed")
    out.write(raw)
    out.close()
    harmed = spark.createDataFrame([(uri, len(raw), 1)], "file string, bytes long, records long")
    with pytest.raises(Exception, match="do not fill|does not have its digest"):
        warc.read_records(harmed, 2048).collect()


def test_no_pages(spark):
    files = warc.write_archives(spark.createDataFrame([], PAGES))
    assert files.count() == 0 and warc.read_archives(files).count() == 0


def test_an_unknown_response_leaves_nulls(spark, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 1)
    body = "b" * 300
    files = warc.write_archives(spark.createDataFrame([(1, "u", body), (2, "u", body)], PAGES))
    kinds = {r.file: r.record_type for r in warc.read_records(files).collect()}
    only = files.filter(F.col("file").isin([f for f, k in kinds.items() if k == "revisit"]))
    rows = warc.read_archives(only).collect()
    assert [(r.page_id, r.record_type, r.payload_bytes, r.refers_to) for r in rows] == [
        ("2", "revisit", None, None)]


def test_query_has_the_contract_columns(spark):
    found = registry.QUERIES["op12_warc"](spark, "/root/testdata/sf0.001")
    assert dict(found.dtypes) == {
        "page_id": "bigint", "payload_bytes": "bigint", "payload_digest": "string",
        "record_type": "string", "refers_to": "bigint"}
