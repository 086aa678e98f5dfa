"""Exact, near and substring dedup against brute force."""

import hashlib
import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from cohortline.llm import bloom, components, exact, registry, simhash, substring, text

SPACE = re.compile(r"[\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")

TRICKY = [
    (1, "a b  c"), (2, "a b\tc"), (3, "a b c "), (4, "a b c"), (5, None), (6, ""), (7, " \n"),
    (8, "é" * 5000), (9, "a b"), (10, "a b"), (None, "a b c"), (None, None), (4, "a b c"),
    (11, "only here"), (12, "x " * 20000),
]


def lowered(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s or "")


# ---- exact dedup ---------------------------------------------------------------------------

def exact_by_hand(rows):
    plain = [SPACE.sub(" ", t or "") for _, t in rows]
    out = []
    for (i, _), t in zip(rows, plain):
        ids = [j for (j, _), u in zip(rows, plain) if u == t]
        known = [j for j in ids if j is not None]
        out.append((i, min(known) if known else None, len(ids),
                    hashlib.sha256(t.encode()).hexdigest()))
    return out


def test_exact_marks(frame, clash):
    found = exact.mark_duplicates(clash(frame(TRICKY))).collect()
    assert sorted(map(str, ((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found))) \
        == sorted(map(str, exact_by_hand(TRICKY)))
    for sha in {r.text_sha256 for r in found}:
        kept = [r for r in found if r.text_sha256 == sha and r.kept]
        assert len(kept) == 1 and kept[0].doc_id == kept[0].keep_id


def test_exact_dedup_keeps_whole_rows(frame, clash):
    docs = clash(frame(TRICKY))
    kept = exact.exact_dedup(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert sorted(SPACE.sub(" ", r.text or "") for r in rows) == sorted(
        {SPACE.sub(" ", t or "") for _, t in TRICKY})
    assert {r.doc_id for r in rows} == {1, 3, 5, 7, 8, 9, 10, 11, 12}


def test_exact_empty(frame):
    assert exact.mark_duplicates(frame([])).count() == 0
    assert exact.exact_dedup(frame([])).count() == 0


def test_filter_never_misses_a_repeat(spark):
    rows = [(f"t{i % 700}",) for i in range(1000)]
    keys = spark.createDataFrame(rows, "key string")
    words = bloom.repeated(keys, "key", 10)
    from pyspark.sql import functions as F
    flags = {r.key: r.maybe for r in bloom.flagged(keys, F.col("key"), words, 10, "maybe").collect()}
    assert all(flags[f"t{i}"] for i in range(300))


def test_a_full_filter_changes_no_result(frame, monkeypatch):
    monkeypatch.setattr(bloom, "MOST_CELLS", 2)
    monkeypatch.setattr(bloom, "cell_bits", lambda rows: 6)
    found = exact.mark_duplicates(frame(TRICKY)).collect()
    assert sorted(map(str, ((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found))) \
        == sorted(map(str, exact_by_hand(TRICKY)))


# ---- SimHash -------------------------------------------------------------------------------

def print_by_hand(s):
    words = WORD.findall(lowered(s))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_by_hand(prints):
    """Component of each value: the smallest index reachable."""
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i, j in itertools.combinations(range(len(prints)), 2):
        if bin(prints[i] ^ prints[j]).count("1") <= 2:
            a, b = sorted((root(i), root(j)))
            parent[b] = a
    return [root(i) for i in range(len(prints))]


def test_fingerprints():
    rng = random.Random(1)
    texts = [t for _, t in TRICKY] + ["One TWO three", "one two", " ".join(
        rng.choice("abcdefg") * rng.randint(1, 4) for _ in range(700))]
    assert simhash.simhash(pa.array(texts, pa.string())).tolist() == [print_by_hand(t) for t in texts]


@pytest.mark.parametrize("few", [1, 512])
def test_components_of_close_fingerprints(spark, monkeypatch, few):
    monkeypatch.setattr(simhash, "_FEW", few)
    rng = random.Random(few)
    prints = set()
    for _ in range(25):
        at = rng.getrandbits(64)
        for _ in range(rng.randint(1, 12)):
            prints.add(at)
            for b in rng.sample(range(64), rng.randint(1, 3)):
                at ^= 1 << b
    base = rng.getrandbits(64)
    prints |= {base ^ (1 << a) ^ (1 << b) for a, b in itertools.combinations(range(40), 2)}
    prints = sorted(prints)
    key, who = [], []
    for batch in (simhash._entries(np.array(prints, np.uint64), 4),):
        for p in batch.column("payload").to_pylist():
            from cohortline.llm.buckets import unpack
            k, w = unpack(p, "u8", "u8")
            key.append(k)
            who.append(w)
    a, b = simhash._links(np.concatenate(key), np.concatenate(who))
    place = {p: i for i, p in enumerate(prints)}
    links = spark.createDataFrame(
        [(max(place[x], place[y]), min(place[x], place[y])) for x, y in zip(a.tolist(), b.tolist())],
        "u bigint, v bigint")
    roots = {r.node: r.root for r in components.components(links).collect()}
    assert [roots.get(i, i) for i in range(len(prints))] == groups_by_hand(prints)


def test_crowded_segments_lose_no_link(spark, monkeypatch):
    """Most fingerprints share a segment, low or high; more buckets than pieces of one key."""
    monkeypatch.setattr(simhash, "CROWDED", 40)
    rng = random.Random(9)
    low, high = rng.getrandbits(32), rng.getrandbits(32)
    prints = set()
    for shared in (lambda x: x << 32 | low, lambda x: high << 32 | x):
        for _ in range(60):
            at = shared(rng.getrandbits(32))
            prints |= {at, at ^ 1 << rng.randrange(64), at ^ 1 << rng.randrange(32) ^ 1 << 32,
                       at ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64)}
    prints = sorted(prints)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    df = spark.createDataFrame(signed, "fingerprint bigint")
    crowded = simhash._crowded(df, len(prints))
    assert {low, high | 1 << 32} <= set(crowded.tolist())
    monkeypatch.setattr(simhash.buckets, "bucket_count", lambda *_: 500)
    roots = {r.fingerprint % (1 << 64): r.root for r in simhash.near_groups(df).collect()}
    groups = groups_by_hand(prints)
    found = [roots.get(p, p) for p in prints]
    assert len(set(found)) == len(set(groups)) == len(set(zip(found, groups)))


def test_components_of_a_long_chain(spark):
    n = 200
    order = list(range(n))
    random.Random(3).shuffle(order)
    links = spark.createDataFrame(
        [(max(a, b), min(a, b)) for a, b in zip(order, order[1:])] + [(1001, 1000), (1001, 1000)],
        "u bigint, v bigint")
    roots = {r.node: r.root for r in components.components(links).collect()}
    assert roots == {i: 0 for i in range(n)} | {1000: 1000, 1001: 1000}


def near_copies():
    rng = random.Random(5)
    vocab = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(400)]
    rows = []
    for i in range(60):
        words = [rng.choice(vocab) for _ in range(rng.choice([0, 1, 2, 3, 50, 900]))]
        rows.append((len(rows) * 3 + 7, " ".join(words)))
        for _ in range(i % 3):
            copy = list(words)
            if copy:
                copy[rng.randrange(len(copy))] = rng.choice(vocab)
            rows.append((len(rows) * 3 + 7, " ".join(copy)))
    rng.shuffle(rows)
    return rows + [(1, None), (2, "  ")]


def test_near_duplicates(frame, clash):
    rows = near_copies()
    docs = clash(frame(rows))
    found = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    rows = sorted(rows)
    prints = [print_by_hand(t) for _, t in rows]
    want = groups_by_hand(prints)
    assert {i: (r.fingerprint % (1 << 64), r.component_id) for i, r in found.items()} == {
        rows[k][0]: (prints[k], rows[want[k]][0]) for k in range(len(rows))}
    kept = simhash.near_dedup(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {rows[k][0] for k in set(want)}


def test_near_duplicates_without_id(frame):
    found = simhash.near_dedup(frame([(None, "a b c d"), (3, "a b c d"), (None, "q r s t")]))
    assert sorted(map(str, (r.doc_id for r in found.collect()))) == ["3", "None"]


def test_one_document_of_a_group_stays_without_ids_or_with_equal_ones(frame):
    long = " ".join(f"w{i}" for i in range(400))
    assert simhash.near_dedup(frame(
        [(None, long), (None, long.upper()), (None, long.title())])).count() == 1
    kept = simhash.near_dedup(frame([(5, long), (5, long.upper()), (6, long), (None, long)]))
    assert [r.doc_id for r in kept.collect()] == [5]


def test_near_duplicates_empty(frame):
    assert simhash.near_duplicates(frame([])).count() == 0
    assert simhash.near_dedup(frame([])).count() == 0


def test_registered_fingerprint_is_hex(spark, folder, frame):
    rows = registry.op5_simhash(spark, folder(documents=frame([(1, ""), (2, "x y z")]))).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in rows} == {
        (1, "0" * 16, 1), (2, f"{print_by_hand('x y z'):016x}", 2)}


# ---- substring dedup -----------------------------------------------------------------------

def cut_by_hand(rows, window):
    words = [WORD.findall(t or "") for _, t in rows]
    seen = {}
    for d, w in enumerate(words):
        for i in range(len(w) - window + 1):
            seen.setdefault(tuple(w[i:i + window]), []).append((d, i))
    gone = {(d, i + k) for at in seen.values() if len(at) > 1 for d, i in at for k in range(window)}
    out = []
    for d, w in enumerate(words):
        kept = [x for k, x in enumerate(w) if (d, k) not in gone]
        out.append((rows[d][0], len(w), len(w) - len(kept), " ".join(kept)))
    return out


def repeated_passages(window):
    rng = random.Random(window)
    vocab = [f"w{i}" for i in range(50)] + ["Ünï", "W1"]
    word = lambda n: [rng.choice(vocab) for _ in range(n)]
    passages = [word(n) for n in (window - 1, window, window + 1, 2 * window, 3 * window + 5)]
    rows = []
    for i in range(80):
        body = []
        for _ in range(rng.randint(0, 4)):
            body += word(rng.randint(0, 30)) + (rng.choice(passages) if rng.random() < 0.5 else [])
        rows.append((i, rng.choice([" ", "\n", "\t "]).join(body)))
    rows += [(100, "same " * (3 * window)), (101, None), (102, ""), (103, " ".join(word(5000)))]
    rows += [rows[5], (None, rows[6][1]), (None, rows[7][1]), (5, "other text of the same id")]
    return rows


@pytest.mark.parametrize("window", [35, 4, 7])
def test_substring(frame, clash, window):
    rows = repeated_passages(window)
    found = substring.remove_repeats(clash(frame(rows, 5)), window).collect()
    assert sorted(map(str, ((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in found))) \
        == sorted(map(str, cut_by_hand(rows, window)))


def test_substring_over_many_parts(frame, monkeypatch):
    rows = repeated_passages(35)
    monkeypatch.setattr(substring, "_PART", 600)
    found = substring.remove_repeats(frame(rows, 2)).collect()
    assert sorted(map(str, ((r.doc_id, r.n_removed) for r in found))) == sorted(
        map(str, ((r[0], r[2]) for r in cut_by_hand(rows, 35))))


def test_a_part_sends_a_hot_window_once(frame):
    """A passage in a third of all rows: its records are bounded by parts, not by copies."""
    rng = random.Random(3)
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(i, f"{passage} u{i}" if i % 3 == 0 else " ".join(
        f"x{rng.random()}" for _ in range(40))) for i in range(300)]
    copies, parts, window = 100, 4, 35
    docs = substring.keyed(frame(rows, parts))
    found = [np.arange(len((t or "").split()) // 18, dtype=np.uint32).tobytes() for _, t in rows]
    near = docs.join(docs.sparkSession.createDataFrame(
        [(i, f) for (i, _), f in zip(rows, found)], "doc_id bigint, found binary"), "doc_id")
    sent = near.repartition(parts).mapInArrow(
        substring._probe_windows(window, 18, 1), substring._ROWS).collect()
    asks = [len(r.payload) // 16 for r in sent if r.kind == substring._ASK]
    told = [len(r.payload) // 12 for r in sent if r.kind == substring._OFTEN]
    # Own windows are asked for once each; the six windows inside the passage once for each part.
    assert 0 < sum(told) <= 6 * parts
    assert sum(asks) <= copies + 200 * 6 + 6 * parts
    cut = substring.remove_repeats(frame(rows, parts)).collect()
    assert {r.n_removed for r in cut if r.doc_id % 3 == 0} == {40}
    assert {r.n_removed for r in cut if r.doc_id % 3} == {0}


def test_substring_spans(frame):
    body = " ".join(f"a{i}" for i in range(60))
    found = {r.doc_id: r for r in substring.remove_repeats(
        frame([(1, "x y " + body), (2, body + " z")])).collect()}
    assert np.frombuffer(found[1].repeats, np.int64).tolist() == [2, 62]
    assert np.frombuffer(found[2].repeats, np.int64).tolist() == [0, 60]


def test_substring_empty(frame):
    assert substring.remove_repeats(frame([])).count() == 0


# ---- words and hashes ----------------------------------------------------------------------

def test_words_follow_the_pattern():
    texts = ["a b", None, "", " x", "y ", "z\x0b\x0cé q", "end", "begin"]
    words = text.Words(pa.array(texts, pa.string()))
    got = [bytes(words.data[a:b]).decode() for a, b in zip(words.start, words.end)]
    assert got == [w for t in texts for w in WORD.findall(t or "")]
    assert words.counts.tolist() == [len(WORD.findall(t or "")) for t in texts]
    joined, begin, stop = words.joined()
    assert [joined[a:b].decode() for a, b in zip(begin, stop)] == got


def test_hashes_do_not_depend_on_place(monkeypatch):
    monkeypatch.setattr(text, "_SEGMENT", 64)
    rng = random.Random(2)
    body = [rng.choice(["aa", "b", "cc" * 40, "d" * 300]) for _ in range(300)]
    words = text.Words(pa.array([" ".join(body)], pa.string()))
    by_word = {}
    for w, h in zip(body, words.hashes().tolist()):
        assert by_word.setdefault(w, h) == h
    assert len(set(by_word.values())) == len(by_word)
    runs = {}
    start = words.window_starts(3)
    for i, h in zip(start.tolist(), text.run_hashes(words.hashes(), start, 3).tolist()):
        assert runs.setdefault(tuple(body[i:i + 3]), h) == h
    assert len(set(runs.values())) == len(runs)


def test_parts_cover_a_batch_once():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * n for n in (5, 0, 100, 3, 3, 3)] + [None]})
    sizes = [p.num_rows for p in text.parts(batch, size=10)]
    assert sum(sizes) == 7 and sizes == [2, 1, 4]
