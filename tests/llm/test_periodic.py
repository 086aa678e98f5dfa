"""Periodic runs against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from cohortline.llm import periodic, registry

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def runs_by_hand(words):
    """(start, length, period) of all runs, by definition."""
    n, out = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            root = words[i:i + q]
            if length >= max(12, 2 * q) and not any(
                    q % d == 0 and root == root[:d] * (q // d) for d in range(1, q)):
                out.append((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed_by_hand(words, runs):
    return " ".join(w for i, w in enumerate(words)
                    if not any(s + q <= i < s + length for s, length, q in runs))


def thue_morse(n):
    return ["ab"[bin(i).count("1") & 1] for i in range(n)]


def fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return list(b[:n])


def texts():
    rng = random.Random(4)
    out = [None, "", " \n\t", "one", "x " * 11, "x " * 12, "x " * 700, "ab " * 5 + "c", "é ü " * 9,
           " ".join(thue_morse(600)), " ".join(fibonacci(500)),
           " ".join(["p"] * 20 + ["q"] * 20) * 1, ("a b c " * 5 + "d ") * 8]
    for k in range(30):
        letters = "abcdefgh"[:rng.choice([1, 2, 2, 3, 8])]
        words = [rng.choice(letters) for _ in range(rng.randint(5, 300))]
        for _ in range(rng.randint(0, 3)):
            at, q = rng.randrange(len(words)), rng.randint(1, 60)
            words[at:at] = (words[at:at + q] or ["z"]) * rng.randint(2, 6)
        out.append(rng.choice([" ", "  ", "\n"]).join(words))
    return out


def test_blocks_fit_every_shortest_stretch():
    for octave in range(10):
        b = periodic.block(octave)
        for q in range(1 << octave, 2 << octave):
            assert 2 * b - 1 <= max(q, 12 - q)


@pytest.mark.parametrize("q, want", [(1, ()), (2, (1,)), (12, (6, 4)), (30, (15, 10, 6)), (49, (7,)),
                                     (97, (1,))])
def test_shorter_periods(q, want):
    assert periodic.shorter_periods(q) == want


def check(found, rows):
    found = {r.doc_id: r for r in found.collect()}
    assert len(found) == len(rows)
    for i, t in rows:
        words = WORD.findall(t or "")
        want = runs_by_hand(words)
        row = found[i]
        assert row.n_words == len(words)
        assert [tuple(r) for r in row.runs] == want, i
        assert row.kept_text == collapsed_by_hand(words, want), i


@pytest.mark.parametrize("tile, spread", [(4096, 1 << 24), (64, 1 << 24), (64, 40), (16, 200)])
def test_runs(frame, clash, monkeypatch, tile, spread):
    monkeypatch.setattr(periodic, "TILE_WORDS", tile)
    monkeypatch.setattr(periodic, "SPREAD_BYTES", spread)
    rows = list(enumerate(texts()))
    check(periodic.collapse_runs(clash(frame(rows))), rows)


@pytest.mark.parametrize("tile", [16, 64])
def test_fragments_of_many_tiles_in_place(monkeypatch, tile):
    monkeypatch.setattr(periodic, "TILE_WORDS", tile)
    for octave in range(4):
        tiles = periodic.Tiles.of(np.array([0, 5, 700, 700, 731]), octave)
        assert (tiles.low[1:] < tiles.core[1:]).any() and (tiles.high > tiles.core_end).any()
        cores = [(a, b) for a, b, d in zip(tiles.core, tiles.core_end, tiles.document) if d == 1]
        assert cores[0][0] == 5 and cores[-1][1] == 700
        assert all(a[1] == b[0] for a, b in zip(cores, cores[1:]))


def test_stitching_keeps_touching_runs_apart(spark):
    rows = [(1, 5, 0, 20), (1, 5, 12, 40), (1, 5, 37, 60), (1, 6, 12, 40), (2, 5, 0, 20), (2, 5, 0, 20)]
    found = spark.createDataFrame(rows, "row long, period long, start long, stop long")
    got = {r.row: [tuple(x) for x in r.runs] for r in periodic.stitch(found).collect()}
    assert got == {1: [(0, 40, 5), (12, 28, 6), (37, 23, 5)], 2: [(0, 20, 5)]}


def test_no_rows_and_rows_without_id(frame):
    assert periodic.collapse_runs(frame([])).count() == 0
    found = periodic.collapse_runs(frame([(None, "x " * 20), (None, "x " * 20), (3, None), (3, None)]))
    assert sorted((str(r.doc_id), len(r.runs), r.kept_text) for r in found.collect()) == [
        ("3", 0, ""), ("3", 0, ""), ("None", 1, "x"), ("None", 1, "x")]


def query_by_hand(rows):
    out = []
    for i, t in rows:
        words = WORD.findall(t or "")
        n, h = len(words), zlib.crc32(str(i).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
        runs = runs_by_hand(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        out.append((i, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
                    hashlib.sha256("".join(f"{s},{x},{q}\n" for s, x, q in runs).encode()).hexdigest(),
                    hashlib.sha256(collapsed_by_hand(words, runs).encode()).hexdigest()))
    return out


def test_query(spark, folder, frame):
    rng = random.Random(2)
    rows = list(enumerate(texts()))
    for i in range(100, 260):
        rows.append((i, " ".join(f"w{rng.randrange(400)}" for _ in range(rng.randint(0, 200)))))
    planted = [i for i, t in rows if t and t.strip() and zlib.crc32(str(i).encode()) % 10 == 0]
    assert len(planted) > 9
    got = registry.QUERIES["op11_period_runs"](spark, folder(documents=frame(rows))).select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
        "collapsed_sha256").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, query_by_hand(rows)))
