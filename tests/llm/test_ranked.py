"""Ranked search against a direct computation."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cohortline.llm import ranked

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms_of(t):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def by_hand(docs, items, top=10):
    counts = [Counter(terms_of(t)) for _, t in docs]
    sizes = [sum(c.values()) for c in counts]
    n, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for c in counts for t in c)
    out = []
    for item, t in items:
        found = []
        for (doc, _), c, size in zip(docs, counts, sizes):
            score = 0
            for term in set(terms_of(t)) & set(c):
                w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[term] + 1)))
                m = 100 - 90 + (90 * size * n) // total
                score += w * ((1000000000 * c[term]) // (1000 * c[term] + 8 * m))
            if score > 0:
                found.append((-score, doc is None, doc or 0))
        out += [(item, k + 1, None if d[1] else d[2], -d[0]) for k, d in enumerate(sorted(found)[:top])]
    return sorted(map(str, out))


def tables():
    rng = random.Random(9)
    vocab = [f"w{i}" for i in range(200)] + ["ÄÖ", "Straße", "it's", "a-b", "X9", "ΑΒ"]
    weights = [1 / (i + 1) for i in range(len(vocab))]
    docs = [(i, rng.choice([" ", ", ", "\n"]).join(rng.choices(vocab, weights, k=rng.choice(
        [1, 5, 40, 300])))) for i in range(250)]
    docs += [(i, docs[i % 7][1]) for i in range(250, 300)]                      # ties
    docs += [(5, docs[5][1]), (None, docs[6][1]), (None, docs[6][1].upper()), (400, None), (401, ""),
             (402, "!?"), (403, "w3 " * 30000)]
    items = [(i, " ".join(rng.choices(vocab, k=rng.choice([1, 3, 30])))) for i in range(12)]
    items += [(3, "w1 w2"), (3, "w1 w2"), (None, "w1 W2 w1"), (50, None), (51, " ?"), (52, "unheard of")]
    return docs, items


@pytest.mark.parametrize("segment, bundle, rarity", [
    (8 << 20, 256, (256, 16, 4)), (2000, 4, (256, 16, 4)), (20000, 1, (9, 3, 1))])
def test_search(spark, frame, clash, monkeypatch, segment, bundle, rarity):
    monkeypatch.setattr(ranked, "SEGMENT_BYTES", segment)
    monkeypatch.setattr(ranked, "BUNDLE", bundle)
    monkeypatch.setattr(ranked, "RARITY", rarity)
    monkeypatch.setattr(ranked, "_SALTS", 2)
    docs, items = tables()
    asked = spark.createDataFrame(items, "item_id bigint, text string").withColumn("q", F.lit("x"))
    got = ranked.search(clash(frame(docs)), asked).collect()
    assert sorted(map(str, map(tuple, got))) == by_hand(docs, items)


def test_nothing_to_search(spark, frame):
    none = spark.createDataFrame([], "item_id bigint, text string")
    one = spark.createDataFrame([(1, "a")], "item_id bigint, text string")
    assert ranked.search(frame([(1, "a b")]), none).count() == 0
    assert ranked.search(frame([]), one).count() == 0


def test_bits_pass_every_term(spark, monkeypatch):
    monkeypatch.setattr(ranked, "MOST_BITS", 1 << 10)
    terms = np.random.default_rng(1).integers(-2 ** 63, 2 ** 63, 3000)
    bits = ranked.term_bits(spark.createDataFrame([(int(t),) for t in terms], "term long"), 3000)
    assert len(bits) == 32 and ranked._has(bits, terms.view(np.uint64)).all()
    few = ranked.term_bits(spark.createDataFrame([(5,), (1 << 40,)], "term long"), 2)
    assert ranked._has(few, np.array([5, 1 << 40, 1 << 50], np.uint64)).tolist()[:2] == [True, True]


@pytest.mark.parametrize("seed", range(5))
def test_what_is_not_carried_cannot_win(seed):
    """Accumulators with and without pruning give one result, also with ties at the edge."""
    rng = np.random.default_rng(seed)
    wanted = [(q, t, int(rng.integers(1, 4)), t % 3) for q in range(4) for t in range(9)]
    kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("q", "term", "weight", "owner")]))
    wanted = [dict(zip(("q", "term", "weight", "owner"), w)) for w in wanted]
    n = 60
    packed = []
    for k in range(3):
        docs = [np.sort(rng.choice(n, rng.integers(1, n), replace=False)) for _ in range(3)]
        first = np.cumsum([0] + [len(d) for d in docs])
        packed.append(ranked.store.dump(
            np.array([k, k + 3, k + 6], np.uint64), first, np.concatenate(docs),
            rng.choice([200_000, ranked.MOST_IMPACT], first[-1]).astype(np.int32)))

    def table(carried):
        return pa.table([pa.array([n]), pa.array([wanted], kind), pa.array([carried], pa.binary())],
                        ["n_docs", "wanted", "carried"])

    whole, carried, sizes = ranked.Carried(table(None)), None, []
    for k in range(3):
        whole.add(k, packed[k])
        step = ranked.Carried(table(carried))
        step.add(k, packed[k])
        carried = step.carried(k, 5)
        sizes.append(((whole.scores > 0).sum(), (ranked.Carried(table(carried)).scores > 0).sum()))
    assert all(np.array_equal(a, b) for a, b in zip(whole.best(5), step.best(5)))
    assert sizes[-1][1] < sizes[-1][0]
