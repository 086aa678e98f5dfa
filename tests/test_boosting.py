"""Boosted trees against a plain grower that splits one node at a time."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortline.operators import boosting
from cohortline.operators.boosting import SCALE, Ensemble, Forest, Growing, Node, Setting

NAMES = ["a", "b", "c"]


def rows(n=240, seed=3):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        a, b, c = rng.randint(0, 9), round(rng.gauss(0, 1), 3), float(rng.random() < 0.3)
        y = int(rng.random() < 1 / (1 + math.exp(-(a - 4.5) * (1 if c else 0.2) - b)))
        out.append((i, y, i % 3, float(a), b, c))
    return out


@pytest.fixture(scope="module")
def train(spark):
    return spark.createDataFrame(
        rows(), "customer_id long, y int, fold int, a double, b double, c double").repartition(3)


def worth(g, h, s):
    t = math.copysign(max(abs(g) - s.l1, 0), g)
    return t * t / (h + s.l2)


def one_split(x, g, h, members, cuts, columns, s):
    """(gain, column, cut value) by trying every cut."""
    best = None
    total = worth(g[members].sum() / SCALE, h[members].sum() / SCALE, s)
    for c in columns:
        for cut in cuts[c]:
            left = members[x[members, c] <= cut]
            right = members[x[members, c] > cut]
            if min(len(left), len(right)) < max(1, s.min_rows):
                continue
            sums = [(g[m].sum() / SCALE, h[m].sum() / SCALE) for m in (left, right)]
            if min(sums[0][1], sums[1][1]) < s.min_curvature:
                continue
            gain = worth(*sums[0], s) + worth(*sums[1], s) - total
            if gain > 1e-9 and (best is None or gain > best[0]):
                best = (gain, c, cut)
    return best


def grown_by_hand(x, y, keys, seen, cuts, s, number, seed):
    """Log-odds of all rows and the leaves of every tree."""
    share = y[seen].mean()
    margin = np.full(len(y), math.log(share / (1 - share)))
    leaves = []
    for t in range(s.trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = np.rint((p - y) * SCALE).astype(np.int64), np.rint(p * (1 - p) * SCALE).astype(np.int64)
        used = seen
        if s.row_share < 1:
            used = seen[boosting.drawn_rows(keys[seen], s.row_share, boosting._salt(seed, number, t))]
        columns = boosting.drawn_columns(s, number, seed, t, x.shape[1])
        nodes = {1: (used, np.arange(len(y)), 0)}
        found = {1: one_split(x, g, h, used, cuts, columns, s)}
        while True:
            can = [p for p in nodes if found[p] and (s.depth is None or nodes[p][2] < s.depth)]
            if not can or (s.leaves and len(nodes) == s.leaves):
                break
            path = min(can, key=lambda p: (-found[p][0], p))
            members, all_rows, depth = nodes.pop(path)
            _, c, cut = found.pop(path)
            for child, side in ((2 * path, lambda m: m[x[m, c] <= cut]), (2 * path + 1, lambda m: m[x[m, c] > cut])):
                nodes[child] = (side(members), side(all_rows), depth + 1)
                found[child] = one_split(x, g, h, nodes[child][0], cuts, columns, s)
        for members, all_rows, _ in nodes.values():
            a, b = g[members].sum() / SCALE, h[members].sum() / SCALE
            margin[all_rows] -= s.learning_rate * math.copysign(max(abs(a) - s.l1, 0), a) / (b + s.l2)
        leaves.append(len(nodes))
    return margin, leaves


SETTINGS = [
    Setting(trees=3, depth=3, learning_rate=0.3, l1=0.2, l2=0.7, min_curvature=2.0),
    Setting(trees=3, leaves=7, learning_rate=0.3, l1=0.0, l2=1.0, min_rows=15),
    Setting(trees=2, leaves=9, depth=4, row_share=0.6, column_share=0.6, l2=2.0),
    Setting(trees=2, depth=2, l1=1e9),
]


@pytest.fixture(scope="module")
def fitted(train):
    jobs = [(s, k) for s in SETTINGS for k in (-1, 0, 1, 2)]
    return boosting.fit_many(train, NAMES, jobs, 11, bins=16), jobs


def by_hand(spark, fitted):
    plain = rows()
    x = np.array([r[3:] for r in plain])
    y = np.array([r[1] for r in plain])
    fold = np.array([r[2] for r in plain])
    keys = {r.customer_id: r.k for r in spark.createDataFrame(
        [(r[0],) for r in plain], "customer_id long").select(
        "customer_id", F.xxhash64("customer_id").alias("k")).collect()}
    keys = np.array([keys[r[0]] for r in plain], np.int64).view(np.uint64)
    cuts = fitted[0].models[0].edges
    return [grown_by_hand(x, y, keys, np.flatnonzero(fold != k), cuts, s, SETTINGS.index(s), 11)
            for s, k in fitted[1]], x, fold


def test_trees_equal_single_splits(spark, train, fitted):
    want, x, fold = by_hand(spark, fitted)
    for (margin, leaves), model, (s, k) in zip(want, fitted[0].models, fitted[1]):
        bins = boosting.binned(list(x.T), model.edges, len(x))
        assert model.start + Forest(model.trees).added(bins) == pytest.approx(margin, abs=1e-9)
        assert [(t["column"] < 0).sum() for t in model.trees] == leaves
    assert {len(t["column"]) for m in fitted[0].models[-4:] for t in m.trees} == {1}


def test_held_out_scores_are_of_the_model_that_did_not_see_the_row(spark, fitted):
    want, x, fold = by_hand(spark, fitted)
    got = {(r.setting, r.customer_id): r for r in fitted[0].held_out().collect()}
    assert len(got) == len(SETTINGS) * len(x)
    for (margin, _), (s, k) in zip(want, fitted[1]):
        for i in np.flatnonzero(fold == k):
            row = got[SETTINGS.index(s), i]
            assert row.fold == k and row.score == pytest.approx(1 / (1 + math.exp(-margin[i])))


def test_bounds_are_obeyed(fitted):
    for model, (s, k) in zip(*[fitted[0].models, fitted[1]]):
        for t in model.trees:
            leaves = t["column"] < 0
            assert s.leaves is None or leaves.sum() <= s.leaves
            assert (t["rows"][leaves] >= s.min_rows).all()


def test_trees_do_not_depend_on_how_rows_are_dealt(train, fitted, monkeypatch):
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 50)
    monkeypatch.setattr(boosting, "STORE_EVERY", 1)
    monkeypatch.setattr(boosting, "PASS_BYTES", 1)
    again = boosting.fit_many(train.repartition(7), NAMES, fitted[1][:2], 11, bins=16)
    for a, b in zip(again.models, fitted[0].models):
        assert a.start == b.start and all(
            np.array_equal(s[k], t[k]) for s, t in zip(a.trees, b.trees) for k in s)


def test_saved_trees_score_the_same(spark, train, fitted, tmp_path):
    for m in (0, 4, 12):
        model = fitted[0].models[m]
        model.save(spark, str(tmp_path / f"m{m}"))
        again = Ensemble.load(spark, str(tmp_path / f"m{m}"))
        one = {r.customer_id: r.score for r in model.scores(train, "customer_id").collect()}
        assert one == {r.customer_id: r.score for r in again.scores(train, "customer_id").collect()}


@pytest.mark.parametrize("change, column", [
    ({"l1": 3.0}, "value"), ({"l2": 50.0}, "value"), ({"min_curvature": 20.0}, "rows"),
    ({"depth": 1}, "rows"), ({"learning_rate": 0.01}, "value"), ({"column_share": 0.3}, "column"),
    ({"row_share": 0.6}, "rows"), ({"trees": 2}, "trees")])
def test_every_parameter_changes_the_model(train, change, column):
    base = Setting(trees=1, depth=2, learning_rate=0.3)
    plain, other = boosting.fit_many(
        train, NAMES, [(base, -1), (Setting(**{**base.__dict__, **change}), -1)], 5).models
    if column == "trees":
        assert (len(plain.trees), len(other.trees)) == (1, 2)
    else:
        assert not np.array_equal(plain.trees[0][column], other.trees[0][column])


def test_the_choice_waits_for_known_gains():
    """A leaf that was split early is dropped when a later leaf has the larger gain."""
    tree = Growing(Setting(leaves=3), np.arange(1), [Node(0, 0.0, 9.0, 90)])
    tree.nodes[0].best = (5.0, 0, 1, 1.0, 4.0, 40)
    assert tree.open() == [1, 2]
    tree.nodes[1].best, tree.nodes[2].best = (2.0, 0, 0, 0.0, 2.0, 20), (1.0, 0, 3, 0.0, 2.0, 20)
    assert tree.open() == [3, 4] and tree.splits() == [0, 1]
    tree.setting = Setting(leaves=4)
    tree.nodes[3].best = (3.0, 0, 0, 0.0, 1.0, 10)
    assert tree.splits() == [0, 1, 3]
    assert tree.open() == [5, 6]
    final = tree.arrays(final=True)
    assert (final["column"] < 0).sum() == 4 and len(final["column"]) == 7


def test_one_class_no_rows_and_missing_values(spark):
    kind = "customer_id long, y int, a double"
    s = [(Setting(trees=2, depth=2), -1)]
    one = boosting.fit_many(spark.createDataFrame([(i, 1, float(i)) for i in range(9)], kind), ["a"], s, 1)
    assert all(0.99 < r.score <= 1 for r in one.models[0].scores(
        spark.createDataFrame([(1, 1, 5.0)], kind), "customer_id").collect())
    none = boosting.fit_many(spark.createDataFrame([], kind), ["a"], s, 1)
    assert none.models[0].start == 0.0 and none.held_out().count() == 0
    gaps = [(i, int(i > 5), None if i > 5 else float(i)) for i in range(12)]
    model = boosting.fit_many(spark.createDataFrame(gaps, kind), ["a"], s, 1).models[0]
    high = {r.customer_id: r.score > 0.5 for r in model.scores(
        spark.createDataFrame(gaps, kind), "customer_id").collect()}
    assert high == {i: i > 5 for i in range(12)}


def test_leaves_are_those_that_rows_walk_to(fitted):
    """Whole-column comparisons against a walk from the root, for trees of both kinds and a subset of rows."""
    draw = np.random.default_rng(3)
    for model in (fitted[0].models[0], fitted[0].models[4]):
        forest = Forest(model.trees)
        bins = draw.integers(0, 16, (200, len(model.columns))).astype(np.uint8)
        for root in forest.roots:
            want = []
            for row in bins:
                node = root
                while forest.column[node] >= 0:
                    left = row[forest.column[node]] <= forest.cut[node]
                    node = (forest.left if left else forest.right)[node]
                want.append(node)
            ids = np.arange(len(forest.column))
            assert forest.spread(bins, root, ids).tolist() == want
            assert forest.spread(bins[50:], root, ids).tolist() == want[50:]


def test_every_core_gets_an_equal_share(spark, train, monkeypatch):
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 20)
    cores, rows = spark.sparkContext.defaultParallelism, train.count()
    assert rows > 20 * cores
    for most, each in ((1 << 16, 1), (-(-rows // (3 * cores)), 3)):
        monkeypatch.setattr(boosting, "MOST_ROWS", most)
        *_, state, groups, tasks = boosting.prepare(train, NAMES, [(Setting(depth=1), -1)] * 3, 16)
        assert (tasks, groups) == (each * cores, 1)
        blocks = [boosting.Block.unpacked(r.packed) for r in state.collect()]
        assert sum(len(b.keys) for b in blocks) == rows
