"""Second-order boosted trees over binned columns, many models in one pass.

A model is a setting and the fold it does not see. All models of a call grow together: a pass reads the
binned rows once and adds up, for every model and every open node, the gradients and curvatures of each
(column, bin) inside its tasks; one shuffle by (model, node) completes the histograms, and the task that
holds one picks its best split. The driver sees one row for each node and holds the trees.

A tree grows level by level down to ``depth``, or the leaf with the largest gain first up to ``leaves``. Leaf
by leaf would be one pass for each split. Instead every leaf that would be split, as far as gains are known,
is split in the same pass, which is repeated until the choice rests on known gains only. What was split in
vain is dropped, so the tree is the one that single splits give.

With G and H the sums of gradients and curvatures and T(G) = sign(G) max(|G| - l1, 0), a node is worth
T(G)^2 / (H + l2), a split gains what its two sides are worth beyond their parent, and a leaf adds
-learning_rate T(G) / (H + l2) to the log-odds. Gradients are whole multiples of 2^-30, so their sums do not
depend on the order of addition and trees do not depend on how rows are dealt.

Bin edges are nearest-rank quantiles from a mergeable sketch, exact below ``ACCURACY`` rows. Missing values
lie behind all others. Rows and columns of a tree are drawn by hashes of seed, setting and tree.
"""

from __future__ import annotations

import heapq
import math
import random
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline.session import stage

BINS = 64
ACCURACY = 20_000
#: A smaller gain is none.
LEAST_GAIN = 1e-9
SCALE = 1 << 30
#: Trees between two stored states; what was grown since is applied again in each pass.
STORE_EVERY = 4
#: Nodes whose histograms complete in one call, while few tasks add to each.
NODES_TOGETHER = 32
#: Rows that are worth a task, and the most rows of a block.
BLOCK_ROWS = 16_384
MOST_ROWS = 65_536
#: Histogram bytes of one pass; more nodes than that make take several passes.
PASS_BYTES = 128 << 20
_U64 = np.uint64


@dataclass(frozen=True)
class Setting:
    """``depth`` or ``leaves`` says how trees grow; both together bound each other."""

    trees: int = 100
    learning_rate: float = 0.1
    row_share: float = 1.0
    column_share: float = 1.0
    l1: float = 0.0
    l2: float = 1.0
    depth: int | None = None
    leaves: int | None = None
    min_curvature: float = 0.0
    min_rows: int = 1

    def __post_init__(self):
        if self.depth is None and self.leaves is None:
            raise ValueError("a setting needs a depth or a number of leaves")


def soft(gradient, l1):
    return np.sign(gradient) * np.maximum(np.abs(gradient) - l1, 0.0)


def worth(gradient, curvature, setting: Setting):
    return soft(gradient, setting.l1) ** 2 / (curvature + setting.l2)


def leaf_value(gradient: float, curvature: float, setting: Setting) -> float:
    return float(-setting.learning_rate * soft(gradient, setting.l1) / (curvature + setting.l2))


# ---- trees on the driver -------------------------------------------------------------------

@dataclass
class Node:
    depth: int
    gradient: float
    curvature: float
    rows: int
    #: Number in a full binary tree: 1 for the root, 2p and 2p + 1 below p. Smaller ones win ties.
    path: int = 1
    #: (gain, column, bin, gradient, curvature and rows of the left side), once known and if any.
    best: tuple | None = None
    left: int = -1
    right: int = -1


@dataclass
class Growing:
    """One tree while it grows."""

    setting: Setting
    columns: np.ndarray
    nodes: list[Node] = field(default_factory=list)

    def may_split(self, i: int) -> bool:
        node, s = self.nodes[i], self.setting
        return (s.depth is None or node.depth < s.depth) and node.rows >= max(2, 2 * s.min_rows) and (
            node.curvature >= 2 * s.min_curvature)

    def splits(self) -> list[int]:
        """The nodes to split, as far as gains are known, in the order they are split."""
        ready = lambda i: self.nodes[i].best is not None and self.may_split(i)
        if self.setting.leaves is None:
            return [i for i in range(len(self.nodes)) if ready(i)]
        out: list[int] = []
        heap = [(-self.nodes[0].best[0], 1, 0)] if ready(0) else []
        while heap and len(out) < self.setting.leaves - 1:
            i = heapq.heappop(heap)[2]
            out.append(i)
            for child in (self.nodes[i].left, self.nodes[i].right):
                if child >= 0 and ready(child):
                    node = self.nodes[child]
                    heapq.heappush(heap, (-node.best[0], node.path, child))
        return out

    def open(self) -> list[int]:
        """Split what is due; the new nodes whose best split has to be found."""
        out = []
        for i in self.splits():
            node = self.nodes[i]
            if node.left < 0:
                _, _, _, g, h, n = node.best
                node.left, node.right = len(self.nodes), len(self.nodes) + 1
                self.nodes += [
                    Node(node.depth + 1, g, h, n, 2 * node.path),
                    Node(node.depth + 1, node.gradient - g, node.curvature - h, node.rows - n,
                         2 * node.path + 1)]
                out += [j for j in (node.left, node.right) if self.may_split(j)]
        return out

    def arrays(self, final: bool) -> dict[str, np.ndarray]:
        """The tree as arrays; without final every node that has children counts as split."""
        split = set(self.splits()) if final else {
            i for i, node in enumerate(self.nodes) if node.left >= 0}
        keep = [0]
        for i in keep:
            if i in split:
                keep += [self.nodes[i].left, self.nodes[i].right]
        keep = keep if final else list(range(len(self.nodes)))
        place = {i: k for k, i in enumerate(keep)}
        rows = []
        for i in keep:
            node = self.nodes[i]
            gain, column, cut = node.best[:3] if i in split else (0.0, -1, 0)
            left, right = (place[node.left], place[node.right]) if i in split else (-1, -1)
            value = 0.0 if i in split else leaf_value(node.gradient, node.curvature, self.setting)
            rows.append((column, cut, left, right, value, gain, node.rows))
        kinds = {"column": np.int32, "cut": np.int32, "left": np.int32, "right": np.int32,
                 "value": np.float64, "gain": np.float64, "rows": np.int64}
        return {k: np.array(v, t) for (k, t), v in zip(kinds.items(), zip(*rows))}


class Forest:
    """Trees end to end in one set of arrays, each with its root."""

    def __init__(self, trees: Sequence[dict[str, np.ndarray]] = ()):
        sizes = [len(t["column"]) for t in trees]
        self.roots = np.concatenate([[0], np.cumsum(sizes)])[:-1].astype(np.int64)
        whole = {k: np.concatenate([t[k] for t in trees]) if trees else np.zeros(0)
                 for k in ("column", "cut", "left", "right", "value")}
        shift = np.repeat(self.roots, sizes)
        self.column, self.cut, self.value = whole["column"], whole["cut"], whole["value"]
        self.left, self.right = whole["left"] + shift, whole["right"] + shift

    def spread(self, bins: np.ndarray, root: int, entries: np.ndarray) -> np.ndarray:
        """For each row of ``bins`` the entry of the leaf that it ends in.

        A split compares one whole column, which costs less than following every row down.
        """
        leaves: list[int] = []
        number = np.zeros(len(bins), np.uint16 if len(self.column) < 1 << 16 else np.uint32)

        def below(node: int, here: np.ndarray | None) -> int:
            """Number the leaves below a node from left to right; ``here`` marks its rows, None all."""
            if self.column[node] < 0:
                leaves.append(node)
                return 1
            right = bins[:, self.column[node]] > int(self.cut[node])
            if here is not None:
                right &= here
            passed = below(int(self.left[node]), ~right if here is None else here ^ right)
            np.add(number, right * number.dtype.type(passed), out=number)
            return passed + below(int(self.right[node]), right)

        below(int(root), None)
        return entries[leaves][number]

    def added(self, bins: np.ndarray) -> np.ndarray:
        out = np.zeros(len(bins))
        for root in self.roots:
            out += self.spread(bins, root, self.value)
        return out


# ---- bins and blocks -----------------------------------------------------------------------

def bin_edges(train: DataFrame, columns: Sequence[str], bins: int = BINS) -> list[np.ndarray]:
    """Ascending cuts of each column: bin b holds values above cut b - 1 and up to cut b."""
    shares = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    row = train.agg(*[
        F.percentile_approx(F.when(~F.isnan(F.col(f"`{c}`").cast("double")), F.col(f"`{c}`").cast("double")),
                            shares, F.lit(ACCURACY)).alias(f"c{i}") for i, c in enumerate(columns)]).first()
    return [np.unique(np.array(values or [], np.float64)) for values in row]


def binned(values: Sequence[np.ndarray], edges: Sequence[np.ndarray], rows: int) -> np.ndarray:
    """(rows, columns) bin numbers; each column lies together."""
    out = np.empty((len(edges), rows), np.uint8)
    for line, v, e in zip(out, values, edges):
        line[:] = np.searchsorted(e, v, "left")
    return out.T


def _doubles(batch: pa.RecordBatch, names: Sequence[str]) -> list[np.ndarray]:
    return [batch.column(n).cast(pa.float64()).to_numpy(zero_copy_only=False) for n in names]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U64(27))) * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


def _salt(*parts) -> int:
    return random.Random(":".join(map(str, parts))).getrandbits(63)


def drawn_columns(setting: Setting, number: int, seed: int, tree: int, n: int) -> np.ndarray:
    """The columns of a tree, the same in every fold."""
    k = max(1, math.ceil(setting.column_share * n - 1e-9))
    return np.array(sorted(random.Random(f"{seed}:{number}:{tree}:columns").sample(range(n), k)))


def drawn_rows(keys: np.ndarray, share: float, salt: int) -> np.ndarray:
    return (_mix(keys ^ _U64(salt)) >> _U64(11)).astype(np.float64) < share * 2.0 ** 53


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches put together, up to ``MOST_ROWS`` rows."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if held and sum(b.num_rows for b in held) + batch.num_rows > MOST_ROWS:
            yield pa.concat_batches(held)
            held = []
        held.append(batch)
    if held:
        yield pa.concat_batches(held)


def _blocks(train: DataFrame, columns: Sequence[str], edges: list[np.ndarray], starts: np.ndarray,
            rows: int) -> tuple[DataFrame, int, int]:
    """Rows in blocks: ids, hash keys, labels, folds, bins, and the log-odds under a group of models.

    Few rows under many models make a block for each of several groups, so that all cores have work.
    Returns beside the blocks the number of groups, and of tasks that share the rows of a group.
    """
    kind = train.schema["customer_id"].dataType.simpleString()
    names = [f"c{i}" for i in range(len(columns))]
    plain = train.select(
        F.col("customer_id").alias("id"), F.xxhash64("customer_id").alias("key"),
        F.col("y").cast("int").alias("y"), F.col("fold").cast("int").alias("fold"),
        *[F.col(f"`{c}`").alias(n) for c, n in zip(columns, names)])
    tasks = max(1, -(-rows // BLOCK_ROWS))
    cores = train.sparkSession.sparkContext.defaultParallelism
    if tasks >= cores:
        # Equal shares for all cores, a block in each.
        tasks = cores * -(-rows // (cores * MOST_ROWS))
    groups = max(1, min(len(starts), 2 * cores // tasks)) if tasks < cores else 1
    cuts = [len(starts) * g // groups for g in range(groups + 1)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in _joined(batches):
            for at in range(0, whole.num_rows, MOST_ROWS):
                batch = whole.slice(at, MOST_ROWS)
                ids = pa.concat_arrays([batch.column("id")])
                keys, fold = batch.column("key").to_numpy().view(np.uint64), batch.column("fold").to_numpy()
                y = batch.column("y").to_numpy().astype(np.int8)
                bins = binned(_doubles(batch, names), edges, len(ids))
                for low, high in zip(cuts, cuts[1:]):
                    block = Block(low, keys, y, fold, bins, np.repeat(starts[low:high, None], len(ids), 1))
                    yield pa.RecordBatch.from_arrays(
                        [pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                         pa.array([block.packed()], pa.binary())], ["ids", "packed"])

    blocks = plain.repartition(tasks, "key").mapInArrow(work, f"ids array<{kind}>, packed binary")
    return stage(blocks.repartition(tasks * groups) if groups > 1 else blocks, "blocks"), groups, tasks


@dataclass
class Block:
    #: The first model of the block's group.
    first: int
    keys: np.ndarray
    y: np.ndarray
    fold: np.ndarray
    bins: np.ndarray
    #: Log-odds, one line for each model.
    margins: np.ndarray

    def packed(self) -> bytes:
        sizes = np.array([self.first, len(self.keys), self.bins.shape[1], len(self.margins)], np.int64)
        return b"".join(x.tobytes() for x in (
            sizes, self.margins, self.keys, self.fold.astype(np.int32), self.y, self.bins.T))

    @classmethod
    def unpacked(cls, raw: pa.Buffer) -> Block:
        first, rows, columns, models = np.frombuffer(raw, np.int64, 4).tolist()
        at, out = 32, []
        for kind, n in ((np.float64, rows * models), (np.uint64, rows), (np.int32, rows), (np.int8, rows),
                        (np.uint8, rows * columns)):
            out.append(np.frombuffer(raw, kind, n, at))
            at += out[-1].nbytes
        margins, keys, fold, y, bins = out
        return cls(first, keys, y, fold, bins.reshape(columns, rows).T, margins.reshape(models, rows))

    def has(self, model: int) -> bool:
        return self.first <= model < self.first + len(self.margins)

    @classmethod
    def all(cls, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Block, pa.RecordBatch]]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield cls.unpacked(batch.column("packed")[i].as_buffer()), batch.slice(i, 1)


# ---- passes --------------------------------------------------------------------------------

@dataclass
class Ask:
    """What a pass has to know of one model."""

    model: int
    setting: Setting
    fold: int
    salt: int
    since: Forest
    tree: Forest
    nodes: np.ndarray
    columns: np.ndarray

    def histograms(self, block: Block, bins: int) -> np.ndarray:
        """(node, column, bin) sums of gradient, curvature and rows over the rows that the model sees."""
        slot = np.full(len(self.tree.column), -1)
        slot[self.nodes] = np.arange(len(self.nodes)) * bins
        place = self.tree.spread(block.bins, 0, slot)
        asked = (place >= 0) & (block.fold != self.fold)
        if self.setting.row_share < 1:
            asked &= drawn_rows(block.keys, self.setting.row_share, self.salt)
        rows = np.flatnonzero(asked)
        place, mine = place[rows], block.bins.T.take(rows, axis=1).T
        chance = 1 / (1 + np.exp(-(block.margins[self.model - block.first, rows] + self.since.added(mine))))
        gradient = np.rint((chance - block.y[rows]) * SCALE)
        curvature = np.rint(chance * (1 - chance) * SCALE)
        n = len(self.nodes) * bins
        out = np.empty((len(self.columns), n, 3), np.int64)
        for k, c in enumerate(self.columns):
            at = place + mine[:, c]
            out[k, :, 0] = np.bincount(at, gradient, n)
            out[k, :, 1] = np.bincount(at, curvature, n)
            out[k, :, 2] = np.bincount(at, minlength=n)
        return out.reshape(len(self.columns), len(self.nodes), bins, 3).transpose(1, 0, 2, 3)


_SPLIT = ("model int, node int, gain double, column int, cut int, gradient long, curvature long, rows long, "
          "all_gradient long, all_curvature long, all_rows long")


def best_split(sums: np.ndarray, columns: np.ndarray, setting: Setting) -> tuple:
    """(gain, column, bin, left sums, all sums) of a node's histograms; column -1 if no split is allowed."""
    left = np.cumsum(sums, 1)
    total = left[0, -1]
    gains = split_gains(left, total, setting)
    at = int(np.argmax(gains))
    k, cut = divmod(at, gains.shape[1])
    if not gains.flat[at] > LEAST_GAIN:
        return 0.0, -1, 0, 0, 0, 0, *total.tolist()
    return float(gains.flat[at]), int(columns[k]), cut, *left[k, cut].tolist(), *total.tolist()


def split_gains(left: np.ndarray, total: np.ndarray, setting: Setting) -> np.ndarray:
    """Gains of all (column, bin) cuts from the sums to their left; -inf where a side is too small."""
    g, h, n = (left[..., i] for i in range(3))
    right = total - left
    gain = (worth(g / SCALE, h / SCALE, setting)
            + worth(right[..., 0] / SCALE, right[..., 1] / SCALE, setting)
            - worth(total[0] / SCALE, total[1] / SCALE, setting))
    allowed = ((n >= max(1, setting.min_rows)) & (right[..., 2] >= max(1, setting.min_rows))
               & (h / SCALE >= setting.min_curvature) & (right[..., 1] / SCALE >= setting.min_curvature))
    return np.where(allowed, gain, -np.inf)


def histograms(blocks: DataFrame, asks: list[Ask], bins: int = BINS, together: int = 1) -> DataFrame:
    """(bucket, model, node, sums): partial histograms, one row for each task and node.

    ``blocks`` has the one column ``packed``; a bucket holds ``together`` nodes.
    """
    ends = np.cumsum([len(a.nodes) for a in asks])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: list[np.ndarray | None] = [None] * len(asks)
        for block, _ in Block.all(batches):
            for k, ask in enumerate(asks):
                if block.has(ask.model):
                    found = ask.histograms(block, bins)
                    sums[k] = found if sums[k] is None else sums[k] + found
        for ask, end, found in zip(asks, ends, sums):
            if found is not None:
                n = len(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array((np.arange(end - n, end) // together).astype(np.int32)),
                     pa.array(np.full(n, ask.model, np.int32)), pa.array(ask.nodes.astype(np.int32)),
                     pa.array([x.tobytes() for x in found], pa.binary())], ["bucket", "model", "node", "sums"])

    return blocks.mapInArrow(work, "bucket int, model int, node int, sums binary")


def _best_splits(blocks: DataFrame, asks: list[Ask], bins: int, together: int = 1) -> list:
    known = {a.model: (a.columns, a.setting) for a in asks}
    fields = [f.split() for f in _SPLIT.split(", ")]
    kinds = {"double": pa.float64(), "int": pa.int32(), "long": pa.int64()}
    schema = pa.schema([(name, kinds[kind]) for name, kind in fields])

    def work(table: pa.Table) -> pa.Table:
        whole: dict[tuple[int, int], np.ndarray] = {}
        for model, node, sums in zip(*[table.column(c).to_pylist() for c in ("model", "node", "sums")]):
            part = np.frombuffer(sums, np.int64)
            whole[model, node] = whole[model, node] + part if (model, node) in whole else part
        found = []
        for (model, node), sums in whole.items():
            columns, setting = known[model]
            found.append((model, node, *best_split(sums.reshape(len(columns), bins, 3), columns, setting)))
        return pa.table([pa.array(v, t.type) for v, t in zip(zip(*found), schema)], schema=schema)

    return histograms(blocks, asks, bins, together).groupBy("bucket").applyInArrow(work, _SPLIT).collect()


def _passes(asks: list[Ask], bins: int, groups: int) -> Iterator[list[Ask]]:
    """Asks in runs whose histograms fit ``PASS_BYTES`` in each task."""
    group, used = [], 0
    for ask in asks:
        size = len(ask.nodes) * len(ask.columns) * bins * 24
        if group and used + size > PASS_BYTES * groups:
            yield group
            group, used = [], 0
        group.append(ask)
        used += size
    if group:
        yield group


# ---- fitting -------------------------------------------------------------------------------

@dataclass
class Ensemble:
    """A fitted model: where its log-odds start, and its trees over binned columns."""

    columns: list[str]
    edges: list[np.ndarray]
    start: float
    trees: list[dict[str, np.ndarray]]

    def scores(self, df: DataFrame, *keep: str) -> DataFrame:
        """``keep`` columns and ``score``, the probability of the label 1."""
        forest, edges, start = Forest(self.trees), self.edges, self.start
        names = [f"x{i}" for i in range(len(self.columns))]
        plain = df.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)],
                          *[F.col(f"`{c}`").cast("double").alias(n) for c, n in zip(self.columns, names)])
        schema = plain.select(*[f"k{i}" for i in range(len(keep))], F.lit(0.0).alias("score")).schema

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                margin = start + forest.added(binned(_doubles(batch, names), edges, batch.num_rows))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:len(keep)], pa.array(1 / (1 + np.exp(-margin)))], schema.names)

        return plain.mapInArrow(work, schema).toDF(*keep, "score")

    def table(self, spark: SparkSession) -> DataFrame:
        """(tree, node, column, threshold, left, right, value, gain, rows); a tree's root is node 0.

        Row (-1, 0) holds the start in ``value``.
        """
        rows = [(-1, 0, None, None, None, None, self.start, None, None)]
        for t, tree in enumerate(self.trees):
            for i in range(len(tree["column"])):
                c = int(tree["column"][i])
                inner = c >= 0
                rows.append((
                    t, i, self.columns[c] if inner else None,
                    float(self.edges[c][tree["cut"][i]]) if inner else None,
                    int(tree["left"][i]) if inner else None, int(tree["right"][i]) if inner else None,
                    None if inner else float(tree["value"][i]), float(tree["gain"][i]) if inner else None,
                    int(tree["rows"][i])))
        return spark.createDataFrame(
            rows, "tree int, node int, column string, threshold double, left int, right int, "
            "value double, gain double, rows long")

    def save(self, spark: SparkSession, path: str) -> None:
        self.table(spark).coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Ensemble:
        """The saved trees; bins are the thresholds that they use."""
        rows = spark.read.parquet(path).orderBy("tree", "node").collect()
        used: dict[str, set] = {}
        for r in rows:
            if r["column"] is not None:
                used.setdefault(r["column"], set()).add(r.threshold)
        columns = sorted(used)
        edges = [np.array(sorted(used[c])) for c in columns]
        number = {c: i for i, c in enumerate(columns)}
        trees: list[dict] = []
        for r in rows:
            if r.tree < 0:
                start = r.value
                continue
            if r.node == 0:
                trees.append({k: [] for k in ("column", "cut", "left", "right", "value", "gain", "rows")})
            inner = r["column"] is not None
            c = number[r["column"]] if inner else -1
            for k, v in zip(trees[-1], (
                    c, int(np.searchsorted(edges[c], r.threshold)) if inner else 0,
                    r.left if inner else -1, r.right if inner else -1, r.value or 0.0, r.gain or 0.0,
                    r["rows"])):
                trees[-1][k].append(v)
        return cls(columns, edges, start, [{k: np.array(v) for k, v in t.items()} for t in trees])


@dataclass
class Fitted:
    models: list[Ensemble]
    #: Blocks with the log-odds of all rows under all models.
    state: DataFrame
    jobs: list[tuple[Setting, int]]

    def held_out(self) -> DataFrame:
        """(customer_id, y, fold, setting, score) of every row from the model that did not see its fold.

        ``setting`` numbers the distinct settings in their order.
        """
        kind = self.state.schema["ids"].dataType.elementType.simpleString()
        order = list(dict.fromkeys(s for s, _ in self.jobs))
        jobs = [(m, order.index(s), fold) for m, (s, fold) in enumerate(self.jobs) if fold >= 0]

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for block, batch in Block.all(batches):
                ids = batch.column("ids")[0].values
                for m, setting, fold in jobs:
                    if not block.has(m):
                        continue
                    rows = np.flatnonzero(block.fold == fold)
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(rows)), pa.array(block.y[rows].astype(np.int32)),
                         pa.array(block.fold[rows]), pa.array(np.full(len(rows), setting, np.int32)),
                         pa.array(1 / (1 + np.exp(-block.margins[m - block.first, rows])))],
                        ["customer_id", "y", "fold", "setting", "score"])

        return self.state.mapInArrow(
            work, f"customer_id {kind}, y int, fold int, setting int, score double")


def _starts(train: DataFrame, jobs: Sequence[tuple[Setting, int]]) -> tuple[np.ndarray, int]:
    """Log-odds of the rows that each model sees, and the number of all rows."""
    counts = train.groupBy("fold").agg(F.count("*").alias("n"), F.sum(F.col("y").cast("long")).alias("ones")).collect()
    out = []
    for _, fold in jobs:
        n = sum(r.n for r in counts if r.fold != fold)
        ones = sum(r.ones for r in counts if r.fold != fold)
        # A single class, or no row, would have no finite log-odds.
        share = min(max(ones / n, 1e-6), 1 - 1e-6) if n else 0.5
        out.append(math.log(share / (1 - share)))
    return np.array(out), sum(r.n for r in counts)


def prepare(train: DataFrame, columns: Sequence[str], jobs: Sequence[tuple[Setting, int]],
            bins: int = BINS) -> tuple[list[np.ndarray], np.ndarray, DataFrame, int, int]:
    """Edges, starts, and what ``_blocks`` returns for the training rows."""
    if "fold" not in train.columns:
        train = train.withColumn("fold", F.lit(0))
    edges = bin_edges(train, columns, bins)
    starts, rows = _starts(train, jobs)
    return edges, starts, *_blocks(train, columns, edges, starts, rows)


def fit_many(train: DataFrame, columns: Sequence[str], jobs: Sequence[tuple[Setting, int]], seed: int,
             bins: int = BINS) -> Fitted:
    """Fit one model for each (setting, fold it does not see); fold -1 sees all rows.

    ``train`` has customer_id, y and the columns, and fold where folds are left out.
    """
    jobs, columns = list(jobs), list(columns)
    edges, starts, state, groups, parts = prepare(train, columns, jobs, bins)
    numbers = {s: i for i, s in enumerate(dict.fromkeys(s for s, _ in jobs))}
    grown: list[list[dict]] = [[] for _ in jobs]
    stored, blocks = 0, state.select("packed")
    # Every task that has rows of a model sends a row for each of its nodes.
    together = max(1, NODES_TOGETHER // parts)
    for t in range(max((s.trees for s, _ in jobs), default=0)):
        if t - stored == STORE_EVERY:
            state, stored = _advanced(state, [g[stored:t] for g in grown]), t
            blocks = state.select("packed")
        trees = {m: Growing(s, drawn_columns(s, numbers[s], seed, t, len(columns)), [Node(0, 0.0, 0.0, 0)])
                 for m, (s, _) in enumerate(jobs) if t < s.trees}
        since = {m: Forest(grown[m][stored:]) for m in trees}
        wanted = {m: [0] for m in trees}
        while wanted:
            asks = [Ask(m, trees[m].setting, jobs[m][1], _salt(seed, numbers[jobs[m][0]], t), since[m],
                        Forest([trees[m].arrays(final=False)]), np.array(nodes), trees[m].columns)
                    for m, nodes in wanted.items()]
            for group in _passes(asks, bins, groups):
                for r in _best_splits(blocks, group, bins, together):
                    node = trees[r.model].nodes[r.node]
                    node.gradient, node.curvature = r.all_gradient / SCALE, r.all_curvature / SCALE
                    node.rows = r.all_rows
                    if r["column"] >= 0:
                        node.best = (r.gain, r["column"], r.cut, r.gradient / SCALE, r.curvature / SCALE, r["rows"])
            wanted = {m: nodes for m in wanted if (nodes := trees[m].open())}
        for m, tree in trees.items():
            grown[m].append(tree.arrays(final=True))
    state = _advanced(state, [g[stored:] for g in grown])
    return Fitted([Ensemble(columns, edges, float(s), g) for s, g in zip(starts, grown)], state, jobs)


def _advanced(state: DataFrame, trees: list[list[dict]]) -> DataFrame:
    """The state with the given trees of every model applied; stored."""
    forests = [Forest(t) for t in trees]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, batch in Block.all(batches):
            mine = forests[block.first:block.first + len(block.margins)]
            block.margins = block.margins + np.stack([f.added(block.bins) for f in mine])
            yield pa.RecordBatch.from_arrays(
                [batch.column("ids"), pa.array([block.packed()], pa.binary())], ["ids", "packed"])

    return stage(state.mapInArrow(work, state.schema), "boosted")
