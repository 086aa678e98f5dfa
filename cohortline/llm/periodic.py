"""Periodic runs: stretches of words that repeat themselves, found in scale tiles.

A run is a stretch of consecutive words with smallest period q and a length of at least
``max(LEAST, 2 * q)`` that no neighbouring word extends keeping period q. Periods are searched in octaves
[P, 2P). For each octave a document is cut into tiles whose length follows P and which overlap by more
than a period, and every tile is solved on its own. Boundaries stand every few words of a tile; at each of
them the Z-values to the right and to the left of the boundary, for the shifts of the octave, say how
far the words keep that period on either side. Fragments of runs, cut off at the ends of their tile, then
shuffle by document and period, where overlapping fragments are stitched together.

The tiles of a document share its task, so that its words are not copied, unless the text is longer than
``SPREAD_BYTES``: then its tiles become rows of their own and are dealt over all tasks. Only fragments, and
the texts of documents that have some, are shuffled. Z-values come from 64-bit names of windows of
power-of-two lengths, so equal words means equal 64-bit names.

Defined cases: null texts have no words; rows without id, and rows that repeat id and text, are documents
of their own; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortline.llm import text
from cohortline.session import stage

LEAST = 12
#: Texts above this size have their tiles dealt over all tasks.
SPREAD_BYTES = 16 << 20
#: Shortest tile, in words; long enough that overlaps cost little at small periods.
TILE_WORDS = 4096
PART_BYTES = 2 << 20
_GRID = 1 << 20
_U64 = np.uint64
_ODD = _U64(0x9E3779B97F4A7C15)
RUNS = "array<struct<start: long, length: long, period: long>>"
_FRAGMENTS = "array<struct<period: long, start: long, stop: long>>"
_FRAGMENT_TYPE = pa.struct([(c, pa.int64()) for c in ("period", "start", "stop")])


def block(octave: int) -> int:
    """Words between boundaries of an octave, and of the match that is asked for there.

    Words one period apart are equal over a stretch of ``length - q`` words. That holds an aligned block
    of b words if it has ``2 * b - 1`` of them.
    """
    low = 1 << octave
    shortest = min(max(q, LEAST - q) for q in range(low, min(2 * low, low + LEAST)))
    return 1 << (((shortest + 1) // 2).bit_length() - 1)


def tile_shape(octave: int) -> tuple[int, int, int]:
    """(stride, words before the core, words behind the core) of an octave's tiles."""
    low = 1 << octave
    return max(TILE_WORDS, 16 * low), max(2 * low, 16), max(4 * low, 32)


def octaves(words: int) -> int:
    """Number of octaves that a document of so many words can have runs in."""
    return max(0, (words // 2).bit_length()) if words >= LEAST else 0


class Tiles:
    """Tiles as bounds in an array of words: [low, high) may be read, cores hold the boundaries."""

    def __init__(self, low, high, core, core_end, document, origin):
        self.low, self.high, self.core, self.core_end = low, high, core, core_end
        self.document, self.origin = document, origin

    @classmethod
    def of(cls, first: np.ndarray, octave: int) -> Tiles:
        """The tiles of one octave over documents that begin at ``first`` (one offset more)."""
        stride, before, behind = tile_shape(octave)
        size = np.diff(first)
        wide = np.flatnonzero((size >= LEAST) & (size >= 2 << octave))
        count = -(-size[wide] // stride)
        document = np.repeat(wide, count)
        turn = np.arange(len(document)) - np.repeat(np.cumsum(count) - count, count)
        origin, end = first[document], first[document + 1]
        core = origin + turn * stride
        return cls(np.maximum(core - before, origin), np.minimum(core + stride + behind, end),
                   core, np.minimum(core + stride, end), document, origin)


class Names:
    """64-bit names of all windows of 2^level words, kept for a few levels at a time."""

    def __init__(self, words: np.ndarray):
        self.levels = {0: words}

    def rise(self, level: int) -> None:
        """Make ``level`` known; its predecessor and every fourth level stay known."""
        top = max(self.levels)
        while top < level:
            now, half = self.levels[top], 1 << top
            n = max(0, len(now) - half)
            self.levels[top + 1] = text.mix(now[:n] * _ODD + now[half:half + n] + _U64(top + 1))
            if (top - 1) % 4 and top - 1 > 0:
                self.levels.pop(top - 1, None)
            top += 1

    def same(self, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Are the windows of ``size`` words at a and b equal? Levels of the sizes must be known."""
        out = np.ones(len(a), bool)
        level = np.frexp(size.astype(np.float64))[1] - 1
        for j in np.unique(level):
            at = np.flatnonzero(level == j)
            name, x, y = self.levels[int(j)], a[at], b[at]
            shift = size[at] - (1 << int(j))
            out[at] = (name[x] == name[y]) & (name[x + shift] == name[y + shift])
        return out

    def reach(self, a: np.ndarray, b: np.ndarray, room: np.ndarray, back: bool) -> np.ndarray:
        """Z-values: how many words from a and b on, or back from there, are equal, within ``room``."""
        got = np.zeros(len(a), np.int64)
        for j in sorted(self.levels, reverse=True):
            name, step = self.levels[j], 1 << j
            live = np.arange(len(a))
            while len(live):
                live = live[got[live] + step <= room[live]]
                at = -got[live] - step if back else got[live]
                live = live[name[a[live] + at] == name[b[live] + at]]
                got[live] += step
        return got


@lru_cache(maxsize=1 << 16)
def shorter_periods(q: int) -> tuple[int, ...]:
    """q / r for the primes r that divide q; a block of q words that repeats inside repeats at one."""
    out, rest, r = [], q, 2
    while r * r <= rest:
        if rest % r == 0:
            out.append(q // r)
            while rest % r == 0:
                rest //= r
        r += 1
    return tuple(out + [q // rest] if rest > 1 else out)


def _matches(name: np.ndarray, tiles: Tiles, octave: int, step: int) -> Iterator[tuple]:
    """(tile, boundary, period) wherever the block at a boundary recurs a period of the octave later."""
    low = 1 << octave
    last = np.minimum(tiles.core_end, tiles.high - low - step + 1)
    count = np.maximum(0, -(-(last - tiles.core) // step))
    tile = np.repeat(np.arange(len(count)), count)
    turn = np.arange(len(tile)) - np.repeat(np.cumsum(count) - count, count)
    place = tiles.core[tile] + turn * step
    periods = np.arange(low, 2 * low)
    rows = max(1, _GRID // low)
    for i in range(0, len(place), rows):
        at, t = place[i:i + rows], tile[i:i + rows]
        there = at[:, None] + periods
        found = name[np.minimum(there, len(name) - 1)] == name[at][:, None]
        found &= there + step <= tiles.high[t][:, None]
        r, c = np.nonzero(found)
        if len(r):
            yield t[r], at[r], periods[c]


def solve(names: Names, tiles: Tiles, octave: int) -> np.ndarray:
    """Distinct fragments (document, period, start, stop) of all tiles of an octave."""
    step = block(octave)
    names.rise(max(octave, step.bit_length() - 1))
    out = []
    for tile, at, q in _matches(names.levels[step.bit_length() - 1], tiles, octave, step):
        # Inside a run the q words at the boundary are a turn of its root, which repeats in no shorter way.
        several, which = np.unique(q, return_inverse=True)
        shifts = [shorter_periods(int(x)) for x in several]
        for k in range(max(map(len, shifts), default=0)):
            shift = np.array([s[k] if k < len(s) else 0 for s in shifts], np.int64)[which]
            some = np.flatnonzero(shift)
            repeats = names.same(at[some], at[some] + shift[some], q[some] - shift[some])
            keep = np.ones(len(at), bool)
            keep[some[repeats]] = False
            tile, at, q, which = tile[keep], at[keep], q[keep], which[keep]
        right = names.reach(at, at + q, tiles.high[tile] - at - q, back=False)
        left = names.reach(at, at + q, at - tiles.low[tile], back=True)
        run = left + right + q >= np.maximum(LEAST, 2 * q)
        tile, at, q, left, right = (x[run] for x in (tile, at, q, left, right))
        origin = tiles.origin[tile]
        out.append(np.stack([tiles.document[tile], q, at - left - origin, at + right + q - origin], 1))
    found = np.concatenate(out) if out else np.zeros((0, 4), np.int64)
    return np.unique(found, axis=0)


def fragments(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Fragments (document, period, start, stop) of documents whose words begin at ``first``."""
    names = Names(words)
    found = [solve(names, Tiles.of(first, k), k)
             for k in range(octaves(int(np.diff(first).max(initial=0))))]
    found = np.concatenate([np.zeros((0, 4), np.int64), *found])
    return found[np.argsort(found[:, 0], kind="stable")]


def _list_array(found: np.ndarray, rows: int) -> pa.Array:
    """One list of fragments for each row; ``found`` ascends by row."""
    offsets = np.searchsorted(found[:, 0], np.arange(rows + 1))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(
        [pa.array(found[:, i]) for i in (1, 2, 3)], fields=list(_FRAGMENT_TYPE)))


def _in_place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as words joined by spaces, with their fragments; long texts get no fragments here."""
    for batch in batches:
        for part in text.parts(batch, size=PART_BYTES):
            words = text.Words(part.column("text"))
            rows = part.num_rows
            size = np.diff(words.rows)
            spread = size > SPREAD_BYTES
            found = (np.zeros((0, 4), np.int64) if spread.any()
                     else fragments(words.hashes(), words.first))
            joined, begin, stop = words.joined()
            # Each row's bytes end one space before the next row's first word.
            edge = np.concatenate([begin, [len(joined)]])[words.first]
            lengths = np.maximum(np.diff(edge) - 1, 0)
            plain = pa.array([joined[a:a + n] for a, n in zip(edge, lengths)], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), part.column("id"), plain.cast(pa.string()),
                 pa.array(words.counts.astype(np.int64)), pa.array(spread), _list_array(found, rows)],
                ["row", "id", "text", "n_words", "spread", "fragments"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each tile of long texts, with its words as numbers of this text."""
    for batch in batches:
        for part in text.parts(batch, size=1):
            words = text.Words(part.column("text"))
            codes = np.unique(words.hashes(), return_inverse=True)[1].astype(np.uint32)
            for k in range(octaves(len(codes))):
                t = Tiles.of(words.first, k)
                for low, high, core, end in zip(t.low, t.high, t.core, t.core_end):
                    yield pa.RecordBatch.from_arrays(
                        [part.column("row"), pa.array([k], pa.int32()),
                         *[pa.array([int(x)]) for x in (low, core - low, end - low)],
                         pa.array([codes[low:high].tobytes()], pa.binary())],
                        ["row", "octave", "low", "core", "core_end", "words"])


def _tile_by_tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            words = text.mix(np.frombuffer(row["words"], np.uint32).astype(_U64) + _U64(1))
            tile = Tiles(*[np.array([x]) for x in (
                0, len(words), row["core"], row["core_end"], 0, 0)])
            found = solve(Names(words), tile, row["octave"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(found), row["row"])), pa.array(found[:, 1]),
                 pa.array(found[:, 2] + row["low"]), pa.array(found[:, 3] + row["low"])],
                ["row", "period", "start", "stop"])


def stitch(found: DataFrame) -> DataFrame:
    """(row, runs) from fragments (row, period, start, stop): those that share a period's words are one.

    Two runs of one period share fewer words than the period, fragments of one run more.
    """
    near = Window.partitionBy("row", "period").orderBy("start", "stop")
    before = F.max("stop").over(near.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(before - F.col("start") >= F.col("period"), 0).otherwise(1)
    runs = (found.withColumn("fresh", fresh)
            .withColumn("run", F.sum("fresh").over(near.rowsBetween(Window.unboundedPreceding, 0)))
            .groupBy("row", "period", "run").agg(F.min("start").alias("start"), F.max("stop").alias("stop")))
    listed = F.sort_array(F.collect_list(F.struct(
        "start", "period", (F.col("stop") - F.col("start")).alias("length"))))
    return runs.groupBy("row").agg(F.transform(
        listed, lambda r: F.struct(r.start.alias("start"), r.length.alias("length"),
                                   r.period.alias("period"))).alias("runs"))


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Drop every word that a run contains after that run's first period."""
    for batch in batches:
        kept = []
        for line, runs in zip(batch.column("text").to_pylist(), batch.column("runs").to_pylist()):
            words = line.split(" ")
            cover = np.zeros(len(words) + 1, np.int64)
            for r in runs:
                cover[r["start"] + r["period"]] += 1
                cover[r["start"] + r["length"]] -= 1
            kept.append(" ".join([w for w, c in zip(words, np.cumsum(cover).tolist()) if not c]))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(kept, pa.string())], [*batch.schema.names, "kept_text"])


def collapse_runs(docs: DataFrame, id_column: str = "doc_id", column: str = "text") -> DataFrame:
    """(id, n_words, runs, kept_text) of every document.

    ``runs`` lists (start, length, period) by start, then period, in words. ``kept_text`` joins by one
    space the words that no run contains after that run's first period.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"),
                       F.col(f"`{id_column}`").alias("id"), F.col(f"`{column}`").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    solved = stage(rows.mapInArrow(
        _in_place, f"row long, id {kind}, text string, n_words long, spread boolean, "
        f"fragments {_FRAGMENTS}"), "fragments", compression="zstd")
    found = solved.select("row", F.inline("fragments"))
    if solved.filter("spread").limit(1).count():
        tiles = solved.filter("spread").select("row", "text").mapInArrow(
            _cut, "row long, octave int, low long, core long, core_end long, words binary")
        tasks = docs.sparkSession.sparkContext.defaultParallelism * 4
        found = found.unionByName(tiles.repartition(tasks, "row", "octave", "low").mapInArrow(
            _tile_by_tile, "row long, period long, start long, stop long"))
    runs = stage(stitch(found), "runs")
    with_some = F.col("spread") | (F.size("fragments") > 0)
    some = solved.filter(with_some).join(runs, "row", "left").select(
        "id", "n_words", "text", F.coalesce("runs", F.array().cast(RUNS)).alias("runs"))
    done = some.mapInArrow(_collapse, f"id {kind}, n_words long, text string, runs {RUNS}, kept_text string")
    alone = solved.filter(~with_some).select(
        "id", "n_words", F.array().cast(RUNS).alias("runs"), F.col("text").alias("kept_text"))
    return alone.unionByName(done.drop("text")).select(
        F.col("id").alias(id_column), "n_words", "runs", "kept_text")
