"""Words and rolling hashes of Arrow text batches, vectorised over bytes.

Everything works on bytes of UTF-8, so the ASCII word patterns of the operators are byte classes.
Hashes are prefix sums of a polynomial modulo 2^64 over random byte codes, mixed at the end; any
run of words then costs one subtraction. Work goes in segments, so memory follows the segment and
not the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

PART_BYTES = 4 << 20
_SEGMENT = 1 << 19
_U64 = np.uint64


def byte_class(*members: int | range) -> np.ndarray:
    table = np.zeros(256, bool)
    for m in members:
        table[list(m) if isinstance(m, range) else m] = True
    return table


#: Words between ASCII white space.
NOT_SPACE = ~byte_class(0x20, range(0x09, 0x0E))
#: Letters, digits and everything outside ASCII; for lower-cased text.
ALNUM = byte_class(range(0x30, 0x3A), range(0x61, 0x7B), range(0x80, 0x100))
#: Lower-cases A-Z and nothing else.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def _powers(base: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = (np.full(_SEGMENT + 1, b, _U64) for b in (base, pow(base, -1, 1 << 64)))
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


_BYTE_CODES = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=_U64) | _U64(1)
_POW, _INV = _powers(0x9E3779B97F4A7C15)


def power(k: int) -> np.uint64:
    """Factor of the word at place ``k`` of a run."""
    return _POW[k]


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64."""
    x = (x ^ (x >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U64(27))) * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


def parts(batch: pa.RecordBatch, column: str = "text",
          size: int = PART_BYTES) -> Iterator[pa.RecordBatch]:
    """Row slices of about ``size`` bytes of text each; a longer text is a slice of its own."""
    if not batch.num_rows:
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    total = np.cumsum(lengths, dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        before = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, before + size, "right")))
        yield batch.slice(at, to - at)
        at = to


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array, and where each row begins (one offset more than rows)."""
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = pc.fill_null(texts, b"")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[at[0]:at[-1]], at - at[0]


class Words:
    """Words of a batch: byte bounds ``start``/``end``, and ``first`` word of each row (n + 1)."""

    def __init__(self, texts: pa.Array, keep: np.ndarray = NOT_SPACE, lower: bool = False):
        data, self.rows = flat(texts)
        self.data = LOWER[data] if lower else data
        inside = keep[self.data]
        start, end = inside.copy(), inside.copy()
        start[1:] &= ~inside[:-1]
        end[:-1] &= ~inside[1:]
        cuts = self.rows[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < len(data))]
        start[cuts] = inside[cuts]
        end[cuts - 1] = inside[cuts - 1]
        self.inside = inside
        self.start, self.end = np.flatnonzero(start), np.flatnonzero(end) + 1
        self.first = np.searchsorted(self.start, self.rows)

    def __len__(self) -> int:
        return len(self.start)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def row_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def hashes(self) -> np.ndarray:
        return byte_hashes(self.data, self.start, self.end)

    def window_starts(self, size: int) -> np.ndarray:
        """First words of all runs of ``size`` words that lie within one row."""
        ends = np.repeat(self.first[1:], self.counts)
        at = np.arange(len(self))
        return at[at + size <= ends]

    def joined(self) -> tuple[bytes, np.ndarray, np.ndarray]:
        """The words with one space after each, as bytes, and each word's bounds there."""
        lengths = self.end - self.start
        stop = np.cumsum(lengths + 1)
        begin = stop - lengths - 1
        out = np.full(stop[-1] if len(stop) else 0, 0x20, np.uint8)
        at = np.flatnonzero(self.inside)
        out[at + np.repeat(begin - self.start, lengths)] = self.data[at]
        return out.tobytes(), begin, stop - 1


def byte_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte runs that ascend and do not overlap."""
    out = np.empty(len(start), _U64)
    i = 0
    while i < len(start):
        low = start[i]
        j = int(np.searchsorted(end, low + _SEGMENT, "right"))
        if j <= i:  # one run longer than a segment
            out[i] = xxhash.xxh64_intdigest(data[low:end[i]].tobytes(), 7)
            i += 1
            continue
        run = data[low:end[j - 1]]
        sums = np.zeros(len(run) + 1, _U64)
        np.cumsum(_BYTE_CODES[run] * _POW[:len(run)], out=sums[1:])
        a, b = start[i:j] - low, end[i:j] - low
        out[i:j] = (sums[b] - sums[a]) * _INV[a]
        i = j
    return mix(out + (end - start).astype(_U64))


def run_hashes(hashes: np.ndarray, start: np.ndarray, size: int | np.ndarray,
               salt: int = 0) -> np.ndarray:
    """Hashes of runs of word hashes; ``start`` ascends, no run is longer than a segment half."""
    out = np.empty(len(start), _U64)
    size = np.broadcast_to(np.asarray(size), start.shape)
    salted = mix(hashes + _U64(salt)) if salt else hashes
    i = 0
    while i < len(start):
        low = start[i]
        j = int(np.searchsorted(start, low + _SEGMENT // 2, "left"))
        high = int((start[i:j] + size[i:j]).max())
        run = salted[low:high]
        sums = np.zeros(len(run) + 1, _U64)
        np.cumsum(run * _POW[:len(run)], out=sums[1:])
        a = start[i:j] - low
        out[i:j] = (sums[a + size[i:j]] - sums[a]) * _INV[a]
        i = j
    return mix(out + size.astype(_U64))


def per_row(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of each row's slice of ``values``; empty slices give 0."""
    sums = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return sums[first[1:]] - sums[first[:-1]]
