"""Token ids of text batches by the tokenizers library, encoding each distinct word once.

The tokenizer drops white space and joins nothing across it, so the ids of a text are the ids of
its words in a row. Words are found and hashed in numpy; those a worker has not met go to the
library, the others come from its table. A-Z are lower-cased first, as the tokenizer does itself,
and trailing ASCII signs behind an ASCII letter or digit are a word of their own, as they are
for the tokenizer; words with ``<`` (special tokens) or with a trailing apostrophe are left as they are.
Only a tokenizer with such rules may be used: lower case, white space dropped.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np
import pyarrow as pa

from cohortline.llm import text

PART_BYTES = 8 << 20
_MOST_WORDS = 3_000_000
_PLAIN = text.byte_class(range(0x30, 0x3A), range(0x41, 0x5B), range(0x61, 0x7B))
_SOLID = _PLAIN | text.byte_class(range(0x80, 0x100))


class Encoder:
    def __init__(self, path: str, special_as_text: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(path)
        self._library.encode_special_tokens = special_as_text
        self._forget()

    def _forget(self) -> None:
        self._known = np.zeros(0, np.uint64)
        self._place = np.zeros(0, np.int64)
        self._size = np.zeros(0, np.int64)
        self._ids = np.zeros(0, np.uint32)

    def _learn(self, keys: np.ndarray, words: list[str]) -> None:
        if len(self._known) + len(keys) > _MOST_WORDS:
            self._forget()
        ids = [e.ids for e in self._library.encode_batch_fast(words, add_special_tokens=False)]
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        place = len(self._ids) + np.cumsum(size) - size
        self._ids = np.concatenate(
            [self._ids, np.fromiter((i for e in ids for i in e), np.uint32, size.sum())])
        known = np.concatenate([self._known, keys])
        order = np.argsort(known, kind="stable")
        self._known = known[order]
        self._place = np.concatenate([self._place, place])[order]
        self._size = np.concatenate([self._size, size])[order]

    def _units(self, words: text.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Bytes, and the bounds and word numbers of what is encoded on its own."""
        raw, start, end = words.data, words.start, words.end
        data = text.LOWER[raw]
        if not len(start):
            return data, start, end, start
        solid = np.where(_SOLID[raw], np.arange(len(raw)), -1)
        core = np.maximum.accumulate(solid)[end - 1] + 1
        split = (core > start) & (core < end) & _PLAIN[raw[np.maximum(core, 1) - 1]]
        for sign, tail_only in ((0x27, True), (0x3C, False)):
            at = np.flatnonzero(raw == sign)
            if len(at):
                owner = np.searchsorted(end, at, "right")
                if tail_only:
                    owner = owner[at >= core[owner]]
                split[owner] = False
                if not tail_only:
                    for w in np.unique(owner).tolist():
                        data[start[w]:end[w]] = raw[start[w]:end[w]]
        word = np.repeat(np.arange(len(start)), 1 + split)
        tail = np.concatenate([[False], word[1:] == word[:-1]])
        head = np.append(tail[1:], False)
        return (data, np.where(tail, core[word], start[word]),
                np.where(head, core[word], end[word]), word)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows in a row, and how many each row has."""
        words = text.Words(texts)
        data, start, end, word = self._units(words)
        values, first, place = np.unique(
            text.byte_hashes(data, start, end), return_index=True, return_inverse=True)
        # Chunks, so that the table's bound holds for any batch; none is larger than the bound.
        size = np.zeros(len(values), np.int64)
        pieces: list[np.ndarray] = []
        offset, total = np.zeros(len(values), np.int64), 0
        for low in range(0, len(values), _MOST_WORDS // 2):
            keys = values[low:low + _MOST_WORDS // 2]
            at = np.searchsorted(self._known, keys)
            new = at == len(self._known)
            new[~new] = self._known[at[~new]] != keys[~new]
            if new.any():
                raw = data.tobytes()
                if len(self._known) + new.sum() > _MOST_WORDS:
                    self._forget()
                    new[:] = True
                which = first[low:low + len(keys)][new]
                self._learn(keys[new], [
                    raw[a:b].decode("utf-8", "replace")
                    for a, b in zip(start[which].tolist(), end[which].tolist())])
                at = np.searchsorted(self._known, keys)
            n = self._size[at]
            size[low:low + len(keys)] = n
            offset[low:low + len(keys)] = total + np.cumsum(n) - n
            pieces.append(self._ids[_ranges(self._place[at], n)])
            total += n.sum()
        ids = np.concatenate(pieces) if pieces else np.zeros(0, np.uint32)
        out = ids[_ranges(offset[place], size[place])]
        unit_first = np.searchsorted(word, words.first)
        return out, text.per_row(size[place], unit_first)


def _ranges(low: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All positions of the ranges [low, low + size), one range after the other."""
    ends = np.cumsum(size)
    return np.repeat(low - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)


def with_end(ids: np.ndarray, counts: np.ndarray, end: int) -> np.ndarray:
    """``ids`` with an end id behind each row."""
    out = np.full(len(ids) + len(counts), end, np.uint32)
    out[np.arange(len(ids)) + np.repeat(np.arange(len(counts)), counts)] = ids
    return out


@lru_cache(maxsize=2)
def encoder(path: str, special_as_text: bool = False) -> Encoder:
    """The worker's encoder; its table lasts from task to task."""
    return Encoder(path, special_as_text)
