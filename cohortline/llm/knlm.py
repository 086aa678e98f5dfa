"""Interpolated modified Kneser-Ney language model.

Tokens are words between ASCII white space with A-Z lower-cased, then one end mark. Grams are
counted in Spark: each part of the input sends its distinct grams with counts to hash buckets; a
bucket adds them up, writes them as sorted arrays of hashes with counts, and sends what the next
lower order needs: a continuation for each distinct gram. Lower orders
hold continuation counts, the lowest order backs off to a uniform distribution over the training
vocabulary and one unknown token. Discounts come from the counts of counts of each order.

All words are counted first: a word's number is its rank by hash. Grams travel as numbers into a list of the
words that their payload holds, frequent words first and otherwise ascending, so that the list is the steps
between their numbers; all of it one byte plane after the other and compressed. Files keep of a gram's hash what its place does not tell: a
directory over the leading bits, then 40 bits. A context that was seen once has no entry: it
is a gram of the order below, and what follows it was seen once.

Scoring maps the files into the memory of each worker and looks up the distinct grams of a batch in
sorted order. Buckets of a context follow the context; a context frequent enough to weigh on one
bucket is spread over all by the whole gram. Which contexts those are is counted over all
documents; it decides where records lie and nothing else.

Defined cases: null and empty texts are an end mark; with nothing to learn from, every token is
unknown and equally likely; rows may repeat.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortline.llm import buckets, store, text
from cohortline.session import stage

ORDER = 3
BUCKET_TEXT = 8 << 20
_PART = 8 << 20
# Tokens that a task gathers before it sends their grams.
_GATHERED = 3 << 20
_U64 = np.uint64
_BEGIN, _END = _U64(0x5BD1E995A3C59AC3), _U64(0x2545F4914F6CDD1D)
_ROWS = "level int, kind int, bucket int, payload binary"
_GRAM, _CONTEXT, _WORD, _TABLE = range(4)
_OWN = _TABLE + _TABLE
# Columns of a context table behind its keys.
_SUMS = 4


def gram_key(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    return text.mix(context * _U64(0x9E3779B97F4A7C15) + word)


class Tokens:
    """Word hashes of a batch with begin and end marks, and where the predicted tokens lie."""

    def __init__(self, texts: pa.Array, order: int):
        words = text.Words(texts, lower=True)
        hashes, counts = words.hashes(), words.counts
        pad = order - 1
        size = counts + pad + 1
        low = np.cumsum(size) - size
        self.all = np.full(size.sum(), _BEGIN, _U64)
        place = np.arange(len(hashes)) + np.repeat(low + pad - words.first[:-1], counts)
        self.all[place] = hashes
        self.all[low + size - 1] = _END
        self.counts = counts + 1
        self.at = np.arange(self.counts.sum()) + np.repeat(
            low + pad - (np.cumsum(self.counts) - self.counts), self.counts)
        self.word = self.all[self.at]

    def context(self, size: int) -> np.ndarray:
        return text.run_hashes(self.all, self.at - size, size)


def _placed(context: np.ndarray | None, word: np.ndarray, heavy: np.ndarray, n: int) -> np.ndarray:
    """Bucket of each gram."""
    if context is None:
        return buckets.bucket_of(word, n)
    out = buckets.bucket_of(context, n)
    if len(heavy):
        at = np.minimum(np.searchsorted(heavy, context), len(heavy) - 1)
        spread = heavy[at] == context
        out[spread] = buckets.bucket_of(gram_key(context[spread], word[spread]), n)
    return out


def _places(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, a place of each, and which of them stands where; numpy's ``unique`` wants the
    first place and so a slower, stable sort."""
    order = np.argsort(keys)
    ranked = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    which = np.empty(len(keys), np.int64)
    which[order] = np.cumsum(new) - 1
    return ranked[new], order[new], which


def _batch(level: int, kind: int, bucket, payload: list[bytes]) -> pa.RecordBatch:
    n = len(payload)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, level), pa.int32()), pa.array(np.full(n, kind), pa.int32()),
         pa.array(bucket, pa.int32()), pa.array(payload, pa.binary())],
        ["level", "kind", "bucket", "payload"])


def _run(columns: list[np.ndarray]) -> np.ndarray:
    """Hashes of the runs whose words stand in ``columns``, as ``Tokens.context`` gives them."""
    out = np.full(columns[0].shape, len(columns), _U64)
    for k, words in enumerate(columns):
        out += words * text.power(k)
    return text.mix(out)


def _distinct(columns: list[np.ndarray], size: int,
              weights: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """First row and total of each distinct gram of word numbers below ``size``, in their order."""
    rows = len(columns[0])
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    key, top = columns[0].astype(_U64), size
    for column in columns[1:]:
        if top * size >= 1 << 64:
            key = np.unique(key, return_inverse=True)[1].astype(_U64)
            top = rows
        key = key * _U64(size) + column.astype(_U64)
        top *= size
    order = np.argsort(key)
    key = key[order]
    cuts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    total = np.diff(np.append(cuts, rows)) if weights is None else \
        np.add.reduceat(weights[order], cuts)
    return order[cuts], total


def _often_first(words: np.ndarray,
                 columns: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Renumber the words so that frequent ones have small numbers; those about as frequent stay in order."""
    total = sum(np.bincount(c, minlength=len(words)) for c in columns)
    often = np.argsort(-np.frexp(total)[1], kind="stable")
    rank = np.empty(len(words), np.int32)
    rank[often] = np.arange(len(words), dtype=np.int32)
    return words[often], [rank[c] for c in columns]


def _planes(values: np.ndarray) -> np.ndarray:
    """Bytes of unsigned integers, all first bytes before all second ones."""
    values = store.narrow(values)
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T).ravel()


def _from_planes(raw: np.ndarray, rows: int) -> np.ndarray:
    out = np.zeros(rows, np.int64)
    for k in range(len(raw) // rows):
        out |= raw[k * rows:(k + 1) * rows].astype(np.int64) << (8 * k)
    return out


@dataclass
class Vocabulary:
    """Numbers of all words of the training texts, from the files of words that lie in hash buckets.

    The begin mark follows the last word; it is no word and has no count.
    """

    files: dict[int, str]
    # Words in the buckets before each, and in all.
    before: np.ndarray

    def __len__(self) -> int:
        return int(self.before[-1]) + 1

    def numbers(self, words: np.ndarray) -> np.ndarray:
        """Of ascending hashes, each of a word of the training texts or the begin mark."""
        out = np.full(len(words), len(self) - 1)
        bucket = buckets.bucket_of(words, len(self.before) - 1)
        for b in np.unique(bucket).tolist():
            if b in self.files:
                i, j = np.searchsorted(bucket, [b, b + 1])
                out[i:j] = self.before[b] + np.searchsorted(_opened(self.files[b])[0], words[i:j])
        out[words == _BEGIN] = len(self) - 1
        return out

    def hashes(self, numbers: np.ndarray) -> np.ndarray:
        out = np.full(len(numbers), _BEGIN, _U64)
        order = np.argsort(numbers, kind="stable")
        cuts = np.searchsorted(numbers[order], self.before)
        for b in np.flatnonzero(np.diff(cuts)).tolist():
            rows = order[cuts[b]:cuts[b + 1]]
            out[rows] = _opened(self.files[b])[0][numbers[rows] - self.before[b]]
        return out


def _send_grams(level: int, numbers: np.ndarray, words: np.ndarray, size: int,
                columns: list[np.ndarray], heavy: np.ndarray, n: int) -> pa.RecordBatch:
    """Add up equal grams and send them; columns give the place of each gram's words in ``words``.

    ``numbers`` are those of the words in a vocabulary of ``size``.
    """
    first, total = _distinct(columns, len(words), None)
    columns = [c[first] for c in columns]
    bucket = _placed(_run([words[c] for c in columns[:-1]]) if level > 1 else None,
                     words[columns[-1]], heavy, n)
    order = np.argsort(bucket, kind="stable")
    bucket, total, columns = bucket[order], total[order], [c[order] for c in columns]
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]]) \
        if len(bucket) else np.zeros(1, np.int64)
    payload, rank = [], np.empty(len(words), np.int32)
    pack = zstandard.ZstdCompressor(level=1)
    for i, j in zip(cuts[:-1], cuts[1:]):
        used = np.unique(np.concatenate([c[i:j] for c in columns]))
        rank[used] = np.arange(len(used), dtype=np.int32)
        lead, *rest = (rank[c[i:j]] for c in columns)
        payload.append(pack.compress(store.dump(
            np.array([j - i, len(used), size]), _planes(np.diff(numbers[used], prepend=0) % size),
            _planes(total[i:j]), _planes(np.diff(lead, prepend=0)), *[_planes(c) for c in rest])))
    return _batch(level, _GRAM, bucket[cuts[:-1]], payload)


def _grams(payload: bytes) -> tuple[np.ndarray, ...]:
    """Numbers of the words, counts, and where the words of each gram stand among them."""
    (rows, used, size), steps, *columns = store.load(zstandard.decompress(payload))
    total, lead, *rest = (_from_planes(c, rows) for c in columns)
    return np.cumsum(_from_planes(steps, used)) % size, total, np.cumsum(lead), *rest


def _send_sums(level: int, kind: int, keys: np.ndarray, sums: np.ndarray,
               n: int) -> pa.RecordBatch:
    bucket = buckets.bucket_of(keys, n)
    order = np.argsort(bucket, kind="stable")
    bucket, keys, sums = bucket[order], keys[order], sums[order]
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]]) \
        if len(bucket) else np.zeros(1, np.int64)
    return _batch(level, kind, bucket[cuts[:-1]], [
        store.dump(keys[i:j], *[store.narrow(c) for c in sums[i:j].T])
        for i, j in zip(cuts[:-1], cuts[1:])])


def _gathered(batches: Iterator[pa.RecordBatch], order: int) -> Iterator[list[Tokens]]:
    gathered: list[Tokens] = []
    for batch in batches:
        for part in text.parts(batch, size=_PART):
            gathered.append(Tokens(part.column("text"), order))
            if sum(len(t.all) for t in gathered) >= _GATHERED:
                yield gathered
                gathered = []
    if gathered:
        yield gathered


def _count_words(n: int):
    """Plain word counts of each part of the input."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for gathered in _gathered(batches, 1):
            words, total = np.unique(
                np.concatenate([t.word for t in gathered]), return_counts=True)
            yield _send_sums(0, _WORD, words, total[:, None], n)
    return work


def _add_up_words(folder: str):
    """The table of one bucket's words."""
    def work(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        keys, sums = _summed(table.column("payload").to_pylist())
        out = _written(folder, "words", 0, _TABLE + _WORD, bucket,
                       [keys, store.narrow(sums[0])], [len(keys), sums[0].sum()])
        return pa.Table.from_batches([out.cast(table.schema)])
    return work


def _summed(payloads: list[bytes]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Distinct keys in order, and the totals of their sums."""
    rows = [store.load(p) for p in payloads]
    keys = np.concatenate([r[0] for r in rows])
    sums = [np.concatenate([r[k].astype(np.int64) for r in rows]) for k in range(1, len(rows[0]))]
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    cuts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[cuts], [np.add.reduceat(s[order], cuts) for s in sums]


def _count(order: int, heavy: list[np.ndarray], vocabulary, n: int):
    """Top-order grams of each part of the input; ``vocabulary`` is a broadcast one."""
    def send(gathered: list[Tokens]) -> Iterator[pa.RecordBatch]:
        every = np.concatenate([t.all for t in gathered])
        low = np.cumsum([0] + [len(t.all) for t in gathered])
        at = np.concatenate([t.at + start for t, start in zip(gathered, low)])
        gathered.clear()
        words, place = np.unique(every, return_inverse=True)
        del every
        words, (place,) = _often_first(words, [place])
        order_of = np.argsort(words)
        numbers = np.empty(len(words), np.int64)
        numbers[order_of] = vocabulary.value.numbers(words[order_of])
        yield _send_grams(
            order, numbers, words, len(vocabulary.value),
            [place[at - k] for k in range(order - 1, -1, -1)], heavy[order], n)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for gathered in _gathered(batches, order):
            yield from send(gathered)
    return work


def _merged(payloads: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Numbers of the words, counts and columns of places among them, of all payloads of a bucket."""
    parts = [_grams(p) for p in payloads]
    numbers = np.unique(np.concatenate([p[0] for p in parts]))
    columns = [np.concatenate([np.searchsorted(numbers, p[0]).astype(np.int32)[p[k]] for p in parts])
               for k in range(2, len(parts[0]))]
    return numbers, np.concatenate([p[1] for p in parts]), columns


def _add_up(level: int, heavy: list[np.ndarray], vocabulary, n: int, folder: str):
    """One bucket of one order: its tables, what the order below needs, and what passes through."""
    def contexts(words, columns, total, bucket) -> Iterator[pa.RecordBatch]:
        new = np.zeros(len(total), bool)
        new[0] = True
        for c in columns[:-1]:
            new[1:] |= c[1:] != c[:-1]
        cuts = np.flatnonzero(new)
        kind = np.minimum(total, 3)
        sums = np.add.reduceat(
            np.column_stack([total, kind == 1, kind == 2, kind == 3]).astype(np.int64), cuts, axis=0)
        lead = [words[c[cuts]] for c in columns[:-1]]
        keys = _run(lead)
        spread = np.isin(keys, heavy[level])
        yield _send_sums(level, _CONTEXT, keys[spread], sums[spread], n)
        # What is left out here is found as a gram of the order below; no gram ends in a begin mark.
        own = np.flatnonzero(~spread & ((sums[:, 0] > 1) | (lead[-1] == _BEGIN)))
        if len(own):
            own = own[np.argsort(keys[own])]
            yield _written(folder, f"contexts-{level}", level, _OWN, bucket,
                           [keys[own], *[store.narrow(c) for c in sums[own].T]], [len(own)])

    def work(table: pa.Table) -> pa.Table:
        out = []
        levels, kinds = table.column("level").to_numpy(), table.column("kind").to_numpy()
        bucket = table.column("bucket")[0].as_py()
        payload = table.column("payload").to_pylist()
        mine = np.flatnonzero((kinds == _GRAM) & (levels == level))
        if len(mine):
            numbers, counts, columns = _merged([payload[i] for i in mine])
            numbers, columns = _often_first(numbers, columns)
            words = vocabulary.value.hashes(numbers)
            first, total = _distinct(columns, len(words), counts)
            columns = [c[first] for c in columns]
            keys = words[columns[-1]]
            if level > 1:
                keys = gram_key(_run([words[c] for c in columns[:-1]]), keys)
            often = np.bincount(np.minimum(total, 5), minlength=6)[1:]
            order = np.argsort(keys)
            keys, ranked = keys[order], store.narrow(total[order])
            out.append(_written(folder, f"grams-{level}", level, _TABLE, bucket,
                                [*_shortened(keys), ranked] if level > 1 else [keys, ranked],
                                [*often, total.sum()]))
            del keys, ranked, order
            if level > 1:
                out.extend(contexts(words, columns, total, bucket))
                out.append(_send_grams(level - 1, numbers, words, len(vocabulary.value),
                                       columns[1:], heavy[level - 1], n))
        # Sums of contexts are complete one exchange after they were sent.
        own = np.flatnonzero((kinds == _CONTEXT) & (levels == level + 1))
        if len(own):
            keys, sums = _summed([payload[i] for i in own])
            out.append(_written(
                folder, f"spread-{level + 1}", level + 1, _TABLE + _CONTEXT, bucket,
                [keys, *[store.narrow(s) for s in sums]], [len(keys), sums[0].sum()]))
        rest = table.filter(pa.array(kinds >= _TABLE))
        batches = [b.cast(rest.schema) for b in out if b.num_rows]
        return pa.concat_tables([rest, pa.Table.from_batches(batches, rest.schema)])
    return work


def _shortened(keys: np.ndarray) -> list[np.ndarray]:
    """Sorted hashes as a directory over some leading bits and the 40 bits that follow them."""
    bits = _U64(max(1, len(keys).bit_length() - 4))
    slots = (keys >> (_U64(64) - bits)).astype(np.int64)
    cuts = np.searchsorted(slots, np.arange((1 << int(bits)) + 1)).astype(np.uint32)
    rest = (keys << bits) >> _U64(24)
    return [cuts, rest.astype(np.uint32), (rest >> _U64(32)).astype(np.uint8)]


def _find_short(table: list[np.ndarray], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each key would stand, and whether it does; bisection inside the directory's slots."""
    cuts, low, high = table[:3]
    bits = _U64((len(cuts) - 1).bit_length() - 1)
    slot = (keys >> (_U64(64) - bits)).astype(np.int64)
    wanted = (keys << bits) >> _U64(24)
    at, stop = cuts[slot].astype(np.int64), cuts[slot + 1].astype(np.int64)
    size, last = stop - at, len(low) - 1

    def smaller(place: np.ndarray) -> np.ndarray:
        place = np.minimum(place, last)
        return (high[place].astype(_U64) << _U64(32) | low[place]) < wanted

    # The first ``size`` places from ``at`` on are still open.
    for _ in range(int(size.max(initial=0)).bit_length()):
        half = size >> 1
        right = (size > 0) & smaller(at + half)
        at = np.where(right, at + half + 1, at)
        size = np.where(right, size - half - 1, half)
    place = np.minimum(at, last)
    return place, (at < stop) & ((high[place].astype(_U64) << _U64(32) | low[place]) == wanted)


def _written(folder: str, name: str, level: int, kind: int, bucket: int,
             arrays: list[np.ndarray], facts: list[int]) -> pa.RecordBatch:
    uri, out = store.create(folder, f"{name}-{bucket:06d}")
    out.write(store.dump(*arrays))
    out.close()
    return _batch(level, kind, [bucket], [
        store.dump(np.frombuffer(uri.encode(), np.uint8), np.array(facts, np.int64))])


def _heavy(docs: DataFrame, order: int, n: int) -> list[np.ndarray]:
    """For each order the sorted contexts that make up more than 1 / 2n of all tokens.

    Some with more than 1 / 4n are among them, so there are at most 4n of each order. Parts leave out
    what is below 1 / 4n of their own tokens, which takes less than that from any sum.
    """
    if order < 2:
        return [np.zeros(0, _U64)] * (order + 1)
    share = 4 * n

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text.parts(batch, size=_PART):
                tokens = Tokens(part.column("text"), order)
                for k in range(order):
                    keys, total = np.unique(tokens.context(k), return_counts=True) if k else (
                        np.zeros(1, _U64), np.array([len(tokens.at)]))
                    use = total * share >= len(tokens.at)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(use.sum(), k), pa.int32()),
                         pa.array(keys[use].view(np.int64)), pa.array(total[use])],
                        ["size", "key", "n"])

    found = stage(docs.mapInArrow(work, "size int, key long, n long")
                  .groupBy("size", "key").agg(F.sum("n").alias("n")), "heavy")
    tokens = found.filter("size = 0").agg(F.sum("n")).first()[0] or 0
    rows = found.filter((F.col("size") > 0) & (F.col("n") * share >= tokens)).collect()
    return [np.zeros(0, _U64)] * 2 + [
        np.sort(np.array([r["key"] for r in rows if r["size"] == level - 1], np.int64).view(_U64))
        for level in range(2, order + 1)]


@dataclass
class Model:
    """Where the tables lie, and the numbers that hold for all grams of an order."""

    order: int
    n: int
    heavy: list[np.ndarray]
    files: dict[tuple[str, int], str]
    discounts: list[np.ndarray]
    vocabulary: int = 0
    tokens: int = 0
    continuations: int = 0
    low_mass: float = 1.0

    def table(self, name: str, bucket: int) -> list[np.ndarray] | None:
        uri = self.files.get((name, bucket))
        return _opened(uri) if uri else None

    def find(self, name: str, bucket: np.ndarray, keys: np.ndarray, columns: int) -> np.ndarray:
        """Sums of each key, 0 where it does not occur; looked up bucket by bucket in key order."""
        out = np.zeros((len(keys), columns), np.int64)
        order = np.lexsort((keys, bucket))
        ranked = bucket[order]
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(ranked)) + 1, [len(ranked)]])
        for i, j in zip(cuts[:-1], cuts[1:]):
            if i == j or (table := self.table(name, int(ranked[i]))) is None:
                continue
            rows = order[i:j]
            if len(table) > 1 + columns:
                at, hit = _find_short(table, keys[rows])
            else:
                at = np.minimum(np.searchsorted(table[0], keys[rows]), len(table[0]) - 1)
                hit = table[0][at] == keys[rows]
            for k in range(columns):
                out[rows[hit], k] = table[k - columns][at[hit]]
        return out

    def sums(self, level: int, contexts: np.ndarray, below: np.ndarray) -> np.ndarray:
        """Totals of distinct contexts; ``below`` says which were seen as grams of the order below."""
        out = np.zeros((len(contexts), _SUMS), np.int64)
        spread = np.isin(contexts, self.heavy[level])
        for name, some in (("contexts", ~spread), ("spread", spread)):
            keys = contexts[some]
            out[some] = self.find(
                f"{name}-{level}", buckets.bucket_of(keys, self.n), keys, _SUMS)
        out[(out[:, 0] == 0) & below & ~spread, :2] = 1
        return out

    def score(self, texts: pa.Array) -> tuple[np.ndarray, ...]:
        """(tokens, known tokens, base score, score) of each text; scores are log10."""
        tokens = Tokens(texts, self.order)
        words, place = np.unique(tokens.word, return_inverse=True)
        by = buckets.bucket_of(words, self.n)
        count = self.find("words", by, words, 1)[:, 0]
        base = np.log10((count + 0.5) / (self.tokens + 0.5 * (self.vocabulary + 1)))
        follows = self.find("grams-1", by, words, 1)[:, 0]
        low = self.low_mass / (self.vocabulary + 1)
        if self.continuations:
            low = low + (follows - self.discounts[1][np.minimum(follows, 3)]) / self.continuations
        chance = np.broadcast_to(low, words.shape)[place]
        starts = np.cumsum(tokens.counts) - tokens.counts
        seen = follows[place]
        for level in range(2, self.order + 1):
            context = tokens.context(level - 1)
            contexts, lead, which = _places(context)
            # A context is the gram of the order below that ends one token earlier.
            below = np.concatenate([[0], seen[:-1]]) > 0
            below[starts] = False
            sums = self.sums(level, contexts, below[lead])
            discount = self.discounts[level]
            total = np.maximum(sums[:, 0], 1)
            back = np.where(sums[:, 0] > 0, sums[:, 1:] @ discount[1:] / total, 1.0)
            keys, first, gram = _places(gram_key(context, tokens.word))
            found = self.find(f"grams-{level}", _placed(
                context[first], tokens.word[first], self.heavy[level], self.n), keys, 1)[:, 0]
            kept = (found - discount[np.minimum(found, 3)]) / total[which[first]]
            chance = kept[gram] + back[which] * chance
            seen = found[gram]
        add = lambda x: np.add.reduceat(x, starts) if len(starts) else np.zeros(0)
        return (tokens.counts, add((count > 0).astype(np.int64)[place]), add(base[place]),
                add(np.log10(chance)))


# Fewer maps than a process may hold by default on Linux.
@lru_cache(maxsize=1 << 15)
def _opened(uri: str) -> list[np.ndarray]:
    return store.load(store.mapped(uri))


def discounts(often: np.ndarray) -> np.ndarray:
    """Discounts of counts 0, 1, 2 and 3 or more, from how many grams have counts 1, 2, 3 and 4.

    Where there are too few grams for an estimate between 0 and the count, it is half the count, so
    every context leaves something for unseen words.
    """
    one, two = often[0], often[1]
    share = one / (one + 2 * two) if one else 0.5
    out = [0.0]
    for k in (1, 2, 3):
        value = k - (k + 1) * share * often[k] / often[k - 1] if often[k - 1] else 0.0
        out.append(float(value) if 0 < value < k else k / 2)
    return np.array(out)


def _words(rows: DataFrame, n: int, folder: str) -> list:
    """Where the tables of words lie, and what they hold."""
    return stage(rows.mapInArrow(_count_words(n), _ROWS)
                 .groupBy("bucket").applyInArrow(_add_up_words(folder), _ROWS), "lm-words").collect()


def _vocabulary(found: list, n: int) -> Vocabulary:
    files, words = {}, np.zeros(n + 1, np.int64)
    for row in found:
        uri, facts = store.load(bytes(row["payload"]))
        files[row["bucket"]], words[row["bucket"] + 1] = uri.tobytes().decode(), facts[0]
    return Vocabulary(files, np.cumsum(words))


def fit(docs: DataFrame, order: int = ORDER, column: str = "text") -> Model:
    """Count all documents and write the tables of the model."""
    rows = docs.select(F.col(f"`{column}`").alias("text"))
    n = buckets.bucket_count(buckets.text_bytes(rows), BUCKET_TEXT)
    heavy = _heavy(rows, order, n)
    folder = store.new_folder(docs.sparkSession, "lm")
    # One row for each bucket of each table.
    found = _words(rows, n, folder)
    vocabulary = docs.sparkSession.sparkContext.broadcast(_vocabulary(found, n))
    flow = rows.mapInArrow(_count(order, heavy, vocabulary, n), _ROWS)
    for level in range(order, 0, -1):
        flow = flow.groupBy("bucket").applyInArrow(
            _add_up(level, heavy, vocabulary, n, folder), _ROWS)
    found += stage(flow, "lm-files").collect()

    files: dict[tuple[str, int], str] = {}
    facts: dict[str, np.ndarray] = {}
    for row in found:
        uri, own = store.load(bytes(row["payload"]))
        name = {_TABLE: f"grams-{row['level']}", _TABLE + _CONTEXT: f"spread-{row['level']}",
                _TABLE + _WORD: "words", _OWN: f"contexts-{row['level']}"}[row["kind"]]
        files[name, row["bucket"]] = uri.tobytes().decode()
        facts[name] = facts.get(name, 0) + own
    often = [facts.get(f"grams-{k}", np.zeros(6, np.int64)) for k in range(order + 1)]
    model = Model(order, n, heavy, files, [discounts(o[:4]) for o in often])
    if "words" in facts:
        model.vocabulary, model.tokens = (int(x) for x in facts["words"])
        model.continuations = int(often[1][5])
        ones, twos, more = often[1][0], often[1][1], often[1][2:5].sum()
        model.low_mass = float(
            model.discounts[1][1:] @ [ones, twos, more]) / model.continuations
    return model


def with_scores(docs: DataFrame, model: Model, id_column: str = "doc_id",
                column: str = "text") -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score, perplexity) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{column}`").alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text.parts(batch, size=2 * text.PART_BYTES):
                n, known, base, score = shared.value.score(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(known, pa.int64()),
                     pa.array(base, pa.float64()), pa.array(score, pa.float64())],
                    ["doc_id", "n_tokens", "n_known", "base_score", "score"])

    schema = rows.select(
        "doc_id", F.lit(0).cast("long").alias("n_tokens"), F.lit(0).cast("long").alias("n_known"),
        F.lit(0.0).alias("base_score"), F.lit(0.0).alias("score")).schema
    return rows.mapInArrow(work, schema).withColumn(
        "perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
