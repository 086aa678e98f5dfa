"""Token files, separator scan and packing against plain code."""

import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from cohortline.llm import dac, packing, store, token_scan, tokenise

TEXTS = [
    "Plain words, twice. Plain WORDS!", None, "", "  ", "don't can't 'quoted' dogs' x'. it's.'",
    "<|endoftext|> a<|endoftext|>b <|STARTOFTEXT|> <b>Bold</b> <", "ÉTÉ café… “quoted”. naïve's ≠ ≠.",
    "a b c\n\td\x0be", "12 345.67 $9,99 #tag @me ... --- ...", "İstanbul ΣΑΣ Σ. ǅ", "é. É!",
    "日本語 テスト。 mixed日本 x", "KK Å", "🙂🙂 ok.🙂 x🙂. 🙂.", "a" * 3000, "%%% word%%% word###", "''' '''. '",
    "\x00 ctrl \x1f\x7f", "a.b.c. a..b U.S.A.", "<", "x<.", "<'.",
]


def random_texts(n, seed=0):
    rng = random.Random(seed)
    alphabet = "aAbBzZ019.,'!<>|#éÉß́ \n 日🙂"
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(n)]


@pytest.mark.parametrize("as_text", [False, True])
def test_encoder_equals_the_library(public, as_text):
    library = Tokenizer.from_file(public)
    library.encode_special_tokens = as_text
    texts = TEXTS + random_texts(400)
    want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    encoder = tokenise.Encoder(public, as_text)
    for _ in range(2):
        ids, counts = encoder.encode(pa.array(texts, pa.string()))
        assert counts.tolist() == list(map(len, want))
        assert ids.tolist() == list(itertools.chain.from_iterable(want))


def test_encoder_with_a_small_table(public, monkeypatch):
    monkeypatch.setattr(tokenise, "_MOST_WORDS", 10)
    library = Tokenizer.from_file(public)
    texts = TEXTS + random_texts(50, 4)
    ids, _ = tokenise.Encoder(public).encode(pa.array(texts, pa.string()))
    assert ids.tolist() == [
        i for t in texts for i in library.encode(t or "", add_special_tokens=False).ids]


@pytest.mark.parametrize("top", [1, 256, 257, 49408, 1 << 20, (1 << 32) - 1])
def test_codes_round_trip(top):
    rng = np.random.default_rng(top)
    ids = rng.integers(0, top, 5000, dtype=np.uint32, endpoint=top > 1 and top < (1 << 32) - 1)
    codes = dac.Codes(store.load(store.dump(*dac.encode(ids))))
    assert (codes.all() == ids).all() and len(codes) == len(ids)
    at = rng.integers(0, len(ids), 3000)
    assert (codes.get(at) == ids[at]).all()
    assert codes.get(np.zeros(0, np.int64)).tolist() == []


def by_hand(public, rows, end):
    library = Tokenizer.from_file(public)
    start, out = 0, []
    for i, t in sorted(rows):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, end]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("segment", [64, 1 << 18])
def test_token_files(frame, clash, public, monkeypatch, segment):
    monkeypatch.setattr(dac, "SEGMENT", segment)
    rows = list(zip(range(5, 5 + len(TEXTS)), TEXTS)) + [(-3, "first"), (900, "word " * 20000)]
    docs = clash(frame(rows)) if segment > 64 else frame(rows)
    # Workers read the module's own segment size, so the small one is tried in this process.
    if segment > 64:
        manifest = dac.write_tokens(docs, public, 2)
        found = sorted(tuple(r) for r in dac.read_documents(manifest).collect())
        assert found == by_hand(public, rows, 2)
        library = Tokenizer.from_file(public)
        ids = [i for _, t in sorted(rows)
               for i in [*library.encode(t or "", add_special_tokens=False).ids, 2]]
        files = [dac.File(r.file) for r in manifest.orderBy("part").collect()]
        low = 0
        for file in files:
            at = np.random.default_rng(1).integers(0, file.tokens, 200)
            assert file.get(at).tolist() == [ids[low + k] for k in at.tolist()]
            low += file.tokens
        assert low == len(ids)


def test_writer_across_segments(tmp_path, monkeypatch):
    monkeypatch.setattr(dac, "SEGMENT", 64)
    writer, rng, every = dac._Writer(str(tmp_path), 0), np.random.default_rng(0), []
    for n in (0, 10, 200, 64, 1):
        ids = rng.integers(0, 49408, n, dtype=np.uint32)
        writer.add(ids)
        every.append(ids)
        writer.ids.append(np.array([n]))
        writer.known.append(np.array([True]))
        writer.counts.append(np.array([n]))
    file = dac.File(writer.close().column("file")[0].as_py())
    every = np.concatenate(every)
    assert file.get(np.arange(len(every))).tolist() == every.tolist()
    assert file.first.tolist() == [0, 0, 10, 210, 274, 275]


def test_token_files_without_rows_or_ids(frame, public):
    assert dac.read_documents(dac.write_tokens(frame([]), public, 2)).count() == 0
    rows = dac.read_documents(dac.write_tokens(
        frame([(None, "a b"), (1, "c"), (None, None), (1, "c")]), public, 2)).collect()
    assert [(r.doc_id, r.n_tokens) for r in sorted(rows, key=lambda r: r.start)] == [
        (None, 1), (None, 3), (1, 2), (1, 2)]


# ---- separator scan ------------------------------------------------------------------------

@pytest.mark.parametrize("block", [2, 6, 64, 4096])
def test_scan_stitches_blocks_and_files(spark, tmp_path, block):
    rng, end = random.Random(block), 9
    stream = [rng.choice([1, 2, 3, 4, 9]) if rng.random() < 0.7 else 1 for _ in range(700)]
    cuts = [0, 0, 13, 14, 300, 301, 650, 700]
    files = []
    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
        uri, out = store.create(str(tmp_path), f"f{k}")
        out.write(np.array(stream[a:b], "<u2").tobytes())
        out.close()
        files.append((k // 2, k, uri, 2 * (b - a)))
    table = spark.createDataFrame(files, "part int, turn int, file string, bytes long")
    want, at = [], 0
    for k, x in enumerate(stream):
        if x == end:
            want.append((len(want), at, k - at, True))
            at = k + 1
    if at < len(stream):
        want.append((len(want), at, len(stream) - at, False))
    found = token_scan.count_tokens(table, end, block_bytes=block).collect()
    assert sorted((r.document, r.start, r.n_tokens, r.closed) for r in found) == want


def test_token_counts(frame, clash, public):
    rows = list(zip(range(len(TEXTS)), TEXTS)) + [(None, "no id"), (3, "again")]
    files, names = token_scan.write_flat(clash(frame(rows)), public, 49407)
    found = token_scan.count_tokens(files, 49407).join(
        names, ["part", "turn", "ordinal"]).collect()
    library = Tokenizer.from_file(public)
    library.encode_special_tokens = True
    want = [(i, len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in rows]
    assert sorted(map(str, ((r.doc_id, r.n_tokens) for r in found))) == sorted(map(str, want))


def test_ids_beyond_the_width_are_refused(frame, public):
    files, _ = token_scan.write_flat(frame([(1, "ab")]), public, 70_000, width=4)
    assert [r.n_tokens for r in token_scan.count_tokens(files, 70_000, width=4).collect()]
    with pytest.raises(Exception, match="70000 does not fit 2 bytes"):
        token_scan.write_flat(frame([(1, "ab")]), public, 70_000)


def test_token_counts_of_nothing(frame, public):
    files, names = token_scan.write_flat(frame([]), public, 49407)
    assert token_scan.count_tokens(files, 49407).count() == 0 and names.count() == 0


# ---- packing -------------------------------------------------------------------------------

def padding(bounds, lengths, counts):
    return sum(c * (min(b for b in bounds if b >= n) - n) for n, c in zip(lengths, counts))


@pytest.mark.parametrize("seed", range(30))
def test_boundaries_are_optimal(seed):
    rng = random.Random(seed)
    lengths = sorted(rng.sample(range(1, 60), rng.randint(1, 9)))
    counts = [rng.randint(1, 20) for _ in lengths]
    most = rng.randint(1, 5)
    bounds = packing.boundaries(np.array(lengths), np.array(counts), most)
    assert bounds == sorted(set(bounds)) and len(bounds) <= most and bounds[-1] == lengths[-1]
    best = min(padding([*inner, lengths[-1]], lengths, counts)
               for k in range(most) for inner in itertools.combinations(lengths[:-1], k))
    assert padding(bounds, lengths, counts) == best


def packed_by_hand(rows, longest, most, budget):
    pieces = sorted(
        (i, k, min(longest, n - k * longest)) for i, n in rows for k in range(-(-n // longest)))
    lengths, counts = np.unique([p[2] for p in pieces], return_counts=True)
    bounds = packing.boundaries(lengths, counts, most)
    out, seen = [], {}
    for i, k, n in pieces:
        bucket = min(b for b in bounds if b >= n)
        rank = seen[bucket] = seen.get(bucket, -1) + 1
        per = max(1, budget // bucket)
        out.append((i, k, n, bucket, rank // per, rank % per))
    return out


def test_packing(spark):
    rng = random.Random(8)
    rows = [(i * 7 % 501, max(1, int(rng.paretovariate(1) * 5))) for i in range(501)]
    table = spark.createDataFrame(rows, "doc_id bigint, n bigint").repartition(7)
    found = packing.pack(table, 50, 4, 120).collect()
    assert sorted(map(tuple, found)) == packed_by_hand(rows, 50, 4, 120)


def test_packing_of_documents(frame, clash):
    rows = [(1, None), (2, ""), (3, "a b c"), (None, "x"), (3, "a b c"), (4, "w " * 9000)]
    found = packing.pack(packing.word_lengths(clash(frame(rows)))).collect()
    assert sorted(map(str, ((r.doc_id, r.piece, r.n_tokens) for r in found))) == sorted(map(str, [
        (1, 0, 1), (2, 0, 1), (3, 0, 4), (None, 0, 2), (3, 0, 4),
        (4, 0, 4096), (4, 1, 4096), (4, 2, 809)]))
    assert packing.pack(packing.word_lengths(frame([]))).count() == 0
