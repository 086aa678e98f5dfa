"""Language, quality and language-model scores, decontamination and the pipeline."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from cohortline.llm import decontam, knlm, langid, quality, registry, text

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ALPHABETS = {"en": "thaeinos", "fr": "éèçeulan", "xx": "wkzvyqjp"}


def lowered(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s or "")


def prose(rng, lang, n):
    return " ".join("".join(rng.choice(ALPHABETS[lang]) for _ in range(rng.randint(2, 7)))
                    for _ in range(n))


# ---- language ------------------------------------------------------------------------------

def test_languages(frame, clash, spark):
    rng = random.Random(1)
    rows = [(i, prose(rng, lang, rng.randint(3, 60)), lang)
            for i, lang in enumerate(rng.choice(list(ALPHABETS)) for _ in range(150))]
    model = langid.fit(clash(frame(rows + [(500, "no language here", None)])))
    assert model.languages == sorted(ALPHABETS)
    fresh = [(i, prose(rng, lang, 12), lang) for i, lang in enumerate(list(ALPHABETS) * 10)]
    odd = [(900, None, None), (901, "123 !!", None), (902, "", None), (903, "Ⅷ ²", None)]
    found = {r.doc_id: r for r in langid.with_language(
        frame(fresh + odd).select("doc_id", "text"), model).collect()}
    assert all(found[i].lang_pred == lang and 0.5 < found[i].score <= 1 for i, _, lang in fresh)
    assert all(found[i].lang_pred == "und" and found[i].score == 0 for i, _, _ in odd)
    docs = clash(frame(fresh + odd))
    kept = langid.keep_identified(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, _, _ in fresh}


def grams_by_hand(s):
    s = re.sub(" +", " ", "".join(
        chr(langid._folding()[ord(c)]) for c in s))
    return Counter(s[i:i + n] for n in (1, 2, 3) for i in range(len(s) - n + 1))


@pytest.mark.parametrize("segment", [1, 2, 5, 16, 1 << 19])
def test_counts_of_whole_texts(monkeypatch, segment):
    monkeypatch.setattr(langid, "_SEGMENT", segment)
    texts = ["Ab  c1d", "", "é" * 50 + " x", "ab" * 40, "a" + "  1" * 30 + "b", "!" * 40, " x "]
    want = sum((grams_by_hand(t) for t in texts), Counter())

    def total():
        bins = np.zeros(langid.BINS, int)
        for letters, row, _, known in langid._segments(pa.array(texts)):
            for b, _ in langid._grams(letters, row, known):
                bins += np.bincount(b, minlength=langid.BINS)
        return bins

    by_hand = np.zeros(langid.BINS, int)
    for gram, n in want.items():
        letters = np.array([ord(c) for c in gram], np.uint32)
        *_, (b, _) = langid._grams(letters, np.zeros(len(letters), int))
        by_hand[b[0]] += n
    assert total().tolist() == by_hand.tolist()


def bayes_by_hand(learn, texts):
    """Language and posterior from dictionaries of hashed n-grams."""
    def bins(t):
        for gram, n in grams_by_hand(t).items():
            code = len(gram)
            for c in gram:
                code = ((code << 21) ^ ord(c)) & (1 << 64) - 1
            yield (code * 0x9E3779B97F4A7C15 & (1 << 64) - 1) >> 49, n
    counts, rows = defaultdict(Counter), Counter()
    for _, t, lang in learn:
        rows[lang] += 1
        for b, n in bins(t):
            counts[lang][b] += n
    out = []
    for t in texts:
        logs = {lang: math.log(rows[lang] / len(learn)) + sum(
            n * math.log((counts[lang][b] + 1) / (sum(counts[lang].values()) + langid.BINS))
            for b, n in bins(t)) for lang in sorted(rows)}
        best = max(logs, key=lambda lang: logs[lang])
        out.append((best, 1 / sum(math.exp(v - logs[best]) for v in logs.values())))
    return out


def test_languages_equal_a_plain_model(frame):
    rng = random.Random(4)
    learn = [(i, prose(rng, lang, rng.randint(1, 9)), lang)
             for i, lang in enumerate(rng.choice(list(ALPHABETS)) for _ in range(30))]
    mixed = [" ".join(prose(rng, lang, rng.randint(1, 3)) for lang in ALPHABETS) for _ in range(40)]
    found = langid.classify(langid.fit(frame(learn)), pa.array(mixed))
    want = bayes_by_hand(learn, mixed)
    assert found[0] == [lang for lang, _ in want]
    assert np.allclose(found[1], [score for _, score in want], atol=1e-4)


def test_nothing_to_learn(frame):
    model = langid.fit(frame([(1, "a b", None)]))
    rows = langid.with_language(frame([(1, "a b")]).select("doc_id", "text"), model).collect()
    assert [(r.lang_pred, r.score) for r in rows] == [("und", 0.0)]
    assert langid.with_language(frame([]).select("doc_id", "text"), model).count() == 0


def test_ties_go_to_the_first_language():
    model = langid.Model(["aa", "bb"], np.zeros((2, langid.BINS)), np.ones(2))
    assert langid.classify(model, pa.array(["same"]))[0] == ["aa"]


# ---- quality -------------------------------------------------------------------------------

def test_gradient():
    rng = np.random.default_rng(0)
    model = quality.Model(0.6)
    x = rng.normal(size=(12, quality.N_FEATURES))
    row = np.array([0, 0, 0, 1, 2, 2, 2, 2, 3, 3, 4, 4])
    y = np.array([1., 0, 1, 0, 1])

    def loss():
        s = model.forward(x, row)[0]
        return -(y * np.log(s) + (1 - y) * np.log(1 - s)).mean()
    slopes = model.gradient(x, row, y)
    for name, slope in slopes.items():
        value = np.atleast_1d(model.weights[name]).astype(float)
        at = tuple(int(k) // 2 for k in value.shape)
        sides = []
        for step in (1e-5, -1e-5):
            moved = value.copy()
            moved[at] += step
            model.weights[name] = moved.reshape(np.shape(slope))
            sides.append(loss())
        model.weights[name] = value.reshape(np.shape(slope))
        assert np.isclose((sides[0] - sides[1]) / 2e-5, np.atleast_1d(slope)[at], atol=1e-6)


def test_quality(frame, clash, spark):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(240):
        body = prose(rng, "en", rng.randint(20, 350))
        bad = i % 3 == 0
        # Only one stretch of a bad document is bad.
        if bad:
            words = body.split()
            at = rng.randrange(len(words))
            words[at:at + 60] = [w.upper() + "!!" for w in words[at:at + 60]]
            body = " ".join(words)
        rows.append((i, body))
        labels.append((i, 0 if bad else 1))
    table = spark.createDataFrame(labels + [(0, 0), (9999, 1), (None, 1), (3, None)],
                                  "doc_id bigint, quality int")
    docs = clash(frame(rows + [(700, None), (701, ""), (None, "x")]))
    model = quality.fit(docs, table.filter("doc_id is null or doc_id % 5 != 4"))
    found = {r.doc_id: r.score for r in quality.with_quality(docs, model).collect()}
    assert len(found) == 243 and all(0 <= s <= 1 for s in found.values())
    held = [(i, q) for i, q in labels if i % 5 == 4]
    assert np.mean([(found[i] >= 0.5) == (q == 1) for i, q in held]) > 0.9


def test_learning_sees_every_passage(frame, spark, monkeypatch):
    rng = random.Random(12)
    texts = [prose(rng, "en", 100 * n) for n in (70, 3)]
    seen = {}
    monkeypatch.setattr(quality, "train", lambda bags, y: seen.update(zip(y.tolist(), bags)))
    table = spark.createDataFrame([(0, 0), (1, 1)], "doc_id bigint, quality int")
    quality.fit(frame(list(enumerate(texts))), table)
    for y, t in enumerate(texts):
        assert np.array_equal(seen[y], quality.passages(pa.array([t]))[0])
    # Whole documents go when the budget is spent.
    assert quality.last_place([(5, 3), (-4, 6), (9, 2)], 9) == 5
    assert quality.last_place([(1, 20), (2, 6), (3, 4)], 9) == 2


def test_quality_without_labels(frame, spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    docs = frame([(1, "a"), (2, None)])
    rows = quality.with_quality(docs, quality.fit(docs, none)).collect()
    assert all(0 <= r.score <= 1 for r in rows) and len(rows) == 2
    one = spark.createDataFrame([(1, 1)], "doc_id bigint, quality int")
    assert all(r.score > 0.5 for r in quality.with_quality(docs, quality.fit(docs, one)).collect())
    assert quality.with_quality(frame([]), quality.Model()).count() == 0


def test_passages_of_any_text():
    texts = [None, "", " \n ", "a", "b " * 1000, "É" * 300, "x\ny\n" * 80]
    x, row = quality.passages(pa.array(texts, pa.string()))
    assert np.isfinite(x).all() and np.bincount(row).tolist() == [1, 1, 1, 1, 10, 1, 2]


def measures_by_hand(t):
    """One list of surface measures for each passage of a text."""
    raw = (t or "").encode()
    punct = [b for b in range(0x21, 0x7F) if not chr(b).isalnum()]

    def kind(b):
        if b in punct:
            return 6 + punct.index(b)
        if b == 0x0A:
            return 5
        c = chr(b)
        return 4 if b >= 0x80 else 1 if "A" <= c <= "Z" else 2 if "a" <= c <= "z" else \
            3 if "0" <= c <= "9" else 0
    words = list(re.finditer(rb"[^\x20\x09-\x0D]+", raw))
    out = []
    for k in range(0, max(1, len(words)), quality.PASSAGE):
        own = words[k:k + quality.PASSAGE]
        low = own[0].start() if own else 0
        after = words[k + quality.PASSAGE:k + quality.PASSAGE + 1]
        body = raw[low:after[0].start() if after else len(raw)]
        kinds = Counter(map(kind, body))
        n, w = len(own), [m.group() for m in own]
        small = [x.lower() for x in w]                     # bytes: A-Z only
        pairs = list(zip(small, small[1:]))
        mean = lambda values: sum(values) / max(1, n)
        out.append([math.sqrt(kinds[i] / max(1, len(body))) for i in range(6 + len(punct))] + [
            mean(map(len, w)) / 10,
            mean(not any(kind(b) in (1, 2, 4) for b in x) for x in w),
            mean(2 * sum(kind(b) == 1 for b in x) > len(x) for x in w),
            mean(kind(x[-1]) >= 6 for x in w),
            mean(a == b for a, b in pairs),
            len(set(small)) / max(1, n), len(set(pairs)) / max(1, len(pairs)),
            n / quality.PASSAGE, n == 0])
    return out


def quality_by_hand(model, t):
    p = {k: np.asarray(v).tolist() for k, v in model.weights.items()}
    sigmoid = lambda z: 1 / (1 + math.exp(-z))
    dot = lambda v, m, j: sum(a * line[j] for a, line in zip(v, m))
    coded, raw = [], []
    for x in measures_by_hand(t):
        z = [(a - c) / s for a, c, s in zip(x, model.center, model.scale)]
        h = [math.tanh(dot(z, p["W"], j) + p["b"][j]) for j in range(quality.HIDDEN)]
        coded.append(h)
        raw.append(sum(p["w"][j] * math.tanh(dot(h, p["V"], j)) * sigmoid(dot(h, p["U"], j))
                       for j in range(quality.ATTENTION)))
    share = [math.exp(r) / sum(map(math.exp, raw)) for r in raw]
    bag = [sum(a * h[j] for a, h in zip(share, coded)) for j in range(quality.HIDDEN)]
    return sigmoid(sum(a * c for a, c in zip(bag, p["c"])) + p["d"])


def test_scores_by_hand():
    rng = random.Random(21)
    texts = [None, "", " \n ", "a", "  Word word WORD! 12 é\n\n--", "x\ny\n" * 80,
             prose(rng, "en", 345), "ÉTÉ! " * 230 + "\n", "A b, " * 50 + " "]
    x, row = quality.passages(pa.array(texts, pa.string()))
    want = [(r, m) for r, t in enumerate(texts) for m in measures_by_hand(t)]
    assert row.tolist() == [r for r, _ in want]
    assert np.allclose(x, np.array([m for _, m in want], float), atol=1e-6)
    draw = np.random.default_rng(8)
    model = quality.Model(0.4)
    model.center, model.scale = draw.normal(size=quality.N_FEATURES), draw.uniform(
        0.5, 2, quality.N_FEATURES)
    model.weights["c"] = draw.normal(size=quality.HIDDEN)
    model.weights["b"] = draw.normal(size=quality.HIDDEN)
    scores = model.score(pa.array(texts, pa.string()))
    assert np.allclose(scores, [quality_by_hand(model, t) for t in texts], atol=1e-6)


# ---- language model ------------------------------------------------------------------------

def kneser_ney_by_hand(train, texts, order):
    def tokens(s):
        return [*WORD.findall(lowered(s)), "</s>"]
    top, words = Counter(), Counter()
    for s in train:
        seq = ["<s>"] * (order - 1) + tokens(s)
        words.update(tokens(s))
        for i in range(order - 1, len(seq)):
            top[tuple(seq[i - order + 1:i + 1])] += 1
    counts = {order: top}
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    marks = {k: knlm.discounts(np.array([sum(v == c for v in counts[k].values())
                                         for c in (1, 2, 3, 4)])) for k in counts}
    contexts = {k: defaultdict(list) for k in counts}
    for k in counts:
        for g, c in counts[k].items():
            contexts[k][g[:-1]].append(c)

    def chance(gram):
        if not gram:
            return 1 / (len(words) + 1)
        k = len(gram)
        here = contexts[k].get(gram[:-1])
        if not here:
            return chance(gram[1:])
        c = counts[k].get(gram, 0)
        back = sum(marks[k][min(x, 3)] for x in here)
        return (c - marks[k][min(c, 3)] + back * chance(gram[1:])) / sum(here)
    out = []
    total, known = sum(words.values()), len(words)
    for s in texts:
        seq = ["<s>"] * (order - 1) + tokens(s)
        grams = [tuple(seq[i - order + 1:i + 1]) for i in range(order - 1, len(seq))]
        out.append((
            len(grams), sum(words[t] > 0 for t in tokens(s)),
            sum(math.log10((words[t] + .5) / (total + .5 * (known + 1))) for t in tokens(s)),
            sum(math.log10(chance(g)) for g in grams)))
    return out, total


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_language_model(frame, clash, order):
    rng = random.Random(order)
    vocab = [f"w{i}" for i in range(40)] + ["Word", "ÉTÉ", "été"]
    draw = lambda n: " ".join(vocab[int(rng.paretovariate(0.7)) % len(vocab)] for _ in range(n))
    rows = [(i, draw(rng.randint(0, 60))) for i in range(80)] + [(90, None), (91, ""), (91, "")]
    fresh = [(i, draw(rng.randint(0, 30)) + rng.choice(["", " never-seen"])) for i in range(100, 130)]
    model = knlm.fit(clash(frame(rows)), order)
    found = {r.doc_id: r for r in knlm.with_scores(frame(fresh + [(7, None)]), model).collect()}
    want, total = kneser_ney_by_hand([t for _, t in rows], [t for _, t in fresh] + [None], order)
    assert model.tokens == total
    for (i, _), (n, known, base, score) in zip([*fresh, (7, None)], want):
        row = found[i]
        assert (row.n_tokens, row.n_known) == (n, known)
        assert math.isclose(row.base_score, base, rel_tol=1e-9)
        assert math.isclose(row.score, score, rel_tol=1e-9), (i, row.score, score)
        assert math.isclose(row.perplexity, 10 ** (-score / n), rel_tol=1e-6)


@pytest.mark.parametrize("step", [1, 2])
def test_spread_contexts_change_no_score(frame, monkeypatch, step):
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choice("abcdefgh") for _ in range(50))) for i in range(60)]
    plain = knlm.fit(frame(rows), 3)
    tokens = knlm.Tokens(pa.array([t for _, t in rows]), 3)
    some = [np.unique(tokens.context(k))[::step] for k in (1, 2)]
    monkeypatch.setattr(knlm, "_heavy", lambda *a: [some[0][:0], some[0][:0], *some])
    spread = knlm.fit(frame(rows), 3)
    texts = pa.array(["a b c d", "d z", "", rows[0][1], "h g f e d c b a"])
    assert np.allclose(plain.score(texts)[3], spread.score(texts)[3], rtol=1e-12)


def test_heavy_context_of_one_document_is_found(frame):
    rows = [(i, f"x{i} y{i} z{i}") for i in range(300)] + [
        (999, " ".join(f"the w{i}" for i in range(400)))]
    heavy = knlm._heavy(frame(rows).select("text"), 2, 16)
    the = knlm.Tokens(pa.array(["the the"]), 2).context(1)[1]
    assert the in heavy[2] and len(heavy[2]) <= 64


def test_short_keys_find_what_is_there():
    rng = np.random.default_rng(3)
    for rows in (1, 2, 40, 5000):
        keys = np.unique(rng.integers(0, 1 << 64, rows, dtype=np.uint64))
        other = rng.integers(0, 1 << 64, 3000, dtype=np.uint64)
        table = knlm._shortened(keys)
        place, hit = knlm._find_short(table, keys)
        assert hit.all() and (place == np.arange(len(keys))).all()
        assert not knlm._find_short(table, other)[1].any()
        ends = np.array([0, (1 << 64) - 1], np.uint64)
        assert not knlm._find_short(table, ends)[1].any()


def test_distinct_grams_beyond_one_word():
    rng = np.random.default_rng(4)
    columns = [rng.integers(0, 3, 500) * (1 << 30) for _ in range(3)]
    first, total = knlm._distinct(columns, 1 << 32, None)
    want = Counter(zip(*[c.tolist() for c in columns]))
    assert [tuple(int(c[i]) for c in columns) for i in first] == sorted(want)
    assert total.tolist() == [want[g] for g in sorted(want)]


def test_words_have_numbers(spark, frame):
    rng = random.Random(31)
    rows = [(i, " ".join(f"w{rng.randint(0, 900)}" for _ in range(40))) for i in range(50)]
    n = 16
    found = knlm._words(frame(rows).select("text"), n, knlm.store.new_folder(spark, "lm"))
    vocabulary = knlm._vocabulary(found, n)
    tokens = knlm.Tokens(pa.array([t for _, t in rows]), 3)
    words = np.unique(tokens.all)
    numbers = vocabulary.numbers(words)
    assert sorted(numbers.tolist()) == list(range(len(vocabulary))) == list(range(len(words)))
    assert numbers[words == knlm._BEGIN] == len(words) - 1
    mixed = np.random.default_rng(5).permutation(len(words))
    assert (vocabulary.hashes(numbers[mixed]) == words[mixed]).all()
    assert len(vocabulary.numbers(words[:0])) == len(vocabulary.hashes(numbers[:0])) == 0


def test_rare_words_take_little_room_on_the_way():
    """Three places of words that occur once, with their hashes, are 24 bytes a gram."""
    rng = np.random.default_rng(6)
    words = np.unique(rng.integers(0, 1 << 64, 30000, dtype=np.uint64))
    numbers = np.arange(len(words)) * 3
    columns = [rng.permutation(len(words)).astype(np.int32) for _ in range(3)]
    batch = knlm._send_grams(3, numbers, words, 3 * len(words), columns, words[:0], 16)
    payload = batch.column("payload").to_pylist()
    assert sum(map(len, payload)) < 12 * len(words)
    grams = set()
    for own, total, *places in map(knlm._grams, payload):
        assert (total == 1).all()
        grams |= set(zip(*[own[p].tolist() for p in places]))
    assert grams == set(zip(*[numbers[c].tolist() for c in columns]))


def test_held_out_texts_are_likelier_under_higher_orders(frame):
    rng = random.Random(12)
    after = {(a, b): rng.choices("abcdefgh", k=2) for a in "abcdefgh" for b in "abcdefgh"}

    def draw():
        words = [rng.choice("abcdefgh"), rng.choice("abcdefgh")]
        for _ in range(60):
            words.append(rng.choice(after[words[-2], words[-1]]))
        return " ".join(words)
    rows = [(i, draw()) for i in range(150)]
    fresh = pa.array([draw() for _ in range(20)])
    scores = [knlm.fit(frame(rows), k).score(fresh)[3].sum() for k in (1, 2, 3)]
    assert scores[0] < scores[1] < scores[2]


def test_model_of_nothing(frame):
    model = knlm.fit(frame([]), 2)
    rows = knlm.with_scores(frame([(1, "a b"), (2, None)]), model).collect()
    assert {(r.doc_id, r.n_tokens, r.n_known, round(r.score, 9)) for r in rows} == {
        (1, 3, 0, 0.0), (2, 1, 0, 0.0)}


# ---- decontamination -----------------------------------------------------------------------

def leaks_by_hand(rows, items, window):
    wanted = defaultdict(set)
    for i, t in items:
        w = ITEM_WORD.findall(lowered(t))
        for k in range(max(1, len(w) - window + 1) if w else 0):
            wanted[tuple(w[k:k + window])].add(None if i is None else str(i))
    out = []
    for i, t in rows:
        w, hit, found = ITEM_WORD.findall(lowered(t)), set(), set()
        for n in {len(x) for x in wanted}:
            for k in range(len(w) - n + 1):
                if (x := tuple(w[k:k + n])) in wanted:
                    hit |= set(range(k, k + n))
                    found |= wanted[x]
        out.append((i, len(w), len(hit),
                    sorted(found - {None}) + [None] * (None in found)))
    return out


def leaking():
    rng = random.Random(4)
    vocab = ["a", "b", "the", "of", "Été", "x9"] + [f"v{i}" for i in range(60)]
    draw = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [(i, draw(rng.choice([1, 2, 3, 5, 9, 10, 11, 40]))) for i in range(30)]
    items += [(0, items[0][1]), (0, items[0][1])]
    items += [(None, draw(14)), (None, draw(7)), (None, items[6][1])]
    items += [(100, items[3][1]), (101, items[4][1][:20]), (102, ["the"] * 12)]
    rows = []
    for i in range(120):
        w = draw(rng.randint(0, 40))
        if rng.random() < 0.4:
            body = rng.choice(items)[1]
            a = rng.randrange(len(body))
            w += body[a:a + rng.randint(1, 40)] + draw(3)
        rows.append((i, rng.choice([" ", ", ", "\n--"]).join(w).replace("the", "THE")))
    nameless = " ".join(next(w for i, w in items if i is None))
    rows += [(510, nameless), (511, nameless + " / " + " ".join(items[2][1]))]
    rows += [(500, None), (501, ""), (502, "the " * 30), (None, " ".join(items[5][1]))]
    return rows, [(i, " ".join(w)) for i, w in items] + [(200, None), (201, "?!"), (1, "again it")]


@pytest.mark.parametrize("slice_bytes", [1 << 20, 200])
def test_decontamination(frame, clash, spark, monkeypatch, slice_bytes):
    monkeypatch.setattr(decontam, "SLICE_BYTES", slice_bytes)
    rows, items = leaking()
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontam.contamination(clash(frame(rows)), clash(bench)).collect()
    want = leaks_by_hand(rows, items, 10)
    assert any(i == [None] for *_, i in want) and any(None in i and len(i) > 1 for *_, i in want)
    assert sorted(map(str, ((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in found))) == sorted(
        map(str, want))
    docs = clash(frame(rows))
    kept = decontam.decontaminate(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(
        str(i) for i, _, n, _ in want if not n)


def test_decontamination_without_items(frame, spark):
    bench = spark.createDataFrame([], "item_id bigint, text string")
    rows = decontam.contamination(frame([(1, "a b")]), bench).collect()
    assert [(r.n_words, r.n_hit, r["items"]) for r in rows] == [(2, 0, [])]
    assert decontam.contamination(frame([]), bench).count() == 0


# ---- pipeline ------------------------------------------------------------------------------

def test_pipeline(frame, folder, spark, clash):
    rng = random.Random(6)
    rows, items = [], [(1, prose(rng, "en", 30))]
    for i in range(100):
        lang = list(ALPHABETS)[i % 3]
        rows.append((i, prose(rng, lang, rng.randint(80, 300)), lang))
    rows[10] = (10, rows[9][1], rows[9][2])                                    # exact copy
    rows[20] = (20, rows[19][1].replace(" ", "\n "), rows[19][2])              # the same, spaced
    words = rows[29][1].split()
    rows[30] = (30, " ".join([*words[:-1], "z"]) + " ", rows[29][2])           # near copy, maybe
    rows[40] = (40, rows[40][1] + " " + items[0][1], "en")                     # leak
    rows[50], rows[51] = (50, "12345 !!", None), (51, None, None)              # no letters
    docs = clash(frame(rows))
    root = folder(documents=docs, benchmark=spark.createDataFrame(items, "item_id bigint, text string"))
    packed = corpus_pipeline.run(spark, root).collect()
    from llm.test_dedup import groups_by_hand, print_by_hand
    left = [r for r in rows if r[0] not in (10, 20, 50, 51)]
    want = {left[k][0] for k in set(groups_by_hand([print_by_hand(t) for _, t, _ in left]))} - {40}
    assert {r.doc_id for r in packed} == want
    assert all(r.n_tokens == len(WORD.findall(dict((i, t) for i, t, _ in rows)[r.doc_id])) + 1
               for r in packed)
    now = docs
    for name, step in corpus_pipeline.STAGES[:-1]:
        now = step(spark, now, root)
        assert now.columns == docs.columns, name


def test_pipeline_of_nothing(frame, folder, spark):
    root = folder(documents=frame([]),
                  benchmark=spark.createDataFrame([], "item_id bigint, text string"))
    assert corpus_pipeline.run(spark, root).count() == 0


def test_registered_queries_have_the_contract_columns(spark):
    sf = "/root/testdata/sf0.001"
    want = {
        "op1_language_id": {"doc_id", "held_out", "lang_pred", "score"},
        "op7_quality": {"doc_id", "held_out", "score", "predicted"},
        "op10_lm_scores": {"doc_id", "held_out", "n_tokens", "n_known", "train_tokens",
                           "base_score", "score"}}
    for name, columns in want.items():
        assert columns <= set(registry.QUERIES[name](spark, sf).columns)
    assert text.PART_BYTES > 0
