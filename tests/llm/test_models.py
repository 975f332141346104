"""Toxicity and language identification: held-out accuracy, exact forward sums, awkward rows."""

import math
import random

import numpy as np
import pyarrow as pa

from tests.llm.brute import language_model, language_of, segmentations, toxic_scores
from tests.llm.helpers import DOCS, awkward, docs, rows, words
from tidemark.llm import language_id, toxicity
from tidemark.llm import textkit as tk

LABELS = "doc_id long, quality int, toxic int"


def labelled(spark, n=400, size=400):
    r = random.Random(3)
    data, labels = [], []
    for i in range(n):
        bad = i % 5 == 0
        w = words(r.randrange(20, 200), i, size).split()
        if bad:
            for _ in range(3):
                w.insert(r.randrange(len(w)), r.choice(["vile", "scumbag", "rotten"]))
        data.append((i, " ".join(w)))
        labels.append((i, 1, int(bad)))
    return docs(spark, data), spark.createDataFrame(labels, LABELS)


def test_toxicity_generalises(spark):
    data, labels = labelled(spark)
    got = {r.doc_id: r.toxic for r in toxicity.toxicity(data, labels.where("doc_id < 300")).where("doc_id >= 300").collect()}
    wrong = [i for i, t in got.items() if t != (i % 5 == 0)]
    assert len(got) == 100 and len(wrong) <= 2
    model = toxicity.train(data, labels)
    assert 0 < len(model.places) < 2000
    kept = toxicity.drop_toxic(data, labels)
    assert kept.columns == data.columns and 310 <= kept.count() <= 330


def test_ftrl_matches_the_textbook_update():
    xs, y = [np.array([0, 2, 4]), np.array([1, 2, 4]), np.array([0, 4])], np.array([1.0, 0.0, 1.0])
    z, n = [0.0] * 5, [0.0] * 5
    a, b, l1, l2 = 0.3, 1.0, 0.1, 1.0

    def weight(i):
        if i == 4:
            return -z[i] * a / (b + math.sqrt(n[i]))
        return 0.0 if abs(z[i]) <= l1 else -(z[i] - math.copysign(l1, z[i])) / ((b + math.sqrt(n[i])) / a + l2)

    for _ in range(3):
        for x, t in zip(xs, y):
            w = {i: weight(i) for i in x}
            g = 1 / (1 + math.exp(-sum(w.values()))) - t
            for i in x:
                s = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / a
                z[i] += g - s * w[i]
                n[i] += g * g
    got = toxicity.ftrl(xs, y, np.ones(3), 4, l1, 3, a, b, l2)
    assert np.allclose(got, [weight(i) for i in range(5)])


def hashes(spark, ids):
    df = spark.createDataFrame([(i,) for i in ids], "id long").selectExpr("id", "pmod(xxhash64(id), 9223372036854775807) AS h")
    return {r.id: r.h for r in df.collect()}


def test_toxicity_equals_a_plain_version(spark):
    data, labels = labelled(spark, 240, 20)  # so few features that no two share a place
    extra = docs(spark, [(900, ""), (901, "vile, VILE scumbag!"), (902, "w1 w2 w3"), (903, None)])
    texts = {r.doc_id: r.text for r in data.unionByName(extra).collect()}
    y = {r.doc_id: r.toxic for r in labels.collect()}
    want = toxic_scores(texts, y, hashes(spark, texts), l1=3.0)
    got = {r.doc_id: (r.score, r.toxic) for r in toxicity.toxicity(data.unionByName(extra), labels, l1=3.0).collect()}
    assert got.keys() == want.keys() and len({t for _, t in want.values()}) == 2
    assert all(math.isclose(got[i][0], want[i][0], rel_tol=1e-4, abs_tol=1e-6) and got[i][1] == want[i][1] for i in want)


def test_toxicity_awkward_rows(spark):
    _, labels = labelled(spark, 10)
    for wide in (False, True):
        data = docs(spark, awkward(), wide)
        got = rows(toxicity.toxicity(data, labels))
        assert len(got) == len(awkward()) and not any(t for i, s, t in got if i in (1, 2, 3, 4))
        assert toxicity.drop_toxic(data, labels).columns == data.columns
    none, no_labels = spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)
    assert rows(toxicity.toxicity(none, labels)) == []
    assert toxicity.drop_toxic(docs(spark, awkward()), no_labels).count() == len(awkward())
    odd = spark.createDataFrame([(None, 1, 1), (5, None, None), (5, 1, 1), (5, 1, 0), (10, 0, 0)], LABELS)
    assert toxicity.toxicity(docs(spark, awkward()), odd).count() == len(awkward())


def test_forward_sums_all_segmentations():
    pieces = sorted({b" ", b"a", b"b", b" a", b"ab", b"aba", b"ba"})
    known = language_id.Pieces(pieces)
    p = np.array([[0.1 + 0.05 * i, 0.2 - 0.02 * i] for i in range(len(pieces))])
    words_ = [b"abab", b"a", b"b" * 90, b"ab" * 400]
    data = np.frombuffer(b"".join(words_), np.uint8)
    end = np.cumsum([len(w) for w in words_])
    got = language_id.word_logs(known, p * (language_id.SCALE ** known.sizes)[:, None], data, end - [len(w) for w in words_], end)
    for k, w in enumerate(words_):
        raw = b" " + w
        for x in range(2):
            f = [0.0] + [-math.inf] * len(raw)
            for t in range(1, len(raw) + 1):
                terms = [f[s] + math.log(p[pieces.index(raw[s:t]), x]) for s in range(max(0, t - 4), t) if raw[s:t] in pieces]
                top = max(terms)
                f[t] = top + math.log(sum(math.exp(v - top) for v in terms)) if top > -math.inf else -math.inf
            assert math.isclose(got[k, x], f[-1], rel_tol=1e-9)


def test_words_sum_all_their_segmentations():
    pieces = sorted({bytes([b]) for b in b" abc"} | {b" a", b"ab", b"abc", b"bc", b" abca", b"ca"})
    known = language_id.Pieces(pieces)
    r = random.Random(1)
    p = np.array([[r.uniform(0.01, 0.4), r.uniform(0.01, 0.4)] for _ in pieces])
    words_ = ["".join(r.choices("abc", k=n)).encode() for n in range(1, 11)]
    end = np.cumsum([len(w) for w in words_])
    got = language_id.word_logs(known, p * (language_id.SCALE**known.sizes)[:, None], np.frombuffer(b"".join(words_), np.uint8), end - [len(w) for w in words_], end)
    for k, w in enumerate(words_):
        ways = segmentations(b" " + w, pieces)
        for x in range(2):
            assert math.isclose(got[k, x], math.log(sum(math.prod(p[pieces.index(q), x] for q in way) for way in ways)), rel_tol=1e-9)


def test_languages_equal_an_enumeration(spark, monkeypatch):
    pieces = sorted({bytes([b]) for b in b" abcd"} | {b" ab", b"cd", b"abc", b"dd", b" c", b"ba"})
    monkeypatch.setattr(language_id, "load", lambda path: pieces)
    r = random.Random(9)
    style = {"x": "aabbbc", "y": "ccdda", "z": "abcd"}
    data = [(i, " ".join("".join(r.choices(style[lang], k=r.randrange(1, 7))) for _ in range(r.randrange(1, 9))), lang if i < 60 else None, "s") for i in range(90) for lang in [r.choice("xyz")]]
    models = {x: language_model([t for _, t, lang, _ in data if lang == x], pieces, 3, 0.05) for x in style}
    got = {q.doc_id: q for q in language_id.languages(docs(spark, data), rounds=3).collect()}
    for i, t, *_ in data:
        lang, margin = language_of(t, models, pieces)
        assert got[i].language == lang and math.isclose(got[i].margin, margin, rel_tol=1e-6, abs_tol=1e-9)


def test_every_piece_of_the_vocabulary_counts():
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=language_id.VOCABULARY)
    names = {sp.id_to_piece(k).lower().replace("▁", " ").encode() for k in range(sp.get_piece_size()) if not (sp.is_control(k) or sp.is_unknown(k) or sp.is_byte(k))}
    inside = {x for x in names if x and x.rfind(b" ") < 1 and all(tk._WORD_BYTE[b] for b in x.lstrip(b" "))}
    assert inside <= set(language_id.load())


def test_em_never_lowers_the_likelihood():
    pieces = sorted({bytes([b]) for b in b" abcd"} | {b" ab", b"cd", b"abc"})
    known = language_id.Pieces(pieces)
    texts = pa.array(["abcd abab ab cd abc", "ab ab abcd"])
    last = -math.inf
    for rounds in range(1, 5):
        p = language_id.fit(known, texts, rounds, 1e-9)
        w = __import__("tidemark.llm.textkit", fromlist=["x"]).words_of(texts)
        now = language_id.word_logs(known, (p * language_id.SCALE**known.sizes)[:, None], w.data, w.start, w.end).sum()
        assert now >= last - 1e-9
        last = now


def test_language_held_out(spark):
    syllables = {"aa": ["ka", "to", "mi", "sun"], "bb": ["schl", "ung", "eit", "ver"], "cc": ["tion", "eau", "que", "ré"]}
    r = random.Random(5)
    data = []
    for i in range(300):
        lang = r.choice(sorted(syllables))
        text = " ".join("".join(r.choices(syllables[lang], k=r.randrange(1, 4))) for _ in range(r.randrange(3, 40)))
        data.append((i, text, lang if i < 200 else None, "s"))
    truth = {i: next(x for x in syllables if any(s in t for s in syllables[x])) for i, t, _, _ in data}
    got = {r_.doc_id: r_.language for r_ in language_id.languages(docs(spark, data)).collect()}
    assert sum(got[i] == truth[i] for i in range(200, 300)) >= 98


def test_long_words_count_in_the_fit():
    pieces = sorted({bytes([b]) for b in b" abcd"} | {b" ab", b"cd", b"abc"})
    known = language_id.Pieces(pieces)
    short = ["abcdab", "ab", "cdabc"]
    data, end = np.frombuffer("".join(short).encode(), np.uint8), np.cumsum([len(x) for x in short])
    n = np.array([len(x) for x in short])
    q = np.linspace(0.05, 0.3, len(pieces)) * language_id.SCALE**known.sizes
    got = language_id.long_counts(known.edges(data, end - n, end), n + 1, q, np.array([1, 2, 3]))
    want = np.zeros(len(pieces))

    def segments(raw):
        return [[]] if not raw else [[k, *x] for k, p in enumerate(pieces) if raw.startswith(p) for x in segments(raw[len(p) :])]

    for x, times in zip(short, (1, 2, 3)):
        ways = segments(b" " + x.encode())
        weight = [math.prod(q[k] for k in way) for way in ways]
        for way, v in zip(ways, weight):
            for k in way:
                want[k] += times * v / sum(weight)
    assert np.allclose(got, want)
    texts = pa.array(["ab" * 40, "abcd" * 30 + " abc", "cd" * 5000])
    w = tk.words_of(texts)
    last = -math.inf
    for rounds in range(1, 5):
        p = language_id.fit(known, texts, rounds, 1e-9)
        now = language_id.word_logs(known, (p * language_id.SCALE**known.sizes)[:, None], w.data, w.start, w.end).sum()
        assert np.isfinite(p).all() and now >= last - 1e-6
        last = now


def test_languages_whose_words_are_all_long(spark):
    letters = {"ja": "あいうえおかきくけこさしすせそ。", "zh": "的一是在不了有和人这中大为上个，"}
    r = random.Random(6)
    data = []
    for i in range(120):
        lang = r.choice(sorted(letters))
        data.append((i, "".join(r.choices(letters[lang], k=r.randrange(22, 300))), lang if i < 80 else None, "s"))
    truth = {i: next(x for x in letters if t[0] in letters[x]) for i, t, _, _ in data}
    got = {x.doc_id: x for x in language_id.languages(docs(spark, data)).collect()}
    assert all(got[i].language == truth[i] and got[i].margin > 0 for i in range(80, 120))


def test_language_awkward_rows(spark):
    for wide in (False, True):
        got = rows(language_id.languages(docs(spark, awkward(), wide)))
        assert len(got) == len(awkward()) and all(x == "und" and m == 0 for i, x, m in got if i in (1, 2, 3, 4))
    assert rows(language_id.languages(spark.createDataFrame([], DOCS))) == []
    assert {x for _, x, _ in rows(language_id.languages(docs(spark, [(1, "a b"), (2, None)])))} == {"und"}
