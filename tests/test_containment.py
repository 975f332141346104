"""The best original of each document against all pairs, over passes of few words and many copies."""

import random

from tidemark import registry
from tidemark.operators import containment
from tests.test_copies import most_rows


def brute(docs):
    out = {}
    for a, s, x in docs:
        for b, t, y in docs:
            if s == t and None not in (a, b, s) and a != b and x and len(x & y) >= 4 and len(x & y) / len(x) >= 0.8:
                out[a] = max(out.get(a, (0, 0)), (len(x & y) / len(x), -b))
    return {(a, -b, c) for a, (c, b) in out.items()}


def corpus(seed, n):
    r = random.Random(seed)
    docs = []
    for i in range(n):
        words = {f"w{int(r.paretovariate(0.5)) % 300}" for _ in range(r.choice((3, 6, 20, 60)))}
        if docs and r.random() < 0.4:  # copies, parts and wholes of earlier ones
            words = {w for w in r.choice(docs)[2] if r.random() < r.choice((1, 0.95, 0.85, 0.8))} | {f"w{r.randrange(300)}" for _ in range(r.randrange(3))}
        docs.append((i, r.choice(("a", "a", "a", "b", None)), words))
    return docs + [(None, "a", docs[0][2]), (5, "a", docs[9][2]), (5, "b", docs[9][2]), (n, "a", set())]


def test_best_original_equals_all_pairs(spark, tmp_path, monkeypatch):
    docs = corpus(3, 400)
    spark.createDataFrame([(i, s, " ".join(sorted(w))) for i, s, w in docs], "doc_id long, source string, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    want = brute(docs)
    assert len(want) > 100
    for words in (containment.MOST_WORDS, 3000):
        monkeypatch.setattr(containment, "MOST_WORDS", words)
        assert {(r.id, r.url, r.coverage) for r in registry.QUERIES["best_original"](spark, str(tmp_path)).collect()} == want


def test_matches_in_small_steps(monkeypatch):
    import numpy as np

    docs = [(i, np.array(sorted(int(w[1:]) for w in x))) for i, s, x in corpus(4, 300) if i is not None and s == "a" and len(x) > 3]
    k, words, n = np.array([i for i, _ in docs]), np.concatenate([x for _, x in docs]), np.array([len(x) for _, x in docs])
    ix = containment.index(k, words, n, 0.8, True)
    want = {(a, b, len(set(x) & set(y))) for a, (i, x) in enumerate(docs) for b, (j, y) in enumerate(docs) if i != j and len(set(x) & set(y)) >= 0.8 * len(x) - 1e-9}
    for most in (containment.MOST_HITS, 1, 500):
        monkeypatch.setattr(containment, "MOST_HITS", most)
        got = [(int(b), int(r), int(m)) for r, e, shared in containment.matches(ix, k, words, n) for b, m in zip(e, shared)]
        assert len(got) == len(set(got)) and set(got) == want


def test_copies_make_no_pairs(spark, tmp_path):
    docs = [(i, "a", f"one two three four five {i % 2}") for i in range(3000)]
    spark.createDataFrame(docs, "doc_id long, source string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows, most = most_rows(spark, registry.QUERIES["best_original"](spark, str(tmp_path)))
    assert most <= 3000 and {r.id: r.url for r in rows} == {i: i % 2 if i > 1 else i + 2 for i in range(3000)}
