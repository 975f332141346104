"""Line dedup, MinHash near-dedup and repeated passages against brute force."""

import itertools
import random

import pytest

from tests.llm.brute import near_groups, shared_lines, tokens, without_lines
from tests.llm.helpers import DOCS, awkward, docs, rows, words
from tidemark.llm import line_dedup, minhash, suffix_dedup


def corpus(seed=1):
    r = random.Random(seed)
    out = []
    for i in range(40):
        out.append((i, words(r.randrange(60, 200), i)))
    for i in range(40, 60):
        w = out[r.randrange(40)][1].split()
        for _ in range(r.randrange(4)):
            w[r.randrange(len(w))] = "edit"
        out.append((i, " ".join(w)))
    shared = words(70, 999)
    out += [(i, f"{words(40, i)} {shared} {words(30, -i)}") for i in range(60, 70)]
    out += [(i, out[0][1]) for i in range(70, 90)]
    return out


def test_near_duplicates_are_the_components_of_similar_pairs(spark):
    data = corpus()
    label = near_groups(data)
    want = {(i, g) for i, g in label.items() if i != g}
    assert set(rows(minhash.near_duplicates(docs(spark, data)))) == want
    kept = {r.doc_id for r in minhash.drop_near_duplicates(docs(spark, data, wide=True)).collect()}
    assert kept == {i for i, g in label.items() if i == g}


def test_a_bucket_of_unlike_documents_is_not_multiplied(spark):
    """Half of each text is a template: all share buckets, few are similar, and few are compared."""
    template = words(60, 1)
    data = [(i, f"{template} {words(60, 100 + i, 5000)}") for i in range(150)]
    data += [(200 + i, data[i * 7][1] + f" tail {i}") for i in range(20)]
    texts = spark.createDataFrame(data, "id long, text string")
    pairs = set(rows(minhash.prefix_pairs(texts, texts.selectExpr("id", "id AS label"), 3, 0.6)))
    label = near_groups(data)
    assert {(200 + i, i * 7) for i in range(20)} <= pairs and len(pairs) < 600
    assert set(rows(minhash.near_duplicates(docs(spark, data)))) == {(i, g) for i, g in label.items() if i != g}
    r = random.Random(3)
    mixed = [(i, " ".join(r.choices("abcdef", k=r.randrange(1, 30)))) for i in range(120)]
    found = set(rows(minhash.prefix_pairs(*(spark.createDataFrame(mixed, "id long, text string").selectExpr("id", x) for x in ("text", "id AS label")), 2, 0.5)))
    sets = {i: {tuple(t.split()[k : k + 2]) for k in range(len(t.split()) - 1)} or {tuple(t.split())} for i, t in mixed}
    assert {(a, b) for a in sets for b in sets if a > b and len(sets[a] & sets[b]) >= 0.5 * len(sets[a] | sets[b])} <= found


def test_sketch_fills_every_bin_and_estimates_similarity():
    import numpy as np

    base = np.arange(1, 400, dtype=np.uint64)
    other = np.concatenate([base[100:], np.arange(1000, 1100, dtype=np.uint64)])
    h = np.concatenate([base, other, base[:1]]) * np.uint64(0x9E3779B97F4A7C15)
    doc = np.repeat([0, 1, 2], [len(base), len(other), 1])
    s = minhash.sketch(doc, h, 3, 256)
    assert (s != np.uint64(0xFFFFFFFFFFFFFFFF)).all()
    assert abs((s[0] == s[1]).mean() - 299 / 499) < 0.12


def test_repeats_in_one_text_and_between_texts(spark):
    data = corpus() + [(100, " ".join(["a", "b", "c"] * 60)), (101, "é " * 55), (102, words(49, 7)), (103, words(49, 7))]
    where = {}
    for i, w in ((i, tokens(t)) for i, t in data):
        for k in range(len(w) - 49):
            where.setdefault(tuple(w[k : k + 50]), []).append((i, k))
    want = {}
    for places in where.values():
        if len(places) > 1:
            for n, (i, k) in enumerate(sorted(places)):
                covered, later = want.setdefault(i, (set(), set()))
                covered.update(range(k, k + 50))
                if n:
                    later.update(range(k, k + 50))
    got = {}
    for i, a, b, later in rows(suffix_dedup.repeated_spans(docs(spark, data))):
        cov, n = got.get(i, (set(), 0))
        got[i] = (cov | set(range(a, b)), n + later)
    assert got == {i: (c, len(x)) for i, (c, x) in want.items()}
    left = {r.doc_id: tokens(r.text) for r in suffix_dedup.remove_repeats(docs(spark, data)).collect()}
    texts = {i: tokens(t) for i, t in data}
    for i, w in texts.items():
        gone = want[i][1] if i in want else set()
        assert left[i] == [x for k, x in enumerate(w) if k not in gone]


def stripped(text):
    return [x.strip(" \t\r") for x in text.split("\n")]


def patience_blocks(a, b):
    """Matched line pairs by the textbook: recurse between the unique common lines of a longest increasing chain."""
    if not a or not b:
        return []
    if a[0] == b[0]:
        return [(0, 0)] + [(i + 1, j + 1) for i, j in patience_blocks(a[1:], b[1:])]
    if a[-1] == b[-1]:
        return patience_blocks(a[:-1], b[:-1]) + [(len(a) - 1, len(b) - 1)]
    one = [(i, b.index(x)) for i, x in enumerate(a) if a.count(x) == 1 and b.count(x) == 1]
    best = []
    for i, j in one:
        before = max((c for c in best if c[-1][1] < j), key=len, default=[])
        best.append([*before, (i, j)])
    chain = max(best, key=len, default=[])
    if not chain:
        return []
    out, i0, j0 = [], 0, 0
    for i, j in [*chain, (len(a), len(b))]:
        out += [(i0 + x, j0 + y) for x, y in patience_blocks(a[i0:i], b[j0:j])]
        out += [(i, j)] if i < len(a) else []
        i0, j0 = i + 1, j + 1
    return out


def aligned_with_all(data, least=line_dedup.LEAST_BLOCK):
    """Lines in blocks of `least` bytes that alignment with some earlier text matches, over all pairs."""
    cut = {}
    for (a, x), (b, y) in itertools.combinations(sorted(data), 2):
        later, earlier = stripped(y), stripped(x)
        block = []
        for i, j in [*patience_blocks(later, earlier), (-5, -5)]:
            if block and (i, j) == (block[-1][0] + 1, block[-1][1] + 1):
                block.append((i, j))
                continue
            if sum(len(later[k].encode()) for k, _ in block) >= least:
                cut.setdefault(b, set()).update(k for k, _ in block)
            block = [(i, j)]
    return cut


def test_no_holder_is_left_out(spark):
    """Blocks that only documents between the first and the nearest holder share, and blocks of short lines."""
    a, b = "a" * 29, "b" * 29
    data = [(0, f"{a}\nx0"), (1, f"{b}\nx1"), (2, f"{a}\n{b}\nx2"), (3, f"{b}\n{a}\nx3"), (4, f"{a}\ny4\n{b}"), (5, f"z5\n{a}\n{b}")]
    short = "\n".join(f"short {k:05d}" for k in range(20))
    data += [(6, short), (7, short)]
    got = {x.doc_id: x.text for x in line_dedup.line_dedup(docs(spark, data)).collect()}
    want = without_lines(data, aligned_with_all(data))
    assert got == want and got[5] == "z5" and 7 not in got


def test_lines_are_cut_from_the_later_document(spark):
    r = random.Random(4)
    pool = [words(r.randrange(2, 12), i) for i in range(60)]
    data = []
    for i in range(60):
        start = r.randrange(50)
        lines = pool[start : start + r.randrange(1, 8)] + [words(6, 1000 + i)]
        if r.random() < 0.3:
            r.shuffle(lines)
        data.append((i, "\n".join(lines)))
    data.append((60, max((t for _, t in data), key=len)))
    shared, aligned = shared_lines(data), aligned_with_all(data)
    assert any(aligned.values()) and all(shared[i] >= c for i, c in aligned.items())
    got = {x.doc_id: x.text for x in line_dedup.line_dedup(docs(spark, data)).collect()}
    assert got == without_lines(data, shared) and 60 not in got


def test_many_shared_lines_are_rewritten_in_linear_time(spark):
    text = "\n".join(f"line {k} of a long shared text" for k in range(30_000))
    data = docs(spark, [(1, text), (2, f"{text}\nown"), (3, text)])
    assert {r.doc_id: r.text for r in line_dedup.line_dedup(data).where("doc_id > 1").collect()} == {2: "own"}


def test_the_query_deletes_repeats(spark, tmp_path):
    from tidemark.llm import queries

    data = corpus() + [(100, None), (101, "É " * 120), (102, "Ab, c! " * 70)]
    docs(spark, data).write.parquet(f"{tmp_path}/documents.parquet")
    seen, want = set(), {}
    for i, t in sorted(data):
        w = tokens(t)
        gone = set()
        for k in range(len(w) - 49):
            if tuple(w[k : k + 50]) in seen:
                gone.update(range(k, k + 50))
            seen.add(tuple(w[k : k + 50]))
        want[i] = [x for k, x in enumerate(w) if k not in gone]
    got = {r.doc_id: r for r in queries.QUERIES["op6_dedup"](spark, str(tmp_path)).collect()}
    assert {i: tokens(r.text) for i, r in got.items()} == want and got[100].text is None
    assert all(r.n_chars == len(r.text) for r in got.values() if r.text is not None)
    assert sum(map(len, want.values())) < sum(len(tokens(t)) for _, t in data)


def test_every_earlier_holder_of_a_block_counts(spark):
    p, q = "p" * 30, "q" * 30
    data = [(0, f"{p}\n{q}")] + [(i, f"{q}\n{p}\nown {i}") for i in range(1, 13)]
    r = random.Random(8)
    pool = [words(r.randrange(1, 12), i) for i in range(30)] + ["", "é" * 20]
    for i in range(13, 80):
        at = r.randrange(30)
        lines = pool[at : at + r.randrange(1, 9)] + r.choices(pool, k=r.randrange(4))
        if r.random() < 0.4:
            r.shuffle(lines)
        data.append((i, "\n".join(lines)))
    want = shared_lines(data)
    assert all(want[b] >= c for b, c in aligned_with_all(data).items())
    got = {x.id: {k for k, m in enumerate(x.mask) if m} for x in line_dedup.deleted_lines(docs(spark, data)).collect()}
    assert got == {i: c for i, c in want.items() if c}
    assert all(got[i] == {0, 1} for i in range(2, 13)) and 1 not in got


def test_blocks_of_short_lines_are_found(spark):
    verse = "\n".join(f"a line of verse {k:03d}" for k in range(10))
    data = [(i, f"own {i}\n{verse}\nend {i}") for i in range(12)] + [(12, "a line of verse 000\na line of verse 001")]
    got = {x.doc_id: x.text for x in line_dedup.line_dedup(docs(spark, data)).collect()}
    assert got == {0: data[0][1], 12: data[12][1]} | {i: f"own {i}\nend {i}" for i in range(1, 12)}


@pytest.mark.parametrize(("a", "b", "want"), [("abc", "abc", 3), ("abcd", "xbcy", 2), ("aXbYc", "aZbWc", 3), ("aab", "baa", 1), ("", "a", 0), ("ab", "ba", 1)])
def test_patience(a, b, want):
    got = line_dedup.patience(list(a), list(b))
    assert len(got) == want and all(a[i] == b[j] for i, j in got)
    assert got == sorted(got) and all(x[1] < y[1] for x, y in zip(got, got[1:]))


@pytest.mark.parametrize("wide", [False, True])
def test_awkward_rows(spark, wide):
    data = docs(spark, awkward(), wide)
    assert sorted(rows(minhash.near_duplicates(data))) == [(7, 6), (9, 9)]
    kept = minhash.drop_near_duplicates(data)
    assert kept.columns == data.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=lambda x: (x is None, x))
    assert ids == [1, 2, 3, 4, 5, 6, 8, 9, 10, 10, None, None]
    spans = rows(suffix_dedup.repeated_spans(data))
    assert {(r[0], r[1], r[2]) for r in spans} == {(6, 0, 30_000), (7, 0, 30_000)} and dict((r[0], r[3]) for r in spans) == {6: 0, 7: 30_000}
    lines = line_dedup.line_dedup(data)
    assert lines.columns == data.columns
    ids = sorted((r.doc_id for r in lines.collect()), key=lambda x: (x is None, x))
    # (9, "one") is under LEAST_BLOCK, so both rows stay, and so do both texts of id 10
    assert ids == [1, 2, 3, 4, 5, 6, 8, 9, 9, 10, 10, None, None]
    left = suffix_dedup.remove_repeats(data)
    assert left.columns == data.columns and left.count() == data.count()


@pytest.mark.parametrize("length", [1, 2, 3, 5, 20, 31, 64, 100])
def test_prefix_doubling_of_any_length(spark, length):
    r = random.Random(length)
    base = words(260, 1, 9 if length < 6 else 60).split()
    data = [(i, " ".join(base[(a := r.randrange(120)) : a + r.randrange(1, 140)] + words(r.randrange(9), i, 9999).split() + base[(b := r.randrange(200)) : b + 40])) for i in range(14)]
    data += [(20, "a b " * 90), (21, "a b " * 70 + "c")]
    where = {}
    for i, w in ((i, tokens(t)) for i, t in data):
        for k in range(len(w) - length + 1):
            where.setdefault(tuple(w[k : k + length]), []).append((i, k))
    covered, later = {}, {}
    for places in (sorted(p) for p in where.values() if len(p) > 1):
        for n, (i, k) in enumerate(places):
            covered.setdefault(i, set()).update(range(k, k + length))
            later.setdefault(i, set()).update(range(k, k + length) if n else ())
    got = {}
    for i, a, b, n in rows(suffix_dedup.repeated_spans(docs(spark, data), length)):
        cov, m = got.get(i, (set(), 0))
        got[i] = (cov | set(range(a, b)), m + n)
    assert got == {i: (c, len(later[i])) for i, c in covered.items()}


def named_docs(spark, data):
    df = docs(spark, data)
    return df.selectExpr("concat('doc-', lpad(doc_id, 4, '0')) AS doc_id", "text", "lang", "source", "n_chars")


def test_ids_of_any_type(spark):
    data = [(i, f"{t}\n{words(12, 500 + i % 7)}") for i, t in corpus(3)]
    plain, named = docs(spark, data), named_docs(spark, data)
    name = "doc-{:04d}".format
    assert {(name(a), name(b)) for a, b in rows(minhash.near_duplicates(plain))} == set(rows(minhash.near_duplicates(named)))
    assert {(name(a), *x) for a, *x in rows(suffix_dedup.repeated_spans(plain))} == set(rows(suffix_dedup.repeated_spans(named)))
    for f in (line_dedup.line_dedup, suffix_dedup.remove_repeats, minhash.drop_near_duplicates):
        got = f(named)
        assert got.dtypes == named.dtypes and {(name(r.doc_id), r.text) for r in f(plain).collect()} == {(r.doc_id, r.text) for r in got.collect()}


def test_rows_that_share_an_id_are_documents_of_their_own(spark):
    one, two = words(80, 1), words(80, 2)
    data = docs(spark, [(1, one), (1, two), (1, one), (2, f"{two} end"), (None, one)])
    assert sorted(rows(minhash.near_duplicates(data))) == [(1, 1), (2, 1)]
    kept = sorted((str(r.doc_id), r.text) for r in minhash.drop_near_duplicates(data).collect())
    assert kept == sorted([("1", one), ("1", two), ("None", one)])
    left = [(r.doc_id, r.text) for r in line_dedup.line_dedup(data).collect()]
    assert sorted(map(str, left)) == sorted(map(str, [(1, one), (1, two), (2, f"{two} end"), (None, one)]))
    assert suffix_dedup.remove_repeats(data).count() == 5


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    assert rows(minhash.near_duplicates(none)) == rows(suffix_dedup.repeated_spans(none)) == rows(line_dedup.line_dedup(none)) == rows(minhash.drop_near_duplicates(none)) == rows(suffix_dedup.remove_repeats(none)) == []
