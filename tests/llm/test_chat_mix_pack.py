"""Tool-call linking, mixing, packing, the pipeline and the SQL of the queries."""

import itertools
import json
import random

import pytest

from tests.llm.brute import least_bins, near_groups, shared_lines, toxic_scores, uses, without_lines
from tests.llm.helpers import DOCS, awkward, docs, rows, words
from tidemark.llm import curriculum, packing, tool_calls

MESSAGES, CALLS, RESULTS = "conv_id long, turn long, role string, content string", "conv_id long, turn long, call_id string, name string, arguments string", "conv_id long, turn long, call_id string, content string"
TOOLS = {"add": {"type": "object", "required": ["a", "b"], "properties": {"a": {"type": ["number", "object"]}, "b": {"type": "number", "maximum": 9}}, "additionalProperties": False}}


def test_link(spark):
    calls = [
        (1, 3, "z", "add", '{"b": 1.0, "a": {"$ref": "y"}}'),
        (1, 2, "y", "add", '{"a": 1, "b": 20, "c": 1}'),
        (1, 1, "x", "add", '{"a": {"$ref": "z"}, "b": 2}'),
        (1, 9, "x", "add", "{}"),
        (1, 4, "bad", "add", "{nope"),
        (1, 5, None, "add", "{}"),
        (1, 6, "lost", "other", None),
        (2, 1, "p", "add", '{"a": {"$ref": "q"}, "b": 1}'),
        (2, 2, "q", "add", '{"a": {"$ref": "p"}, "b": 1}'),
        (3, 1, "n", "add", '{"a": NaN, "b": 1}'),
    ]
    results = [(1, 5, "y", "later"), (1, 4, "y", "21"), (1, 9, "none", "orphan"), (2, 3, "q", None)]
    messages = [(1, 0, "user", 'say "é"\n'), (1, 0, "user", None), (None, 1, "user", "stray")]
    got = {r.conv_id: r for r in tool_calls.link(spark.createDataFrame(messages, MESSAGES), spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS), TOOLS).collect()}
    one = json.loads(got[1].formatted)
    assert [c["id"] for c in one["calls"]] == ["y", "z", "x", "bad", "lost"]
    by = {c["id"]: c for c in one["calls"]}
    assert by["y"]["result"] == "21" and by["y"]["errors"] == ["b: above 9", "c: unknown"] and by["z"]["errors"] == []
    assert '"arguments":{"a":{"$ref":"y"},"b":1}' in got[1].formatted
    assert by["bad"]["errors"] == ["arguments: not JSON"] and by["bad"]["arguments"] == "{nope" and by["lost"]["errors"] == ["arguments: missing"]
    assert [m["content"] for m in one["messages"]] == [None, 'say "é"\n'] and '"say \\"é\\"\\n"' in got[1].formatted
    assert (got[1].calls, got[1].answered, got[1].faulty) == (5, 1, 3)
    assert all(c["errors"] == ["$ref: cycle"] for c in json.loads(got[2].formatted)["calls"])
    assert got[3].faulty == 1 and got[None].calls == 0
    for r in got.values():
        assert tool_calls.canonical(json.loads(r.formatted)) == r.formatted
    empty = [spark.createDataFrame([], s) for s in (MESSAGES, CALLS, RESULTS)]
    assert rows(tool_calls.link(*empty, TOOLS)) == []


def test_conversations_awkward(spark):
    data = [(1, 1, "assistant", None), (1, 2, "user", ""), (2, None, "assistant", "x\ny"), (None, 1, "assistant", "a"), (3, 1, None, "b"), (4, 1, "assistant", "z" * 200_000), (4, 1, "assistant", "z" * 200_000)]
    df = spark.createDataFrame([(*r, "call", "c") for r in data], "conv_id long, turn long, role string, text string, call_id string, name string")
    got = {r.conv_id: r for r in tool_calls.format_conversations(df).collect()}
    assert set(got) == {1, 2, 3, 4, None} and got[4].calls == 1 and got[4].faulty == 1 and got[3].calls == 0
    assert rows(tool_calls.format_conversations(df.limit(0))) == []


def test_positions_follow_the_schedule(spark):
    r = random.Random(2)
    data = [(i, words(r.randrange(1, 40), i), "en", "a" if i % 10 < 6 else "b" if i % 10 < 9 else "c") for i in range(3000)]
    plan = {"a": [(0, 1.0), (1, 0.0)], "b": [(0, 0.0), (0.5, 1.0), (1, 1.0)], "c": [(0, 0.5)]}
    got = rows(curriculum.positions(docs(spark, data), plan))
    assert {i for i, *_ in got} == set(range(3000))
    total = max(p for *_, p in got)
    for lo in (0.1, 0.4, 0.7):
        part = [x for x in got if lo <= x[4] / total < lo + 0.2]
        n = sum(x[3] for x in part)
        mid = lo + 0.1
        want = {"a": 1 - mid, "b": min(1, 2 * mid), "c": 0.5}
        for s, w in want.items():
            assert abs(sum(x[3] for x in part if x[1] == s) / n - w / sum(want.values())) < 0.04
    assert {s for _, s, e, *_ in got if e > 0} == {"b", "c"} or {s for _, s, e, *_ in got if e > 0} == {"a", "c"} or {s for _, s, e, *_ in got if e > 0} == {"a", "b"}


def test_mix_awkward(spark):
    for wide in (False, True):
        data = docs(spark, awkward(), wide)
        out = curriculum.mix(data)
        assert out.columns == data.columns
        ids = [r.doc_id for r in out.collect()]
        assert set(ids) == {*range(1, 11), None} and ids[-2:] == [None, None]
    none = spark.createDataFrame([], DOCS)
    assert rows(curriculum.positions(none)) == rows(curriculum.mix(none)) == []
    assert {(r[0], r[4]) for r in rows(curriculum.positions(docs(spark, [(1, ""), (2, None)])))} == {(1, 0), (2, 0)}
    left_out = docs(spark, [(1, "a b", "en", "x"), (2, "c d", "en", "y"), (3, "e", "en", "z"), (None, "f", "en", "x")])
    shares = {"x": [(0, 1.0)], "y": [(0, 0.0)]}
    assert {(i, p) for i, _, _, _, p in rows(curriculum.positions(left_out, shares))} == {(1, 0)}
    assert [r.doc_id for r in curriculum.mix(left_out, shares).collect()] == [1, None]
    with pytest.raises(ValueError, match="negative"):
        curriculum.plan({"a": 1}, {"a": [(0, -1.0)]})


def test_packing_keeps_every_token_once(spark):
    r = random.Random(6)
    data = [(i, words(r.choice([1, 5, 40, 90, 130, 700]), i)) for i in range(400)] + [(0, words(5, 0)), (0, words(250, 0))]
    got = rows(packing.pack(docs(spark, data), 100, 64))
    pieces = sorted((d, s, n) for _, ds, ss, ns, _ in got for d, s, n in zip(ds, ss, ns))
    sizes = [len(t.split()) for _, t in data]
    want = sorted((i, s, min(100, n - s)) for (i, _), n in zip(data, sizes) for s in range(0, n, 100))
    assert pieces == want and all(t == sum(ns) <= 100 for _, _, _, ns, t in got)
    assert len({b for b, *_ in got}) == len(got) <= sum(sizes) / 100 * 1.03 + 12


def test_local_search_empties_bins():
    sizes = [6, 4, 5, 5, 7, 3, 4, 4, 2]
    bins = [[0], [1], [2, 3], [4], [5], [6, 7, 8]]
    got = packing.local_search(bins, sizes, 10)
    assert sorted(i for b in got for i in b) == list(range(9)) and len(got) == 4
    assert packing._exchange([0], [1], [7, 4], 3) == ([0], [1])
    assert packing._exchange([1, 0], [2], [3, 4, 5], 2) == ([0, 1], [2])


def exchanges(a, b, sizes, free):
    """Every move or exchange from bin a to bin b, of up to two for up to two but two for two, that gains tokens and fits."""
    some = lambda x, n: [c for k in range(n + 1) for c in itertools.combinations(x, k)]
    return [(g, t) for g in some(a, 2) for t in some(b, 2) if g and (len(g), len(t)) != (2, 2) and 0 < sum(sizes[i] for i in g) - sum(sizes[i] for i in t) <= free]


def test_packing_against_all_packings():
    r = random.Random(12)
    optimal = 0
    for _ in range(150):
        sizes = [r.randrange(1, 60) for _ in range(r.randrange(1, 10))]
        bins = packing.local_search(packing.best_fit(sizes, 100), sizes, 100)
        assert sorted(i for b in bins for i in b) == list(range(len(sizes))) and all(sum(sizes[i] for i in b) <= 100 for b in bins)
        best = least_bins(sizes, 100)
        assert len(bins) <= best + 1
        optimal += len(bins) == best
        if len(bins) > -(-sum(sizes) // 100) and len(bins) > 1:
            fill = lambda b: sum(sizes[i] for i in b)  # noqa: B023, E731
            last = min(bins, key=fill)
            assert not any(exchanges(last, b, sizes, 100 - fill(b)) for b in bins if b is not last and fill(b) >= fill(last))
    assert optimal >= 145


def test_packed_table_against_all_packings(spark):
    r = random.Random(13)
    data = [(i, words(r.randrange(1, 80), i)) for i in range(9)]
    got = rows(packing.pack(docs(spark, data), 100))
    assert len(got) == least_bins([len(t.split()) for _, t in data], 100)


def test_packing_awkward(spark):
    for wide in (False, True):
        got = rows(packing.pack(docs(spark, awkward(), wide)))
        n = {}
        for _, ds, _, ns, _ in got:
            for d, k in zip(ds, ns):
                n[d] = n.get(d, 0) + k
        assert n == {4: 3, 5: 120, 6: 30_000, 7: 30_000, 8: 1, 9: 2, 10: 200}
    assert rows(packing.pack(spark.createDataFrame([], DOCS))) == []


@pytest.fixture
def folder(spark, tmp_path):
    r = random.Random(8)
    data = []
    for i in range(120):
        w = words(r.randrange(30, 150), i).split()
        if i % 6 == 0:
            w[3:3] = ["vile", "rotten", "scumbag"]
        data.append((i, "\n".join(" ".join(w[k : k + 12]) for k in range(0, len(w), 12)), "en", f"s{i % 3}"))
    data += [(200, data[1][1], "en", "s1"), (201, data[2][1].replace("\n", " "), "en", "s1")]
    docs(spark, data).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 6 == 0)) for i in range(0, 120)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def test_pipeline(spark, folder):
    import corpus_pipeline as cp

    assert [n for n, _ in cp.STAGES] == ["toxicity", "line_dedup", "near_dedup", "mixing", "packing"]
    state = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = state.columns, []
    for k, (name, stage) in enumerate(cp.STAGES):
        stage(spark, state, folder).write.parquet(f"{folder}/{k}")
        state = spark.read.parquet(f"{folder}/{k}")
        if k < 4:
            assert state.columns == columns
            seen.append({r.doc_id for r in state.select("doc_id").collect()})
    assert not seen[0] & set(range(0, 120, 6)) and len(seen[0]) >= 100
    assert seen[1] == seen[0] - {200} and seen[2] == seen[1] - {201} and seen[3] == seen[2]
    assert {d for r in state.collect() for d in r.doc_ids} == seen[3]
    assert sorted(map(str, cp.run(spark, folder).collect())) == sorted(map(str, state.collect()))


def test_pipeline_against_brute_force(spark, folder):
    """Every stage by a plain version over all documents and pairs; of packing, its pieces."""
    import corpus_pipeline as cp
    from tests.llm.test_models import hashes

    table = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    toxic = toxic_scores({i: t for i, t, _ in table}, labels, hashes(spark, [i for i, *_ in table]))
    kept = sorted((i, t) for i, t, _ in table if not toxic[i][1])
    kept = sorted(without_lines(kept, shared_lines(kept)).items())
    label = near_groups(kept)
    kept = {i: len(t.split()) for i, t in kept if label.get(i, i) == i}
    source = {i: s for i, _, s in table}
    supply = {s: sum(n for i, n in kept.items() if source[i] == s) for s in {source[i] for i in kept}}
    due = uses(supply)
    got = {}
    for r in cp.run(spark, folder).collect():
        assert r.tokens == sum(r.sizes) <= packing.CAPACITY
        for i, a, n in zip(r.doc_ids, r.starts, r.sizes):
            assert (a, n) == (0, kept[i])
            got[i] = got.get(i, 0) + 1
    assert got.keys() == kept.keys()
    for s in supply:
        # whole passes, then documents until the demand is met: the last one may go beyond it
        total = sum(got[i] * kept[i] for i in kept if source[i] == s)
        assert due[s] <= total < due[s] + max(kept[i] for i in kept if source[i] == s)
        turns = {got[i] for i in kept if source[i] == s}
        assert max(turns) - min(turns) <= 1


@pytest.mark.parametrize("stage", range(5))
def test_stages_take_awkward_rows_and_empty_tables(spark, tmp_path, stage):
    import corpus_pipeline as cp

    spark.createDataFrame([(5, 1, 1), (10, 0, 0), (None, 1, None)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    f = cp.STAGES[stage][1]
    for wide in (False, True):
        data = docs(spark, awkward(), wide)
        out = f(spark, data, str(tmp_path))
        got = out.collect()
        if stage < 4:
            assert out.columns == data.columns
            ids = [r.doc_id for r in got]
            assert {1, 2, 3, 4, 8, None} <= set(ids) and ids.count(None) == 2 and ids.count(10) >= (1 if stage == 0 else 2)
    assert f(spark, spark.createDataFrame([], DOCS), str(tmp_path)).collect() == []


def test_pipeline_of_an_empty_corpus(spark, tmp_path):
    import corpus_pipeline as cp

    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert cp.run(spark, str(tmp_path)).collect() == []


@pytest.mark.parametrize("name", ["op1_lines", "op2_topk", "op3_tools", "op6_suffix", "op7_mixing"])
def test_sql(spark, name):
    import duckdb

    from tidemark.llm import queries

    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet'")
    df = queries.QUERIES[name](spark, d)
    want = con.sql(queries.ORACLE[name])
    assert sorted(df.columns) == sorted(want.columns)
    cols = sorted(df.columns)
    assert sorted(map(str, (tuple(r[c] for c in cols) for r in df.collect()))) == sorted(map(str, (tuple(dict(zip(want.columns, r))[c] for c in cols) for r in want.fetchall())))
