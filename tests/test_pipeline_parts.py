"""Sources, manifests, samplers, state and streams."""

import datetime
import json
import random
import hashlib

import pytest
from pyspark.sql import functions as F

from tidemark.operators import audit, dedupe, joins, manifest, rank, sampling, state
from tidemark.plans import dispatch
from tidemark.sources import indexes
from tidemark.sources.manifest import read_manifest, write_manifest
from tidemark.streaming import pages


def write(path, rows):
    path.write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows) + "\n")
    return str(path)


def c(url, **more):
    return {"provider": "wayback", "snapshotUrl": url, **more}


def test_manifest_round_trip(spark, tmp_path):
    a = write(tmp_path / "a.jsonl", [{"publisher": "Daily", "canonicalUrl": "u1", "candidates": [c("s1"), c("s1"), c("s2")]}, "", {"url": "u2", "published_at": "2011-05-05", "section": " "}])
    b = write(tmp_path / "b.jsonl", [{"canonical_url": "u1", "catalog_date": "2010-01-01", "section": "x", "candidates": [c("s2"), c("s3"), c("s2", digest="d")]}, {"url": "u3", "wayback_status": "found", "wayback_snapshot_url": "w", "wayback_status_code": "200"}])
    rows = read_manifest(spark, [a, b], "daily")
    assert rows.count() == 4
    merged = {r.url: r for r in manifest.merge(rows).collect()}
    assert [(x.snapshotUrl, x.digest) for x in merged["u1"].candidates] == [("s1", None), ("s1", None), ("s2", None), ("s3", None), ("s2", "d")]
    assert (merged["u1"].published, merged["u1"].section) == ("2010-01-01", "x") and merged["u3"].candidates[0].statusCode == 200 and merged["u2"].section is None
    write_manifest(manifest.merge(rows), str(tmp_path / "out"), "daily")
    again = read_manifest(spark, str(tmp_path / "out"), "daily")
    assert sorted((r.url, len(r.candidates)) for r in again.collect()) == [("u1", 5), ("u2", 0), ("u3", 1)]
    assert {(r.year, r.articles, r.missing) for r in manifest.summary(again).collect()} == {(2010, 1, 0), (2011, 1, 0), (None, 1, 1)}
    for bad in (["{oops"], ["[1]"], [{"publisher": "other", "url": "u"}], [{"section": "x"}]):
        with pytest.raises(Exception, match="manifest"):
            read_manifest(spark, write(tmp_path / "bad.jsonl", bad), "daily").collect()


def test_candidates(spark):
    df = spark.sql("SELECT array(named_struct('provider','p','snapshotUrl','a'), named_struct('provider','p','snapshotUrl','')) x, array(named_struct('provider','q','snapshotUrl','a'), named_struct('provider','q','snapshotUrl','b')) y")
    got = df.select(manifest.union_candidates(F.col("x"), F.col("y")).alias("z"), manifest.with_live_fallback(F.col("x"), F.lit("u"), F.lit("2024-05-05").cast("date"), 2024).alias("l")).first()
    assert [(r.provider, r.snapshotUrl) for r in got.z] == [("p", "a"), ("q", "b")] and got.l[-1].provider == "live-origin"


CDX = [indexes.CDX_COLUMNS, ["20100101000000", "http://a.com/2010/01/01/x", "text/html", "200", "D1", "10"], ["20100201000000", "http://a.com/2010/01/01/x", "text/html", "200", "D2", "x"], ["20100103000000", "http://a.com/2010/01/01/x", "text/html", "-", "-", "5"], [], ["next"]]


def test_cdx(spark, tmp_path):
    df = spark.createDataFrame([("p", json.dumps(CDX)), ("e", "[]")], "page string, body string")
    rows = indexes.parse_cdx(df).orderBy("place").collect()
    assert [(r.status, r.digest, r.length, r.resume_key) for r in rows] == [(200, "D1", 10, "next"), (200, "D2", None, "next"), (None, None, 5, "next")]
    with pytest.raises(Exception, match="header"):
        indexes.parse_cdx(spark.createDataFrame([("p", '[["a"], ["1","2","3","4","5","6"]]')], "page string, body string")).collect()
    indexes.register(spark)
    for k in range(3):
        (tmp_path / f"{k}.json").write_text(json.dumps([CDX[0], *([f"2010010{k + 1}0{j}0000", "http://a.com/2010/01/01/x", "text/html", "200", f"D{k}{j}", "1"] for j in range(2))]))
    assert spark.read.format("cdx").load(str(tmp_path)).count() == 6
    stream = spark.readStream.format("cdx").option("pagesPerTurn", 1).load(str(tmp_path))
    for _ in range(4):  # each run takes one turn and resumes at the checkpoint's page
        pages.page_stream(stream, str(tmp_path / "state"), str(tmp_path / "check")).awaitTermination()
    now = state.read_state(spark, str(tmp_path / "state"), pages.STATE)
    assert sorted(r.digest for r in now.collect()) == ["D00", "D01", "D10"]
    again = pages.apply(now, pages.candidates(spark.read.format("cdx").load(str(tmp_path))))
    assert sorted(r.digest for r in again.collect()) == ["D00", "D01", "D10"]


def test_feeds(spark):
    index = "<sitemapindex xmlns='x'><sitemap><loc>https://a/s-2010-02.xml?a=1&b=2</loc><lastmod>2010-02-03</lastmod></sitemap><sitemap><loc>https://a/s-2010-02.xml?a=1&amp;b=2</loc><lastmod>2010-02-03</lastmod></sitemap></sitemapindex>"
    assert [tuple(r) for r in indexes.parse_sitemap_index(spark.createDataFrame([(index,)], "xml string")).collect()] == [("https://a/s-2010-02.xml?a=1&b=2", "2010-02-03", 2010, 2)]
    urlset = "<urlset><url><loc> https://a/1 </loc></url><url><ns:loc>https://a/2</ns:loc><lastmod>2011</lastmod>\x01</url></urlset>"
    assert [tuple(r) for r in indexes.parse_sitemap(spark.createDataFrame([(urlset,)], "xml string")).collect()] == [("https://a/1", None), ("https://a/2", "2011")]
    rss = "<rss><item><title><![CDATA[T & t]]></title><link>https://a/1</link><pubDate>Mon, 02 Jan 2012 03:04:05 GMT</pubDate></item><item><link>https://a/2</link><pubDate>bad</pubDate></item></rss>"
    assert [tuple(r) for r in indexes.parse_feed(spark.createDataFrame([(rss,)], "xml string")).collect()] == [("https://a/1", "T & t", datetime.datetime(2012, 1, 2, 3, 4, 5)), ("https://a/2", None, None)]
    ok = {"url": "http://a.com/x", "timestamp": "20100101000000", "status": "200", "mime": "text/html", "digest": "D", "length": "10", "offset": "0", "filename": "crawl-data/a"}
    lines = [json.dumps(ok | m) for m in ({}, {"status": "404"}, {"filename": "x/y"}, {"length": "0"}, {"length": "26000000"}, {"offset": "-1"}, {"mime": "image/png"})]
    assert indexes.parse_index_lines(spark.createDataFrame([(x,) for x in lines], "value string")).count() == 1
    tm = json.dumps([["urlkey", "timestamp"], ["k", "2010"], ["short"]])
    assert [r.row for r in indexes.parse_timemap(spark.createDataFrame([("p", tm)], "page string, body string")).collect()] == [{"urlkey": "k", "timestamp": "2010"}]
    post = {"date": "2012-01-03T00:00:00Z", "title": "one two three four", "links": [{"url": "a", "date": "2012-01-02T00:00:00Z", "priority": 0}, {"url": "b", "date": "2012-01-02T00:00:00Z", "priority": 0}, {"url": "c", "date": "2012-02-02T00:00:00Z", "priority": 0}]}
    assert [r.url for r in indexes.parse_posts(spark.createDataFrame([(json.dumps(post),), (json.dumps(post | {"title": "too short"}),)], "body string")).collect()] == ["b"]
    seg = json.dumps({"count": 9, "segment_by_shard": [[0, 4], [7, 7], [10, 15]]})
    assert [tuple(r) for r in indexes.parse_segments(spark.createDataFrame([(seg,)], "body string")).collect()] == [(9, 0, 0, 4), (9, 2, 10, 15)]


def test_corpus(spark, tmp_path):
    ok = ("https://www.a.com/x", "a.com", "w", "2016-05-05", "one two three four", 500, "en")
    rows = [ok, ("https://b.com/x", *ok[1:]), (*ok[:2], None, *ok[3:]), (*ok[:3], "2017-01-01", *ok[4:]), (*ok[:4], "one two", *ok[5:]), (*ok[:5], 10, "en"), (*ok[:6], "fr")]
    spark.createDataFrame(rows, "url string, url_hostname string, warc_filename string, publish_date string, title string, text_length long, language string").repartition(3).write.parquet(f"{tmp_path}/c")
    out = indexes.corpus_rows(spark.read.parquet(f"{tmp_path}/c"), 2016)
    assert [r.url for r in out.collect()] == ["https://www.a.com/x"]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(language,en)" in plan and "GreaterThanOrEqual(text_length,400)" in plan
    off = indexes.corpus_offsets(spark, f"{tmp_path}/c").orderBy("file").collect()
    assert sum(r.rows for r in off) == 7 and [r["first"] for r in off] == [sum(x.rows for x in off[:k]) for k in range(len(off))]


def test_samplers(spark):
    seg = [(0, 0, 4), (1, 7, 7), (2, 10, 15)]
    df = spark.createDataFrame(seg, "shard int, start long, end long")
    for most in (1, 2, 3, 5, 9, 50):
        n = min(9, most)
        flat = [(0, k) for k in range(4)] + [(2, k) for k in range(10, 15)]
        assert sorted(tuple(r) for r in sampling.systematic(df, most).collect()) == sorted({flat[min(8, int((i + 0.5) * 9 / n))] for i in range(n)})
    draw = random.Random(int.from_bytes(hashlib.sha256(b"s").digest()[:8], "big")).sample(range(9), 5)
    assert sampling.seeded(seg, 5, "s") == [(0, p) if p < 4 else (2, p + 6) for p in draw]
    rows = spark.createDataFrame([("y", str(i)) for i in range(50)], "year string, url string")
    want = sorted((hashlib.sha256(f"seed|y|{i}".encode()).hexdigest(), str(i)) for i in range(50))[:7]
    assert sorted(r.url for r in sampling.by_hash(rows, "year", "url", "seed", 7).collect()) == sorted(u for _, u in want)


def test_title_match_equals_brute_force(spark):
    r = random.Random(1)
    vocabulary = [f"t{k}" for k in range(30)]
    titles = [(i, " ".join(r.sample(vocabulary, r.randrange(4, 9))), datetime.date(2012, 1, 1) + datetime.timedelta(days=r.randrange(6))) for i in range(150)]
    titles += [(200 + i, t, d) for i, t, d in titles[:40]]
    df = spark.createDataFrame(titles, "id int, title string, day date")
    got = {(x.a, x.b) for x in joins.title_match(df, df, 2, 0.7, 4, 1000).collect()}
    sets = {i: (set(t.split()), d) for i, t, d in titles}
    assert got == {(a, b) for a, (x, p) in sets.items() for b, (y, q) in sets.items() if abs((p - q).days) <= 2 and len(x & y) >= 4 and len(x & y) / max(len(x), len(y)) >= 0.7}


def test_state(spark, tmp_path):
    folder, schema = str(tmp_path / "s"), "k int, v int"
    assert state.read_state(spark, folder, schema).count() == 0
    state.write_state(spark.createDataFrame([(1, 1)], schema), folder)
    old = state.read_state(spark, folder, schema)
    state.write_state(state.upsert(old, spark.createDataFrame([(1, None), (2, 5)], schema), ["k"], {"v": "new_if_set"}), folder)
    assert sorted(tuple(r) for r in state.read_state(spark, folder, schema).collect()) == [(1, 1), (2, 5)] and state.versions(spark, folder) == [1, 2]
    with pytest.raises(ValueError, match="unknown"):
        state.upsert(old, old, ["k"], {"v": "wrong"})


def test_blocks(spark):
    df = spark.sql("SELECT array(named_struct('kind','paragraph','text','Hello  World of Quotes'), named_struct('kind','quote','text','world of quotes'), named_struct('kind','quote','text','hello'), named_struct('kind','paragraph','text','hello world of quotes')) b")
    got = df.select(dedupe.blocks(F.col("b")).alias("x"), dedupe.without_contained(F.col("b")).alias("y")).first()
    assert [b.text for b in got.x] == ["Hello  World of Quotes", "world of quotes", "hello"]
    assert [b.kind for b in got.y] == ["paragraph", "paragraph"]


def test_gates_and_ranks(spark):
    base = {"evaluated": 800, "target": 800, "complete_rate": 0.95, "qa_pass_rate": 1.0, "errors": 0, "unbound": 0}
    rows = [base, base | {"evaluated": 799}, base | {"complete_rate": 0.94}, base | {"errors": 1}, base | {"unbound": None}]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], "evaluated int, target int, complete_rate double, qa_pass_rate double, errors int, unbound int")
    assert [r.ok for r in df.select(dispatch.gates().alias("ok")).collect()] == [True, False, False, False, False]
    at = lambda s: datetime.datetime.fromisoformat(s) if s else None
    caps = spark.createDataFrame([("b", at("2012-01-03")), ("a", at("2011-12-31")), ("c", None)], "u string, t timestamp").withColumn("p", F.lit("2012-01-01").cast("timestamp"))
    assert [r.u for r in caps.orderBy(*rank.nearest_order("t", "p", "u")).collect()] == ["a", "b", "c"]


def test_audit(spark):
    f = lambda *v: spark.createDataFrame([("y", x) for x in v], "year string, url string")
    r = audit.overlap(f("a", "b"), f("b", "c", "c"), "year", "url").first()
    assert (r.kept, r.dropped, r.added) == (1, 1, 1) and r.before == hashlib.sha256(b"a\nb\n").hexdigest()


def test_event_windows_stream(spark, tmp_path):
    spark.createDataFrame([(datetime.datetime(2024, 1, 1, h, 5), "x", 1.5) for h in (0, 0, 1, 5)], "ts timestamp, kind string, value double").write.parquet(f"{tmp_path}/e")
    s = spark.readStream.schema("ts timestamp, kind string, value double").parquet(f"{tmp_path}/e")
    q = pages.windowed(s, "ts", ["kind"]).writeStream.format("memory").queryName("win").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted((r.start.hour, r.n) for r in spark.table("win").collect()) == [(0, 2), (1, 1), (5, 1)]


def test_more_sources(spark, tmp_path):
    found = {"results": [{"page": {"url": "https://a.com/2012/01/02/x"}, "task": {"url": "https://a.com/2012/01/02/x"}}, {"page": {"url": "https://a.com/undated"}, "task": None}]}
    assert [r.url for r in indexes.parse_search(spark.createDataFrame([(json.dumps(found),)], "body string")).collect()] == ["https://a.com/2012/01/02/x"]
    from tidemark.functions import quality

    def doc(**m):
        return json.dumps({"doc_ix": 5, "doc_len": m.pop("n", 900), "metadata": {"url": "https://www.a.com/x", "hostname": "a.com", "date": "2016-02-03", "language": "en", "warc_source": "w", "title": "one two three four"} | m})

    cases = [({}, None), ({"url": "https://b.com/"}, "other-host"), ({"hostname": "c.com"}, "host-differs"), ({"date": "2015"}, "other-year"), ({"title": "x"}, "short-title"), ({"n": 3}, "short-text"), ({"language": None}, "other-language"), ({"warc_source": ""}, "no-source"), ({"title": "x", "n": 1}, "short-title")]
    d = indexes.parse_documents(spark.createDataFrame([(doc(**m),) for m, _ in cases], "body string").coalesce(1))
    assert [r.x for r in d.select(quality.document_rejection(F.col("document"), F.lit(2016), "a.com").alias("x")).collect()] == [w for _, w in cases]
    spark.range(10).selectExpr("id AS v").repartition(2).write.parquet(f"{tmp_path}/c")
    corpus = spark.read.parquet(f"{tmp_path}/c")
    off = indexes.corpus_offsets(spark, f"{tmp_path}/c")
    assert sorted(r["index"] for r in indexes.corpus_rows_at(corpus, off, spark.createDataFrame([(0,), (9,), (77,)], "index long")).collect()) == [0, 9]
    page = "<a class=x href='/1'>One <b>two</b></a><a href=\"/1\">One two</a><A HREF=/2>x</A><a name=y>no</a>"
    assert sorted(tuple(r) for r in indexes.anchors(spark.createDataFrame([(page,)], "html string")).collect()) == [("/1", "One two"), ("/2", "x")]


def test_warc_files(spark, tmp_path):
    from tidemark.functions import warc

    def rec(url, body):
        http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n" + body
        return b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: " + url + b"\r\nContent-Length: " + str(len(http)).encode() + b"\r\n\r\n" + http + b"\r\n\r\n"

    parts = [rec(b"http://a/", b"short"), rec(b"http://b/", b"other and longer"), rec(b"http://a/", b"longer")]
    raw = b"".join(parts)
    df = spark.createDataFrame([(raw, "http://a"), (raw[:-12], "http://a"), (None, "http://a")], "c binary, u string")
    assert [r.x and bytes(r.x) for r in df.select(warc.longest_body(F.col("c"), F.col("u")).alias("x")).collect()] == [b"longer", None, None]
    (tmp_path / "w").write_bytes(raw)
    rows = spark.createDataFrame([("w", len(parts[0]), len(parts[1])), ("gone", 0, 1)], "filename string, offset long, length long")
    got = {r.filename: r.d for r in warc.read_ranges(rows, str(tmp_path)).select("filename", warc.decode(F.col("content")).alias("d")).collect()}
    assert bytes(got["w"].body) == b"other and longer" and got["gone"].body is None
    import gzip

    df = spark.createDataFrame([(gzip.compress(b"x"), "gzip"), (b"x", None), (b"\x1f\x8bbad", "gzip")], "c binary, e string")
    assert [r.x and bytes(r.x) for r in df.select(warc.decode_body(F.col("c"), F.col("e")).alias("x")).collect()] == [b"x", b"x", None]


def test_reload_and_reconcile(spark):
    cand = "array<struct<provider string, snapshotUrl string>>"
    old = [("a", None, "s", [("w", "1"), ("live-origin", "L")], "error", 3), ("b", "d", None, [("w", "1")], "error", 3), ("c", "d", None, [("w", "1")], "complete", 1)]
    new = [("a", "d2", None, [("w", "2")]), ("b", None, "t", [("w", "1")]), ("c", "d3", None, [("w", "9")]), ("e", None, None, [("w", "5")])]
    got = {r.url: r for r in state.reload_manifest(spark.createDataFrame(old, f"url string, published string, section string, candidates {cand}, status string, attempts int"), spark.createDataFrame(new, f"url string, published string, section string, candidates {cand}")).collect()}
    assert ([c_.snapshotUrl for c_ in got["a"].candidates], got["a"].status, got["a"].attempts, got["a"].published, got["a"].section) == (["2", "L"], "pending", 0, "d2", "s")
    assert (got["b"].status, got["b"].attempts, got["b"].section) == ("error", 3, "t")
    assert ([c_.snapshotUrl for c_ in got["c"].candidates], got["c"].published, got["c"].status) == (["1"], "d3", "complete") and got["e"].status == "pending"
    q = spark.createDataFrame([(1, "pending"), (2, "closed"), (1, "complete")], "year int, status string")
    art = spark.createDataFrame([(1, "x"), (1, "y"), (2, "x"), (2, "x")], "year int, url string")
    assert sorted(tuple(r) for r in state.reconcile(q, art, 2).collect()) == [(1, "closed"), (1, "complete"), (2, "pending")]


def test_plans(spark):
    rows = spark.createDataFrame([("p", 1, "holdout-2", 5, 10, 2), ("p", 1, "source", 50, 4, 0), ("q", 1, "source", 5, 7, 0)], "publisher string, year int, cohort string, evaluated int, eligible int, excluded int")
    assert sorted(tuple(r) for r in dispatch.next_cohort(rows).collect()) == [("p", 1, "holdout-3"), ("q", 1, "holdout-1")]
    cap = spark.createDataFrame([("p", 1, 20)], "publisher string, year int, capacity int")
    assert sorted(tuple(r) for r in dispatch.candidate_bound(rows, cap).collect()) == [("p", 1, 18), ("q", 1, 7)]
    t = spark.createDataFrame([("a", 1, 2, 5), ("b", 1, 2, 1), ("c", 1, 2, 0), ("d", 1, 2, 0)], "publisher string, first int, last int, priority int")
    s = spark.createDataFrame([("b", 1, 2, False), ("c", 1, 2, True)], "publisher string, first int, last int, complete boolean")
    assert [r.publisher for r in dispatch.catalog_dispatch(t, s, spark.createDataFrame([("d",)], "publisher string"), 5).collect()] == ["a", "b"]


def test_more_columns(spark):
    from tidemark.functions import html, quality, urls

    x = lambda col: spark.range(1).select(col.alias("x")).first().x
    assert x(urls.replay_matches(F.lit("https://web.archive.org/web/2012/http://www.a.com/x/"), F.lit("https://a.com/x"))) is True
    assert x(F.array(*(urls.source_priority(F.lit(u), ("a.com",), ("b.com",)) for u in ("https://m.a.com/", "https://b.com/", "https://xa.com/")))) == [0, 1, 2]
    assert x(urls.unwrap_redirect(F.lit("https://r.search/_ylt=1/RU=https%3a%2f%2fa.com%2fx/RK=2"))) == "https://a.com/x"
    assert x(urls.embedded(F.lit('<a href="http://npr.org/2012/a">x</a> https://www.npr.org/2012/a/ http://b.com'), urls.RULES["npr"])) == ["https://www.npr.org/2012/a"]
    assert urls.spec_fingerprint(urls.RULES["npr"], 2010, 2011) != urls.spec_fingerprint(urls.RULES["npr"], 2010, 2012)
    a = html.article(F.lit("<h1>H</h1><article><p>" + "word " * 300 + "</p><img src='https://a.com/x.jpg'></article>"), F.lit("https://a.com/"))
    r = spark.range(1).select(a.alias("a")).select(quality.article_violations(F.col("a")).alias("v"), quality.thin(F.col("a")).alias("t")).first()
    assert r.v == [] and r.t is False
    assert x(quality.paywalled(F.lit("Subscribe to continue"))) is True and x(quality.is_notice(F.lit("Correction: x"), F.lit(""))) is True
    assert x(quality.noise_sequence(F.array(F.lit("read"), F.lit("more"), F.lit("here")), ("read more",))) is True
    assert x(quality.placeholder_image(F.lit("https://a.com/img%2Fplaceholder.png"))) is True
