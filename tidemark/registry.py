"""Every query of the library by name, each over its whole tables, with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import capture, dates, html, quality, text, urls
from tidemark.operators import audit, containment, dedupe, joins, manifest, rank, sampling, state, store, summary, turns
from tidemark.plans import dispatch
from tidemark.streaming import pages as streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _day(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd")


_HOST = r"regexp_replace(lower(regexp_extract(url, '^https?://([^/?#]+)', 1)), '^www\.', '')"
_PATH = r"regexp_replace(regexp_extract(url, '^https?://[^/?#]+(/[^?#]*)?', 1), '(?i)(\.html?)?/*$', '')"
_STOP = ",".join(f"'{w}'" for w in sorted(text.STOP_WORDS["short"]))
_WORDS = f"list_filter(list_distinct(regexp_extract_all(lower({{}}), '[a-z0-9]+')), lambda x: NOT list_contains([{_STOP}], x))"


# ---- manifests ----


@query(f"""
WITH k AS (SELECT {_HOST} || {_PATH} AS key, page_id, url FROM pages),
r AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY page_id) AS place FROM k)
SELECT key, count(*) AS kept, string_agg(url, ' ' ORDER BY place) AS candidates FROM r WHERE place <= 3 GROUP BY key
""")
def page_manifest(spark: SparkSession, d: str) -> DataFrame:
    p = _t(spark, d, "pages").select(urls.match_key(F.col("url")).alias("url"), F.lit(None).cast("timestamp").alias("published"), F.timestamp_seconds("page_id").alias("captured"), F.col("url").alias("snapshot"), F.lit("").alias("digest"))
    return manifest.build(p).select(F.col("url").alias("key"), F.size("candidates").cast("bigint").alias("kept"), F.array_join(F.transform("candidates", lambda c: c["snapshotUrl"]), " ").alias("candidates"))


@query("""
WITH c AS (SELECT user_id, event_id, CASE WHEN epoch(date_trunc('second', ts))::BIGINT >= 1704067200 + user_id * 10000 THEN epoch(date_trunc('second', ts))::BIGINT - (1704067200 + user_id * 10000) ELSE 1704067200 + user_id * 10000 - epoch(date_trunc('second', ts))::BIGINT + 630720000 END AS rank FROM events),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY rank, event_id) AS place FROM c)
SELECT user_id, event_id, rank, place::INT AS place FROM r WHERE place <= 3
""")
def topk_candidates(spark: SparkSession, d: str) -> DataFrame:
    e = _t(spark, d, "events").withColumn("published", F.timestamp_seconds(1704067200 + F.col("user_id") * 10000))
    e = e.select("user_id", "event_id", dates.capture_distance(F.col("ts").cast("timestamp"), F.col("published")).alias("rank"))
    return rank.top_per_key(e, ["user_id"], ["rank", "event_id"], 3, "place")


@query("SELECT o_custkey, count(*) AS n, string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_orderdate, o_orderkey) AS orders FROM orders GROUP BY o_custkey")
def manifest_export(spark: SparkSession, d: str) -> DataFrame:
    g = _t(spark, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.struct("o_orderdate", "o_orderkey"))).alias("o"))
    return g.select("o_custkey", "n", F.array_join(F.transform("o", lambda x: x["o_orderkey"].cast("string")), ",").alias("orders"))


@query("""
WITH r AS (SELECT o_orderkey % 2 AS source, o_orderkey AS ordinal, 'c' || o_custkey AS url, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS published,
  CASE WHEN o_orderstatus = 'O' THEN '' ELSE o_orderstatus END AS section, o_orderpriority || ' ' || o_orderstatus AS snapshot FROM orders),
f AS (SELECT url, arg_min(published, (source, ordinal)) FILTER (published IS NOT NULL) AS published, arg_min(section, (source, ordinal)) FILTER (section <> '') AS section FROM r GROUP BY url),
u AS (SELECT url, snapshot, min((source, ordinal)) AS pos FROM r GROUP BY url, snapshot)
SELECT f.url, published, section, (SELECT string_agg(snapshot, ',' ORDER BY pos) FROM u WHERE u.url = f.url) AS candidates FROM f
""")
def manifest_merge(spark: SparkSession, d: str) -> DataFrame:
    o = _t(spark, d, "orders")
    empty = {n: F.lit("").alias(n) for n in manifest.IDENTITY}
    one = F.struct(*(F.concat_ws(" ", "o_orderpriority", "o_orderstatus").alias(n) if n == "snapshotUrl" else empty[n] for n in manifest.IDENTITY))
    rows = o.select((F.col("o_orderkey") % 2).alias("source"), F.col("o_orderkey").alias("ordinal"), F.concat(F.lit("c"), "o_custkey").alias("url"), F.when(F.col("o_orderkey") % 3 != 0, _day("o_orderdate")).alias("published"), F.when(F.col("o_orderstatus") == "O", "").otherwise(F.col("o_orderstatus")).alias("section"), F.array(one).alias("candidates"))
    return manifest.merge(rows).select("url", "published", "section", F.array_join(F.transform("candidates", lambda c: c["snapshotUrl"]), ",").alias("candidates"))


@query("""
WITH o AS (SELECT o_orderkey, 'https://www.example.com/' || strftime(o_orderdate, '%Y/%m/%d') || '/x' AS url, CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 7 = 0 THEN '1999-06-01' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS own FROM orders),
p AS (SELECT o_orderkey, coalesce(own, CASE WHEN url LIKE '%/20__/%' THEN substr(url, 25, 4) || '-' || substr(url, 30, 2) || '-' || substr(url, 33, 2) || 'T00:00:00+00:00' END) AS published FROM o)
SELECT * FROM p WHERE published >= '1996-01-01' AND published < '2001-01-01'
""")
def year_filter(spark: SparkSession, d: str) -> DataFrame:
    own = F.when(F.col("o_orderkey") % 5 == 0, None).when(F.col("o_orderkey") % 7 == 0, "1999-06-01").otherwise(_day("o_orderdate"))
    o = _t(spark, d, "orders").select("o_orderkey", F.concat(F.lit("https://www.example.com/"), F.date_format("o_orderdate", "yyyy/MM/dd"), F.lit("/x")).alias("url"), own.alias("published"))
    return manifest.in_years(o, 1996, 2000).select("o_orderkey", "published")


@query("""
WITH o AS (SELECT CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN 'soon' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS p, o_orderkey % 4 AS n FROM orders)
SELECT CASE WHEN regexp_matches(p, '^(19|20)\\d\\d(-|$)') THEN substr(p, 1, 4)::INT END AS year, count(*) AS articles, sum(n)::BIGINT AS candidates, count_if(p IS NULL)::BIGINT AS missing, count_if(p = 'soon')::BIGINT AS invalid FROM o GROUP BY 1
""".replace("\\\\", "\\"))
def summary_by_year(spark: SparkSession, d: str) -> DataFrame:
    p = F.when(F.col("o_orderkey") % 11 == 0, None).when(F.col("o_orderkey") % 13 == 0, "soon").otherwise(_day("o_orderdate"))
    return manifest.summary(_t(spark, d, "orders").select(p.alias("published"), F.array_repeat(F.lit(1), (F.col("o_orderkey") % 4).cast("int")).alias("candidates")))


_TWO_DATES = "a AS (SELECT s_nationkey AS url, min(s_name) AS pa FROM supplier WHERE s_acctbal > 0 GROUP BY 1), b AS (SELECT c_nationkey AS url, min(c_name) AS pb FROM customer WHERE c_acctbal < 0 GROUP BY 1)"


def _catalogs(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    none = F.array().cast("array<struct<snapshotUrl:string>>")
    a = _t(spark, d, "supplier").where("s_acctbal > 0").groupBy("s_nationkey").agg(F.min("s_name"))
    b = _t(spark, d, "customer").where("c_acctbal < 0").groupBy("c_nationkey").agg(F.min("c_name"))
    return a.toDF("url", "published").withColumn("c", none), b.toDF("url", "published").withColumn("c", none)


@query(f"WITH {_TWO_DATES} SELECT coalesce(a.url, b.url) AS url, coalesce(pa, pb) AS published FROM a FULL JOIN b ON a.url = b.url")
def catalog_left_wins(spark: SparkSession, d: str) -> DataFrame:
    return manifest.full_catalog(*_catalogs(spark, d), right_date_wins=False).select("url", "published")


@query(f"WITH {_TWO_DATES} SELECT coalesce(a.url, b.url) AS url, coalesce(pb, pa) AS published FROM a FULL JOIN b ON a.url = b.url")
def catalog_right_wins(spark: SparkSession, d: str) -> DataFrame:
    return manifest.full_catalog(*_catalogs(spark, d), right_date_wins=True).select("url", "published")


@query("SELECT url, min(published) AS published FROM (SELECT o_custkey AS url, o_orderdate AS published FROM orders UNION ALL SELECT l_suppkey, l_shipdate FROM lineitem UNION ALL SELECT user_id, ts FROM events) GROUP BY url")
def earliest_dates(spark: SparkSession, d: str) -> DataFrame:
    o, li, e = _t(spark, d, "orders"), _t(spark, d, "lineitem"), _t(spark, d, "events")
    return manifest.earliest_dates(o.select(F.col("o_custkey").alias("url"), F.col("o_orderdate").alias("published")), li.select(F.col("l_suppkey").alias("url"), F.col("l_shipdate").alias("published")), e.select(F.col("user_id").alias("url"), F.col("ts").alias("published")))


@query("SELECT doc_id AS url, md5(text) AS digest FROM documents QUALIFY row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) = 1")
def reused_digests(spark: SparkSession, d: str) -> DataFrame:
    return manifest.drop_reused_digests(_t(spark, d, "documents").select(F.col("doc_id").alias("url"), F.md5("text").alias("digest")))


# ---- URLs, dates and text ----


@query(f"SELECT page_id, {_HOST} || {_PATH} AS key FROM pages")
def url_key(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "pages").select("page_id", urls.match_key(F.col("url")).alias("key"))


@query(r"""SELECT page_id, CASE WHEN regexp_matches(url, '^https?://(www\.)?example\.com/[a-z]{2}/\d+|^https?://m\.example\.com/') THEN 'x' WHEN regexp_matches(url, '^https?://(?:www\.|m\.)?blog\.example\.com/') THEN NULL END AS article,
regexp_extract(url, '^https?://([^/?#]+)', 1) NOT LIKE '%:%' AS public FROM pages""")
def url_guard(spark: SparkSession, d: str) -> DataFrame:
    p = _t(spark, d, "pages")
    return p.select("page_id", F.when(urls.normalize(urls.RULES["daily"], F.col("url")).isNotNull(), "x").alias("article"), urls.is_public(F.col("url")).alias("public"))


@query(r"""
WITH q AS (SELECT page_id, regexp_replace(url, '[?#].*$', '') AS base, list_filter(string_split(regexp_extract(url, '\?([^#]*)', 1), '&'), lambda x: x <> '' AND NOT regexp_matches(lower(x), '^(ref|fbclid|gclid|mc_cid|mc_eid|cmpid)(=|$)|^utm_')) AS kept FROM pages)
SELECT page_id, CASE WHEN len(kept) > 0 THEN base || '?' || array_to_string(kept, '&') ELSE base END AS url FROM q""")
def url_tracking(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "pages").select("page_id", urls.strip_tracking(F.col("url")).alias("url"))


@query(f"""
WITH p AS (SELECT page_id, {_HOST} AS h, regexp_replace(regexp_extract(url, '^https?://[^/?#]+(/[^?#]*)?', 1), '/+$', '') AS p FROM pages)
SELECT page_id, s || '://' || w || h || p || e AS variant FROM p, (SELECT unnest(['https', 'http']) AS s), (SELECT unnest(['www.', '']) AS w), (SELECT unnest(['', '/']) AS e)
""")
def url_variants(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "pages").select("page_id", F.explode(urls.variants(F.col("url"))).alias("variant"))


_DATED = "CASE o_orderkey % 4 WHEN 0 THEN 'https://www.example.com/' || strftime(o_orderdate + INTERVAL 10 YEAR, '%Y/%m/%d') || '/x' WHEN 1 THEN 'https://www.example.com/news/articles/' || strftime(o_orderdate + INTERVAL 10 YEAR, '%Y-%m-%d') || '/x' WHEN 2 THEN 'https://www.example.com/2010/02/31/a-' || strftime(o_orderdate + INTERVAL 10 YEAR, '%Y-%m-%d') ELSE 'https://www.example.com/none' END"


@query(f"SELECT o_orderkey, {_DATED} AS url, CASE WHEN o_orderkey % 4 < 2 THEN (o_orderdate + INTERVAL 10 YEAR)::DATE END AS published FROM orders")
def url_year(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("o_orderdate") + F.expr("INTERVAL 10 YEAR")
    kind, site = F.col("o_orderkey") % 4, "https://www.example.com/"
    url = F.when(kind == 0, F.concat(F.lit(site), F.date_format(t, "yyyy/MM/dd"), F.lit("/x"))).when(kind == 1, F.concat(F.lit(f"{site}news/articles/"), F.date_format(t, "yyyy-MM-dd"), F.lit("/x"))).when(kind == 2, F.concat(F.lit(f"{site}2010/02/31/a-"), F.date_format(t, "yyyy-MM-dd"))).otherwise(f"{site}none")
    return _t(spark, d, "orders").select("o_orderkey", url.alias("url")).withColumn("published", dates.url_date(F.col("url")))


@query(f"""
WITH b AS (SELECT item_id, {_WORDS.format("text")} AS tb FROM benchmark), a AS (SELECT doc_id, {_WORDS.format("text")} AS ta FROM documents),
p AS (SELECT doc_id, item_id, len(list_intersect(ta, tb)) / CASE WHEN least(len(ta), len(tb)) = 0 THEN NULL ELSE least(len(ta), len(tb)) END AS overlap FROM a, b)
SELECT doc_id, item_id, overlap FROM p WHERE overlap >= 0.35 QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY overlap DESC, item_id) <= 3
""")
def token_overlap(spark: SparkSession, d: str) -> DataFrame:
    a = _t(spark, d, "documents").select(F.col("doc_id").alias("id"), text.tokens(F.col("text")).alias("tokens"))
    b = _t(spark, d, "benchmark").select(F.col("item_id").alias("id"), text.tokens(F.col("text")).alias("tokens"))
    return rank.top_per_key(joins.token_pairs(a, b, 0.35).toDF("doc_id", "item_id", "overlap"), ["doc_id"], [F.desc("overlap"), "item_id"], 3)


@query("SELECT page_id, 'daily:' || sha256(url) AS id, (('0x' || substr(sha256('a:' || page_id), 1, 16))::UBIGINT & 9223372036854775807)::BIGINT AS priority FROM pages")
def stable_ids(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "pages").select("page_id", text.stable_id(F.lit("daily"), F.col("url")).alias("id"), text.hash_number(F.lit("a"), F.col("page_id")).alias("priority"))


@query("SELECT source, sha256(string_agg(DISTINCT lang || chr(10), '' ORDER BY lang || chr(10))) AS fingerprint FROM documents GROUP BY source")
def url_fingerprints(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "documents").groupBy("source").agg(text.url_fingerprint(F.col("lang")).alias("fingerprint"))


@query("""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents),
f AS (SELECT doc_id, line, min(pos) AS pos FROM l GROUP BY doc_id, line)
SELECT doc_id, md5(string_agg(line, chr(10) ORDER BY pos)) AS digest FROM f GROUP BY doc_id
""")
def distinct_lines(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "documents").select("doc_id", F.md5(text.distinct_lines(F.col("text"))).alias("digest"))


# ---- quality and parsing ----

_LOW = "lower(html)"
_SIGNALS = f"""
s AS (SELECT page_id, strlen(html) AS n, {" OR ".join(f"contains({_LOW}, '{m}')" for m in quality.HTML_MARKS)} AS looks, {" OR ".join(f"contains({_LOW}, '{m}')" for m in quality.ARTICLE_MARKS)} AS art, {" OR ".join(f"contains({_LOW}, '{m}')" for m in quality.BODY_MARKS)} AS body,
 {" OR ".join(f"contains({_LOW}, '{m}')" for m in quality.ERROR_MARKS)} AS err, {" OR ".join(f"contains({_LOW}, '{m}')" for m in quality.SHELLS["authentication"])} AS auth, {" OR ".join(f"contains({_LOW}, '{m}')" for m in quality.SHELLS["challenge"])} AS chal,
 {" OR ".join(f"contains({_LOW}, '{m}')" for m in quality.SHELLS["subscription"])} AS sub, {" OR ".join(f"contains({_LOW}, '{m}')" for m in quality.SHELLS["redirect"])} AS redir, CASE WHEN page_id % 9 = 0 THEN 404 ELSE 200 END AS status, regexp_matches(lower(url), '/(auth/login|account/login|sign-?in)([/?#]|$)') AS login FROM pages),
t AS (SELECT *, (NOT art AND (auth OR login)) AS a1, (NOT art AND chal) AS a2, (NOT body AND sub) AS a3, (NOT body AND redir) AS a4, (looks AND n < 512 AND NOT art AND NOT body) AS a5 FROM s)"""


def _signals(spark: SparkSession, d: str) -> DataFrame:
    status = F.when(F.col("page_id") % 9 == 0, 404).otherwise(200)
    return _t(spark, d, "pages").select("page_id", quality.signals(F.col("html"), status, F.lit(""), F.col("url")).alias("s"))


@query(f"""WITH {_SIGNALS}, p AS (SELECT *, (CASE WHEN status = 200 THEN 35 ELSE 0 END + CASE WHEN looks THEN 25 ELSE 0 END + CASE WHEN n >= 2048 THEN 15 ELSE 0 END + CASE WHEN art THEN 15 ELSE 0 END + CASE WHEN err THEN 0 ELSE 10 END)::INT AS p FROM t)
SELECT page_id, n AS bytes, CASE WHEN a1 OR a2 OR a3 OR a4 OR a5 THEN greatest(0, p - 60) ELSE p END AS score FROM p""")
def raw_score(spark: SparkSession, d: str) -> DataFrame:
    return _signals(spark, d).select("page_id", F.col("s.bytes").alias("bytes"), quality.score(F.col("s")).alias("score"))


@query(f"""WITH {_SIGNALS} SELECT page_id, array_to_string(list_filter([CASE WHEN status <> 200 THEN 'http-status' END, CASE WHEN NOT looks THEN 'not-html' END, CASE WHEN err THEN 'archive-error' END, CASE WHEN a1 THEN 'authentication-shell' END, CASE WHEN a2 THEN 'challenge-shell' END, CASE WHEN a3 THEN 'subscription-shell' END, CASE WHEN a4 THEN 'redirect-shell' END, CASE WHEN a5 THEN 'tiny-shell' END, CASE WHEN NOT art AND NOT body THEN 'no-article-mark' END], lambda x: x IS NOT NULL), ',') AS reasons,
 CASE WHEN status <> 200 THEN 'http-status' WHEN NOT looks THEN 'not-html' WHEN err THEN 'archive-error' WHEN a1 THEN 'authentication-shell' WHEN a2 THEN 'challenge-shell' WHEN a3 THEN 'subscription-shell' WHEN a4 THEN 'redirect-shell' WHEN a5 THEN 'tiny-shell' WHEN NOT art AND NOT body THEN 'no-article-mark' END AS first FROM t""")
def rejection_reasons(spark: SparkSession, d: str) -> DataFrame:
    return _signals(spark, d).select("page_id", F.array_join(quality.rejections(F.col("s")), ",").alias("reasons"), quality.first_rejection(F.col("s")).alias("first"))


@query()
def article_parse(spark: SparkSession, d: str) -> DataFrame:
    a = _t(spark, d, "pages").select("page_id", html.article(F.col("html"), F.col("url")).alias("a"))
    return a.select("page_id", "a.headline", "a.language", "a.status", "a.content_type", F.size("a.blocks").alias("blocks"), F.size("a.images").alias("images"), F.char_length("a.plain_text").alias("characters"), F.array_join("a.warnings", ",").alias("warnings"))


_LINES = r"l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents), k AS (SELECT *, lower(trim(regexp_replace(line, '\s+', ' ', 'g'))) AS key FROM l)"


@query(f"WITH {_LINES}, f AS (SELECT doc_id, arg_min(line, pos) AS line, min(pos) AS pos FROM k WHERE key <> '' GROUP BY doc_id, key) SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1)::INT AS position, line FROM f")
def block_dedupe(spark: SparkSession, d: str) -> DataFrame:
    return dedupe.lines(_t(spark, d, "documents"), "doc_id", "text")


@query(
    f"WITH {_LINES} SELECT doc_id, count(*) AS lines, count_if(key IN ({', '.join(repr(x) for x in quality.NOISE_EXACT)}) OR regexp_matches(key, '^_{{2,}}$')"
    + "".join(f" OR starts_with(key, '{x}')" for x in quality.NOISE_STARTS)
    + "".join(f" OR contains(key, '{x}')" for x in quality.NOISE_PARTS)
    + ")::BIGINT AS noise FROM k GROUP BY doc_id"
)
def noise_blocks(spark: SparkSession, d: str) -> DataFrame:
    lines = _t(spark, d, "documents").select("doc_id", F.explode(F.split("text", "\n", -1)).alias("line"))
    key = F.lower(F.trim(F.regexp_replace("line", r"\s+", " ")))
    return lines.groupBy("doc_id").agg(F.count("*").alias("lines"), F.count_if(quality.is_noise(key)).alias("noise"))


# ---- joins ----


@query(f"""
WITH t AS (SELECT p_partkey AS id, {_WORDS.format("p_name || ' ' || p_type")} AS w, DATE '2020-01-01' + p_size AS day FROM part),
p AS (SELECT x.id AS a, y.id AS b, len(list_intersect(x.w, y.w)) / greatest(len(x.w), len(y.w)) AS overlap, abs(x.day - y.day)::INT AS apart FROM t x JOIN t y ON abs(x.day - y.day) <= 2 WHERE len(x.w) >= 2 AND len(y.w) >= 2 AND len(list_intersect(x.w, y.w)) >= 2)
SELECT a, b, overlap, apart FROM p WHERE overlap >= 0.75 QUALIFY row_number() OVER (PARTITION BY a ORDER BY overlap DESC, apart, b) <= 3
""")
def title_match(spark: SparkSession, d: str) -> DataFrame:
    p = _t(spark, d, "part").select(F.col("p_partkey").alias("id"), F.concat("p_name", F.lit(" "), "p_type").alias("title"), F.date_add(F.lit("2020-01-01").cast("date"), F.col("p_size")).alias("day"))
    return joins.title_match(p, p, 2, 0.75, 2, 3, same_year=False)


@query("""
WITH r AS (SELECT l_orderkey AS ref, l_suppkey AS k, l_shipdate AS t FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber) = 1),
p AS (SELECT o_orderkey AS id, o_custkey AS k, o_orderdate AS t FROM orders),
j AS (SELECT p.id, p.k, p.t, r.ref, r.t AS rt FROM p LEFT JOIN r ON r.k = p.k AND r.t <= p.t QUALIFY row_number() OVER (PARTITION BY p.id ORDER BY r.t DESC NULLS LAST, r.ref DESC) = 1)
SELECT id, k, t AS "at", CASE WHEN date_diff('day', rt, t) <= 30 THEN ref END AS ref, CASE WHEN date_diff('day', rt, t) <= 30 THEN rt END AS ref_at FROM j
""")
def asof_title(spark: SparkSession, d: str) -> DataFrame:
    # the SQL leaves open which of equal dates and numbers is first; here it is the least supplier, in any run
    order = [F.asc_nulls_last(c) for c in ("l_shipdate", "l_linenumber", "l_suppkey")]
    r = rank.top_per_key(_t(spark, d, "lineitem"), ["l_orderkey"], order, 1).select(F.col("l_orderkey").alias("ref"), F.col("l_suppkey").alias("k"), F.col("l_shipdate").alias("at"))
    o = _t(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("k"), F.col("o_orderdate").alias("at"))
    return joins.asof(o, r, "k", "at", 30)


_SPANS = [(f"crawl-{y}-{m:02d}", f"{y}-{m:02d}-01", f"{y}-{m + 1:02d}-15") for y in range(1995, 2002) for m in (2, 6, 10)]


@query(f"""
WITH s AS (SELECT * FROM (VALUES {", ".join(f"('{n}', TIMESTAMP '{a}', TIMESTAMP '{b}')" for n, a, b in _SPANS)}) s(name, s, e)),
p AS (SELECT o_orderkey AS id, o_orderdate AS t, name, (CASE WHEN o_orderdate < s THEN epoch(s) - epoch(o_orderdate) WHEN o_orderdate > e THEN epoch(o_orderdate) - epoch(e) ELSE 0 END)::BIGINT AS gap, e, (o_orderdate > e)::INT AS b FROM orders, s)
SELECT id, t AS "at", name, gap, (row_number() OVER (PARTITION BY id ORDER BY gap, b, e DESC, name))::INT AS place FROM p QUALIFY row_number() OVER (PARTITION BY id ORDER BY gap, b, e DESC, name) <= 3
""")
def interval_match(spark: SparkSession, d: str) -> DataFrame:
    spans = spark.createDataFrame(_SPANS, "name string, start string, end string").select("name", F.to_timestamp("start").alias("start"), F.to_timestamp("end").alias("end"))
    items = _t(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").cast("timestamp").alias("at"))
    return joins.rank_intervals(items, spans).withColumn("at", F.col("at").cast("timestamp_ntz"))


@query(f"""
WITH p AS (SELECT page_id, {_HOST} || {_PATH} AS key, url, TIMESTAMP '2024-01-01' + INTERVAL 1 HOUR * page_id AS captured, md5(html) AS digest FROM pages),
a AS (SELECT url, key, min(captured) + INTERVAL 5 HOUR AS published FROM p GROUP BY url, key),
j AS (SELECT a.url, p.url AS original, captured, digest, abs(epoch(captured) - epoch(published)) AS gap FROM a JOIN p USING (key)),
o AS (SELECT * FROM j QUALIFY row_number() OVER (PARTITION BY url, digest ORDER BY gap, captured, original) = 1)
SELECT url, original, captured, digest, (row_number() OVER (PARTITION BY url ORDER BY gap, captured, original))::INT AS place FROM o QUALIFY row_number() OVER (PARTITION BY url ORDER BY gap, captured, original) <= 3
""")
def preindex(spark: SparkSession, d: str) -> DataFrame:
    at = F.timestamp_seconds(1704067200 + F.col("page_id") * 3600)
    c = _t(spark, d, "pages").select(F.col("url").alias("original"), at.alias("captured"), F.md5("html").alias("digest"))
    a = c.groupBy(F.col("original").alias("url")).agg((F.min("captured") + F.expr("INTERVAL 5 HOURS")).alias("published"))
    return joins.preindex(c, a).withColumn("captured", F.col("captured").cast("timestamp_ntz"))


@query(f"""
WITH t AS (SELECT p_partkey, p_brand, p_size, {_WORDS.format("p_name")} AS w FROM part), e AS (SELECT min(p_partkey) AS id, {_WORDS.format("p_name || ' sale'")} AS x FROM part GROUP BY p_name),
s AS (SELECT id, p_partkey, p_size, len(list_intersect(x, w)) / CASE WHEN least(len(x), len(w)) = 0 THEN NULL ELSE least(len(x), len(w)) END AS overlap FROM e, t)
SELECT id, p_partkey AS position, overlap, (row_number() OVER (PARTITION BY id ORDER BY overlap DESC, p_size, p_partkey))::INT AS place FROM s WHERE overlap >= 0.35 QUALIFY row_number() OVER (PARTITION BY id ORDER BY overlap DESC, p_size, p_partkey) <= 8
""")
def search_overlap(spark: SparkSession, d: str) -> DataFrame:
    e = _t(spark, d, "part").groupBy("p_name").agg(F.min("p_partkey").alias("id")).select("id", F.concat("p_name", F.lit(" sale")).alias("title"))
    f = _t(spark, d, "part").select(F.col("p_partkey").alias("position"), F.col("p_size").alias("priority"), F.col("p_name").alias("title"))
    return joins.by_overlap(joins.sharing_tokens(e, f, 8), "expected", "found").select("id", "position", "overlap", "place")


@query(f"""
WITH e AS (SELECT doc_id AS id, source, {_WORDS.format("text")} AS x FROM documents), s AS (SELECT e.id, f.id AS url, len(list_intersect(e.x, f.x)) / len(e.x) AS coverage, len(list_intersect(e.x, f.x)) AS shared FROM e JOIN e f ON e.source = f.source AND e.id <> f.id WHERE len(e.x) > 0)
SELECT id, arg_max(url, (coverage, -url)) AS url, max(coverage) AS coverage FROM s WHERE coverage >= 0.8 AND shared >= 4 GROUP BY id
""")
def best_original(spark: SparkSession, d: str) -> DataFrame:
    """Copies of a document in its source."""
    docs = _t(spark, d, "documents").select(F.col("doc_id").alias("id"), "source", text.tokens(F.col("text")).alias("x"))
    return containment.best_container(docs)


@query("""
WITH s AS (SELECT d.doc_id, n_chars, (quality = 1) AS attributed, abs(d.doc_id % 7 - 3) AS days, (toxic = 1) AS visible, (d.doc_id % 10) / 10.0 AS overlap FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
SELECT doc_id, CASE WHEN n_chars < 400 THEN 'short-body' WHEN NOT coalesce(attributed, false) THEN 'no-attribution' WHEN overlap < 0.5 THEN 'headline-differs' WHEN NOT (days <= 2 OR coalesce(visible, false)) THEN 'date-differs' END AS verdict FROM s
""")
def copy_verdict(spark: SparkSession, d: str) -> DataFrame:
    s = _t(spark, d, "documents").join(_t(spark, d, "labels"), "doc_id", "left")
    k = F.col("doc_id")
    return s.select("doc_id", joins.verdict(F.col("n_chars"), (k % 10) / 10, F.abs(k % 7 - 3), F.coalesce(F.col("quality") == 1, F.lit(False)), F.coalesce(F.col("toxic") == 1, F.lit(False)), least_overlap=0.5).alias("verdict"))


@query("SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def anti_sample(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "documents").join(_t(spark, d, "labels"), "doc_id", "left_anti").select("doc_id", "source")


@query("SELECT source, count(*) AS n, count_if(EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND toxic = 1))::BIGINT AS excluded FROM documents d GROUP BY source")
def exclusion_counts(spark: SparkSession, d: str) -> DataFrame:
    out = _t(spark, d, "labels").where("toxic = 1").select("doc_id", F.lit(True).alias("out")).distinct()
    return summary.conditional_counts(_t(spark, d, "documents").join(out, "doc_id", "left"), ["source"], excluded=F.col("out").isNotNull())


@query("SELECT l.doc_id, l.quality FROM labels l LEFT JOIN documents d ON l.doc_id = d.doc_id WHERE d.doc_id IS NULL OR (l.quality = 1 AND d.lang = 'en') OR (l.quality = 0 AND d.lang <> 'en')")
def stale_results(spark: SparkSession, d: str) -> DataFrame:
    r = _t(spark, d, "labels").select("doc_id", "quality", F.col("quality").alias("digest"))
    c = _t(spark, d, "documents").select("doc_id", (F.col("lang") == "en").cast("int").alias("digest"))
    return state.without_stale(r, c, "doc_id", "digest").select("doc_id", "quality")


# ---- counts, rates and gates ----


@query("SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def status_histogram(spark: SparkSession, d: str) -> DataFrame:
    return summary.status_counts(_t(spark, d, "events"), "event_type")


@query("""
SELECT d.lang, count(*) AS n, count_if(quality = 1)::BIGINT AS good, count_if(toxic = 1)::BIGINT AS toxic, count_if(quality IS NULL)::BIGINT AS unlabelled, count_if(n_chars >= 1000 AND quality = 1)::BIGINT AS long_good, count_if(n_chars < 400)::BIGINT AS short
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY d.lang
""")
def cond_aggregates(spark: SparkSession, d: str) -> DataFrame:
    x = _t(spark, d, "documents").join(_t(spark, d, "labels"), "doc_id", "left")
    good = F.coalesce(F.col("quality") == 1, F.lit(False))
    return summary.conditional_counts(x, ["lang"], good=good, toxic=F.coalesce(F.col("toxic") == 1, F.lit(False)), unlabelled=F.col("quality").isNull(), long_good=(F.col("n_chars") >= 1000) & good, short=F.col("n_chars") < 400)


@query("SELECT count(*) AS keys, coalesce(bool_and(n >= 20), false) AS ready FROM (SELECT lang, count_if(n_chars >= 500) AS n FROM documents GROUP BY lang)")
def target_all(spark: SparkSession, d: str) -> DataFrame:
    return summary.all_reach(_t(spark, d, "documents"), "lang", F.col("n_chars") >= 500, 20)


@query("SELECT l_partkey, l_suppkey, sum(l_quantity) AS total FROM lineitem GROUP BY l_partkey, l_suppkey HAVING sum(l_quantity) < 40")
def having_under_target(spark: SparkSession, d: str) -> DataFrame:
    return summary.under_target(_t(spark, d, "lineitem"), ["l_partkey", "l_suppkey"], F.col("l_quantity"), 40)


@query("SELECT y.year::INT AS year, count(o_orderkey) AS n, count(o_orderkey) >= 300 AS ready FROM (SELECT unnest(range(1993, 2004)) AS year) y LEFT JOIN orders ON year(o_orderdate) = y.year GROUP BY y.year")
def years_ready(spark: SparkSession, d: str) -> DataFrame:
    return summary.years_ready(_t(spark, d, "orders").select(F.year("o_orderdate").alias("year")), "year", 1993, 2003, 300)


@query("""
WITH r AS (SELECT year(o_orderdate) AS y, o_orderkey, o_orderpriority, o_orderstatus FROM orders),
i AS (SELECT y, o_orderpriority AS issue, count(*) AS n FROM r WHERE o_orderstatus = 'F' GROUP BY ALL), m AS (SELECT y, string_agg(issue || '=' || n, ';' ORDER BY issue) AS issues FROM i GROUP BY y),
f AS (SELECT y, lpad(o_orderkey::VARCHAR, 9, '0') AS k FROM r WHERE o_orderstatus <> 'O' QUALIFY row_number() OVER (PARTITION BY y ORDER BY lpad(o_orderkey::VARCHAR, 9, '0')) <= 20),
g AS (SELECT y, string_agg(k, ';' ORDER BY k) AS failures FROM f GROUP BY y)
SELECT y::INT AS sample_year, count(*) AS evaluated, count_if(o_orderstatus <> 'F')::BIGINT AS complete, count_if(o_orderstatus = 'O')::BIGINT AS passed, count_if(o_orderstatus = 'F')::BIGINT AS failed, failures, issues,
 (count(*) >= 100 AND count_if(o_orderstatus <> 'F') / count(*) >= 0.95 AND count_if(o_orderstatus = 'O') = count(*) AND count_if(o_orderstatus = 'F') = 0) AS ready
FROM r LEFT JOIN m USING (y) LEFT JOIN g USING (y) GROUP BY ALL
""")
def validation_summary(spark: SparkSession, d: str) -> DataFrame:
    o = _t(spark, d, "orders")
    bad = F.col("o_orderstatus") == "F"
    r = o.select(F.year("o_orderdate").alias("sample_year"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0").alias("canonical_url"), F.when(bad, "failed").otherwise("complete").alias("status"), (F.col("o_orderstatus") == "O").alias("qa_pass"), F.when(bad, F.array("o_orderpriority")).otherwise(F.array().cast("array<string>")).alias("issues"))
    out = summary.validation(r, 100)
    shown = F.array_join(F.transform(F.map_entries("issues"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ";")
    return out.select("sample_year", "evaluated", "complete", "passed", "failed", F.array_join("failures", ";").alias("failures"), shown.alias("issues"), "ready")


@query("SELECT lang, count(*) AS n, sum(n_chars)::BIGINT AS characters, max(n_chars) AS most, count(DISTINCT source) AS sources FROM documents GROUP BY lang")
def capture_summary(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "documents").groupBy("lang").agg(F.count("*").alias("n"), F.sum("n_chars").alias("characters"), F.max("n_chars").alias("most"), F.countDistinct("source").alias("sources"))


@query("SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n, sum((value * 100)::BIGINT)::BIGINT AS total FROM events GROUP BY ALL")
def event_windows(spark: SparkSession, d: str) -> DataFrame:
    e = _t(spark, d, "events").withColumn("value", F.round(F.col("value") * 100).cast("bigint"))
    return streams.windowed(e, "ts", ["event_type"]).withColumn("start", F.col("start").cast("timestamp_ntz"))


# ---- order, queues and samples ----


@query("SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY md5(event_id::VARCHAR))::INT AS turn FROM events")
def round_robin(spark: SparkSession, d: str) -> DataFrame:
    e = _t(spark, d, "events").select("event_type", "event_id", F.md5(F.col("event_id").cast("string")).alias("h"))
    return rank.round_robin(e, "event_type", ["h"]).drop("h")


@query("""
WITH r AS (SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS turn FROM events), n AS (SELECT event_type, count_if(user_id < 10) AS n FROM events GROUP BY event_type)
SELECT event_type, event_id, turn::INT AS turn FROM r JOIN n USING (event_type) WHERE turn <= 300 - n
""")
def shortfall(spark: SparkSession, d: str) -> DataFrame:
    e = _t(spark, d, "events")
    done = e.groupBy("event_type").agg(F.count_if(F.col("user_id") < 10).alias("n"))
    return rank.shortfall(e.select("event_type", "event_id"), done, "event_type", ["event_id"], 300)


@query("""
WITH n AS (SELECT l_suppkey, l_shipdate, count(*) AS n FROM lineitem GROUP BY ALL)
SELECT l_suppkey, l_shipdate, n, coalesce(sum(n) OVER (PARTITION BY l_suppkey ORDER BY l_shipdate ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS first FROM n
""")
def prefix_offsets(spark: SparkSession, d: str) -> DataFrame:
    n = _t(spark, d, "lineitem").groupBy("l_suppkey", "l_shipdate").agg(F.count("*").alias("n"))
    return rank.prefix_offsets(n, ["l_suppkey"], ["l_shipdate"], "n")


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN 0 WHEN o_orderpriority = '1-URGENT' THEN 1 WHEN o_orderstatus = 'F' THEN 2 ELSE 3 END AS tier,
 row_number() OVER (ORDER BY CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN 0 WHEN o_orderpriority = '1-URGENT' THEN 1 WHEN o_orderstatus = 'F' THEN 2 ELSE 3 END, o_orderdate, o_orderkey)::INT AS place
FROM orders WHERE o_orderstatus IN ('F', 'O') QUALIFY place <= 500
""")
def work_queue(spark: SparkSession, d: str) -> DataFrame:
    """The next 500 items of the queue: a top-k, each partition keeps 500 rows."""
    from pyspark.sql import Window

    o = _t(spark, d, "orders").withColumn("attempts", F.lit(0))
    bad, urgent = F.col("o_orderstatus") == "F", F.col("o_orderpriority") == "1-URGENT"
    order = ["tier", "o_orderdate", "o_orderkey"]
    top = rank.queue(o.withColumn("tier", rank.tiers(bad & urgent, urgent, bad)), order, status="o_orderstatus", states=("F", "O"), limit=500)
    return top.withColumn("place", F.row_number().over(Window.orderBy(*order))).select("o_orderkey", "tier", "place")


@query("SELECT lang, doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY lang ORDER BY sha256('seed|' || lang || '|' || doc_id), doc_id) <= 25")
def hash_sample(spark: SparkSession, d: str) -> DataFrame:
    return sampling.by_hash(_t(spark, d, "documents").select("lang", "doc_id"), "lang", "doc_id", "seed", 25).select("lang", "doc_id")


@query("""
WITH s AS (SELECT o_orderkey AS shard, 10 AS start, 10 + count(*) AS stop FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1),
b AS (SELECT *, (sum(stop - start) OVER (ORDER BY shard))::BIGINT - (stop - start) AS base FROM s), t AS (SELECT sum(stop - start)::BIGINT AS total FROM s),
p AS (SELECT DISTINCT least(total - 1, floor((i + 0.5) * total / least(total, 1000)))::BIGINT AS place FROM t, (SELECT unnest(range(0, 1000)) AS i) WHERE i < least(total, 1000))
SELECT shard, start + place - base AS rank FROM p JOIN b ON place >= base AND place < base + stop - start
""")
def systematic_sample(spark: SparkSession, d: str) -> DataFrame:
    li, o = _t(spark, d, "lineitem"), _t(spark, d, "orders")
    n = li.join(o, li.l_orderkey == o.o_orderkey).groupBy(F.col("l_orderkey").alias("shard")).agg(F.count("*").alias("n"))
    return sampling.systematic(n.select("shard", F.lit(10).cast("bigint").alias("start"), (F.col("n") + 10).alias("end")), 1000)


@query("""
WITH a AS (SELECT d.lang, d.doc_id, CASE WHEN l.doc_id IS NOT NULL THEN 0 WHEN n_chars >= 1000 THEN 1 ELSE 2 END AS tier FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY tier, sha256('plan|' || lang || '|' || doc_id), doc_id) AS place FROM a)
SELECT lang, doc_id, tier, place::INT AS place, place > 50 AS reserve FROM r WHERE place <= 150
""")
def sample_plan(spark: SparkSession, d: str) -> DataFrame:
    docs, labels = _t(spark, d, "documents"), _t(spark, d, "labels").select("doc_id")
    done = docs.join(labels, "doc_id", "left_semi").select("lang", "doc_id")
    return sampling.plan(done, docs, "lang", "doc_id", "plan", 50, F.col("n_chars") >= 1000).select("lang", "doc_id", "tier", "place", "reserve")


# ---- state, audits and plans ----


def _halves(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    o = _t(spark, d, "orders")
    part = lambda c: o.where(c).groupBy("o_custkey").agg(F.max("o_orderdate").alias("day"), F.max("o_totalprice").alias("price"), F.min("o_orderstatus").alias("status"), F.min("o_orderpriority").alias("section"))
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    return part(F.col("o_orderdate") < cut), part(F.col("o_orderdate") >= cut)


_HALVES = "a AS (SELECT o_custkey, max(o_orderdate) AS day, max(o_totalprice) AS price, min(o_orderstatus) AS status, min(o_orderpriority) AS section FROM orders WHERE o_orderdate < '1998-01-01' GROUP BY 1), b AS (SELECT o_custkey, max(o_orderdate) AS day, max(o_totalprice) AS price, min(o_orderstatus) AS status, min(o_orderpriority) AS section FROM orders WHERE o_orderdate >= '1998-01-01' GROUP BY 1)"


@query(f"WITH {_HALVES} SELECT coalesce(a.o_custkey, b.o_custkey) AS o_custkey, least(a.day, b.day) AS day, greatest(a.price, b.price) AS price, coalesce(a.status, b.status) AS status, coalesce(b.section, a.section) AS section FROM a FULL JOIN b ON a.o_custkey = b.o_custkey")
def upsert_rules(spark: SparkSession, d: str) -> DataFrame:
    return state.upsert(*_halves(spark, d), ["o_custkey"], {"day": "least", "price": "greatest", "status": "old", "section": "new_if_set"})


@query(f"WITH {_HALVES} SELECT coalesce(a.o_custkey, b.o_custkey) AS o_custkey, CASE WHEN a.o_custkey IS NULL OR a.status <> 'O' THEN coalesce(b.day, a.day) ELSE a.day END AS day, CASE WHEN a.o_custkey IS NULL OR a.status <> 'O' THEN coalesce(b.price, a.price) ELSE a.price END AS price, CASE WHEN a.o_custkey IS NULL OR a.status <> 'O' THEN coalesce(b.status, a.status) ELSE a.status END AS status, coalesce(a.section, b.section) AS section FROM a FULL JOIN b ON a.o_custkey = b.o_custkey")
def upsert_guarded(spark: SparkSession, d: str) -> DataFrame:
    return state.upsert(*_halves(spark, d), ["o_custkey"], {"section": "insert_only"}, when=F.col("old.status") != "O")


@query(f"WITH {_HALVES} SELECT * FROM a UNION ALL SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.o_custkey = b.o_custkey)")
def insert_absent(spark: SparkSession, d: str) -> DataFrame:
    return state.insert_absent(*_halves(spark, d), ["o_custkey"])


@query(f"WITH {_HALVES}, u AS (SELECT *, 1 AS old FROM a UNION ALL SELECT *, 0 FROM b) SELECT o_custkey, day, price, status, section FROM u QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY price DESC, old DESC) = 1")
def better_record(spark: SparkSession, d: str) -> DataFrame:
    return state.better_record(*_halves(spark, d), "o_custkey", "price")


@query("SELECT DISTINCT sha256(text) AS sha256, strlen(text) AS bytes FROM documents")
def content_store(spark: SparkSession, d: str) -> DataFrame:
    return state.content_store(_t(spark, d, "documents"), "text").select("sha256", F.octet_length("content").cast("bigint").alias("bytes"))


@query("""
WITH p AS (SELECT DISTINCT source, lang || ':' || (n_chars // 100) AS k FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)), c AS (SELECT DISTINCT source, lang || ':' || (n_chars // 100) AS k FROM documents WHERE n_chars >= 1000),
b AS (SELECT coalesce(p.source, c.source) AS source, coalesce(p.k, c.k) AS k, p.k IS NOT NULL AS p, c.k IS NOT NULL AS c FROM p FULL JOIN c ON p.source = c.source AND p.k = c.k)
SELECT source, count_if(p AND c)::BIGINT AS kept, count_if(p AND NOT c)::BIGINT AS dropped, count_if(c AND NOT p)::BIGINT AS added,
 sha256(coalesce(string_agg(k || chr(10), '' ORDER BY k) FILTER (p), chr(10))) AS before, sha256(coalesce(string_agg(k || chr(10), '' ORDER BY k) FILTER (c), chr(10))) AS after FROM b GROUP BY source
""")
def set_audit(spark: SparkSession, d: str) -> DataFrame:
    docs = _t(spark, d, "documents").withColumn("k", F.concat_ws(":", "lang", F.expr("n_chars DIV 100").cast("string")))
    before = docs.join(_t(spark, d, "labels").select("doc_id"), "doc_id", "left_semi")
    return audit.overlap(before, docs.where("n_chars >= 1000"), "source", "k")


@query("""
WITH s AS (SELECT text, 'lang-' || lang AS label FROM documents UNION ALL SELECT text, 'src-' || source FROM documents), c AS (SELECT DISTINCT text FROM documents WHERE doc_id IN (SELECT doc_id FROM labels))
SELECT md5(text) AS key, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM s JOIN c USING (text) GROUP BY text
""")
def holdout_audit(spark: SparkSession, d: str) -> DataFrame:
    docs = _t(spark, d, "documents").select("doc_id", F.md5("text").alias("key"), "lang", "source")
    seen = docs.select("key", F.concat(F.lit("lang-"), "lang").alias("label")).unionByName(docs.select("key", F.concat(F.lit("src-"), "source").alias("label")))
    now = docs.join(_t(spark, d, "labels").select("doc_id"), "doc_id", "left_semi")
    return audit.holdout(seen, now, "key").select("key", F.array_join("labels", ",").alias("labels"))


_CELLS = "s AS (SELECT c_mktsegment AS publisher, c_nationkey AS year, CASE WHEN c_custkey % 5 = 0 THEN 'holdout-' || (c_custkey % 3) WHEN c_custkey % 5 = 1 THEN 'validation' WHEN c_custkey % 5 = 2 THEN 'source' ELSE 'x' || (c_custkey % 5) END AS cohort, count(*) AS evaluated FROM customer GROUP BY ALL), l AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY publisher, year ORDER BY CASE WHEN starts_with(cohort, 'holdout-') THEN 3 WHEN cohort = 'validation' THEN 2 WHEN cohort = 'source' THEN 1 ELSE 0 END DESC, CASE WHEN starts_with(cohort, 'holdout-') THEN substr(cohort, 9)::INT ELSE -1 END DESC, evaluated DESC, cohort DESC) = 1)"


def _summaries(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    cohort = F.when(k % 5 == 0, F.concat(F.lit("holdout-"), k % 3)).when(k % 5 == 1, "validation").when(k % 5 == 2, "source").otherwise(F.concat(F.lit("x"), k % 5))
    return _t(spark, d, "customer").groupBy(F.col("c_mktsegment").alias("publisher"), F.col("c_nationkey").alias("year"), cohort.alias("cohort")).agg(F.count("*").alias("evaluated"))


@query(f"WITH {_CELLS} SELECT publisher, year, cohort, evaluated FROM l")
def current_cohort(spark: SparkSession, d: str) -> DataFrame:
    return dispatch.current_cohort(_summaries(spark, d))


@query(f"""
WITH {_CELLS}, g AS (SELECT DISTINCT c_mktsegment AS publisher, y::INT AS year FROM customer, (SELECT unnest(range(0, 30)) AS y)),
a AS (SELECT DISTINCT c_mktsegment AS publisher, c_nationkey AS year FROM customer WHERE c_acctbal < -950),
o AS (SELECT publisher, year, cohort, evaluated FROM g LEFT JOIN l USING (publisher, year) WHERE (publisher, year) NOT IN (SELECT publisher, year FROM a) AND 20 > coalesce(evaluated, 0))
SELECT row_number() OVER (ORDER BY (evaluated IS NOT NULL), evaluated, publisher, year)::INT AS place, publisher, year, cohort, evaluated FROM o QUALIFY place <= 40
""")
def dispatch_plan(spark: SparkSession, d: str) -> DataFrame:
    """The next 40 cells: a top-k of the plan."""
    c = _t(spark, d, "customer")
    grid = dispatch.grid(c.select(F.col("c_mktsegment").alias("publisher")).distinct(), 0, 29)
    rows = _summaries(spark, d).withColumns({"target": F.lit(800), "complete_rate": F.lit(1.0), "qa_pass_rate": F.lit(1.0), "errors": F.lit(0), "unbound": F.lit(0)})
    active = c.where("c_acctbal < -950").select(F.col("c_mktsegment").alias("publisher"), F.col("c_nationkey").alias("year")).distinct()
    return dispatch.dispatch(grid, rows, active, grid.withColumn("eligible", F.lit(20)), 40)


@query("SELECT n_nationkey, 'manifests/' || CASE WHEN n_regionkey = 0 THEN 'reuters' ELSE lower(n_name) END || '/' || CASE WHEN n_regionkey = 0 THEN ((1990 + n_nationkey) // 5 * 5) || '-' || ((1990 + n_nationkey) // 5 * 5 + 4) ELSE (1990 + n_nationkey)::VARCHAR END || '.jsonl.gz' AS shard FROM nation")
def shard_case(spark: SparkSession, d: str) -> DataFrame:
    n = _t(spark, d, "nation")
    return n.select("n_nationkey", dispatch.shard(F.when(F.col("n_regionkey") == 0, "reuters").otherwise(F.lower("n_name")), F.lit(1990) + F.col("n_nationkey")).alias("shard"))


@query("SELECT count_if(o_orderstatus IN ('F', 'O') AND o_orderkey % 5 < 3 AND n < 400) > 0 AS more FROM orders JOIN (SELECT year(o_orderdate) AS y, count_if(o_orderstatus = 'P') AS n FROM orders GROUP BY 1) ON year(o_orderdate) = y")
def should_continue(spark: SparkSession, d: str) -> DataFrame:
    o = _t(spark, d, "orders").select(F.year("o_orderdate").alias("year"), F.when(F.col("o_orderstatus") == "P", "complete").when(F.col("o_orderstatus") == "F", "error").otherwise("pending").alias("status"), (F.col("o_orderkey") % 5).alias("attempts"))
    done = o.groupBy("year").agg(F.count_if(F.col("status") == "complete").alias("n"))
    return dispatch.should_continue(o.where("status <> 'complete'"), done, "year", 400)


# ---- validation tables, queues and stores ----


@query("SELECT lang, doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY lang ORDER BY sha256('seed' || chr(0) || 'ap' || chr(0) || lang || chr(0) || doc_id), doc_id) <= 25")
def validation_sample(spark: SparkSession, d: str) -> DataFrame:
    return sampling.by_hash(_t(spark, d, "documents").select("lang", "doc_id"), "lang", "doc_id", "seed", 25, publisher="ap", sep=sampling.NUL).select("lang", "doc_id")




def _marks(column: str, marks: tuple[str, ...]) -> str:
    return "(" + " OR ".join("contains({}, '{}')".format(column, m.replace("'", "''")) for m in marks) + ")"


@query(f"""
WITH p AS (SELECT page_id, lower(html) AS h, strlen(html) AS n, CASE WHEN page_id % 9 = 0 THEN 404 ELSE 200 END AS status, lower(url) AS u FROM pages),
s AS (SELECT *, {_marks("h", capture.HTML_MARKS)} AS looks, {_marks("h", quality.ARTICLE_MARKS)} AS art, {_marks("h", capture.BODY_MARKS)} AS body, {_marks("h", capture.ERROR_MARKS)} AS err, {_marks("h", capture.SERVER_MARKS)} AND n <= {capture.PLACEHOLDER} AS server,
 {_marks("h", capture.SHELLS["authentication"])} OR regexp_matches(u, '{capture.LOGIN_PATH}') AS auth, {_marks("h", capture.SHELLS["challenge"])} OR regexp_matches(u, '{capture.CHALLENGE_PATH}') AS chal, {_marks("h", capture.SHELLS["redirect"])} AS redir,
 regexp_matches(u, '{capture.BARRIER_URL}') OR {_marks("h", capture.SHELLS["subscription"])} OR {" OR ".join("(" + " AND ".join(f"contains(h, '{m}')" for m in marks) + ")" for marks in capture.SUBSCRIPTION_SETS)} AS walled, contains(h, '{capture.SNIPPET_MARK}') AS snippet,
 {" AND ".join(f"contains(h, '{m}')" for m in capture.CUT_NOTICE)} AS cut, contains(u, 'bloomberg.com/') AND (contains(h, 'teaser-body__') OR (contains(h, 'body-content') AND contains(h, 'teaser-content__'))) AS teaser,
 {" AND ".join(f"regexp_matches(h, '{x}')" for x in capture.EMPTY_ARTICLE)} AS blank FROM p),
t AS (SELECT *, (NOT art AND auth) OR (NOT art AND chal) OR snippet OR blank OR (NOT body AND walled) OR (NOT body AND redir) OR cut OR teaser OR server OR (looks AND n < {capture.TINY} AND NOT art AND NOT body) AS shell,
 (CASE WHEN status = 200 THEN 35 ELSE 0 END + CASE WHEN looks THEN 25 ELSE 0 END + CASE WHEN n >= {capture.SUBSTANTIAL} THEN 15 ELSE 0 END + CASE WHEN art THEN 15 ELSE 0 END + CASE WHEN err THEN 0 ELSE 10 END)::INT AS points FROM s)
SELECT page_id, CASE WHEN shell THEN greatest(0, points - 60) ELSE points END AS score FROM t
""")
def capture_score(spark: SparkSession, d: str) -> DataFrame:
    status = F.when(F.col("page_id") % 9 == 0, 404).otherwise(200)
    s = _t(spark, d, "pages").select("page_id", capture.signals(F.col("html"), status, F.lit(""), F.col("url")).alias("s"))
    return s.select("page_id", capture.score(F.col("s")).alias("score"))


@query("SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'https://www.bloomberg.com/news/articles/2021-03-04/' || p_partkey END AS original FROM part")
def mirrored_urls(spark: SparkSession, d: str) -> DataFrame:
    url = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("https://www.bnnbloomberg.ca/bloomberg/2021/03/04/"), "p_partkey", F.lit("/?x=1"))).otherwise("https://example.com/x")
    return _t(spark, d, "part").select("p_partkey", urls.mirrored_original(url).alias("original"))


@query("""
SELECT o_orderkey, abs(o_orderkey % 41 - 20)::INT AS gap, o_orderkey % 41 = 20 AS shown FROM orders
""")
def visible_dates(spark: SparkSession, d: str) -> DataFrame:
    """Each of the five spellings in turn, so many days before or after the expected day."""
    day = F.date_add(F.lit("2012-03-10").cast("date"), (F.col("o_orderkey") % 41 - 20).cast("int"))
    shown = F.lit("")
    for k, f in enumerate(("yyyy-MM-dd", "MMMM d, yyyy", "MMM d, yyyy", "d MMMM yyyy", "d MMM yyyy")):
        shown = F.when(F.col("o_orderkey") % 5 == k, F.date_format(day, f)).otherwise(shown)
    page, want = F.concat(F.lit("Posted on "), shown, F.lit(" by the desk")), F.lit("2012-03-10").cast("date")
    return _t(spark, d, "orders").select("o_orderkey", dates.visible_date_gap(page, want).alias("gap"), dates.date_visible(page, want).alias("shown"))


_QUEUE = "q AS (SELECT o_orderkey AS key, CASE WHEN o_orderstatus = 'F' THEN 'error' WHEN o_orderstatus = 'O' THEN 'pending' ELSE 'complete' END AS status, (o_orderkey % 5)::INT AS attempts, o_orderdate AS day FROM orders)"


def _queue(spark: SparkSession, d: str) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "F", "error").when(F.col("o_orderstatus") == "O", "pending").otherwise("complete")
    return _t(spark, d, "orders").select(F.col("o_orderkey").alias("key"), status.alias("status"), (F.col("o_orderkey") % 5).cast("int").alias("attempts"), F.col("o_orderdate").alias("day"), F.lit(None).cast("string").alias("error"))


@query(f"""
WITH {_QUEUE}, c AS (SELECT key FROM q WHERE status IN ('pending', 'error') AND attempts < 3 ORDER BY day, key LIMIT 200)
SELECT key, CASE WHEN c.key IS NULL THEN status WHEN key % 2 = 0 THEN 'complete' WHEN attempts + 1 >= 3 THEN 'exhausted' ELSE 'error' END AS status, attempts + (c.key IS NOT NULL)::INT AS attempts, CASE WHEN c.key IS NOT NULL AND key % 2 = 1 THEN 'timeout' END AS error FROM q LEFT JOIN c USING (key)
""")
def claimed_turn(spark: SparkSession, d: str) -> DataFrame:
    """A turn of 200 rows: claimed, half of them failed, settled."""
    now, mine = turns.claim(_queue(spark, d), "key", ["day", "key"], 200)
    back = mine.select("key", F.when(F.col("key") % 2 == 1, "timeout").alias("error"))
    return turns.settle(now, back, "key").select("key", "status", "attempts", "error")


@query(f"WITH {_QUEUE}, s AS (SELECT status, count(*) AS n FROM q GROUP BY status) SELECT string_agg(status || '=' || n, ';' ORDER BY status) AS by_status, sum(n)::BIGINT AS rows, (SELECT sum(attempts)::BIGINT FROM q) AS attempts FROM s")
def queue_summary(spark: SparkSession, d: str) -> DataFrame:
    return summary.status_summary(_queue(spark, d), sums=("attempts",)).select(summary.shown(F.col("by_status")).alias("by_status"), "rows", "attempts")


_TABLES = "s AS (SELECT o_orderkey AS k FROM orders WHERE o_custkey % 3 = 0), c AS (SELECT o_orderkey AS k, o_orderstatus <> 'P' AS done, year(o_orderdate) AS y FROM orders WHERE o_orderkey % 4 <> 1), r AS (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_quantity >= 48), x AS (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_discount >= 0.1)"


def _tables(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    o, li = _t(spark, d, "orders"), _t(spark, d, "lineitem")
    key = F.col("o_orderkey").alias("canonical_url")
    captures = o.where("o_orderkey % 4 <> 1").select(key, F.when(F.col("o_orderstatus") != "P", "complete").otherwise("pending").alias("status"), F.year("o_orderdate").alias("y"))
    of = lambda c: li.where(c).select(F.col("l_orderkey").alias("canonical_url")).distinct()
    return o.where("o_custkey % 3 = 0").select(key), captures, of("l_quantity >= 48"), of("l_discount >= 0.1")


@query(f"WITH {_TABLES} SELECT k AS canonical_url FROM s WHERE k IN (SELECT k FROM c WHERE done) AND k NOT IN (SELECT k FROM r)")
def pending_validation(spark: SparkSession, d: str) -> DataFrame:
    samples, captures, results, _ = _tables(spark, d)
    return joins.pending(samples, captures, results, complete_only=True)


@query(f"WITH {_TABLES} SELECT k AS canonical_url FROM c WHERE k NOT IN (SELECT k FROM s) AND k NOT IN (SELECT k FROM x)")
def unsampled_captures(spark: SparkSession, d: str) -> DataFrame:
    samples, captures, _, out = _tables(spark, d)
    return joins.unsampled(captures, samples, out).select("canonical_url")


@query(f"WITH {_TABLES} SELECT y::INT AS year, count_if(x.k IS NULL)::BIGINT AS eligible, count_if(x.k IS NOT NULL)::BIGINT AS excluded FROM c LEFT JOIN x USING (k) WHERE y BETWEEN 1993 AND 1997 GROUP BY y")
def exclusion_split(spark: SparkSession, d: str) -> DataFrame:
    _, captures, _, out = _tables(spark, d)
    return joins.exclusion_split(captures, out, F.col("y"), 1993, 1997)


@query(f"WITH {_TABLES} SELECT k AS canonical_url, 0 AS sample_year FROM s UNION ALL SELECT k, 1 FROM r WHERE k NOT IN (SELECT k FROM s)")
def adopted_samples(spark: SparkSession, d: str) -> DataFrame:
    samples, _, results, _ = _tables(spark, d)
    return joins.adopt(samples.withColumn("sample_year", F.lit(0)), results, F.lit(1))


@query("SELECT DISTINCT sha256(html) AS sha256, 'objects/html/' || substr(sha256(html), 1, 2) || '/' || sha256(html) || '.html.gz' AS path, strlen(html) AS bytes FROM pages")
def page_objects(spark: SparkSession, d: str) -> DataFrame:
    return store.objects(_t(spark, d, "pages").select(F.encode("html", "UTF-8").alias("content")), "html").select("sha256", "path", "bytes")
