import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions import dates, html, quality, text, urls, warc


def one(spark, column, **values):
    schema = ", ".join(f"{k} {'int' if isinstance(v, int) else 'binary' if isinstance(v, bytes) else 'string'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("rule", "url", "want"),
    [
        ("npr", "http://npr.org//2012/01/02/a/?x=1#y", "https://www.npr.org/2012/01/02/a"),
        ("npr", "https://www.npr.org/2012/a%0D%0A=", "https://www.npr.org/2012/a%0D%0A"),
        ("npr", "https://www.npr.org/2012/a%0D%0A", "https://www.npr.org/2012/a"),
        ("npr", "https://www.npr.org/music/2012/", None),
        ("npr", "ftp://www.npr.org/2012/", None),
        ("npr", "https://evil.org/2012/", None),
        ("npr", "https://www.npr.org/2012/a.JS", None),
        ("npr", "not a url", None),
        ("npr", None, None),
        ("caixin", "http://magazine.caixin.com/2012/a.html", "https://magazine.caixin.com/2012/a.html"),
        ("caixin", "http://caixin.com/2012-01-02/1.html", "https://www.caixin.com/2012-01-02/1.html"),
        ("nikkei", "https://www.nikkei.com/article/article/DGXNASDD1/", None),
        ("nikkei", "https://www.nikkei.com/article/article/DGXNASDD1234567/", "https://www.nikkei.com/article/DGXNASDD1234567"),
        ("ft", "https://www.ft.com/content/0123456789abcdef-0123", "https://www.ft.com/content/0123456789abcdef-0123"),
    ],
)
def test_normalize(spark, rule, url, want):
    assert one(spark, urls.normalize(urls.RULES[rule], F.col("u")), u=url) == want


def test_url_parts(spark):
    assert one(spark, urls.match_key(F.col("u")), u="HTTPS://WWW.Example.com/a//b.html?q#f") == "example.com/a/b"
    assert one(spark, urls.snapshot_target(F.col("u")), u="https://web.archive.org/web/20100101000000id_/http://a.com/x") == "http://a.com/x"
    assert one(spark, urls.snapshot_target(F.col("u")), u="https://a.com/x") is None
    assert one(spark, urls.srcset(F.col("u")), u="a.jpg 100w, b.jpg 900w, a.jpg 50w") == ["b.jpg", "a.jpg"]
    assert one(spark, urls.image_family(F.col("u")), u="https://i.com/a/1200x-1/x.jpg?w=1") == one(spark, urls.image_family(F.col("u")), u="https://i.com/a/60x60/x.jpg")
    for bad in ("http://10.0.0.1/", "http://localhost/", "https://u:p@a.com/", "https://a.com:8080/", "https://b.ft.com/"):
        assert one(spark, urls.is_public(F.col("u"), ("ft.com",)), u=bad) is False
    assert one(spark, urls.is_public(F.col("u")), u="https://a.com/x") is True
    assert one(spark, urls.archive_guesses(F.col("u"), F.lit("2012-01-31").cast("timestamp")), u="http://a.com/") == [f"https://web.archive.org/web/{s}000000id_/http://a.com/" for s in ("20120201", "20120207", "20120301")]
    assert urls.RULES["npr"].query_prefixes(2010, 2011) == ["npr.org/2010/*", "npr.org/2011/*", "www.npr.org/2010/*", "www.npr.org/2011/*"]


@pytest.mark.parametrize(
    ("url", "want"),
    [
        ("https://a.com/2012/01/02/x", datetime.date(2012, 1, 2)),
        ("https://a.com/2012/02/31/x-2012-03-01", None),
        ("https://a.com/x-2012-03-01", datetime.date(2012, 3, 1)),
        ("https://www.zaobao.com.sg/news/story20120304-1", datetime.date(2012, 3, 4)),
        ("https://www.reuters.com/article/x-idUS20120305", datetime.date(2012, 3, 5)),
        ("https://a.com/x", None),
    ],
)
def test_url_date(spark, url, want):
    assert one(spark, dates.url_date(F.col("u")), u=url) == want


def test_dates(spark):
    at = lambda s: F.lit(s).cast("timestamp")
    assert one(spark, dates.capture_distance(at("2012-01-02"), at("2012-01-01")), u="") == 86400
    assert one(spark, dates.capture_distance(at("2011-12-31"), at("2012-01-01")), u="") == 86400 + 630720000
    assert one(spark, dates.capture_distance(at("2012-01-02"), F.lit(None).cast("timestamp")), u="") == 20120102000000
    assert one(spark, dates.stamp(F.col("u")), u="20120230000000") is None
    assert one(spark, dates.slug_epoch_date(F.col("u")), u="https://a.com/articles/some-slug-11325376000") == datetime.date(2012, 1, 1)
    assert one(spark, dates.query_stamp(F.col("u")), u="http://h/x?A=1&CTIME=2012-01-02-03-04-05") == datetime.datetime(2012, 1, 2, 3, 4, 5)
    assert one(spark, dates.sitemap_date(F.col("u"), F.lit(2012), F.lit(3)), u="2012-04-01T00:00:00Z") == datetime.datetime(2012, 3, 15, 12)
    assert one(spark, dates.visible_date_gap(F.col("u"), F.lit("2012-01-03").cast("date")), u="Posted January 5, 2012 or 2 January 2012") == 1


def test_text(spark):
    assert one(spark, text.clean(F.col("u")), u="a &amp;\u0092  b\n") == "a &’ b"
    assert one(spark, text.casefolded(F.col("u")), u="Straße") == "strasse"
    assert one(spark, text.slug(F.col("u")), u="Café: A & B!") == "cafe-a-b"
    assert sorted(one(spark, text.tokens(F.col("u")), u="The Cat and the cat SAT")) == ["cat", "sat"]
    a, b = text.tokens(F.lit("red green blue")), text.tokens(F.lit("red green"))
    assert one(spark, F.array(*(text.overlap(a, b, o) for o in ("least", "greatest", "first"))), u="") == [1.0, 2 / 3, 2 / 3]
    assert one(spark, text.overlap(a, text.tokens(F.lit("the")), "least"), u="") == 0
    assert one(spark, text.clean_title(F.col("u")), u="<b>Hello</b> world | The Site") == "Hello world"


def test_score(spark):
    def score(page, status=200):
        s = quality.signals(F.col("h"), F.lit(status), F.lit("text/html"), F.lit("https://a.com/x"))
        return one(spark, F.struct(quality.score(s), F.array_join(quality.rejections(s), ",")), h=page)

    body = "<!doctype html><html><article>" + "x" * 3000
    assert tuple(score(body)) == (100, "")
    assert tuple(score(body, 404)) == (65, "http-status")
    assert tuple(score("<html>hi")) == (10, "tiny-shell,no-article-mark")
    assert tuple(score("<html>" + "x" * 3000 + "verify you are human")) == (25, "challenge-shell,no-article-mark")
    assert tuple(score(body + "subscribe to continue reading")) == (40, "subscription-shell")
    assert tuple(score(body + '"articleBody" subscribe to continue reading')) == (100, "")
    assert one(spark, quality.image_type(F.col("c")), c=b"\x89PNG\r\n\x1a\nxx") == "image/png"
    assert one(spark, quality.image_type(F.col("c")), c=b"nope") is None


def test_warc(spark):
    import gzip
    import zlib

    def rec(head, body, kind="response"):
        http = b"HTTP/1.1 200 OK\r\n" + head + b"\r\n\r\n" + body
        return b"WARC/1.0\r\nWARC-Type: " + kind.encode() + b"\r\nWARC-Target-URI: <http://a.com/>\r\nContent-Length: " + str(len(http)).encode() + b"\r\n\r\n" + http + b"\r\n\r\n"

    cases = [
        (rec(b"Content-Length: 2", b"hi!"), b"hi"),
        (gzip.compress(rec(b"Transfer-Encoding: chunked", b"2\r\nhi\r\n1;x\r\n!\r\n0\r\n\r\n")), b"hi!"),
        (rec(b"Content-Encoding: gzip", gzip.compress(b"zip")), b"zip"),
        (rec(b"Content-Encoding: gzip", b"plain"), b"plain"),
        (rec(b"Content-Encoding: deflate", zlib.compress(b"z")[2:-4]), b"z"),
        (rec(b"X: y", b"", "request"), None),
        (rec(b"X: y", b"abc")[:-8], None),
        (b"junk", None),
        (None, None),
    ]
    df = spark.createDataFrame([(k, c) for k, (c, _) in enumerate(cases)], "k int, c binary").select("k", warc.decode(F.col("c")).alias("d"))
    for r in df.collect():
        want = cases[r.k][1]
        assert (bytes(r.d.body) if r.d.body is not None else None) == want
        assert (r.d.error is None) == (want is not None or r.k == 8)
    with pytest.raises(ValueError, match="too large"):
        warc.inflate(zlib.compress(b"0" * 1000), 15, 100)


PAGE = """<!doctype html><html lang="en"><head><title>Site title</title><link rel="canonical" href="/x"><meta property="og:description" content="Desc">
<script type="application/ld+json">{"@graph":[{"@type":"NewsArticle","headline":"Head &amp; line","datePublished":"2012-01-02","author":[{"name":"Ann"},{"name":"ann"},"Bo"]}]}</script></head>
<body><nav><p>menu</p></nav><article><h1>Head</h1><p>First para<p>Second <b>bold</b> para<ul><li>item</ul><p>First para</p><div class="ad"><p>buy</p></div>
<figure><img src="/i/800x600/a.jpg?w=1" alt="A"><figcaption>Cap</figcaption></figure><img src="/i/100x60/a.jpg"><img src="/logo.png"><script>var x="<p>no</p>"</script></article><footer><p>foot</p></footer></body></html>"""


def test_article(spark):
    a = one(spark, html.article(F.col("h"), F.lit("https://a.com/opinion/x")), h=PAGE)
    assert (a.headline, a.description, a.published_at, a.language, a.canonical) == ("Head &amp; line", "Desc", "2012-01-02", "en", "https://a.com/x")
    assert a.authors == ["Ann", "Bo"] and a.content_type == "opinion" and a.status == "partial" and "short-body" in a.warnings
    assert [(b.kind, b.text) for b in a.blocks] == [("heading", "Head"), ("paragraph", "First para"), ("paragraph", "Second bold para"), ("list_item", "item"), ("image", "Cap"), ("caption", "Cap")]
    assert [b.position for b in a.blocks] == list(range(6))
    assert [(i.role, i.keep) for i in a.images] == [("lead", True), ("decoration", False)]
    assert {b.asset for b in a.blocks if b.asset} <= {i.asset for i in a.images}
    for odd in ("", "<p>", "<b>" * 3000, "<p>x</p>", None, "<script type='application/ld+json'>{bad</script>"):
        r = one(spark, html.article(F.col("h"), F.lit(None).cast("string")), h=odd)
        assert (r is None) == (odd is None)
