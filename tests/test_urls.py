"""URL keys on the FIXTURES edge table; expected values worked out by hand from the
standard-library URL rules the original tooling relies on."""
import pytest

from feedcat.functions import urls as U

# (input, B2 catalog, B3 crawl, B4 export, B5 build key of B2, B6 validate, B7 discovery)
CASES = [
    ("HTTP://Example.COM/Feed", "http://example.com/Feed", "http://example.com/Feed", "https://example.com/Feed",
     "example.com/Feed", "example.com/Feed", "https://example.com/feed"),
    ("http://a.com:80/x/", "http://a.com/x/", "http://a.com/x/", "https://a.com:80/x", "a.com/x", "a.com:80/x",
     "https://a.com:80/x"),
    ("https://a.com:443/x", "https://a.com/x", "https://a.com/x", "https://a.com/x", "a.com/x", "a.com/x",
     "https://a.com:443/x"),
    ("http://a.com:443/x", "http://a.com:443/x", "http://a.com:443/x", "https://a.com/x", "a.com:443/x", "a.com/x",
     "https://a.com:443/x"),
    ("example.com/feed", "http:example.com/feed", "https://example.com/feed", "https:example.com/feed",
     "example.com/feed", "example.com/feed", "example.com/feed"),
    ("//h.org/p", "http://h.org/p", "", "https://h.org/p", "h.org/p", "h.org/p", "//h.org/p"),
    ("https://a.com", "https://a.com", "https://a.com", "https://a.com", "a.com", "a.com", "https://a.com/"),
    ("https://a.com/", "https://a.com/", "https://a.com/", "https://a.com", "a.com/", "a.com", "https://a.com/"),
    ("https://a.com/x///", "https://a.com/x///", "https://a.com/x///", "https://a.com/x", "a.com/x//", "a.com/x",
     "https://a.com/x"),
    ("https://a.com/x;p=1", "https://a.com/x", "https://a.com/x;p=1", "https://a.com/x", "a.com/x", "a.com/x",
     "https://a.com/x;p=1"),
    ("https://a.com/x#frag", "https://a.com/x", "https://a.com/x", "https://a.com/x", "a.com/x", "a.com/x",
     "https://a.com/x"),
    ("https://a.com/f?utm_source=x&b=2&A=1", "https://a.com/f?utm_source=x&b=2&A=1",
     "https://a.com/f?utm_source=x&b=2&A=1", "https://a.com/f?utm_source=x&b=2&A=1", "a.com/f?A=1&b=2",
     "a.com/f?utm_source=x&b=2&A=1", "https://a.com/f"),
    ("https://a.com/f?ref=x", "https://a.com/f?ref=x", "https://a.com/f?ref=x", "https://a.com/f?ref=x", "a.com/f",
     "a.com/f?ref=x", "https://a.com/f"),
    ("https://a.com/f?a=", "https://a.com/f?a=", "https://a.com/f?a=", "https://a.com/f?a=", "a.com/f?a=",
     "a.com/f?a=", "https://a.com/f"),
    ("https://a.com/f?a=1&a=2", "https://a.com/f?a=1&a=2", "https://a.com/f?a=1&a=2", "https://a.com/f?a=1&a=2",
     "a.com/f?a=1&a=2", "a.com/f?a=1&a=2", "https://a.com/f"),
    ("https://a.com/f?q=a+b%20c&z=%C3%A9", "https://a.com/f?q=a+b%20c&z=%C3%A9", "https://a.com/f?q=a+b%20c&z=%C3%A9",
     "https://a.com/f?q=a+b%20c&z=%C3%A9", "a.com/f?q=a+b+c&z=%C3%A9", "a.com/f?q=a+b%20c&z=%C3%A9", "https://a.com/f"),
    ("https://a.com/f?q=é", "https://a.com/f?q=é", "https://a.com/f?q=é", "https://a.com/f?q=é", "a.com/f?q=%C3%A9",
     "a.com/f?q=é", "https://a.com/f"),
    ("https://www.a.com/x", "https://www.a.com/x", "https://www.a.com/x", "https://www.a.com/x", "www.a.com/x",
     "a.com/x", "https://a.com/x"),
    ("https://www.www.a.com/x", "https://www.www.a.com/x", "https://www.www.a.com/x", "https://www.www.a.com/x",
     "www.www.a.com/x", "www.a.com/x", "https://www.a.com/x"),
    ("https://a.com/UP/Case", "https://a.com/UP/Case", "https://a.com/UP/Case", "https://a.com/UP/Case",
     "a.com/UP/Case", "a.com/UP/Case", "https://a.com/up/case"),
    ("  https://a.com/x  ", "https://a.com/x", "https://a.com/x", "https://a.com/x", "a.com/x", "a.com/x",
     "https://a.com/x"),
    ("", "", "", "", "", "", "/"),
    ("https://a.com/f?a%zz=1", "https://a.com/f?a%zz=1", "https://a.com/f?a%zz=1", "https://a.com/f?a%zz=1",
     "a.com/f?a%25zz=1", "a.com/f?a%zz=1", "https://a.com/f"),
]


@pytest.fixture(scope="module")
def keyed(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, u string")
    df = U.normalize_url(df, "u", "b2")
    df = U.normalize_url_crawl(df, "u", "b3")
    df = U.url_key_export(df, "u", "b4")
    df = U.url_key_catalog(df, "b2", "b5")
    df = U.url_key_validate(df, "u", "b6")
    df = U.url_key_discovery(df, "u", "b7")
    return {r["i"]: r for r in df.collect()}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_url_keys(keyed, i):
    r = keyed[i]
    exp = CASES[i]
    assert (r["b2"], r["b3"], r["b4"], r["b5"], r["b6"], r["b7"]) == exp[1:]


def test_keys_idempotent(spark):
    df = spark.createDataFrame([(c[0],) for c in CASES], "u string")
    for fn in (U.normalize_url, U.url_key_export, U.url_key_discovery, U.normalize_url_crawl):
        once = fn(df, "u", "k1")
        twice = fn(once, "k1", "k2")
        # the discovery key strips exactly one 'www.', so 'www.www.' shrinks again (faithful)
        bad = twice.where("k1 <> k2 and k1 <> '' and not u like '%www.www.%'").count()
        assert bad == 0, fn.__name__


def test_resolve_url(spark):
    cases = [("https://h.org", "/a/b", "https://h.org/a/b"), ("https://h.org", "../x", "https://h.org/x"),
             ("https://h.org", "a/./b/../c", "https://h.org/a/c"), ("https://h.org", "?q=1", "https://h.org?q=1"),
             ("https://h.org", "//o.org/p", "https://o.org/p"), ("https://h.org", "mailto:x@y", "mailto:x@y"),
             ("https://h.org", "ftp://f.org/x", "ftp://f.org/x"), ("https://h.org", "a//b", "https://h.org/a/b"),
             ("https://h.org", "/a//b/.", "https://h.org/a//b/"), ("https://h.org/dir/file", "x", "https://h.org/dir/x"),
             ("https://h.org", "http://z.org/q", "http://z.org/q"), ("https://h.org", "", "https://h.org")]
    df = spark.createDataFrame([(b, h) for b, h, _ in cases], "b string, h string")
    got = {(r["b"], r["h"]): r["j"] for r in U.resolve_url(df, "b", "h", "j").collect()}
    for b, h, exp in cases:
        assert got[(b, h)] == exp, (b, h)


def test_host_origin_hash_rank_hint(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([("https://WWW.Example.org:8443/Blog/Feed/",), ("http://x.org/rss.xml",),
                                ("https://x.org/feeds",), ("https://x.org/atom.xml?x=1",)], "u string")
    df = U.url_host(df, "u", "host")
    df = U.url_origin(df, "u", "origin")
    df = U.feed_path_rank(df, "u", "rank")
    df = U.url_hash(df, "u", "h")
    got = {r["u"]: r for r in df.withColumn("hint", U.has_feed_hint(F.col("u"))).collect()}
    r = got["https://WWW.Example.org:8443/Blog/Feed/"]
    assert (r["host"], r["origin"], r["rank"], r["hint"]) == ("example.org:8443", "https://www.example.org:8443", 5, True)
    assert got["http://x.org/rss.xml"]["rank"] == 2
    assert got["https://x.org/feeds"]["hint"] is False
    assert got["https://x.org/atom.xml?x=1"]["rank"] == 1
    import hashlib
    assert got["http://x.org/rss.xml"]["h"] == hashlib.sha1(b"https://x.org/rss.xml").hexdigest()
