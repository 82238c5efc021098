from pyspark.sql import functions as F

from feedcat.operators import links as L

HTML = """<html><head><title>x</title>
<link rel="alternate" type="application/rss+xml" href="/feed.xml">
<link rel='alternate' href='/atom?x=1&amp;y=2'>
<link rel="alternate" type="text/html" href="/about">
<link rel="stylesheet" type="application/rss+xml" href="/nope.xml">
<script>var s = '<a href="/in-script">';</script><!-- <a href="/in-comment"> -->
</head><body>
<a href="https://other.example.org/page">o</a><a href='#top'>t</a><a href="mailto:x@y">m</a>
<a href="javascript:void(0)">j</a><a href="tel:123">tel</a><a href="ftp://f.example.org/x">f</a>
<a href="../up">u</a><a href="?q=1">q</a><a href="//cdn.example.com/p">c</a><a href="/img/logo.PNG">i</a>
<a href=/unquoted>u2</a><a class="x" HREF="/blog/feeds">no hint</a><a href="/rss/">hint</a>
</body></html>"""


def test_hrefs_and_outbound(spark):
    pages = spark.createDataFrame([(1, "https://site.example.org/a/b", HTML)], "page_id bigint, url string, html string")
    hrefs = [r["href"] for r in L.page_hrefs(pages).orderBy("pos").collect()]
    assert "/in-script" not in hrefs and "/in-comment" not in hrefs
    assert hrefs[:3] == ["https://other.example.org/page", "#top", "mailto:x@y"]
    assert "/unquoted" in hrefs and "/blog/feeds" in hrefs
    links = {r["link"] for r in L.outbound_links(pages).collect()}
    assert "https://other.example.org/page" in links
    assert "https://site.example.org/up" in links
    assert "https://site.example.org?q=1" in links
    assert "https://cdn.example.com/p" in links
    assert "https://tel:123" in links            # crawl normaliser quirk; dropped later for no dot
    assert not any(x.lower().endswith(".png") for x in links)
    assert not any("javascript" in x or "mailto" in x for x in links)


def test_advertised_feeds(spark):
    pages = spark.createDataFrame([(1, "https://site.example.org/a/b", HTML)], "page_id bigint, url string, html string")
    feeds = {r["feed_url"] for r in L.advertised_feeds(pages).collect()}
    assert feeds == {"https://site.example.org/feed.xml", "https://site.example.org/atom?x=1&y=2",
                     "https://site.example.org/rss/"}


def test_blocked_suffixes(spark):
    hosts = spark.createDataFrame([("bad.org",), ("a.bad.org",), ("notbad.org",), ("",), ("x.y.bad.org",)], "host string")
    blocked = spark.createDataFrame([("bad.org",)], "domain string")
    got = {r["host"]: r["blocked"] for r in L.blocked_hosts(hosts, "host", blocked).collect()}
    assert got == {"bad.org": True, "a.bad.org": True, "notbad.org": False, "": True, "x.y.bad.org": True}


def test_crawl_sites_one_origin_per_host(spark):
    html = ('<a href="https://www.s.example.org/x">a</a><a href="http://s.example.org/y">b</a>'
            '<a href="https://github.com/z">g</a><a href="https://nodot/z">n</a><a href="https://ok.bad.org/">b</a>')
    pages = spark.createDataFrame([(1, "https://seed.example.org/", html)], "page_id bigint, url string, html string")
    blocked = spark.createDataFrame([("bad.org",)], "domain string")
    sites = {r["host"]: r["site_url"] for r in L.crawl_sites(pages, blocked).collect()}
    assert sites == {"s.example.org": "http://s.example.org"}  # ignored, dotless and blocked hosts dropped


def test_probe_urls(spark):
    sites = spark.createDataFrame([("https://s.example.org",)], "site_url string")
    adv = spark.createDataFrame([("https://s.example.org", "https://s.example.org/feed"),
                                 ("https://s.example.org", "https://s.example.org/custom.xml")],
                                "site_url string, feed_url string")
    bf = spark.createDataFrame([("https://s.example.org/rss.xml",)], "feed string")
    p = {r["feed_url"]: r["discovered_via"] for r in L.probe_urls(sites, adv, None, bf).collect()}
    assert len(p) == 14  # 14 paths + custom - blocked rss.xml
    assert p["https://s.example.org/feed"] == "rel=alternate"
    assert p["https://s.example.org/atom.xml"] == "common_path"
    assert "https://s.example.org/rss.xml" not in p


def test_quoted_markup_and_character_references(spark):
    html = """<a title="x>y" href="/one">1</a><a title="z href=/no" href='/two?a=1&amp;b=2'>2</a><a href="&#47;three&#x2F;x">3</a>
<a title=it's href="/four">4</a><a title="href=/none">5</a><a href="/five?x=&amp;#47;&#0;&lt;&bogus;&">6</a><a data-href="/six">7</a>
<a title="a = 'b>" href = /seven>8</a><a href="/&#233;&#x1F600;">9</a>
<link title="a>b href=/bad" rel="alternate" type="application/rss+xml" href="/good&#46;xml">"""
    pages = spark.createDataFrame([(1, "https://site.example.org/", html)], "page_id bigint, url string, html string")
    assert [r["href"] for r in L.page_hrefs(pages).orderBy("pos").collect()] == [
        "/one", "/two?a=1&b=2", "/three/x", "/four", "/five?x=&#47;\ufffd<&bogus;&", "/seven", "/\u00e9\U0001f600"]
    assert {r["feed_url"] for r in L.advertised_feeds(pages).collect()} == {"https://site.example.org/good.xml"}


def test_tag_with_very_many_attributes(spark):
    html = "<a " + " ".join(f"data-x{i}='{i}'" for i in range(300)) + " title='" + "t" * 200_000 + "' href='/end'>x</a>"
    pages = spark.createDataFrame([(1, "https://site.example.org/", html)], "page_id bigint, url string, html string")
    assert [r["href"] for r in L.page_hrefs(pages).collect()] == ["/end"]


def _hostile():
    """(page, hrefs of its anchors): pages that are deep or slow to read when a pattern goes back."""
    many = " ".join(f"data-x{i}='{i}'" for i in range(100_000))
    text = "a = b, c = 'd " * 80_000
    return [
        (f"<a {many} href='/end'>x</a>", ["/end"]),
        ("<a " + "x " * 200_000 + "href=/bare>", ["/bare"]),
        ("<a " + text, []),
        ("<a href=/lost " * 80_000, []),
        ("<a href=/one>1</a>" + "<a " * 300_000, ["/one"]),
        ("<a href=/two>2</a>" + "<!-- " * 250_000, ["/two"]),
        ("<a href=/three>3</a>" + "<script " * 150_000 + "<a href=/in>", ["/three"]),
        ("<a title='never closed href=/no " + "<b> " * 200_000 + "<a href=/four>4</a>", ["/no", "/four"]),
        ("<a" + " =" * 199_998 + " href=/five>", ["/five"]),  # a name, a sign and a value of three signs each
        ("<a href='/six" + "x" * 1_000_000 + "'>6</a>", ["/six" + "x" * 1_000_000]),
        ("<a href='/a" + " " * 500_000 + "b  \n'>", ["/a" + " " * 500_000 + "b"]),
        ("<" * 1_000_000 + "<a href=/seven>7</a>", ["/seven"]),
        ("<a-b href=/no><abbr href=/no><a\nhref=/eight><a/href=/nine><a x=\"1\"href=/ten><a href><a href=>", ["/eight", "/nine", "/ten"]),
    ]


def test_hostile_pages_are_read_once(spark):
    import time
    cases = _hostile()
    pages = spark.createDataFrame([(i, "https://site.example.org/", h) for i, (h, _) in enumerate(cases)],
                                  "page_id bigint, url string, html string").repartition(4)
    began = time.time()
    got = {}
    for r in L.page_hrefs(pages).orderBy("page_id", "pos").collect():
        got.setdefault(r["page_id"], []).append(r["href"])
    assert time.time() - began < 60
    for i, (_, want) in enumerate(cases):
        assert got.get(i, []) == want, i
    links = {r["link"] for r in L.outbound_links(pages).where("page_id not in (9, 10)").collect()}
    assert links == {f"https://site.example.org/{x}" for x in ("end", "bare", "one", "two", "three", "four", "no", "five", "seven", "eight", "nine", "ten")}


def test_link_tag_with_very_many_attributes(spark):
    many = " ".join(f'data-x{i}="rel=alternate"' for i in range(100_000))
    html = (f'<link {many} rel="alternate" type="application/rss+xml" href="/good.xml">' + "<link " * 100_000
            + '<link rel=alternate type=application/atom+xml href=/late>')
    pages = spark.createDataFrame([(1, "https://site.example.org/", html)], "page_id bigint, url string, html string")
    # the many unclosed tags are one tag up to the first '>', whose first attributes are the names "<link"
    assert {r["feed_url"] for r in L.advertised_feeds(pages).collect()} == {
        "https://site.example.org/good.xml", "https://site.example.org/late"}


def test_crawl_goes_by_hops(spark):
    """A page that is neither a seed nor a site's home page changes nothing; errors and other types aren't read."""
    link = '<a href="https://{}.example.org/x">l</a>'.format
    feed = '<link rel="alternate" type="application/rss+xml" href="/{}.xml">'.format
    rows = [(1, "https://seed.example.org/list", link("one") + link("two"), 200, "text/html"),
            (2, "https://seed.example.org/list2", link("three"), 404, "text/html"),
            (3, "https://seed.example.org/list3", link("four"), 200, "application/pdf"),
            (4, "https://one.example.org", feed("a"), 200, "text/html; charset=x"),
            (5, "https://two.example.org/", feed("b"), 500, "text/html"),
            (6, "HTTPS://TWO.example.org:443/#top", feed("c"), 200, "text/html")]
    other = [(7, "https://other.example.org/", link("five") + feed("d"), 200, "text/html"),
             (8, "https://one.example.org/deep", link("six") + feed("e"), 200, "text/html")]
    seeds = spark.createDataFrame([("https://seed.example.org/list",), ("https://seed.example.org/list2",), ("https://seed.example.org/list3",),
                                   ("https://never.example.org/",)], "url string")
    schema = "page_id bigint, url string, html string, http_status int, content_type string"

    def crawl(pages):
        pages = spark.createDataFrame(pages, schema)
        sites = L.linked_sites(L.seed_links(pages, seeds))
        feeds = L.site_feeds(L.home_links(pages, sites))
        return (sorted((r["site_url"], r["found_on"], r["n_links"]) for r in sites.collect()),
                sorted((r["site_url"], r["feed_url"]) for r in feeds.collect()))

    want = ([(f"https://{s}.example.org", "https://seed.example.org/list", 1) for s in ("one", "two")],
            [("https://one.example.org", "https://one.example.org/a.xml"), ("https://two.example.org", "https://two.example.org/c.xml")])
    assert crawl(rows) == want and crawl(rows + other) == want


def test_hot_suffixes_are_dealt_over_tasks(spark):
    """Very many hosts of one top-level domain against a list that isn't broadcast: no task gets far more than others."""
    hosts = spark.range(60_000).select(F.concat(F.lit("h"), F.col("id").cast("string"), F.lit(".shop.com")).alias("host"))
    blocked = spark.createDataFrame([(f"h{i}.shop.com",) for i in range(0, 60_000, 50)] + [("com.org",), ("b.com",)], "domain string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = L.drop_blocked_hosts(hosts, "host", blocked)
        assert kept.count() == 60_000 - 1_200
        assert L.drop_blocked_hosts(hosts, "host", blocked, key=["host"]).count() == 60_000 - 1_200
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    dealt = L.suffix_rows(hosts, "host").where("__sfx = 'com'").repartition(4, "__sfx", "__salt")
    sizes = sorted(r["count"] for r in dealt.groupBy(F.spark_partition_id().alias("p")).count().collect())
    assert len(sizes) == 4 and sizes[-1] <= 2 * sizes[len(sizes) // 2]


def test_probes_of_a_site_with_very_many_feeds(spark):
    sites = spark.createDataFrame([("https://s.example.org",), ("https://t.example.org",)], "site_url string")
    adv = spark.range(500).select(F.lit("https://s.example.org").alias("site_url"), F.concat(F.lit("https://s.example.org/f"), "id").alias("feed_url")) \
        .unionByName(spark.createDataFrame([("https://u.example.org", "https://u.example.org/feed")], "site_url string, feed_url string"))
    got = L.probe_urls(sites, adv)
    assert got.groupBy("site_url", "discovered_via").count().orderBy("site_url", "discovered_via").collect() == [
        ("https://s.example.org", "common_path", 14), ("https://s.example.org", "rel=alternate", 500), ("https://t.example.org", "common_path", 14)]
