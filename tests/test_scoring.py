import datetime as dt

from pyspark.sql import functions as F

from feedcat.lexicon import Lexicon
from feedcat.operators import entries as E
from feedcat.operators import scoring as R

LEX = Lexicon(keywords=["apt", "rce", "k1", "k2", "k3", "k4", "k5", "k6", "k7", "k8", "k9"], strong=["apt"],
              negative=["recipe", "fashion"], category_rules=[("Intel", [r"\bapt\b"]), ("Vuln", [r"rce"])],
              default_category="General")


def _score(spark, entries):
    df = spark.createDataFrame(entries, "feed string, pos bigint, title string, summary string")
    return {r["feed"]: r for r in R.relevance_score(df, LEX).collect()}


def test_substring_semantics_and_weights(spark):
    got = _score(spark, [("f", 1, "Adapt", "the source")])
    r = got["f"]
    assert r["matched_keywords"] == ["apt", "rce"]  # substring hits inside words
    assert r["score"] == 4 and r["suggested_category"] == "Vuln"  # \bapt\b does not match 'adapt'


def test_density_and_negative(spark):
    six = " ".join(["k1", "k2", "k3", "k4", "k5", "k6"])
    ten = " ".join(["k1", "k2", "k3", "k4", "k5", "k6", "k7", "k8", "k9", "apt"])
    got = _score(spark, [("six", 1, "", six), ("ten", 1, "", ten), ("neg1", 1, "", "k1 recipe"),
                         ("neg2", 1, "", "k1 recipe fashion")])
    assert got["six"]["score"] == 6 + 2
    assert got["ten"]["score"] == 9 + 3 + 5
    assert got["neg1"]["score"] == 1
    assert got["neg2"]["score"] == 1 - 4


def test_all_entries_count_unless_capped(spark):
    df = spark.createDataFrame([("f", p, None if p == 3 else "", "k1" if p == 16 else "x") for p in range(1, 17)],
                               "feed string, pos bigint, title string, summary string")
    r = R.relevance_score(df, LEX).first()
    assert (r["n_entries"], r["matched_keywords"], r["score"]) == (16, ["k1"], 1 + 2)
    r = R.relevance_score(df, LEX, max_entries=15).first()
    assert (r["n_entries"], r["matched_keywords"], r["score"]) == (15, [], 2)


def test_phrase_across_entries_is_no_hit(spark):
    lex = Lexicon(keywords=["zero day"], strong=[], negative=[], category_rules=[("Z", ["zero day"])], default_category="G")
    df = spark.createDataFrame([("apart", 1, "", "zero"), ("apart", 2, "day", ""), ("within", 1, "Zero", "Day"),
                                ("null", 1, None, "zero day"), ("empty", 1, None, None)],
                               "feed string, pos bigint, title string, summary string")
    got = {r["feed"]: (r["score"], r["suggested_category"]) for r in R.relevance_score(df, lex).collect()}
    assert got == {"apart": (0, "G"), "within": (1, "Z"), "null": (1, "Z"), "empty": (0, "G")}


def test_more_keywords_than_one_mask_holds(spark):
    kws = [f"w{i:03d}" for i in range(130)]
    lex = Lexicon(keywords=kws, strong=kws[:1], negative=[], category_rules=[], default_category="G")
    df = spark.createDataFrame([("f", i, "", f"{kws[j]} x") for i, j in enumerate([0, 61, 62, 123, 124, 129, 129])],
                               "feed string, pos bigint, title string, summary string")
    r = R.relevance_score(df, lex).first()
    assert r["matched_keywords"] == [kws[j] for j in (0, 61, 62, 123, 124, 129)] and r["score"] == 3 + 5 + 2


def test_recency_boundaries(spark):
    now = dt.datetime(2024, 6, 1)
    ages = {"d30": 30, "d31": 31, "d90": 90, "d91": 91, "d365": 365, "d366": 366, "future": -3}
    rows = [(k, 1, now - dt.timedelta(days=v), None) for k, v in ages.items()] + [("none", 1, None, None)]
    df = spark.createDataFrame(rows, "feed string, pos bigint, published_ts timestamp_ntz, updated_ts timestamp_ntz")
    got = {r["feed"]: r for r in E.feed_recency(df, "2024-06-01 00:00:00").collect()}
    assert {k: got[k]["recency_bonus"] for k in ages} == {"d30": 3, "d31": 1, "d90": 1, "d91": 0, "d365": 0,
                                                           "d366": -4, "future": 3}
    assert got["future"]["age_days"] == -3 and got["none"]["recency_bonus"] == 0


def test_first_entries_salted_matches_plain(spark):
    df = spark.range(0, 2000).select(F.lit("hot").alias("feed"), F.col("id").alias("pos"))
    got = [r["pos"] for r in E.first_entries(df, k=15, salt_buckets=7).orderBy("rank").collect()]
    assert got == list(range(15))


def test_bucket_cascade(spark):
    df = spark.createDataFrame([("A concert blog", "", "https://x.org", ["apt"], "Threat Intel"),
                                ("Weekly", "", "https://y.org", [], "Vulnerabilities, CVEs"),
                                ("Plain", "", "https://z.org", [], "Security (General)")],
                               "title string, description string, site_url string, matched_keywords array<string>, "
                               "suggested_category string")
    got = [(r["bucket"], r["bucket_label"]) for r in R.candidate_bucket(df).collect()]
    assert got[0][0] == "government-cert-and-advisories"  # 'cert' inside 'concert'
    assert got[1][0] == "vulnerabilities-cves-and-exploits"
    assert got[2] == ("general-security-and-blogs", "Security (General) & Blogs")


def test_seen_upsert_and_items(spark):
    from feedcat.operators import candidates as K
    seen = spark.createDataFrame([("h1", "https://a.org/f", "https://a.org", "old", 1, 3, "rss", "x"),
                                  ("h2", "https://b.org/f", "https://b.org", "keep", 2, 4, "atom", "y")],
                                 "url_hash string, feed_url string, site_url string, title string, last_seen_ts bigint, "
                                 "score int, feed_type string, note string")
    cands = spark.createDataFrame([("h1", "https://a.org/feed", "https://A.org", "", "", "rss", 9, None),
                                   ("h3", "https://c.org/f", "https://c.org", "C", "d" * 230, "atom", 7, "Threat Intel")],
                                  "url_hash string, feed_url string, site_url string, title string, description string, "
                                  "feed_type string, score int, suggested_category string")
    up = {r["url_hash"]: r for r in K.seen_upsert(seen, cands, 100).collect()}
    assert (up["h1"]["feed_url"], up["h1"]["title"], up["h1"]["score"], up["h1"]["last_seen_ts"], up["h1"]["note"]) == \
        ("https://a.org/feed", "", 9, 100, "x")
    assert (up["h2"]["title"], up["h2"]["last_seen_ts"]) == ("keep", 2)
    assert up["h3"]["note"] is None and up["h3"]["last_seen_ts"] == 100
    items = {r["url"]: r for r in K.candidate_items(cands).collect()}
    a = items["https://a.org/feed"]
    assert (a["title"], a["category"], a["description"]) == \
        ("A.org", "Security (General)", "Updates from A.org covering security (general).")
    c = items["https://c.org/f"]
    assert c["description"] == "d" * 217 + "..." and c["category"] == "Threat Intel"
    names = {r["url_hash"]: r["record_name"] for r in K.review_record_names(cands).collect()}
    assert names["h1"] == "a-org__h1" and names["h3"] == "c__h3"


def test_parse_bodies_rss_atom_bozo(spark):
    rss = ('<?xml version="1.0"?><rss version="2.0"><channel><title>R</title><description>rd</description>'
           '<item><title>a &amp; b</title><description> x </description><pubDate>Mon, 01 Jan 2024 10:00:00 GMT</pubDate>'
           '</item></channel></rss>')
    atom = ('<feed xmlns="http://www.w3.org/2005/Atom"><title>A</title><subtitle>S</subtitle><entry><title>e</title>'
            '<content>c</content><link href="https://x.org/1"/><updated>2024-01-03T00:00:00Z</updated></entry></feed>')
    bad = "<rss><channel><item><title>x</title></channel>"
    short = "<rss version='2.0'><channel><item/></channel></rss>"
    bodies = spark.createDataFrame([("r", rss, 200), ("a", atom, 200), ("b", bad, 200), ("s", short, 200),
                                    ("n", rss, 404)], "feed_url string, body string, http_status int") \
        .withColumn("body_bytes", F.octet_length("body"))
    feeds, entries = E.parse_feed_bodies(bodies)
    f = {r["feed_url"]: r for r in E.feed_type(feeds).collect()}
    assert (f["r"]["version"], f["r"]["feed_type"], f["r"]["n_entries"], f["r"]["bozo"]) == ("rss20", "rss", 1, False)
    assert (f["a"]["version"], f["a"]["feed_type"], f["a"]["title"], f["a"]["description"]) == ("atom10", "atom", "A", "S")
    assert f["b"]["bozo"] is True and f["b"]["n_entries"] == 0
    e = {r["feed_url"]: r for r in entries.collect()}
    assert (e["r"]["title"], e["r"]["summary"]) == ("a & b", " x ")
    assert e["r"]["published_ts"] == dt.datetime(2024, 1, 1, 10, 0)
    assert (e["a"]["summary"], e["a"]["link"]) == ("c", "https://x.org/1")
    valid = {r["feed_url"] for r in E.valid_feeds(bodies.withColumn("chunk", F.lit(0).cast("bigint")), feeds).collect()}
    assert valid == {"r", "a"}  # bozo/empty fail the entry test, 'short' is under 80 bytes, 'n' is a 404


def test_parse_rdf_content_and_links(spark):
    rdf = ('<?xml version="1.0"?><rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns="http://purl.org/rss/1.0/" '
           'xmlns:dc="http://purl.org/dc/elements/1.1/"><channel><title>D</title><description>dd</description>'
           '<dc:language>en</dc:language></channel><item><title>one</title><link>https://x.org/1</link><dc:date>2024-01-05T00:00:00Z</dc:date>'
           '</item><item><title>two</title><description>s</description></item></rdf:RDF>')
    rss = ('<rss version="2.0" xmlns:content="http://purl.org/rss/1.0/modules/content/"><channel><title>R</title><item><title>t</title>'
           '<content:encoded>long text</content:encoded></item></channel></rss>')
    atom = ('<feed xmlns="http://www.w3.org/2005/Atom"><title>A</title><entry><title>e</title><link rel="self" href="https://x.org/self"/>'
            '<link rel="alternate" href="https://x.org/page"/><link rel="replies" href="https://x.org/comments"/></entry></feed>')
    feeds, entries = E.parse_feed_bodies(spark.createDataFrame([("d", rdf), ("r", rss), ("a", atom), ("h", "<html/>"), ("n", None)],
                                                               "feed_url string, body string"))
    f = {r["feed_url"]: r for r in E.feed_type(feeds).collect()}
    assert (f["d"]["version"], f["d"]["title"], f["d"]["language"], f["d"]["n_entries"], f["d"]["bozo"]) == ("rss10", "D", "en", 2, False)
    assert {k: f[k]["bozo"] for k in "rahn"} == {"r": False, "a": False, "h": True, "n": True}
    e = {(r["feed_url"], r["idx"]): r for r in entries.collect()}
    assert len(e) == 4 and (e["d", 0]["link"], e["d", 0]["updated_ts"], e["d", 1]["summary"]) == \
        ("https://x.org/1", dt.datetime(2024, 1, 5), "s")
    assert e["r", 0]["summary"] == "long text" and e["a", 0]["link"] == "https://x.org/page"


def test_site_dedup_and_best_ties(spark):
    from feedcat.operators import candidates as K
    rows = [("https://s.org/rss.xml", "https://s.org", "Blog  News", "rss", 7, "h1"),
            ("https://s.org/feed", "https://s.org", "blog news", "rss", 5, "h2"),
            ("https://s.org/atom.xml", "https://s.org", "Blog News", "atom", 6, "h3"),
            ("https://s.org/custom", "https://s.org", "", "rss", 6, "h4"),
            ("https://s.org/rss", "https://s.org", " ", "rss", 6, "h5"),
            ("https://t.org/feed", "https://t.org", "x", "rss", 8, "hx"),
            ("https://t.org/rss.xml", "https://t.org", "y", "rss", 8, "hx")]
    df = spark.createDataFrame(rows, "feed_url string, site_url string, title string, feed_type string, score int, url_hash string")
    kept = {r["feed_url"] for r in K.site_dedup(df).collect()}
    # same type + same collapsed title -> lowest path rank (/feed beats /rss.xml); other type kept; blank titles group
    assert kept == {"https://s.org/feed", "https://s.org/atom.xml", "https://s.org/rss",
                    "https://t.org/feed", "https://t.org/rss.xml"}
    best = {r["url_hash"]: r["feed_url"] for r in K.best_by_hash(df).collect()}
    assert best["hx"] == "https://t.org/feed"  # score tie -> lower path rank


def test_keyword_cap_and_density_edges(spark):
    kws = [f"w{i:02d}" for i in range(26)]
    lex = Lexicon(keywords=kws, strong=[], negative=[], category_rules=[], default_category="G")
    texts = {"k26": " ".join(kws), "k5": " ".join(kws[:5]), "k9": " ".join(kws[:9])}
    df = spark.createDataFrame([(k, 1, "", v) for k, v in texts.items()], "feed string, pos bigint, title string, summary string")
    assert {len(r["matched_keywords"]) for r in R.relevance_score(df, lex).collect()} == {26, 5, 9}  # no cut unless asked for
    got = {r["feed"]: r for r in R.relevance_score(df, lex, max_keywords=25).collect()}
    assert len(got["k26"]["matched_keywords"]) == 25 and got["k26"]["matched_keywords"][-1] == "w24"
    assert got["k26"]["score"] == 26 + 5
    assert got["k5"]["score"] == 5 and got["k9"]["score"] == 9 + 2
