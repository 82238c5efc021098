"""The discovery job: scores row by row, fields of a candidate, outputs of a run and of the next."""
import json

from pyspark.sql import functions as F

from feedcat.operators import candidates as K
from feedcat.operators import entries as E
from feedcat.operators import links as L
from feedcat.operators import scoring as R
from feedcat.plans import jobs as J
from feedcat.sources.versions import VersionedTable

NOW = "2024-01-10T00:00:00"
RSS = '<?xml version="1.0"?><rss version="2.0"><channel><title>{0}</title><language>en</language>{1}</channel></rss>'.format
ATOM = '<feed xmlns="http://www.w3.org/2005/Atom"><title>{0}</title><subtitle>s</subtitle>{1}</feed>'.format


def rss_items(n, text="malware exploit cve campaign", date="Mon, 01 Jan 2024 10:00:00 GMT"):
    return "".join(f"<item><title> t{i} </title><link>https://l.example.org/{i}</link><description>{text}</description><pubDate>{date}</pubDate></item>"
                   for i in range(n))


def test_scores_row_by_row_equal_scores_by_entry(spark):
    bodies = [("a", 0, RSS("A", rss_items(3, "recipe cooking cve"))), ("a", 1, RSS("A2", rss_items(70, "phishing"))),
              ("b", 0, ATOM("B", "<entry><title>T</title><summary>ransomware</summary><updated>2023-01-01T00:00:00Z</updated></entry>")),
              ("c", 0, RSS("C", rss_items(12, date="not a date"))), ("d", 0, RSS("D", ""))]
    df = spark.createDataFrame([(k, c, b, 200, len(b)) for k, c, b in bodies], "feed_url string, chunk bigint, body string, http_status int, body_bytes int")
    parsed = E.valid_bodies(E.parse_bodies(df), min_bytes=10).cache()
    got = R.scored_feeds(parsed, now=NOW)
    entries = E.entries_of(parsed).withColumn("pos", F.col("chunk") * 64 + F.col("idx")).withColumnRenamed("feed_url", "feed")
    want = R.relevance_score(entries, now=NOW)
    cols = ["n_entries", "score", "matched_keywords", "suggested_category"]
    assert sorted(got.select("feed_url", *cols).collect()) == sorted(want.select("feed", *cols).collect())
    by = {r["feed_url"]: r for r in got.collect()}
    assert set(by) == {"a", "b", "c"} and (by["a"]["title"], by["a"]["n_entries"], by["b"]["feed_type"]) == ("A", 73, "atom")
    assert [tuple(e) for e in by["c"]["entries_sample"]] == [(f"t{i}", f"https://l.example.org/{i}", "not a date") for i in range(5)]
    assert by["b"]["entries_sample"][0]["published"] == "2023-01-01T00:00:00Z" and by["b"]["latest"].year == 2023 and by["c"]["latest"] is None
    few = {r["feed_url"]: r["n_entries"] for r in R.scored_feeds(parsed, now=NOW, max_entries=2).collect()}
    assert few == {"a": 4, "b": 1, "c": 2}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan.replace("Generate inline", "") or "posexplode" not in plan  # nothing is exploded


def _tables(spark, n=3):
    seed = "".join(f'<a href="https://s{i}.example.org/about">s</a>' for i in range(n))
    pages = [(0, "https://seed.example.org/list", seed)] + [
        (1 + i, f"https://s{i}.example.org/", f'<link rel="alternate" type="application/rss+xml" href="/news{i}.xml">') for i in range(n)]
    feeds = [(f"https://s{i}.example.org/news{i}.xml", 200, RSS(f"News {i}", rss_items(12))) for i in range(n)]
    feeds += [("https://s0.example.org/feed", 404, ""), ("https://s1.example.org/rss.xml", 200, RSS("Empty", "")), ("https://elsewhere.example.org/feed", 200, RSS("E", rss_items(12)))]
    return (spark.createDataFrame(pages, "page_id bigint, url string, html string"),
            spark.createDataFrame(feeds, "feed_url string, http_status int, body string").withColumn("body_bytes", F.octet_length("body")),
            spark.createDataFrame([("https://known.example.org/feed",)], "url string"),
            spark.createDataFrame([("https://seed.example.org/list",)], "url string"))


def test_a_run_and_the_next(spark, tmp_path):
    out = str(tmp_path / "out")
    pages, fetches, known, seeds = _tables(spark)
    run = J.discover(spark, pages, fetches, known, None, NOW, seeds=seeds, out=out)
    assert run["summary"].counts() == {"seeds": 1, "sites": 3, "probes": 45, "kept": 3, "added": 3}
    doc = json.loads((tmp_path / "out" / "candidates.json").read_text())
    assert sorted(doc[0]) == sorted(J.CANDIDATE_FIELDS) and len(doc) == 3 and [c["url_hash"] for c in doc] == sorted(c["url_hash"] for c in doc)
    assert doc[0]["entries_sample"][0]["title"] == "t0" and doc[0]["discovered_via"] == "rel=alternate" and doc[0]["discovered_at"] == NOW
    files = sorted(p for p in (tmp_path / "out" / "review-files").iterdir() if not p.name.startswith("."))
    import yaml
    items = [x for p in files for x in yaml.safe_load(p.read_text())]
    assert sorted(x["url"] for x in items) == [f"https://s{i}.example.org/news{i}.xml" for i in range(3)]
    assert json.loads(items[0]["discovery"])["score"] == 15
    records = spark.read.json(f"{out}/records")
    assert {r["record_name"] for r in records.collect()} == {f"news-{i}__{c['url_hash'][:10]}" for i in range(3) for c in doc if c["title"] == f"News {i}"}
    # the next run: one site more; what is filed stays as it is
    before = {p.name: p.read_bytes() for p in files}
    pages, fetches, known, seeds = _tables(spark, 4)
    run = J.discover(spark, pages, fetches, known, None, "2024-01-11T00:00:00", seeds=seeds, out=out, only_new_items=True)
    assert run["summary"].counts()["added"] == 1 and run["summary"].counts()["kept"] == 4
    assert VersionedTable(spark, f"{out}/review").read().count() == 4 and VersionedTable(spark, f"{out}/discovered").read().count() == 4
    seen = {r["feed_url"]: r["last_seen_ts"] for r in VersionedTable(spark, f"{out}/seen").read().collect()}
    assert len(seen) == 4 and len(set(seen.values())) == 1
    run = J.discover(spark, pages, fetches, known, None, "2024-01-12T00:00:00", seeds=seeds, out=out)
    assert run["summary"].counts()["added"] == 0
    assert {p.name for p in (tmp_path / "out" / "review-files").iterdir() if not p.name.startswith(".")} >= set(before)
    J.discover(spark, *_tables(spark, 2)[:3], None, NOW, seeds=seeds, out=out, merge_existing=False)
    assert VersionedTable(spark, f"{out}/discovered").read().count() == 2


def test_bucket_merge_is_distinct_inside_the_batch(spark):
    d = "discovery struct<score:int,url_hash:string>"
    items = spark.createDataFrame([("b", "https://x ", (3, "h1")), ("b", "https://x", (5, "h2")), ("c", "https://x", (1, "h3")), ("b", "https://y", (1, "h4")),
                                   ("b", " ", (9, "h5"))], f"bucket string, url string, {d}")
    old = spark.createDataFrame([("b", " https://y ")], "bucket string, url string")
    assert sorted((r["bucket"], r["discovery"]["url_hash"]) for r in K.bucket_merge(items, old).collect()) == [("b", "h2"), ("c", "h3")]


def test_review_rank_over_ranges(spark):
    items = spark.range(300).select(F.when(F.col("id") % 3 > 0, "hot").otherwise("b").alias("bucket"), F.lit("C").alias("category"),
                                    F.concat(F.lit("t"), (F.col("id") % 7).cast("string")).alias("title"), F.lit("rss").alias("type"),
                                    F.concat(F.lit("https://x/"), F.col("id").cast("string")).alias("url"))
    for n in (1, 7):
        got = [(r["bucket"], r["title"], r["url"]) for r in K.review_rank(items, n).orderBy("bucket", "rank").collect()]
        assert got == sorted((r["bucket"], r["title"], r["url"]) for r in items.collect())


def test_a_body_is_parsed_once_and_html_stays_out_of_joins(spark):
    pages, fetches, _, seeds = _tables(spark)
    parsed = E.valid_bodies(E.parse_bodies(fetches.withColumn("chunk", F.lit(0).cast("bigint"))), min_bytes=10)
    scored = R.scored_feeds(parsed, now=NOW)
    assert scored._jdf.queryExecution().optimizedPlan().toString().count("from_xml") == 3  # one for each kind of root
    assert sorted(r["feed_url"] for r in scored.collect()) == ["https://elsewhere.example.org/feed"] + [f"https://s{i}.example.org/news{i}.xml" for i in range(3)]
    hop = L.seed_links(pages, seeds)
    plan = hop._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join LeftSemi") < plan.index("regexp_extract_all")  # the tags are cut below the join
    cut = L.seed_links(L.page_links(pages), seeds)
    assert hop.collect() == cut.collect() and [(r["page_id"], r["origin"], len(r["hrefs"])) for r in cut.collect()] == [(0, "https://seed.example.org", 3)]
