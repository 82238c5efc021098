"""The whole discovery run as queries, over pages and feed bodies captured from the driver tables.

Captures: every page, and for every page a capture of its origin's root with the same HTML; status and content type
differ by size and language. Seeds are the pages that aren't German, so German pages are neither seeds nor home pages.
Feeds: each page's conversation as an RSS or Atom body, at an address its home page advertises and at a common path;
some are answered with an error, have no entries, or no dates.
"""
from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import urls as U
from ..functions.text import xml_attr_escape
from ..operators import candidates as K
from ..operators import scoring as R
from ..sources import catalog_files as CF
from ..sources import lists as LS
from . import jobs as J
from . import queries as Q
from . import views as V
from .artifacts import scratch

register = Q.register

LARGE, SMALL = 9000, 1200


def _pages(spark, sf_dir):
    p = U.url_origin(V.v_pages_with_feeds(spark, sf_dir), "url", "origin")
    lang, n = F.regexp_extract("url", V.SEGMENT_RE, 1), F.length("html")
    return p.withColumns({
        "lang": lang, "http_status": F.when(n < SMALL, 404).when(n > LARGE, 503).otherwise(200),
        "content_type": F.when((lang == "de") & F.col("url").contains(".html"), "application/pdf")
                         .when(lang == "fr", "application/xhtml+xml").otherwise("Text/HTML; charset=utf-8")})


def v_captures(spark, sf_dir):
    p = _pages(spark, sf_dir)
    home = p.withColumns({"page_id": -1 - F.col("page_id"), "url": F.concat("origin", F.lit("/"))})
    return p.unionByName(home).select("page_id", "url", "html", "http_status", "content_type")


def v_seeds(spark, sf_dir):
    lines = _pages(spark, sf_dir).where("lang <> 'de'").select(F.col("page_id").alias("ord"), F.col("url").alias("line"))
    return LS.seed_urls(lines)


def v_feed_captures(spark, sf_dir):
    """(feed_url, http_status, body, body_bytes): a conversation's turns are a feed's entries, one or two days apart."""
    p = U.url_host(_pages(spark, sf_dir).select("page_id", "url", "origin", "lang", "http_status"), "url", "host")
    path = F.lit("/blog/feed")
    for lang, own in reversed(V.FEED_PATH_BY_LANG):
        path = F.when(F.col("lang") == lang, F.lit(own)).otherwise(path)
    esc = xml_attr_escape
    e = V.v_entries(spark, sf_dir).join(p.select(F.col("page_id").alias("feed"), "lang"), "feed")
    ts = F.timestamp_add("DAY", -(F.col("feed") * 5 + F.col("pos")).cast("int"), F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"))
    dated = F.col("lang") != "es"
    link = F.concat(F.lit("https://chat.example.org/"), F.col("feed").cast("string"), F.lit("/"), F.col("pos").cast("string"))
    rss = F.concat(F.lit("<item><title>"), esc("title"), F.lit("</title><link>"), link, F.lit("</link><description>"), esc("summary"),
                   F.lit("</description>"), F.when(dated, F.concat(F.lit("<pubDate>Thu, "), F.date_format(ts, "d MMM yyyy HH:mm:ss"),
                                                                   F.lit(" GMT</pubDate>"))).otherwise(F.lit("")), F.lit("</item>"))
    atom = F.concat(F.lit("<entry><title>"), esc("title"), F.lit('</title><link rel="self" href="https://chat.example.org/"/><link href="'), link,
                    F.lit('"/><summary>'), esc("summary"), F.lit("</summary>"),
                    F.when(dated, F.concat(F.lit("<updated>"), F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit("</updated>"))).otherwise(F.lit("")),
                    F.lit("</entry>"))
    items = e.groupBy("feed").agg(F.array_sort(F.collect_list(F.struct("pos", rss.alias("rss"), atom.alias("atom")))).alias("x"))
    f = p.join(items, p["page_id"] == items["feed"], "left")
    about, title = F.concat(F.lit("About "), "host"), F.concat(F.lit("Feed of "), "host")
    body = F.when(F.col("x").isNull(), F.lit('<rss version="2.0"></rss>')) \
        .when(F.col("page_id") % 2 == 0, F.concat(
            F.lit('<?xml version="1.0"?><rss version="2.0"><channel><title>'), title, F.lit("</title><description>"), about,
            F.lit("</description><language>"), "lang", F.lit("</language>"), F.array_join(F.transform("x", lambda i: i["rss"]), ""),
            F.lit("</channel></rss>"))) \
        .otherwise(F.concat(F.lit('<feed xmlns="http://www.w3.org/2005/Atom"><title>'), title, F.lit("</title><subtitle>"), about, F.lit("</subtitle>"),
                            F.array_join(F.transform("x", lambda i: i["atom"]), ""), F.lit("</feed>")))
    f = f.select("page_id", "origin", path.alias("path"), "http_status", body.alias("body"))
    own = f.select(F.concat("origin", F.lit("/blog/rss?page="), F.col("page_id").cast("string")).alias("feed_url"), "http_status", "body")
    common = f.groupBy(F.concat("origin", "path").alias("feed_url")).agg(F.min_by(F.struct("http_status", "body"), F.col("page_id")).alias("r")) \
        .select("feed_url", "r.*")
    return own.unionByName(common).withColumn("body_bytes", F.octet_length("body"))


def _run(spark, sf_dir, **more):
    known = V.v_catalog(spark, sf_dir).select("url")
    return J.discover(spark, v_captures(spark, sf_dir), v_feed_captures(spark, sf_dir), known, None, V.NOW, V.v_blocked(spark),
                      V.v_blocked_feeds(spark), V.test_lexicon(), seeds=v_seeds(spark, sf_dir), **more)


@register("discover_chain")
def q_discover_chain(spark, sf_dir):
    run = _run(spark, sf_dir)
    sample = F.transform("entries_sample", lambda e: F.concat_ws("|", e["title"], e["link"], e["published"]))
    c = R.candidate_bucket(run["candidates"], V.test_lexicon()).join(run["sites"].select("site_url", "found_on"), "site_url")
    return c.select("feed_url", "site_url", "found_on", "title", "description", "language", "feed_type", "score",
                    F.array_join("matched_keywords", ",").alias("matched"), "suggested_category", "discovered_via",
                    F.array_join(sample, ";").alias("sample"), "url_hash",
                    F.date_format("discovered_at", "yyyy-MM-dd HH:mm:ss").alias("discovered_at"), "bucket")


@register("captured_html_pages")
def q_captured_html_pages(spark, sf_dir):
    """A10 on captures of every status and type."""
    from ..operators import links as L
    return L.html_pages(v_captures(spark, sf_dir)).select("page_id", "url", "http_status")


@register("captured_feeds")
def q_captured_feeds(spark, sf_dir):
    """C5 and B21 on bodies of every kind: error answers, RSS and Atom, with entries and without."""
    from ..operators import entries as E
    parsed = E.parse_bodies(v_feed_captures(spark, sf_dir))
    feeds = E.feed_type(E.feeds_of(parsed))
    valid = E.valid_bodies(parsed).select("feed_url").withColumn("valid", F.lit(True))
    return feeds.join(valid, "feed_url", "left").select("feed_url", "http_status", "version", "feed_type", "n_entries", "title", "description",
                                                        F.coalesce("valid", F.lit(False)).alias("valid"))


@register("discover_sites")
def q_discover_sites(spark, sf_dir):
    from ..operators import links as L
    return L.linked_sites(L.seed_links(v_captures(spark, sf_dir), v_seeds(spark, sf_dir)), V.v_blocked(spark)) \
        .select("site_url", "host", "found_on")


@register("discover_final")
def q_discover_final(spark, sf_dir):
    """What a run leaves behind, read back: review files (place in the file), the candidates document and the counts.

    The run is done twice; the second finds everything filed and adds nothing."""
    out = scratch(spark, "discovery")
    first = _run(spark, sf_dir, out=out)["summary"].counts()
    again = _run(spark, sf_dir, out=out)["summary"].counts()
    filed = CF.read_yaml_catalog(spark, f"{out}/review-files/*.yaml")
    doc = spark.read.json(f"{out}/candidates.json", multiLine=True, schema="feed_url string, url_hash string, score int")
    place = F.row_number().over(Window.partitionBy("file").orderBy("ord"))
    counts = [F.lit(first[k]).cast("bigint").alias(k) for k in ("seeds", "sites", "probes", "kept", "added")]
    return filed.withColumn("place", place).join(doc, F.col("url") == F.col("feed_url")).select(
        "file", "place", "url", "category", "title", "type", "description", "score", "url_hash", *counts,
        F.lit(again["added"]).cast("bigint").alias("added_again"))


@register("review_rank_by_range")
def q_review_rank(spark, sf_dir):
    items = K.bucket_merge(Q._review(spark, sf_dir), Q._existing_bucket_items(spark, sf_dir))
    return K.review_rank(items, partitions=5).select("bucket", "url", "rank")
