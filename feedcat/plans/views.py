"""Adaptor views: the driver's tables seen as catalog, links, entries, checks.

The captured-web domain has no TPC-style tables, so each view derives one of
our input shapes from a driver table with native expressions only.  The
DuckDB oracle builds the same views in SQL (``plans/oracle.py``).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import clean_text

TITLE_RE = r"(?is)<title>(.*?)</title>"
AD_RE = r'(?is)<div class="ad">(.*?)</div>'
SEGMENT_RE = r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*/([^/?#]*)"
NOW = "2024-02-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def v_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pages as catalog items: url, title from <title>, description from the ad block,
    category = language path segment, file = '<segment>.yaml', ord = page_id."""
    p = table(spark, sf_dir, "pages")
    seg = F.regexp_extract("url", SEGMENT_RE, 1)
    return p.select(
        F.concat(seg, F.lit(".yaml")).alias("file"),
        F.col("page_id").alias("item_idx"),
        F.col("page_id").alias("ord"),
        F.col("url"),
        clean_text(F.regexp_extract("html", TITLE_RE, 1)).alias("title"),
        clean_text(F.regexp_extract("html", AD_RE, 1)).alias("description"),
        F.when(F.col("url").contains(".html"), F.lit("Atom"))
         .when(F.col("url").contains("?"), F.lit("RSS"))
         .otherwise(F.lit("")).alias("type"),
        seg.alias("category"),
    )


def v_catalog_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """v_catalog plus two variants per item, so keys collide the way real catalogs do.

    ord 3k: scheme flipped, blank title (first, so fill-from-later applies);
    ord 3k+1: the item; ord 3k+2: fragment dropped, a utm_ key added, blank
    description, type 'rss'.
    """
    c = v_catalog(spark, sf_dir)
    u = F.col("url")
    flipped = F.when(u.startswith("https://"), F.concat(F.lit("http://"), F.substring(u, 9, 1 << 20))) \
        .otherwise(F.concat(F.lit("https://"), F.substring(u, 8, 1 << 20)))
    nofrag = F.regexp_replace(u, "#.*$", "")
    utm = F.concat(nofrag, F.when(nofrag.contains("?"), F.lit("&")).otherwise(F.lit("?")),
                   F.lit("utm_medium=x"))
    # one scan: explode a variant index, derive the variant's columns after it, so a query
    # that needs only URLs prunes the title/description regexes and never reads html
    ex = c.select("*", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("k"))
    k = F.col("k")
    return ex.select(
        "file", "item_idx", (F.col("ord") * 3 + k).alias("ord"),
        F.when(k == 0, flipped).when(k == 1, u).otherwise(utm).alias("url"),
        F.when(k == 0, F.lit("")).otherwise(F.col("title")).alias("title"),
        F.when(k == 2, F.lit("")).otherwise(F.col("description")).alias("description"),
        F.when(k == 2, F.lit("rss")).otherwise(F.col("type")).alias("type"),
        "category",
        F.when(k == 0, F.lit("flipped")).when(k == 1, F.lit("original")).otherwise(F.lit("tracked")).alias("variant"))


def v_categories(spark: SparkSession) -> DataFrame:
    """Canonical (category, file) rows: es.yaml is unlisted and de.yaml expects another name."""
    return spark.createDataFrame([("en", "en.yaml"), ("fr", "fr.yaml"), ("Deutsch", "de.yaml")],
                                 "category string, file string")


def v_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pages with their url and html (link extraction happens in operators.links)."""
    return table(spark, sf_dir, "pages").select("page_id", "url", "html")


def v_pages_with_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pages with one injected <link rel=alternate> and one feed-looking anchor per page.

    The injected tags depend on the page language so every branch of
    advertised-feed detection is exercised: typed rss, typed atom, untyped
    with a hinting href, and untyped without a hint.
    """
    p = table(spark, sf_dir, "pages")
    lang = F.regexp_extract("url", SEGMENT_RE, 1)
    pid = F.col("page_id").cast("string")
    link = (F.when(lang == "en", F.concat(F.lit('<link rel="alternate" type="application/rss+xml" href="/feed/'), pid, F.lit('.xml">')))
            .when(lang == "fr", F.concat(F.lit("<link rel='alternate' type='application/atom+xml' href='/atom/"), pid, F.lit("'>")))
            .when(lang == "de", F.concat(F.lit('<link rel="alternate" href="/index.xml?p='), pid, F.lit('&amp;x=1">')))
            .otherwise(F.concat(F.lit('<link rel="alternate" type="text/html" href="/about/'), pid, F.lit('">'))))
    anchor = F.concat(F.lit('<a href="/blog/rss?page='), pid, F.lit('">feed</a>'))
    html = F.replace(F.replace(F.col("html"), F.lit("</head>"), F.concat(link, F.lit("</head>"))),
                     F.lit("</footer>"), F.concat(anchor, F.lit("</footer>")))
    return p.select("page_id", "url", html.alias("html"))


def v_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conversations as feed entries: feed = conv_id, pos = turn, title = role, summary = text."""
    c = table(spark, sf_dir, "conversations")
    return c.select(F.col("conv_id").alias("feed"), F.col("turn").alias("pos"),
                    F.col("role").alias("title"), F.col("text").alias("summary"))


def v_blobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as feed entries: feed = source, pos = doc_id, summary = text, no title."""
    d = table(spark, sf_dir, "documents")
    return d.select(F.col("source").alias("feed"), F.col("doc_id").alias("pos"),
                    F.lit("").alias("title"), F.col("text").alias("summary"))


def v_entry_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as dated entries: feed = user_id, published = ts, updated = ts of signups only."""
    e = table(spark, sf_dir, "events")
    return e.select(F.col("user_id").alias("feed"), F.col("event_id").alias("pos"),
                    F.col("ts").alias("published_ts"),
                    F.when(F.col("event_type") == "signup", F.col("ts") + F.expr("INTERVAL 40 DAYS"))
                     .alias("updated_ts"))


def v_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as a check log: url per user, run = day index, status by event type."""
    return checks_of(table(spark, sf_dir, "events"))


def v_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as captured fetch attempts; consecutive events of a user and day pair up
    as attempt 1 and 2 of one check."""
    from pyspark.sql import Window
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    v = F.col("value")
    w = Window.partitionBy("user_id", F.to_date("ts")).orderBy("ts", "event_id")
    rn = F.row_number().over(w)
    net = (F.when(v > 470, F.lit("timeout"))
           .when(v > 460, F.lit("connection:ConnectionError"))
           .when(v > 455, F.lit("request:TooManyRedirects")))
    status = (F.when(net.isNotNull(), F.lit(None).cast("int"))
              .when(v < 5, F.lit(404)).when(v < 10, F.lit(429)).when(v < 15, F.lit(503))
              .otherwise(F.lit(200)))
    bozo = F.when(status == 200, F.col("event_type") == "error")
    return e.select(
        F.concat(F.lit("https://feeds.example.org/u/"), F.col("user_id").cast("string")).alias("url"),
        F.concat_ws("-", F.col("user_id").cast("string"), F.date_format("ts", "yyyyMMdd"),
                    ((rn - 1) / 2).cast("bigint").cast("string")).alias("run_id"),
        F.col("ts").alias("checked_at"),
        ((rn - 1) % 2 + 1).cast("int").alias("attempt"),
        status.alias("http_status"),
        net.alias("net_error"),
        bozo.alias("bozo"),
        F.when(bozo & (k % 3 == 0), F.lit("SAXParseException")).alias("bozo_error"),
        F.when(status == 200, F.when(bozo & (k < 40), F.lit(0)).otherwise(k)).alias("entries"),
        F.when(net.isNull(), F.when(F.col("event_type") == "view", F.lit("Application/RSS+XML; charset=utf-8"))
               .otherwise(F.lit(" text/xml"))).alias("content_type"),
        F.when(net.isNull(), F.concat(F.lit("https://feeds.example.org/u/"), F.col("user_id").cast("string"))).alias("final_url"),
        (F.col("value") * 10).cast("int").alias("latency_ms"),
        (k * 7).alias("body_bytes"))


def v_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pages as a status snapshot keyed by the raw page URL; status from the page size
    band; Spanish pages have no status (read as 'unknown')."""
    p = table(spark, sf_dir, "pages")
    n = F.length("html")
    st = F.when(n > 9000, F.lit("active")).when(n < 4000, F.lit("down")).otherwise(F.lit("rate_limited"))
    err = F.when(st == "down", F.lit("http_404")).when(st == "rate_limited", F.lit("http_429")).otherwise(F.lit(""))
    return p.where(F.regexp_extract("url", SEGMENT_RE, 1) != "es").select("url", st.alias("status"), err.alias("error"))


BLOCKED_DOMAINS = ["spam-farm.example.org", "example.net"]
BLOCKED_FEEDS = ["https://blog.ththan.example.net/feed", "https://ththed.example.org/rss.xml",
                 "http://ththed.example.org/rss.xml", "HTTP://THERHA.EXAMPLE.COM/FEED/"]
EXCLUSION_RULES = ["# test rules", "domain:www.cheap-pills.example.com", "domain:spam-farm.example.org",
                   "url_contains:utm_", "title_contains:ththe"]


def v_blocked(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(d,) for d in BLOCKED_DOMAINS], "domain string")


def v_blocked_feeds(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(d,) for d in BLOCKED_FEEDS], "feed string")


# Test lexicon for the driver tables (invented prose: the security lexicon hits nothing).
TEST_KEYWORDS = ["the", "tion", "ing", "and", "ent", "der", "que", "sch", "eau", "para", "ly", "wh",
                 "ou", "ble", "ein", "zzq"]
TEST_STRONG = ["the", "tion", "sch"]
TEST_NEGATIVE = ["ththth", "onon", "xqz", "erer"]
TEST_CATEGORY_RULES = [("Alpha", [r"\bthe\b", r"zzq"]), ("Beta", [r"\bder\b", r"sch"]), ("Gamma", [r"que", r"\bpara\b"])]
TEST_BUCKET_RULES = [("blob", "alpha-bucket", ["zzq", "example.net"]), ("category", "beta-bucket", ["beta"]),
                     ("blob", "gamma-bucket", ["gamma"]), ("category", "alpha-second", ["alpha"])]


def test_lexicon():
    from ..lexicon import Lexicon
    return Lexicon(keywords=TEST_KEYWORDS, strong=TEST_STRONG, negative=TEST_NEGATIVE,
                   category_rules=TEST_CATEGORY_RULES, default_category="Other",
                   bucket_rules=TEST_BUCKET_RULES, default_bucket="general-security-and-blogs")


FEED_PATH_BY_LANG = [("en", "/feed"), ("fr", "/rss.xml"), ("de", "/atom.xml"), ("es", "/blog/feed")]


def v_feed_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page publishes the feed whose entries are the conversation with the same id:
    feed_url = page origin + a language-specific common path + '?feed=<id>'."""
    from ..functions import urls as U
    p = table(spark, sf_dir, "pages").select("page_id", "url")
    p = U.url_origin(p, "url", "site_url")
    p = U.url_host(p, "url", "host")
    lang = F.regexp_extract("url", SEGMENT_RE, 1)
    path = F.lit("/blog/feed")
    for lg, pth in reversed(FEED_PATH_BY_LANG):
        path = F.when(lang == lg, F.lit(pth)).otherwise(path)
    return p.select(F.col("page_id").alias("feed"), "site_url", "host",
                    F.concat("site_url", path, F.lit("?feed="), F.col("page_id").cast("string")).alias("feed_url"),
                    F.concat(F.lit("Feed of "), F.col("host")).alias("channel_title"))


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table as a file stream (the table's file matched by a one-file glob)."""
    schema = table(spark, sf_dir, name).schema
    return (spark.readStream.schema(schema).option("basePath", sf_dir).option("maxFilesPerTrigger", 1)
            .parquet(f"{sf_dir}/{name}.parque[t]"))


def stream_in_batches(spark: SparkSession, sf_dir: str, name: str, key: str, batches: int = 4) -> DataFrame:
    """A driver table as a stream of ``batches`` micro-batches, dealt by a hash of ``key``: each brings rows of all
    times, so all but the first are late."""
    import uuid

    from ..session import shared_dir
    t = table(spark, sf_dir, name)
    path = f"{shared_dir(spark)}/batches-{uuid.uuid4().hex}"
    t.repartition(batches, key).write.parquet(path)
    return spark.readStream.schema(t.schema).option("maxFilesPerTrigger", 1).parquet(path)


def checks_of(events: DataFrame) -> DataFrame:
    """Events as check-log rows (same mapping as v_checks, usable on a stream)."""
    return events.select(
        F.col("event_id"),
        F.concat(F.lit("https://feeds.example.org/u/"), F.col("user_id").cast("string")).alias("url"),
        F.datediff(F.to_date("ts"), F.lit("2024-01-01")).alias("run_idx"),
        F.col("ts").alias("checked_at"),
        F.when(F.col("event_type") == "error", F.lit("down"))
         .when(F.col("event_type") == "signup", F.lit("rate_limited"))
         .otherwise(F.lit("active")).alias("status"))


def sightings_of(events: DataFrame) -> DataFrame:
    """Events as candidate sightings: a feed URL per user with the event type as a query."""
    from ..functions import urls as U
    s = events.select("event_id", "ts", F.concat(F.lit("https://feeds.example.org/u/"), F.col("user_id").cast("string"),
                                                 F.lit("?e="), F.col("event_type")).alias("feed_url"))
    return U.url_hash(s, "feed_url", "url_hash")
