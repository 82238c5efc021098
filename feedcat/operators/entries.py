"""Feed bodies -> feeds and entries; per-feed entry windows (A12, C5, F3, E17,
E18, B21, B26).

Bodies are parsed row-locally with ``from_xml`` against the RSS, RDF or Atom
schema of their root element (PERMISSIVE: a body that doesn't parse is 'bozo').  The first-k
entries per feed use a salted two-stage top-k so a feed with a huge number
of entries is ranked by many tasks, never by one.
"""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import strip_ws, xml_attr_escape
from ..lexicon import MIN_FEED_BODY_BYTES

ITEM = ("struct<title:string, description:string, `content:encoded`:string, link:string, pubDate:string, "
        "`dc:date`:string, guid:string>")
RSS_SCHEMA = f"struct<_version:string, channel:struct<title:string, description:string, language:string, item:array<{ITEM}>>>"
RDF_SCHEMA = ("struct<channel:struct<title:string, description:string, `dc:language`:string>, "
              f"item:array<{ITEM}>>")  # RSS 1.0: items stand beside the channel
ATOM_SCHEMA = ("struct<_xmlns:string, title:string, subtitle:string, "
               "entry:array<struct<title:string, summary:string, content:string, "
               "link:array<struct<_href:string, _rel:string>>, published:string, updated:string>>>")
XML_OPTS = {"mode": "PERMISSIVE", "ignoreSurroundingSpaces": "false"}
ROOT_RE = r"^\s*(?:<\?[^>]*\?>\s*)?(?:<!--.*?-->\s*)*<([A-Za-z_][\w.:-]*)"
# RFC-822 forms after the optional weekday prefix (Spark parses no day-of-week text)
RFC822 = ["d MMM yyyy HH:mm:ss z", "d MMM yyyy HH:mm:ss Z", "d MMM yyyy HH:mm z", "d MMM yyyy HH:mm:ss"]


def parse_date(col) -> F.Column:
    """Feed date text -> timestamp (ISO-8601 first, then RFC-822 forms); NULL if unparseable."""
    c = strip_ws(col)
    rfc = F.regexp_replace(c, r"^[A-Za-z]{3},\s*", "")
    tries = [F.try_to_timestamp(c)] + [F.try_to_timestamp(rfc, F.lit(f)) for f in RFC822]
    return F.when(c == "", F.lit(None)).otherwise(F.coalesce(*tries))


def parse_bodies(bodies: DataFrame, key: str = "feed_url") -> DataFrame:
    """A12 step 1: parse each body once, with the schema of its root element (RSS, RDF or Atom).

    Keeps (key, chunk, root, rss, rdf, atom, namespaces) plus the fetch columns
    http_status and body_bytes when present; this relation is the stage to
    checkpoint when both feeds and entries are needed.
    """
    chunk = F.col("chunk") if "chunk" in bodies.columns else F.lit(0).cast("bigint")
    extra = [c for c in ("http_status", "body_bytes") if c in bodies.columns]
    root = F.lower(F.regexp_extract(F.col("body"), ROOT_RE, 1))

    def parsed(name: str, schema: str) -> F.Column:
        return F.when(F.col("root") == name, F.from_xml("body", schema, XML_OPTS))

    spaces = F.regexp_extract_all(F.col("body"), F.lit(r"xmlns(?::[\w.-]+)?\s*=\s*[\"']([^\"']*)[\"']"), 1)
    trees = F.struct(parsed("rss", RSS_SCHEMA).alias("rss"), parsed("rdf:rdf", RDF_SCHEMA).alias("rdf"),
                     parsed("feed", ATOM_SCHEMA).alias("atom"))
    # a filter isn't moved below ``inline``; below a plain projection it would take a second parse of every body
    return bodies.select(key, chunk.alias("chunk"), *extra, root.alias("root"), "body", spaces.alias("namespaces")).select(
        key, "chunk", *extra, "root", "namespaces", F.inline(F.array(trees))).select(
        key, "chunk", *extra, "root", "rss", "rdf", "atom", "namespaces")


def feeds_of(p: DataFrame, key: str = "feed_url", keep: tuple = ()) -> DataFrame:
    """A12 step 2: feed-level rows (version, namespaces, title, description, language,
    n_entries, bozo) of parsed bodies, with the columns ``keep``."""
    ok = F.coalesce(F.col("rss.channel").isNotNull() | F.col("rdf.channel").isNotNull() | F.col("atom").isNotNull(), F.lit(False))
    version = (F.when(F.col("root") == "rss", F.concat(F.lit("rss"), F.regexp_replace(F.coalesce("rss._version", F.lit("")), r"\.", "")))
               .when(F.col("root") == "feed", F.lit("atom10")).when(F.col("root") == "rdf:rdf", F.lit("rss10")).otherwise(F.lit("")))
    extra = [c for c in ("http_status", "body_bytes", *keep) if c in p.columns]
    n = F.coalesce(*[F.when(F.col(c).isNotNull(), F.size(c)) for c in ("rss.channel.item", "rdf.item", "atom.entry")], F.lit(0))
    return p.select(
        key, "chunk", *extra, "root", version.alias("version"), "namespaces",
        F.coalesce("rss.channel.title", "rdf.channel.title", "atom.title").alias("title"),
        F.coalesce("rss.channel.description", "rdf.channel.description", "atom.subtitle").alias("description"),
        F.coalesce("rss.channel.language", F.col("rdf.channel")["dc:language"]).alias("language"),
        n.cast("int").alias("n_entries"), (~ok).alias("bozo"))


def _atom_link(links) -> F.Column:
    """The first link without ``rel`` or with ``rel="alternate"``."""
    return F.get(F.filter(links, lambda x: F.coalesce(F.lower(x["_rel"]), F.lit("alternate")) == "alternate"), 0)["_href"]


def entry_array() -> F.Column:
    """The entries of a parsed body in document order, of an RSS, RDF or Atom feed alike: title, summary, link,
    published, updated (texts) and guid. The content stands in for a missing summary, ``dc:date`` is a time of update."""
    def item(e):
        return F.struct(e["title"].alias("title"), F.coalesce(e["description"], e["content:encoded"]).alias("summary"),
                        e["link"].alias("link"), e["pubDate"].alias("published"), e["dc:date"].alias("updated"),
                        e["guid"].alias("guid"))

    def entry(e):
        return F.struct(e["title"].alias("title"), F.coalesce(e["summary"], e["content"]).alias("summary"),
                        _atom_link(e["link"]).alias("link"), e["published"].alias("published"),
                        e["updated"].alias("updated"), F.lit(None).cast("string").alias("guid"))

    return F.coalesce(F.transform("rss.channel.item", item), F.transform("rdf.item", item), F.transform("atom.entry", entry))


def entries_of(p: DataFrame, key: str = "feed_url") -> DataFrame:
    """A12 step 3: one row per RSS item, RDF item or Atom entry, in document order (idx)."""
    ex = p.select(key, "chunk", F.posexplode(entry_array()).alias("idx", "e")).select(key, "chunk", "idx", "e.*")
    return ex.withColumns({"published_ts": parse_date(F.col("published")), "updated_ts": parse_date(F.col("updated"))})


def valid_bodies(p: DataFrame, min_bytes: int = MIN_FEED_BODY_BYTES) -> DataFrame:
    """C5 on parsed bodies, row by row: answered exactly 200, of ``min_bytes`` bytes at least, with an entry."""
    return p.where((F.col("http_status") == 200) & (F.col("body_bytes") >= min_bytes) & (F.size(F.coalesce(
        entry_array(), F.array())) >= 1))


def recency_bonus(latest, now: str) -> tuple[F.Column, F.Column]:
    """B26 and E15's recency points of a latest entry time: (whole days of age, bonus). ``now`` without a zone is UTC,
    whatever the session's zone."""
    at = dt.datetime.fromisoformat(now)
    at = at if at.tzinfo else at.replace(tzinfo=dt.timezone.utc)
    age = F.floor((F.lit(int(at.timestamp())) - F.unix_seconds(latest)) / 86400).cast("bigint")
    return age, F.when(latest.isNull(), F.lit(0)).when(age <= 30, F.lit(3)).when(age <= 90, F.lit(1)) \
        .when(age > 365, F.lit(-4)).otherwise(F.lit(0))


def parse_feed_bodies(bodies: DataFrame, key: str = "feed_url") -> tuple[DataFrame, DataFrame]:
    """(key, [chunk], body) -> (feeds, entries); see parse_bodies / feeds_of / entries_of."""
    p = parse_bodies(bodies, key)
    return feeds_of(p, key), entries_of(p, key)


def valid_feeds(fetches: DataFrame, feeds: DataFrame, key: str = "feed_url",
                min_bytes: int = MIN_FEED_BODY_BYTES) -> DataFrame:
    """Fetches answered exactly 200 with a body of at least ``min_bytes`` bytes
    that parsed to at least one entry."""
    f = fetches.where((F.col("http_status") == 200) & (F.col("body_bytes") >= min_bytes))
    return f.join(feeds.where(F.col("n_entries") >= 1).select(key, "chunk"), [key, "chunk"], "left_semi")


def first_entries(entries: DataFrame, k: int, feed: str = "feed",
                  pos: str = "pos", salt_buckets: int = 32) -> DataFrame:
    """the first ``k`` entries of every feed in ``pos`` order, with ``rank`` 1..k.

    Stage one keeps the first k inside (feed, salt) buckets, stage two ranks
    at most k * salt_buckets survivors per feed.
    """
    salted = entries.withColumn("__salt", F.pmod(F.xxhash64(F.col(pos)), F.lit(salt_buckets)))
    w1 = Window.partitionBy(feed, "__salt").orderBy(pos)
    s1 = salted.withColumn("__r1", F.row_number().over(w1)).where(F.col("__r1") <= k).drop("__r1", "__salt")
    w2 = Window.partitionBy(feed).orderBy(pos)
    return s1.withColumn("rank", F.row_number().over(w2)).where(F.col("rank") <= k)


def entry_sample(first: DataFrame, n: int, feed: str = "feed") -> DataFrame:
    """First ``n`` of (title, link, published-or-updated), stripped."""
    return first.where(F.col("rank") <= n).select(
        feed, "rank", strip_ws("title").alias("title"), strip_ws("link").alias("link"),
        strip_ws(F.coalesce(F.nullif(F.col("published"), F.lit("")), F.col("updated"))).alias("published"))


def feed_recency(entries: DataFrame, now: str, feed: str = "feed") -> DataFrame:
    """E18 + B26: latest published/updated time (to the second) over the entries,
    whole days of age (floor; future dates negative) and the recency bonus."""
    latest = F.greatest(F.date_trunc("second", F.col("published_ts")),
                        F.date_trunc("second", F.col("updated_ts")))
    g = entries.groupBy(feed).agg(F.max(latest).alias("latest"))
    now_c = F.lit(now).cast(dict(g.dtypes).get("latest", "timestamp_ntz"))
    age = F.floor(F.timestamp_diff("SECOND", F.col("latest"), now_c) / 86400).cast("bigint")
    return g.withColumns({
        "age_days": age,
        "recency_bonus": F.when(F.col("latest").isNull(), F.lit(0)).when(age <= 30, F.lit(3))
                          .when(age <= 90, F.lit(1)).when(age > 365, F.lit(-4)).otherwise(F.lit(0)),
    })


def feed_type(feeds: DataFrame, url_col: str = "feed_url") -> DataFrame:
    """Version says atom/rss, else any atom namespace, else 'atom' in the URL, else rss."""
    v = F.lower(F.coalesce(F.col("version"), F.lit("")))
    ns_atom = F.exists(F.coalesce(F.col("namespaces"), F.array().cast("array<string>")),
                       lambda n: F.lower(n).contains("atom"))
    return feeds.withColumn("feed_type", F.when(v.contains("atom"), F.lit("atom")).when(v.contains("rss"), F.lit("rss"))
                            .when(ns_atom, F.lit("atom"))
                            .when(F.lower(F.col(url_col)).contains("atom"), F.lit("atom")).otherwise(F.lit("rss")))


def render_rss_items(entries: DataFrame, feed: str = "feed", pos: str = "pos", chunk_size: int = 64,
                     title_col: str | None = None) -> DataFrame:
    """Render entries back into RSS documents, one body per (feed, chunk of ``chunk_size``
    positions) so no document grows with the feed; the guid carries the position."""
    e = entries.withColumn("chunk", F.floor(F.col(pos) / chunk_size).cast("bigint"))
    e = e.withColumn("__ct", F.col(title_col) if title_col else F.concat(F.lit("feed "), F.col(feed).cast("string")))
    item = F.concat(F.lit("<item><title>"), xml_attr_escape("title"), F.lit("</title><description>"),
                    xml_attr_escape("summary"), F.lit("</description><guid>"), F.col(pos).cast("string"),
                    F.lit("</guid></item>"))
    g = e.groupBy(feed, "__ct", "chunk").agg(
        F.array_sort(F.collect_list(F.struct(F.col(pos).alias("p"), item.alias("x")))).alias("__items"))
    body = F.concat(F.lit('<?xml version="1.0" encoding="UTF-8"?><rss version="2.0"><channel><title>'),
                    xml_attr_escape("__ct"), F.lit("</title>"),
                    F.array_join(F.transform("__items", lambda s: s["x"]), ""), F.lit("</channel></rss>"))
    return g.select(feed, "chunk", body.alias("body"))
