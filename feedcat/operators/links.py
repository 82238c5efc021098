"""Link mining over captured pages.

Pages are processed row-locally: comments, scripts and styles are cut, tags
are pulled with ``regexp_extract_all``, hrefs read from the tags and exploded, then resolved and
normalised with native expressions.  The large ``html`` column is projected
away before any exchange, so shuffles carry only URLs.  Blocklists are
equi-joins on exploded host suffixes (never a theta join); Spark's
size-checked broadcast (autoBroadcastJoinThreshold / AQE) decides whether a
list is broadcast.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import markup as M
from ..functions import urls as U
from ..functions.text import html_unescape, strip_ws
from ..lexicon import COMMON_FEED_PATHS, IGNORED_HOSTS

# what begins and isn't closed goes to the end of the page, as for a browser, and so is looked for once
STRIP_RE = r"(?is)<!--(?:.*?-->|.*+)|<script\b(?:.*?</script\s*+>|.*+)|<style\b(?:.*?</style\s*+>|.*+)"
NAMES = "a|link"


def html_pages(pages: DataFrame) -> DataFrame:
    """A10: keep fetched pages answered 200 with an HTML-ish content type
    (columns absent on the driver table mean 'accepted')."""
    cond = F.lit(True)
    if "http_status" in pages.columns:
        cond = cond & (F.col("http_status") == 200)
    if "content_type" in pages.columns:
        ct = F.lower(F.coalesce(F.col("content_type"), F.lit("")))
        cond = cond & (ct.contains("text/html") | ct.contains("application/xhtml+xml") | ct.startswith("text/"))
    return pages.where(cond)


def page_tags(html) -> F.Column:
    """The page's whole <a> and <link> tags in document order, those in comments, scripts and styles left out."""
    return M.tags(F.regexp_replace(html, STRIP_RE, " "), NAMES)


def _is_anchor(tag):
    return tag.rlike(r"(?i)^<a[\s/>]")


def _raw_hrefs(tags) -> F.Column:
    """The href values of the anchors that have one, as written."""
    return F.filter(F.transform(F.filter(tags, _is_anchor), lambda t: M.raw_attribute(t, "href", NAMES)), lambda v: v != "")


def page_hrefs(pages: DataFrame, keep=("page_id", "url")) -> DataFrame:
    """Every <a href> of a page in document order: (*keep, pos, href).

    href is entity-decoded and trimmed, as an HTML parser would hand it over.
    """
    df = pages.select(*keep, page_tags(F.col("html")).alias("__tags"))
    df = df.select(*keep, F.posexplode(_raw_hrefs(F.col("__tags"))).alias("pos", "__h"))
    return df.select(*keep, "pos",
                     _clean_href(F.col("__h")).alias("href"))


def page_links(pages: DataFrame) -> DataFrame:
    """One pass over each page's HTML: (page_id, url, origin, hrefs, tags).

    The page is cut into its <a> and <link> tags, and attributes are read from a tag alone.
    ``hrefs`` are the raw captured <a href> values in document order, ``tags``
    the raw <link> tags; decoding happens after the explode, row by row.  The
    relation is small next to ``html`` and is the natural stage to checkpoint
    when several operators (outbound links, advertised feeds) read the pages.
    """
    base = html_pages(pages).select("page_id", "url", page_tags(F.col("html")).alias("__tags"))
    base = U.url_origin(base, "url", "origin")
    return base.select("page_id", "url", "origin", _raw_hrefs(F.col("__tags")).alias("hrefs"),
                       F.filter("__tags", lambda t: ~_is_anchor(t)).alias("tags"))


def _clean_href(c):
    return strip_ws(html_unescape(M.unquoted(c)))


def _attr(tag, name):
    return M.attribute(tag, name, NAMES)


def _links_of(pages: DataFrame) -> DataFrame:
    return pages if "hrefs" in pages.columns else page_links(pages)


def resolve_links(pages: DataFrame) -> DataFrame:
    """B10 on every href with the page origin as base: (page_id, pos, href, resolved)."""
    df = page_hrefs(pages)
    df = U.url_origin(df, "url", "base")
    df = U.resolve_url(df, "base", "href", "resolved")
    return df.select("page_id", "pos", "href", "base", "resolved")


def _outbound(pages: DataFrame) -> DataFrame:
    """C4: (page_id, page_url, link) for every outbound http(s) link after join + crawl normalisation,
    skipping '#', mailto:, javascript:, blanks and asset paths; a link as often as it occurs."""
    pl = _links_of(pages)
    df = pl.select("page_id", F.col("url").alias("page_url"), F.col("origin").alias("base"), F.explode("hrefs").alias("__raw"))
    df = df.select("page_id", "page_url", "base", _clean_href(F.col("__raw")).alias("href"))
    h = F.col("href")
    df = df.where((h != "") & ~h.startswith("#") & ~h.startswith("mailto:") & ~h.startswith("javascript:"))
    df = U.resolve_url(df, "base", "href", "__j")
    df = U.normalize_url_crawl(df, "__j", "link")
    df = df.where(F.col("link") != "")
    df = U.url_scheme(df, "link", "__s")
    df = U.url_path(df, "link", "__p")
    df = df.where(F.col("__s").isin("http", "https") & ~U.is_asset_path(F.lower(F.col("__p"))))
    return df.select("page_id", "page_url", "link")


def outbound_links(pages: DataFrame) -> DataFrame:
    """Distinct outbound links per page."""
    return _outbound(pages).select("page_id", "link").distinct()


#: Copies of the blocklist that a suffix's hosts are dealt over: short suffixes (a top-level domain) have very many.
SALTS = 16


def _salt(host) -> F.Column:
    return F.pmod(F.xxhash64(host), F.lit(SALTS)).cast("int")


def suffix_rows(df: DataFrame, host_col: str) -> DataFrame:
    """A row for each dot-suffix of the host, with the salt that spreads a suffix over its hosts."""
    return df.select(*df.columns, _salt(host_col).alias("__salt"), F.explode(U.host_suffixes(F.col(host_col))).alias("__sfx"))


def salted_blocklist(blocked: DataFrame) -> DataFrame:
    """(__sfx, __salt) of each blocked domain, once for each salt."""
    return blocked.select(F.col("domain").alias("__sfx")).where(F.col("__sfx") != "").distinct() \
        .select("__sfx", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("__salt"))


def blocked_hosts(df: DataFrame, host_col: str, blocked: DataFrame | None) -> DataFrame:
    """C2 as a flag: adds boolean ``blocked`` (blank host, or equal to / a dot-suffix
    of a blocked domain).  Distinct hosts explode into their dot-suffixes and meet
    the blocklist in an equi-join; the verdict joins back on the host."""
    blank = F.col(host_col) == ""
    if blocked is None:
        return df.withColumn("blocked", blank)
    sfx = suffix_rows(df.select(F.col(host_col).alias("__h")).distinct(), "__h")
    bad = sfx.join(salted_blocklist(blocked), ["__sfx", "__salt"], "left_semi").select("__h").distinct().withColumn("__hit", F.lit(True))
    out = df.join(bad, df[host_col] == bad["__h"], "left")
    return out.withColumn("blocked", blank | F.coalesce(F.col("__hit"), F.lit(False))).drop("__h", "__hit")


def drop_blocked_hosts(df: DataFrame, host_col: str, blocked: DataFrame | None,
                       key: list[str] | None = None) -> DataFrame:
    """C2 as a filter: remove rows whose host is blank or blocked.

    With ``key`` (columns unique per row) each row's dot-suffixes are exploded,
    left-joined to the blocklist (equi-join; Spark broadcasts it when its size
    allows) and regrouped by the key, so ``df`` is read once and a hot host is
    spread by the key.  Without a key the distinct hosts are checked and joined
    back (``df`` is then read twice).
    """
    df = df.where(F.col(host_col) != "")
    if blocked is None:
        return df
    bl = salted_blocklist(blocked)
    if key:
        # rows are unique on ``key``, so grouping on every column keeps them whole while the
        # only aggregate is a boolean (hash aggregation, no sort)
        j = suffix_rows(df, host_col).join(bl.withColumn("__hit", F.lit(True)), ["__sfx", "__salt"], "left")
        g = j.groupBy(*df.columns).agg(F.max(F.coalesce(F.col("__hit"), F.lit(False))).alias("__bad"))
        return g.where(~F.col("__bad")).select(*df.columns)
    sfx = suffix_rows(df.select(F.col(host_col).alias("__h")).distinct(), "__h")
    bad = sfx.join(bl, ["__sfx", "__salt"], "left_semi").select("__h").distinct()
    return df.join(bad, df[host_col] == bad["__h"], "left_anti")


def page_key(df: DataFrame, url_col: str, out: str) -> DataFrame:
    """The name a page is asked for by: the crawl-normalised URL, a site's root with or without its slash alike."""
    df = U.normalize_url_crawl(df, url_col, out)
    return df.withColumn(out, F.regexp_replace(out, r"^([A-Za-z]+://[^/?#]+)/$", "$1"))


def seed_links(pages: DataFrame, seeds: DataFrame) -> DataFrame:
    """Hop 1 of the crawl: ``page_links`` of the pages that are seeds (``url``), and of no others, under the URL they were
    asked for by. Pages (or their ``page_links``) are cut to their tags before they are joined, so no HTML is shuffled
    however many seeds there are."""
    keyed = page_key(_links_of(pages), "url", "__key")
    wanted = page_key(seeds.select("url"), "url", "__key").where("__key <> ''").select("__key").distinct()
    asked = keyed.join(wanted, "__key", "left_semi").select("page_id", F.col("__key").alias("url"), "hrefs", "tags")
    return U.url_origin(asked, "url", "origin").select("page_id", "url", "origin", "hrefs", "tags")


def home_links(pages: DataFrame, sites: DataFrame) -> DataFrame:
    """Hop 2 of the crawl: ``page_links`` of the sites' home pages (``site_url``), and of no others. Pages (or their
    ``page_links``) are cut to their tags before they are joined, so no HTML is shuffled however many sites there are."""
    keyed = page_key(_links_of(pages), "url", "__key")
    homes = keyed.join(sites.select(F.col("site_url").alias("__key")), "__key", "left_semi")
    return homes.select("page_id", F.col("__key").alias("url"), F.col("__key").alias("origin"), "hrefs", "tags")


def linked_sites(links: DataFrame, blocked: DataFrame | None = None, max_sites: int | None = None) -> DataFrame:
    """E7/C1 with provenance: (site_url, host, found_on, n_links). Origins are taken right from the links, so what is
    shuffled is one row per task and host; ``site_url`` is the host's smallest origin (so http:// beats https://),
    ``found_on`` the smallest URL of a page that links to it. Hosts without a dot, ignored and blocked ones are
    dropped; capped after ordering if ``max_sites`` is given."""
    df = U.url_origin(_outbound(links), "link", "site_url").where(F.col("site_url") != "")
    df = U.url_host(df, "site_url", "host")
    df = df.where((F.col("host") != "") & F.col("host").contains(".") & ~F.col("host").isin(*IGNORED_HOSTS))
    out = df.groupBy("host").agg(F.min("site_url").alias("site_url"), F.min("page_url").alias("found_on"), F.count("*").alias("n_links"))
    out = drop_blocked_hosts(out, "host", blocked, key=["host"])
    if max_sites:
        out = out.orderBy("site_url").limit(max_sites)
    return out.select("site_url", "host", "found_on", "n_links")


def crawl_sites(pages: DataFrame, blocked: DataFrame | None = None,
                max_sites: int | None = None) -> DataFrame:
    """Candidate site origins from outbound links, one per host; see ``linked_sites``."""
    return linked_sites(pages, blocked, max_sites).select("site_url", "host")


def _advertised(pages: DataFrame) -> DataFrame:
    """(page_id, origin, feed_url) for every advertised feed, as often as it occurs."""
    pl = _links_of(pages)
    ex = pl.select("page_id", "origin", F.size("tags").alias("__nt"),
                   F.posexplode(F.concat("tags", "hrefs")).alias("__i", "__raw"))
    is_link = F.col("__i") < F.col("__nt")
    df = ex.select("page_id", "origin", is_link.alias("__link"),
                   F.when(is_link, strip_ws(_attr(F.col("__raw"), "rel"))).alias("rel"),
                   F.when(is_link, F.lower(_attr(F.col("__raw"), "type"))).alias("type"),
                   F.when(is_link, strip_ws(_attr(F.col("__raw"), "href")))
                    .otherwise(_clean_href(F.col("__raw"))).alias("href"))
    t, href = F.col("type"), F.col("href")
    hint = U.has_feed_hint(href)
    keep = (href != "") & ((F.col("__link") & (F.col("rel") == "alternate")
                            & (t.contains("rss") | t.contains("atom") | t.contains("xml") | hint))
                           | (~F.col("__link") & hint))
    df = U.resolve_url(df.where(keep), "origin", "href", "__j")
    df = U.normalize_url_crawl(df, "__j", "feed_url")
    return df.where(F.col("feed_url") != "").select("page_id", "origin", "feed_url")


def advertised_feeds(pages: DataFrame) -> DataFrame:
    """H1: <link rel="alternate"> whose type mentions rss/atom/xml or whose href hints,
    plus <a href> that hint; resolved against the page origin and crawl-normalised.
    One explode over both kinds (no second pass over the page).  Output (page_id, feed_url)."""
    return _advertised(pages).select("page_id", "feed_url").distinct()


def site_feeds(pages: DataFrame) -> DataFrame:
    """H1 by site: distinct (site_url, feed_url), the site being the page's origin."""
    return _advertised(pages).select(F.col("origin").alias("site_url"), "feed_url").distinct()


def blocked_feed_flags(probes: DataFrame, blocked_feeds: DataFrame) -> DataFrame:
    """C3 as a flag: ``blocked`` when the lower-cased crawl-normalised URL or the
    lower-cased raw URL is listed (two equi left joins with the small list)."""
    bf = blocked_feeds.select(F.lower(strip_ws("feed")).alias("__bf")).distinct()
    df = U.normalize_url_crawl(probes, "feed_url", "__n").withColumn("__n", F.lower("__n"))
    df = df.join(bf.withColumn("__h1", F.lit(True)), df["__n"] == bf["__bf"], "left").drop("__bf")
    df = df.withColumn("__raw", F.lower("feed_url"))
    df = df.join(bf.withColumn("__h2", F.lit(True)), df["__raw"] == bf["__bf"], "left").drop("__bf")
    return df.withColumn("blocked", F.coalesce(F.col("__h1"), F.lit(False)) | F.coalesce(F.col("__h2"), F.lit(False))) \
        .drop("__n", "__raw", "__h1", "__h2")


def probe_urls(sites: DataFrame, advertised: DataFrame | None = None,
               blocked: DataFrame | None = None, blocked_feeds: DataFrame | None = None) -> DataFrame:
    """Per site, the advertised feeds plus the 14 common paths, distinct;
    ``discovered_via`` is 'rel=alternate' when advertised.  Blocked hosts and blocked
    feed URLs (exact on the lower-cased normalised or raw URL) are removed.

    ``sites`` has site_url; ``advertised`` has (site_url, feed_url).
    """
    paths = F.array(*[F.lit(p) for p in COMMON_FEED_PATHS])
    s = sites.select("site_url")
    ex = s.select("site_url", F.explode(paths).alias("__p"))
    ex = U.resolve_url(ex, "site_url", "__p", "__j")
    ex = U.normalize_url_crawl(ex, "__j", "feed_url").select("site_url", "feed_url", F.lit(False).alias("__adv"))
    if advertised is not None:
        ex = ex.unionByName(advertised.join(s, "site_url", "left_semi").select("site_url", "feed_url", F.lit(True).alias("__adv")))
    df = ex.groupBy("site_url", "feed_url").agg(F.max("__adv").alias("__adv"))
    df = df.withColumn("discovered_via", F.when(F.col("__adv"), F.lit("rel=alternate"))
                       .otherwise(F.lit("common_path"))).drop("__adv")
    df = U.normalize_url_crawl(df, "feed_url", "__n")
    df = df.withColumn("__n", F.lower(F.col("__n")))
    df = U.url_host(df, "__n", "__host")
    df = drop_blocked_hosts(df, "__host", blocked, key=["site_url", "feed_url"])
    if blocked_feeds is not None:
        bf = blocked_feeds.select(F.lower(strip_ws("feed")).alias("__bf")).distinct()
        df = df.join(bf, df["__n"] == bf["__bf"], "left_anti")
        df = df.join(bf, F.lower(df["feed_url"]) == bf["__bf"], "left_anti")
    return df.drop("__n", "__host")
