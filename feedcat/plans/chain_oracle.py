"""DuckDB SQL of the discovery run."""
from __future__ import annotations

from . import duck as D
from . import oracle as O
from . import views as V
from .chain import LARGE, SMALL

q = D.q
oracle = O.oracle


def _pages() -> str:
    ch = D.Chain(O.v_pages_with_feeds())
    D.url_origin(ch, "url", "origin")
    lang = f"regexp_extract(url, {q(V.SEGMENT_RE)}, 1)"
    return ch.select(
        f"page_id, url, html, origin, {lang} AS lang, CASE WHEN length(html) < {SMALL} THEN 404 WHEN length(html) > {LARGE} THEN 503 ELSE 200 END AS http_status, "
        f"CASE WHEN {lang} = 'de' AND contains(url, '.html') THEN 'application/pdf' WHEN {lang} = 'fr' THEN 'application/xhtml+xml' "
        f"ELSE 'Text/HTML; charset=utf-8' END AS content_type")


def _key(src: str, cols: str) -> str:
    ch = D.Chain(src)
    D.normalize_url_crawl(ch, "url", "_k")
    return ch.select(f"{cols}, regexp_replace(_k, '^([A-Za-z]+://[^/?#]+)/$', '\\1') AS k")


def _base() -> str:
    """CTEs: pg (pages), cap (captures that are HTML, by key), seed, hop, out, site, adv, probe."""
    html = "http_status = 200 AND (contains(lower(content_type), 'text/html') OR contains(lower(content_type), 'application/xhtml+xml'))"
    caps = (f"SELECT page_id, url, html FROM pg WHERE {html} UNION ALL SELECT -1 - page_id, origin || '/', html FROM pg WHERE {html}")
    seeds = _key("SELECT url FROM pg WHERE lang <> 'de'", "1 AS one")
    sites = D.Chain("SELECT o.link, h.url AS page_url FROM out o JOIN hop h USING (page_id)")
    D.url_origin(sites, "link", "site_url")
    sites.where("site_url <> ''")
    D.url_host(sites, "site_url", "host")
    ign = ", ".join(q(h) for h in O.IGNORED_HOSTS)
    sites.where(f"host <> '' AND contains(host, '.') AND host NOT IN ({ign}) AND NOT {O.blocked_cond('host')}")
    site = sites.select("host, min(site_url) AS site_url, min(page_url) AS found_on") + " GROUP BY host"
    adv = D.Chain(f"SELECT a.feed_url, h.url FROM ({O.advertised_sql('home')}) a JOIN home h USING (page_id)")
    D.url_origin(adv, "url", "site_url")
    probe = O.probes_of("SELECT * FROM site", "SELECT site_url, feed_url, true AS adv FROM adv")
    return (f"pg AS MATERIALIZED ({_pages()}), cap AS MATERIALIZED ({_key(caps, 'page_id, url, html')}), seed AS MATERIALIZED ({seeds}), "
            f"hop AS MATERIALIZED (SELECT page_id, k AS url, html FROM cap WHERE k IN (SELECT k FROM seed WHERE k <> '')), out AS MATERIALIZED ({O.outbound_sql('hop')}), "
            f"site AS MATERIALIZED ({site}), home AS MATERIALIZED (SELECT page_id, k AS url, html FROM cap WHERE k IN (SELECT site_url FROM site)), "
            f"adv AS MATERIALIZED ({adv.select('DISTINCT site_url, feed_url')}), probe AS MATERIALIZED ({probe})")


def _feeds() -> str:
    """CTEs fp, feed: the captured feeds (feed_url, page_id, lang, http_status, host); pg comes before."""
    own = D.Chain("SELECT page_id, url, origin, lang, http_status FROM pg")
    D.url_host(own, "url", "host")
    path = "CASE " + " ".join(f"WHEN lang = {q(lg)} THEN {q(p)}" for lg, p in V.FEED_PATH_BY_LANG) + " ELSE '/blog/feed' END"
    feeds = (f"SELECT origin || '/blog/rss?page=' || CAST(page_id AS VARCHAR) AS feed_url, page_id, lang, http_status, host FROM fp UNION ALL "
             f"SELECT origin || {path} AS feed_url, min(page_id), arg_min(lang, page_id), arg_min(http_status, page_id), arg_min(host, page_id) FROM fp GROUP BY 1")
    return f"fp AS MATERIALIZED ({own.select('*')}), feed AS MATERIALIZED ({feeds})"


def _raw() -> str:
    """CTEs up to raw: scored feeds of the sites that probe them."""
    entries = ("SELECT f.feed_url AS feed, f.page_id, f.lang, f.host, c.turn AS pos, c.role AS title, c.text AS summary FROM feed f "
               "JOIN conversations c ON c.conv_id = f.page_id WHERE f.http_status = 200 AND f.feed_url IN (SELECT feed_url FROM probe)")
    ts = "(TIMESTAMP '2024-02-01 00:00:00' - to_days(CAST(page_id * 5 + pos AS INTEGER)))"
    shown = (f"CASE WHEN lang = 'es' THEN '' WHEN page_id % 2 = 0 THEN 'Thu, ' || strftime({ts}, '%-d %b %Y %H:%M:%S') || ' GMT' "
             f"ELSE strftime({ts}, '%Y-%m-%dT%H:%M:%SZ') END")
    per = (f"SELECT feed, any_value(page_id) AS page_id, any_value(lang) AS lang, any_value(host) AS host, min(page_id * 5 + pos) AS age, "
           f"array_to_string(list_slice(list({D.strip_ws('title')} || '|https://chat.example.org/' || CAST(page_id AS VARCHAR) || '/' || CAST(pos AS VARCHAR) "
           f"|| '|' || {shown} ORDER BY pos), 1, 5), ';') AS sample FROM entry GROUP BY feed")
    bonus = "CASE WHEN a.lang = 'es' THEN 0 WHEN a.age <= 30 THEN 3 WHEN a.age <= 90 THEN 1 WHEN a.age > 365 THEN -4 ELSE 0 END"
    raw = D.Chain(f"SELECT p.feed_url, p.site_url, p.discovered_via, 'Feed of ' || a.host AS title, 'About ' || a.host AS description, "
                  f"CASE WHEN a.page_id % 2 = 0 THEN a.lang ELSE '' END AS language, CASE WHEN a.page_id % 2 = 0 THEN 'rss' ELSE 'atom' END AS feed_type, "
                  f"CAST(s.score + {bonus} AS INTEGER) AS score, s.matched_keywords, s.suggested_category, a.sample "
                  f"FROM probe p JOIN about a ON a.feed = p.feed_url JOIN scored s ON s.feed = p.feed_url")
    D.url_hash(raw, "feed_url", "url_hash")
    D.feed_path_rank(raw, "feed_url", "path_rank")
    final = D.Chain(O.best_of_sites_sql("SELECT * FROM raw"))
    D.url_key_discovery(final, "feed_url", "_k")
    known = O.known_sql(f"SELECT url FROM ({O.v_catalog()}) c")
    final.where(f"_k NOT IN ({known})")
    score = O.score_sql("SELECT feed, title, summary FROM entry")
    return (f"{_base()}, {_feeds()}, entry AS MATERIALIZED ({entries}), "
            f"about AS MATERIALIZED ({per}), scored AS MATERIALIZED ({score}), raw AS MATERIALIZED ({raw.select('*')}), "
            f"final AS MATERIALIZED ({final.select('* EXCLUDE (_k)')})")


@oracle("captured_html_pages")
def o_captured_html_pages():
    ok = ("http_status = 200 AND (contains(lower(content_type), 'text/html') OR contains(lower(content_type), 'application/xhtml+xml') "
          "OR starts_with(lower(content_type), 'text/'))")
    return (f"WITH pg AS ({_pages()}) SELECT page_id, url, http_status FROM pg WHERE {ok} UNION ALL "
            f"SELECT -1 - page_id, origin || '/', http_status FROM pg WHERE {ok}")


@oracle("captured_feeds")
def o_captured_feeds():
    n = "coalesce(c.n, 0)"
    rss = "page_id % 2 = 0"
    return (f"WITH pg AS MATERIALIZED ({_pages()}), {_feeds()}, c AS (SELECT conv_id, count(*) AS n FROM conversations GROUP BY 1) "
            f"SELECT feed_url, http_status, CASE WHEN {n} = 0 OR {rss} THEN 'rss20' ELSE 'atom10' END AS version, "
            f"CASE WHEN {n} = 0 OR {rss} THEN 'rss' ELSE 'atom' END AS feed_type, CAST({n} AS INTEGER) AS n_entries, "
            f"CASE WHEN {n} > 0 THEN 'Feed of ' || host END AS title, CASE WHEN {n} > 0 THEN 'About ' || host END AS description, "
            f"http_status = 200 AND {n} > 0 AS valid FROM feed LEFT JOIN c ON c.conv_id = feed.page_id")


@oracle("discover_sites")
def o_discover_sites():
    return f"WITH {_base()} SELECT site_url, host, found_on FROM site"


@oracle("discover_chain")
def o_discover_chain():
    return (f"WITH {_raw()}, b AS ({O.bucket_sql('SELECT * FROM final')}) SELECT feed_url, b.site_url, found_on, title, description, language, feed_type, score, "
            f"array_to_string(matched_keywords, ',') AS matched, suggested_category, discovered_via, sample, url_hash, {q(V.NOW)} AS discovered_at, bucket "
            f"FROM b JOIN site s ON s.site_url = b.site_url")


@oracle("discover_final")
def o_discover_final():
    items = O.items_sql(O.bucket_sql("SELECT * FROM final"))
    return (f"WITH {_raw()}, it AS MATERIALIZED (SELECT bucket || '.yaml' AS file, url, bucket_label AS category, title_i AS title, type_i AS type, "
            f"description_i AS description, score, url_hash FROM ({items}) i) "
            f"SELECT file, CAST(row_number() OVER (PARTITION BY file ORDER BY lower(category), lower(title), lower(type), url) AS INTEGER) AS place, "
            f"url, category, title, type, description, score, url_hash, (SELECT count(*) FROM ({_seed_count()}) x) AS seeds, "
            f"(SELECT count(*) FROM site) AS sites, (SELECT count(*) FROM probe) AS probes, (SELECT count(*) FROM final) AS kept, "
            f"(SELECT count(*) FROM it) AS added, 0::BIGINT AS added_again FROM it")


def _seed_count() -> str:
    ch = D.Chain("SELECT url FROM pg WHERE lang <> 'de'")
    D.normalize_url_crawl(ch, "url", "u")
    ch.where("u <> ''")
    return ch.select("DISTINCT u")


@oracle("review_rank_by_range")
def o_review_rank():
    return (f"SELECT bucket, url, CAST(row_number() OVER (PARTITION BY bucket ORDER BY lower(category), lower(title), lower(type), url) AS INTEGER) AS rank "
            f"FROM ({O.merged_sql()}) m")
