"""DuckDB oracle SQL for the registered queries (same column names as Spark).

The adaptor views are re-stated over the raw driver tables, then each query
is written in DuckDB's own dialect with the builders of ``plans/duck.py``.
"""
from __future__ import annotations

from . import duck as D
from .views import AD_RE, SEGMENT_RE, TITLE_RE

q = D.q
ORACLE: dict = {}


def oracle(name):
    def deco(fn):
        ORACLE[name] = fn
        return fn
    return deco


# --- views ---------------------------------------------------------------------

def v_catalog() -> str:
    seg = f"regexp_extract(url, {q(SEGMENT_RE)}, 1)"
    return (f"SELECT {seg} || '.yaml' AS file, page_id AS item_idx, page_id AS ord, url, "
            f"{D.clean_text(f'regexp_extract(html, {q(TITLE_RE)}, 1)')} AS title, "
            f"{D.clean_text(f'regexp_extract(html, {q(AD_RE)}, 1)')} AS description, "
            f"CASE WHEN contains(url, '.html') THEN 'Atom' WHEN contains(url, '?') THEN 'RSS' ELSE '' END AS type, "
            f"{seg} AS category FROM pages")


def v_catalog_dups() -> str:
    c = v_catalog()
    nofrag = "regexp_replace(url, '#.*$', '')"
    return (f"SELECT file, item_idx, ord * 3 AS ord, CASE WHEN starts_with(url, 'https://') THEN 'http://' || substr(url, 9) "
            f"ELSE 'https://' || substr(url, 8) END AS url, '' AS title, description, type, category, 'flipped' AS variant FROM ({c}) c1 "
            f"UNION ALL SELECT file, item_idx, ord * 3 + 1, url, title, description, type, category, 'original' FROM ({c}) c2 "
            f"UNION ALL SELECT file, item_idx, ord * 3 + 2, {nofrag} || CASE WHEN contains({nofrag}, '?') THEN '&' ELSE '?' END || 'utm_medium=x', "
            f"title, '', 'rss', category, 'tracked' FROM ({c}) c3")


def items_chain(policy: str = "catalog", blank_category: str | None = None, where: str | None = None) -> D.Chain:
    """A1 projection over v_catalog_dups: url_n, t, d, ty, c (+ ord, file, variant)."""
    base = v_catalog_dups()
    if where:
        base = f"SELECT * FROM ({base}) w WHERE {where}"
    ch = D.Chain(base)
    ch.add(_raw=D.strip_ws("url"))
    if policy == "export":
        D.url_key_export(ch, "_raw", "url_n")
    else:
        D.normalize_url(ch, "_raw", "url_n")
    c = D.clean_text("category")
    if blank_category is not None:
        c = f"(CASE WHEN {c} = '' THEN {q(blank_category)} ELSE {c} END)"
    ch.add(t=D.clean_text("title"), d=D.clean_text("description"), ty=f"lower({D.clean_text('type')})", c=c)
    return ch


def _dups_chain() -> D.Chain:
    return D.Chain(f"SELECT ord, url, title, description, category FROM ({v_catalog_dups()}) v")


def _first(col: str, cond: str | None = None) -> str:
    if cond is None:
        return f"arg_min({col}, ord)"
    return f"arg_min({col}, ord) FILTER (WHERE {cond})"


# --- 2.B scalars ------------------------------------------------------------------

@oracle("clean_text")
def o_clean_text():
    h = D.clean_text(f"regexp_extract(html, {q('(?is)<h1>(.*?)</h1>')}, 1)")
    f = D.clean_text(f"regexp_extract(html, {q('(?is)<footer>(.*?)</footer>')}, 1)")
    return f"SELECT page_id, {h} AS heading, {f} AS footer, {D.clean_text('html')} AS page FROM pages"


def _url_query(fn, out, **kw):
    ch = _dups_chain()
    fn(ch, "url", out, **kw)
    return ch.select(f"ord, {out}")


@oracle("url_normalize")
def o_url_normalize():
    return _url_query(D.normalize_url, "url_norm")


@oracle("url_normalize_crawl")
def o_url_normalize_crawl():
    return _url_query(D.normalize_url_crawl, "url_norm")


@oracle("url_key_export")
def o_url_key_export():
    return _url_query(D.url_key_export, "url_key")


@oracle("url_key_catalog")
def o_url_key_catalog():
    ch = _dups_chain()
    D.normalize_url(ch, "url", "_n")
    D.url_key_catalog(ch, "_n", "url_key")
    return ch.select("ord, url_key")


@oracle("url_key_validate")
def o_url_key_validate():
    return _url_query(D.url_key_validate, "url_key")


@oracle("url_key_discovery")
def o_url_key_discovery():
    return _url_query(D.url_key_discovery, "url_key")


@oracle("url_host")
def o_url_host():
    return _url_query(D.url_host, "host")


@oracle("url_origin")
def o_url_origin():
    return _url_query(D.url_origin, "origin")


@oracle("url_hash")
def o_url_hash():
    return _url_query(D.url_hash, "url_hash")


@oracle("slug")
def o_slug():
    return (f"SELECT ord, {D.slug('title', 'uncategorized', True)} AS slug, {D.slug('description')} AS slug_plain "
            f"FROM ({v_catalog_dups()}) v")


@oracle("slug_short")
def o_slug_short():
    return f"SELECT ord, {D.slug_short('title')} AS slug FROM ({v_catalog_dups()}) v"


@oracle("item_description")
def o_item_description():
    return (f"SELECT ord, {D.item_description('description', 'category', 'title')} AS description "
            f"FROM ({v_catalog_dups()}) v")


@oracle("html_escape")
def o_html_escape():
    return (f"SELECT ord, {D.html_escape('title')} AS title_html, {D.xml_escape('title')} AS title_xml, "
            f"{D.md_escape('title')} AS title_md FROM ({v_catalog_dups()}) v")


# --- 2.E catalog ------------------------------------------------------------------

@oracle("catalog_dedup")
def o_catalog_dedup():
    ch = items_chain()
    D.url_key_catalog(ch, "url_n", "key")
    inner = ch.select(
        "key, " + _first("url_n") + " AS first_url, " + _first("url_n", "starts_with(url_n, 'https:')") + " AS https_url, "
        + ", ".join(f"coalesce({_first(c, c + ' <> ' + q(''))}, '') AS {n}"
                    for c, n in (("t", "title"), ("d", "description"), ("ty", "type"), ("c", "category")))
        + ", min(ord) AS ord, count(*) AS n_items") + " GROUP BY key"
    return ("SELECT key, CASE WHEN starts_with(first_url, 'http:') AND https_url IS NOT NULL THEN https_url ELSE first_url END AS url, "
            f"title, description, type, category, ord, n_items FROM ({inner}) g")


@oracle("import_dedup")
def o_import_dedup():
    ch = items_chain()
    fill = ", ".join(f"coalesce({_first(c, c + ' <> ' + q(''))}, '') AS {n}"
                     for c, n in (("t", "title"), ("d", "description"), ("ty", "type"), ("c", "category")))
    return ch.select(f"{_first('c')} AS group_category, url_n AS url, {fill}, min(ord) AS ord") + " GROUP BY url_n"


@oracle("export_dedup")
def o_export_dedup():
    ch = items_chain("export", "Uncategorized")
    D.url_key_export(ch, "url_n", "key")
    ch.where("key <> ''")
    cols = ", ".join(f"{_first(c)} AS {n}" for c, n in (("t", "title"), ("d", "description"), ("ty", "type"), ("c", "category")))
    return ch.select(f"key AS url, {cols}, min(ord) AS ord") + " GROUP BY key"


@oracle("check_worklist")
def o_check_worklist():
    ch = D.Chain(v_catalog_dups())
    ch.add(_raw=D.strip_ws("url"))
    D.normalize_url(ch, "_raw", "url_n")
    ch.where("url_n <> ''")
    return ch.select("url_n AS url, min(ord) AS ord") + " GROUP BY url_n"


@oracle("category_counts")
def o_category_counts():
    return f"SELECT coalesce(category, 'Uncategorized') AS category, count(*) AS n FROM ({v_catalog()}) v GROUP BY 1"


@oracle("category_facets")
def o_category_facets():
    return f"SELECT DISTINCT category FROM ({v_catalog()}) v WHERE category IS NOT NULL AND category <> ''"


@oracle("manifest")
def o_manifest():
    return f"SELECT category, file, count(*) AS count FROM ({v_catalog()}) v GROUP BY category, file"


@oracle("merge_by_url")
def o_merge_by_url():
    ch = items_chain()
    ch.add(_u=D.strip_ws("url_n"))
    base = ch.select("url_n AS url, t AS title, c AS category, ord, _u")
    return (f"WITH it AS ({base}), ex AS (SELECT * FROM it WHERE category = 'en'), "
            f"nw AS (SELECT * FROM it WHERE category <> 'en' AND _u <> '') "
            f"SELECT url, title, category, ord, false AS added FROM ex UNION ALL "
            f"SELECT arg_min(url, ord), arg_min(title, ord), arg_min(category, ord), min(ord), true FROM nw "
            f"WHERE _u NOT IN (SELECT _u FROM ex WHERE _u <> '') GROUP BY _u")


@oracle("promote_candidates")
def o_promote():
    m = items_chain("export", "Uncategorized", where="variant = 'original'")
    D.url_key_export(m, "url_n", "k")
    c = items_chain("export", "Uncategorized", where="variant <> 'original'")
    D.url_key_export(c, "url_n", "k")
    ms = m.select("file, url_n AS url, t AS title, ord, k")
    cs = c.select("file, url_n AS url, t AS title, ord, k")
    return (f"WITH m AS ({ms}), c AS ({cs}) SELECT file, url, title, ord, false AS promoted FROM m UNION ALL "
            f"SELECT arg_min(file, ord), arg_min(url, ord), arg_min(title, ord), min(ord), true FROM c "
            f"WHERE k NOT IN (SELECT k FROM m) GROUP BY k")


# --- links --------------------------------------------------------------------------

STRIP_RE = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
ATTRS = r"""(?:=\s*"[^"]*"|=\s*'[^']*'|=\s*[^\s"'>]|[^>=])*"""
A_HREF_RE = rf"""(?is)<a\b{ATTRS}?\shref\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""


def unquote_attr(e: str) -> str:
    return f"(CASE WHEN substr({e}, 1, 1) IN ('\"', '''') THEN substr({e}, 2, greatest(length({e}) - 2, 0)) ELSE {e} END)"


def unescape(e: str) -> str:
    named = " ".join(f"WHEN s = {q(a)} THEN {q(b)}" for a, b in
                     (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&nbsp;", "\u00a0"), ("&amp;", "&")))
    code = ("CASE WHEN length(s) > 12 THEN 0 WHEN lower(substr(s, 3, 1)) = 'x' THEN CAST('0x' || substr(s, 4, length(s) - 4) AS BIGINT) "
            "ELSE CAST(substr(s, 3, length(s) - 3) AS BIGINT) END")
    ch = f"CASE WHEN {code} BETWEEN 1 AND 55295 OR {code} BETWEEN 57344 AND 1114111 THEN chr(CAST({code} AS INTEGER)) ELSE chr(65533) END"
    return (f"array_to_string(list_transform(regexp_extract_all({e}, '&#?[0-9a-zA-Z]+;|[^&]+|&'), lambda s: "
            f"CASE {named} WHEN regexp_full_match(s, '&#([0-9]+|[xX][0-9a-fA-F]+);') THEN {ch} ELSE s END), '')")


def hrefs_sql(pages: str = "pages", keep: str = "page_id, url", col: str = "html", stripped: bool = False) -> str:
    body = col if stripped else f"regexp_replace({col}, {q(STRIP_RE)}, ' ', 'g')"
    inner = (f"SELECT {keep}, unnest(range(len(m))) AS pos0, unnest(m) AS raw "
             f"FROM (SELECT {keep}, regexp_extract_all({body}, {q(A_HREF_RE)}, 1) AS m FROM {pages}) x")
    return (f"SELECT {keep}, CAST(pos0 AS INTEGER) AS pos, {D.strip_ws(unescape(unquote_attr('raw')))} AS href "
            f"FROM ({inner}) y")


@oracle("resolve_links")
def o_resolve_links():
    ch = D.Chain(hrefs_sql())
    D.url_origin(ch, "url", "base")
    D.resolve_url(ch, "base", "href", "resolved")
    return ch.select("page_id, pos, href, resolved")


def outbound_sql(pages: str = "pages") -> str:
    ch = D.Chain(hrefs_sql(pages))
    ch.where("href <> '' AND NOT starts_with(href, '#') AND NOT starts_with(href, 'mailto:') AND NOT starts_with(href, 'javascript:')")
    D.url_origin(ch, "url", "base")
    D.resolve_url(ch, "base", "href", "_j")
    D.normalize_url_crawl(ch, "_j", "link")
    ch.where("link <> ''")
    p = D.tmp()
    D.split(ch, "link", p)
    from ..lexicon import ASSET_EXTENSIONS
    asset = " OR ".join(f"ends_with(lower({p}_path), {q(e)})" for e in ASSET_EXTENSIONS)
    ch.where(f"{p}_s IN ('http', 'https') AND NOT ({asset})")
    return ch.select("DISTINCT page_id, link")


@oracle("outbound_links")
def o_outbound_links():
    return outbound_sql()


@oracle("html_pages")
def o_html_pages():
    return "SELECT page_id, url FROM pages"


# --- quality -----------------------------------------------------------------------

from ..lexicon import ALLOWED_TYPES, COMMON_FEED_PATHS, IGNORED_HOSTS  # noqa: E402
from .views import BLOCKED_DOMAINS, BLOCKED_FEEDS  # noqa: E402

CANON = "SELECT * FROM (VALUES ('en', 'en.yaml'), ('fr', 'fr.yaml'), ('Deutsch', 'de.yaml')) t(category, file)"
LOC = "file || ' #' || CAST(item_idx AS VARCHAR)"


def validation_sql() -> str:
    return (f"SELECT file, item_idx, ord, true AS is_dict, {D.strip_ws('url')} AS url_raw, "
            f"{D.strip_ws('category')} AS category_v, lower({D.strip_ws('type')}) AS type_v, "
            f"lower({D.strip_ws('title')}) AS title_v FROM ({v_catalog_dups()}) v")


def dup_urls_sql() -> str:
    ch = D.Chain(f"SELECT * FROM ({validation_sql()}) x WHERE is_dict AND url_raw <> ''")
    D.url_key_validate(ch, "url_raw", "key")
    keyed = ch.select("ord, file, item_idx, url_raw, key")
    return (f"WITH k AS ({keyed}), f AS (SELECT key, arg_min({LOC}, ord) AS first_loc, min(ord) AS first_ord "
            f"FROM k GROUP BY key HAVING count(*) > 1) "
            f"SELECT k.ord, k.file, k.item_idx, k.url_raw, k.key, f.first_loc FROM k JOIN f ON k.key = f.key "
            f"WHERE k.ord > f.first_ord")


def dup_titles_sql() -> str:
    ch = D.Chain(f"SELECT * FROM ({validation_sql()}) x WHERE is_dict AND url_raw <> '' AND title_v <> ''")
    D.normalize_url(ch, "url_raw", "_n")
    D.url_host(ch, "_n", "host")
    keyed = ch.select("ord, file, item_idx, host, title_v")
    return (f"WITH k AS ({keyed}), f AS (SELECT host, title_v, arg_min({LOC}, ord) AS first_loc, min(ord) AS first_ord "
            f"FROM k GROUP BY host, title_v HAVING count(*) > 1) "
            f"SELECT k.ord, k.file, k.item_idx, k.host, k.title_v AS title, f.first_loc FROM k "
            f"JOIN f ON k.host = f.host AND k.title_v = f.title_v WHERE k.ord > f.first_ord")


@oracle("duplicate_urls")
def o_duplicate_urls():
    return dup_urls_sql()


@oracle("duplicate_titles")
def o_duplicate_titles():
    return dup_titles_sql()


def violations_sql() -> str:
    allowed = ", ".join(q(t) for t in ALLOWED_TYPES)
    return (f"WITH v AS (SELECT x.*, c.category AS expected FROM ({validation_sql()}) x LEFT JOIN ({CANON}) c ON x.file = c.file) "
            f"SELECT DISTINCT CAST(NULL AS BIGINT) AS ord, file, CAST(NULL AS BIGINT) AS item_idx, 'error' AS level, 'file_not_listed' AS rule, '' AS detail FROM v WHERE expected IS NULL "
            f"UNION ALL SELECT ord, file, item_idx, 'error', 'not_a_dict', '' FROM v WHERE NOT is_dict "
            f"UNION ALL SELECT ord, file, item_idx, 'error', 'missing_url', '' FROM v WHERE is_dict AND url_raw = '' "
            f"UNION ALL SELECT ord, file, item_idx, 'error', 'category_mismatch', category_v || ' != ' || expected FROM v "
            f"WHERE is_dict AND url_raw <> '' AND expected IS NOT NULL AND category_v <> expected "
            f"UNION ALL SELECT ord, file, item_idx, 'warn', 'unusual_type', type_v FROM v WHERE is_dict AND url_raw <> '' AND type_v NOT IN ({allowed}) "
            f"UNION ALL SELECT ord, file, item_idx, 'error', 'duplicate_url', first_loc FROM ({dup_urls_sql()}) d1 "
            f"UNION ALL SELECT ord, file, item_idx, 'warn', 'possible_duplicate', first_loc FROM ({dup_titles_sql()}) d2")


@oracle("quality_violations")
def o_quality_violations():
    return violations_sql()


@oracle("quality_summary")
def o_quality_summary():
    ch = D.Chain(validation_sql())
    D.url_key_validate(ch, "url_raw", "key")
    keys = ch.select("count(*) AS items, count(DISTINCT CASE WHEN is_dict AND url_raw <> '' THEN key END) AS unique_urls")
    return (f"SELECT e.errors, e.warnings, k.items, k.unique_urls, e.errors = 0 AS passed FROM "
            f"(SELECT count(*) FILTER (WHERE level = 'error') AS errors, count(*) FILTER (WHERE level = 'warn') AS warnings "
            f"FROM ({violations_sql()}) x) e, ({keys}) k")


@oracle("exclusion_rules")
def o_exclusion_rules():
    ch = D.Chain(f"SELECT ord, {D.strip_ws('url')} AS u, title FROM ({v_catalog_dups()}) v")
    D.url_host(ch, "u", "h")
    doms = "['www.cheap-pills.example.com', 'spam-farm.example.org']"
    body = ch.select(
        f"ord, len(list_filter({doms}, lambda d: lower(h) = d OR ends_with(lower(h), '.' || d))) > 0 AS by_domain, "
        f"contains(lower(u), 'utm_') AS by_url, contains(lower(coalesce(title, '')), 'ththe') AS by_title")
    return f"SELECT * FROM ({body}) z WHERE by_domain OR by_url OR by_title"


# --- search / status -------------------------------------------------------------------

def v_status() -> str:
    st = "CASE WHEN length(html) > 9000 THEN 'active' WHEN length(html) < 4000 THEN 'down' ELSE 'rate_limited' END"
    return (f"SELECT url, status, CASE WHEN status = 'down' THEN 'http_404' WHEN status = 'rate_limited' THEN 'http_429' ELSE '' END AS error "
            f"FROM (SELECT url, {st} AS status FROM pages WHERE regexp_extract(url, {q(SEGMENT_RE)}, 1) <> 'es') s")


def with_status() -> str:
    cat = o_catalog_dedup()
    return (f"SELECT c.url, c.title, c.description, c.type, c.category, lower(coalesce(nullif(s.status, ''), 'unknown')) AS status, "
            f"coalesce(s.error, '') AS error FROM ({cat}) c LEFT JOIN ({v_status()}) s ON c.url = s.url")


@oracle("catalog_with_status")
def o_catalog_with_status():
    return (f"SELECT url, status, error, CASE WHEN status = 'active' THEN 'badge badge-active' WHEN status = 'down' "
            f"THEN 'badge badge-down' ELSE 'badge badge-unknown' END AS badge, "
            f"coalesce(nullif(trim(coalesce(title, '')), ''), '(untitled)') AS display_title FROM ({with_status()}) w")


@oracle("catalog_search")
def o_catalog_search():
    hay = "lower(url || ' ' || coalesce(title, '') || ' ' || coalesce(description, '') || ' ' || coalesce(type, '') || ' ' || coalesce(category, ''))"
    return f"SELECT url, title, status FROM ({with_status()}) w WHERE status = 'active' AND contains({hay}, 'th')"


@oracle("status_counts")
def o_status_counts():
    return (f"SELECT count(*) FILTER (WHERE status = 'active') AS active, count(*) FILTER (WHERE status = 'down') AS down, "
            f"count(*) FILTER (WHERE status NOT IN ('active', 'down')) AS unknown, count(*) AS total FROM ({with_status()}) w")


@oracle("active_feeds")
def o_active_feeds():
    st = D.Chain(f"SELECT url FROM ({v_status()}) s WHERE status = 'active'")
    D.url_key_export(st, "url", "k")
    return (f"SELECT url, title, category FROM ({o_export_dedup()}) e "
            f"WHERE url IN ({st.select('k')})")


# --- health ------------------------------------------------------------------------------

def v_fetch() -> str:
    k = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
    base = (f"SELECT *, {k} AS k, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS rn, "
            f"CASE WHEN value > 470 THEN 'timeout' WHEN value > 460 THEN 'connection:ConnectionError' "
            f"WHEN value > 455 THEN 'request:TooManyRedirects' END AS net FROM events")
    b2 = (f"SELECT *, CASE WHEN net IS NOT NULL THEN NULL WHEN value < 5 THEN 404 WHEN value < 10 THEN 429 "
          f"WHEN value < 15 THEN 503 ELSE 200 END AS http FROM ({base}) b")
    b3 = f"SELECT *, CASE WHEN http = 200 THEN event_type = 'error' END AS bz FROM ({b2}) c"
    return (f"SELECT 'https://feeds.example.org/u/' || CAST(user_id AS VARCHAR) AS url, "
            f"CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d') || '-' || CAST((rn - 1) // 2 AS VARCHAR) AS run_id, "
            f"ts AS checked_at, CAST((rn - 1) % 2 + 1 AS INTEGER) AS attempt, CAST(http AS INTEGER) AS http_status, net AS net_error, "
            f"bz AS bozo, CASE WHEN bz AND k % 3 = 0 THEN 'SAXParseException' END AS bozo_error, "
            f"CASE WHEN http = 200 THEN CASE WHEN bz AND k < 40 THEN 0 ELSE k END END AS entries, "
            f"CASE WHEN net IS NULL THEN CASE WHEN event_type = 'view' THEN 'Application/RSS+XML; charset=utf-8' ELSE ' text/xml' END END AS content_type, "
            f"CAST(trunc(value * 10) AS INTEGER) AS latency_ms FROM ({b3}) d")


def fetch_status_sql() -> str:
    got = "(net_error IS NULL AND http_status IS NOT NULL)"
    bz = "coalesce(bozo, false)"
    ent = "coalesce(entries, 0)"
    berr = f"CASE WHEN {bz} AND bozo_error IS NOT NULL THEN 'bozo:' || bozo_error WHEN {bz} THEN 'bozo' END"
    act = f"(NOT {bz} OR {ent} > 0)"
    ct_base = "split_part(coalesce(content_type, ''), ';', 1)"
    return (f"SELECT url, run_id, attempt, checked_at, latency_ms, "
            f"CASE WHEN net_error IS NOT NULL OR http_status IS NULL THEN 'down' WHEN http_status = 429 THEN 'rate_limited' "
            f"WHEN http_status >= 400 THEN 'down' WHEN {act} THEN 'active' ELSE 'down' END AS status, "
            f"CASE WHEN net_error IS NOT NULL THEN net_error WHEN http_status IS NULL THEN 'unexpected:NoResponse' "
            f"WHEN http_status = 429 THEN 'http_429' WHEN http_status >= 400 THEN 'http_' || CAST(http_status AS VARCHAR) "
            f"WHEN {act} THEN {berr} ELSE coalesce({berr}, 'empty_or_unparseable') END AS error, "
            f"CASE WHEN {got} THEN http_status END AS http_status, "
            f"CASE WHEN {got} AND http_status < 400 THEN {bz} END AS bozo, "
            f"CASE WHEN {got} AND http_status < 400 THEN {ent} END AS entries, "
            f"CASE WHEN {got} THEN lower({D.strip_ws(ct_base)}) END AS content_type "
            f"FROM ({v_fetch()}) f")


@oracle("fetch_status")
def o_fetch_status():
    return f"SELECT url, run_id, attempt, status, error, http_status, bozo, entries, content_type FROM ({fetch_status_sql()}) s"


def retry_sql() -> str:
    fs = fetch_status_sql()
    e = "coalesce(a.error, '')"
    trans = f"(a.status = 'down' AND ({e} = 'timeout' OR starts_with({e}, 'connection:') OR starts_with({e}, 'request:')))"
    use2 = f"coalesce({trans} AND b.url IS NOT NULL AND (b.status <> 'down' OR b.http_status IS NOT NULL), false)"
    cols = ["status", "error", "http_status"]
    pick = ", ".join(f"CASE WHEN {use2} THEN b.{c} ELSE a.{c} END AS {c}" for c in cols)
    return (f"WITH s AS ({fs}) SELECT a.url, a.run_id, {pick}, {use2} AS retried FROM (SELECT * FROM s WHERE attempt = 1) a "
            f"LEFT JOIN (SELECT * FROM s WHERE attempt = 2) b ON a.url = b.url AND a.run_id = b.run_id")


@oracle("retry_resolution")
def o_retry_resolution():
    return retry_sql()


@oracle("check_totals")
def o_check_totals():
    return (f"SELECT count(*) AS total, count(*) FILTER (WHERE status = 'active') AS active, "
            f"count(*) FILTER (WHERE status NOT IN ('active', 'rate_limited')) AS down, "
            f"count(*) FILTER (WHERE status = 'rate_limited') AS rate_limited FROM ({retry_sql()}) r")


def v_checks() -> str:
    return ("SELECT event_id, 'https://feeds.example.org/u/' || CAST(user_id AS VARCHAR) AS url, "
            "date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS run_idx, ts AS checked_at, "
            "CASE WHEN event_type = 'error' THEN 'down' WHEN event_type = 'signup' THEN 'rate_limited' ELSE 'active' END AS status "
            "FROM events")


ISO = "'%Y-%m-%dT%H:%M:%S.%f'"


def history_sql() -> str:
    o = "ORDER BY run_idx, checked_at, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    return (f"WITH c AS ({v_checks()}), "
            f"b AS (SELECT *, CASE WHEN lag(run_idx) OVER (PARTITION BY url ORDER BY run_idx, checked_at, event_id) IS NULL "
            f"OR run_idx - lag(run_idx) OVER (PARTITION BY url ORDER BY run_idx, checked_at, event_id) > 1 THEN 1 ELSE 0 END AS brk FROM c), "
            f"s AS (SELECT *, sum(brk) OVER (PARTITION BY url {o}) AS seg FROM b), "
            f"i AS (SELECT *, sum(CASE WHEN status = 'active' THEN 1 ELSE 0 END) OVER (PARTITION BY url, seg {o}) AS island FROM s) "
            f"SELECT event_id, url, run_idx, checked_at, status, "
            f"CAST(CASE WHEN status = 'active' THEN 0 ELSE sum(CASE WHEN status = 'down' THEN 1 ELSE 0 END) OVER (PARTITION BY url, seg, island {o}) END AS INTEGER) AS consecutive_failures, "
            f"CASE WHEN status = 'active' THEN NULL ELSE min(CASE WHEN status = 'down' THEN checked_at END) OVER (PARTITION BY url, seg, island {o}) END AS down_since, "
            f"max(CASE WHEN status = 'active' THEN checked_at END) OVER (PARTITION BY url, seg {o}) AS last_seen_active FROM i")


@oracle("health_history")
def o_health_history():
    return (f"SELECT event_id, status, consecutive_failures, strftime(down_since, {ISO}) AS down_since, "
            f"strftime(last_seen_active, {ISO}) AS last_seen_active FROM ({history_sql()}) h")


@oracle("health_merge")
def o_health_merge():
    now = "TIMESTAMP '2024-02-01 00:00:00'"
    key = "struct_pack(r := run_idx, t := checked_at, e := event_id)"
    return (f"WITH log AS ({v_checks()}), "
            f"latest AS (SELECT url, arg_max(status, {key}) AS status, arg_max(event_id, {key}) AS last_event FROM log GROUP BY url), "
            f"prev AS (SELECT l.url, CAST(count(*) FILTER (WHERE l.status = 'down') AS INTEGER) AS cf, "
            f"min(l.checked_at) FILTER (WHERE l.status = 'down') AS ds, max(l.checked_at) FILTER (WHERE l.status = 'active') AS lsa "
            f"FROM log l JOIN latest t ON l.url = t.url WHERE l.event_id <> t.last_event GROUP BY l.url) "
            f"SELECT t.url, t.status, CAST(CASE WHEN t.status = 'active' THEN 0 WHEN t.status = 'rate_limited' THEN coalesce(p.cf, 0) "
            f"ELSE coalesce(p.cf, 0) + 1 END AS INTEGER) AS consecutive_failures, "
            f"strftime(CASE WHEN t.status = 'active' THEN NULL WHEN t.status = 'rate_limited' THEN p.ds ELSE coalesce(p.ds, {now}) END, {ISO}) AS down_since, "
            f"strftime(CASE WHEN t.status = 'active' THEN {now} ELSE p.lsa END, {ISO}) AS last_seen_active "
            f"FROM latest t LEFT JOIN prev p ON t.url = p.url")


# --- discovery links -----------------------------------------------------------------------

def blocked_cond(host: str) -> str:
    doms = "[" + ", ".join(q(d) for d in BLOCKED_DOMAINS) + "]"
    return f"({host} = '' OR len(list_filter({doms}, lambda d: {host} = d OR ends_with({host}, '.' || d))) > 0)"


@oracle("blocked_hosts")
def o_blocked_hosts():
    ch = D.Chain("SELECT url FROM pages")
    D.url_host(ch, "url", "host")
    return f"SELECT host, {blocked_cond('host')} AS blocked FROM ({ch.select('DISTINCT host')}) h"


def v_pages_with_feeds() -> str:
    lang = f"regexp_extract(url, {q(SEGMENT_RE)}, 1)"
    pid = "CAST(page_id AS VARCHAR)"
    link = (f"CASE WHEN {lang} = 'en' THEN '<link rel=\"alternate\" type=\"application/rss+xml\" href=\"/feed/' || {pid} || '.xml\">' "
            f"WHEN {lang} = 'fr' THEN '<link rel=''alternate'' type=''application/atom+xml'' href=''/atom/' || {pid} || '''>' "
            f"WHEN {lang} = 'de' THEN '<link rel=\"alternate\" href=\"/index.xml?p=' || {pid} || '&amp;x=1\">' "
            f"ELSE '<link rel=\"alternate\" type=\"text/html\" href=\"/about/' || {pid} || '\">' END")
    anchor = f"'<a href=\"/blog/rss?page=' || {pid} || '\">feed</a>'"
    return (f"SELECT page_id, url, replace(replace(html, '</head>', {link} || '</head>'), '</footer>', {anchor} || '</footer>') AS html "
            f"FROM pages")


def crawl_sites_sql(pages: str = "pages", max_sites: int | None = None) -> str:
    ch = D.Chain(outbound_sql(pages))
    D.url_origin(ch, "link", "site_url")
    ch.where("site_url <> ''")
    sites = D.Chain(ch.select("DISTINCT site_url"))
    D.url_host(sites, "site_url", "host")
    ign = ", ".join(q(h) for h in IGNORED_HOSTS)
    sites.where(f"host <> '' AND contains(host, '.') AND host NOT IN ({ign}) AND NOT {blocked_cond('host')}")
    g = sites.select("host, min(site_url) AS site_url") + " GROUP BY host"
    return f"SELECT site_url, host FROM ({g}) g" + (f" ORDER BY site_url LIMIT {max_sites}" if max_sites else "")


@oracle("crawl_sites")
def o_crawl_sites():
    return crawl_sites_sql()


LINK_TAG_RE = rf"(?is)<link\b{ATTRS}>"
ATTR_RE = rf"""(?is)^<link\b{ATTRS}?\s{{name}}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""


def advertised_sql(pages: str | None = None) -> str:
    body = f"regexp_replace(html, {q(STRIP_RE)}, ' ', 'g')"
    base = D.Chain(f"SELECT page_id, url, {body} AS b FROM {pages or f'({v_pages_with_feeds()}) p'}")
    D.url_origin(base, "url", "origin")
    based = base.select("page_id, origin, b")

    def attr(name):
        return unescape(unquote_attr(f"regexp_extract(t, {q(ATTR_RE.format(name=name))}, 1)"))

    tags = f"SELECT page_id, origin, unnest(regexp_extract_all(b, {q(LINK_TAG_RE)}, 0)) AS t FROM ({based}) x"
    links = (f"SELECT page_id, origin, {D.strip_ws(attr('rel'))} AS rel, lower({attr('type')}) AS type, "
             f"{D.strip_ws(attr('href'))} AS href FROM ({tags}) y")
    links = (f"SELECT page_id, origin, href FROM ({links}) z WHERE rel = 'alternate' AND href <> '' AND "
             f"(contains(type, 'rss') OR contains(type, 'atom') OR contains(type, 'xml') OR {D.has_feed_hint('href')})")
    anchors = (f"SELECT page_id, origin, href FROM ({hrefs_sql(f'({based}) a0', 'page_id, origin', 'b', True)}) a "
               f"WHERE href <> '' AND {D.has_feed_hint('href')}")
    ch = D.Chain(f"{links} UNION ALL {anchors}")
    D.resolve_url(ch, "origin", "href", "_j")
    D.normalize_url_crawl(ch, "_j", "feed_url")
    ch.where("feed_url <> ''")
    return ch.select("DISTINCT page_id, feed_url")


@oracle("advertised_feeds")
def o_advertised_feeds():
    return advertised_sql()


@oracle("feed_hint_links")
def o_feed_hint_links():
    return f"SELECT page_id, pos, href, {D.has_feed_hint('href')} AS is_hint FROM ({hrefs_sql(f'({v_pages_with_feeds()}) p')}) h"


def probes_sql() -> str:
    sites = crawl_sites_sql(f"({v_pages_with_feeds()}) pw")
    ps = D.Chain("SELECT page_id, url FROM pages")
    D.url_origin(ps, "url", "site_url")
    adv = (f"SELECT ps.site_url, a.feed_url, true AS adv FROM ({advertised_sql()}) a JOIN ({ps.select('page_id, site_url')}) ps "
           f"ON a.page_id = ps.page_id WHERE ps.site_url IN (SELECT site_url FROM ({sites}) s2)")
    return probes_of(sites, adv)


def probes_of(sites: str, adv: str) -> str:
    """Probes of ``sites (site_url)`` and their advertised feeds ``adv (site_url, feed_url, adv)``."""
    paths = "[" + ", ".join(q(p) for p in COMMON_FEED_PATHS) + "]"
    common = D.Chain(f"SELECT site_url, unnest({paths}) AS p FROM ({sites}) s")
    D.resolve_url(common, "site_url", "p", "_j")
    D.normalize_url_crawl(common, "_j", "feed_url")
    common_sql = common.select("site_url, feed_url, false AS adv")
    g = (f"SELECT site_url, feed_url, CASE WHEN bool_or(adv) THEN 'rel=alternate' ELSE 'common_path' END AS discovered_via "
         f"FROM ({common_sql} UNION ALL {adv}) u GROUP BY site_url, feed_url")
    ch = D.Chain(g)
    D.normalize_url_crawl(ch, "feed_url", "_n0")
    ch.add(_n="lower(_n0)")
    D.url_host(ch, "_n", "_host")
    bf = ", ".join(q(f.strip().lower()) for f in BLOCKED_FEEDS)
    ch.where(f"NOT {blocked_cond('_host')} AND _n NOT IN ({bf}) AND lower(feed_url) NOT IN ({bf})")
    return ch.select("site_url, feed_url, discovered_via")


@oracle("probe_urls")
def o_probe_urls():
    return probes_sql()


@oracle("feed_path_rank")
def o_feed_path_rank():
    ch = D.Chain(probes_sql())
    D.feed_path_rank(ch, "feed_url", "rank")
    return ch.select("site_url, feed_url, rank")


# --- entries, scoring, candidates ------------------------------------------------------------

from ..functions.text import WS as _WS  # noqa: E402
from ..lexicon import BUCKET_LABELS, FEED_PATH_PREFERENCE  # noqa: E402
from ..operators.scoring import word_boundaries  # noqa: E402
from . import views as _V  # noqa: E402


def feed_sources_sql() -> str:
    ch = D.Chain("SELECT page_id, url FROM pages")
    D.url_origin(ch, "url", "site_url")
    D.url_host(ch, "url", "host")
    lang = f"regexp_extract(url, {q(SEGMENT_RE)}, 1)"
    path = "CASE " + " ".join(f"WHEN {lang} = {q(lg)} THEN {q(p)}" for lg, p in _V.FEED_PATH_BY_LANG) + " ELSE '/blog/feed' END"
    return ch.select(f"page_id AS feed, site_url, host, site_url || {path} || '?feed=' || CAST(page_id AS VARCHAR) AS feed_url, "
                     f"'Feed of ' || host AS channel_title")


def conv_entries_sql() -> str:
    return (f"SELECT s.feed_url, s.site_url, s.channel_title, c.turn AS pos, c.role AS title, c.text AS summary "
            f"FROM conversations c JOIN ({feed_sources_sql()}) s ON c.conv_id = s.feed")


@oracle("feed_entries")
def o_feed_entries():
    return f"SELECT feed_url, pos, title, summary FROM ({conv_entries_sql()}) e"


@oracle("valid_feeds")
def o_valid_feeds():
    return f"SELECT DISTINCT feed_url, CAST(floor(pos / 64) AS BIGINT) AS chunk FROM ({conv_entries_sql()}) e"


@oracle("feed_type")
def o_feed_type():
    return f"SELECT DISTINCT feed_url, CAST(floor(pos / 64) AS BIGINT) AS chunk, 'rss20' AS version, 'rss' AS feed_type FROM ({conv_entries_sql()}) e"


def first_sql(src: str, feed: str, pos: str, k: int = 15) -> str:
    return (f"SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY {feed} ORDER BY {pos}) AS INTEGER) AS rank "
            f"FROM ({src}) s) r WHERE rank <= {k}")


V_ENTRIES = "SELECT conv_id AS feed, turn AS pos, role AS title, text AS summary FROM conversations"
V_BLOBS = "SELECT source AS feed, doc_id AS pos, '' AS title, text AS summary FROM documents"


@oracle("first_entries")
def o_first_entries():
    return f"SELECT feed, pos, rank FROM ({first_sql(V_ENTRIES, 'feed', 'pos')}) f"


@oracle("entry_sample")
def o_entry_sample():
    return (f"SELECT feed, rank, {D.strip_ws('title')} AS title, 'https://chat.example.org/' || CAST(feed AS VARCHAR) AS link, "
            f"'2024-01-01' AS published FROM ({first_sql(V_ENTRIES, 'feed', 'pos')}) f WHERE rank <= 5")


@oracle("feed_recency")
def o_feed_recency():
    ev = ("SELECT user_id AS feed, event_id AS pos, ts AS published_ts, "
          "CASE WHEN event_type = 'signup' THEN ts + INTERVAL 40 DAY END AS updated_ts FROM events")
    g = (f"SELECT feed, max(greatest(date_trunc('second', published_ts), coalesce(date_trunc('second', updated_ts), date_trunc('second', published_ts)))) AS latest "
         f"FROM ({ev}) f GROUP BY feed")
    age = "CAST(floor((epoch(TIMESTAMP '2024-02-01 00:00:00') - epoch(latest)) / 86400) AS BIGINT)"
    return (f"SELECT feed, strftime(latest, '%Y-%m-%dT%H:%M:%S') AS latest, {age} AS age_days, "
            f"CASE WHEN latest IS NULL THEN 0 WHEN {age} <= 30 THEN 3 WHEN {age} <= 90 THEN 1 WHEN {age} > 365 THEN -4 ELSE 0 END AS recency_bonus FROM ({g}) g")


def score_sql(src: str, feed: str = "feed") -> str:
    lex = _V.test_lexicon()
    kws = dict(lex.weights())
    rules = [(cat, "(?i)" + "|".join(f"(?:{word_boundaries(p)})" for p in pats)) for cat, pats in lex.category_rules]
    text = f"lower(coalesce({D.strip_ws('title')}, '') || ' ' || coalesce({D.strip_ws('summary')}, ''))"
    flags = ([f"bool_or(contains(t, {q(k)})) AS k{i}" for i, k in enumerate(kws)]
             + [f"bool_or(contains(t, {q(k)})) AS n{i}" for i, k in enumerate(lex.negative)]
             + [f"bool_or(regexp_matches(t, {q(rx)})) AS c{i}" for i, (_, rx) in enumerate(rules)])
    g = f"SELECT {feed}, count(*) AS n_entries, {', '.join(flags)} FROM (SELECT {feed}, {text} AS t FROM ({src}) s) e GROUP BY {feed}"
    uniq = "list_sort(list_filter([" + ", ".join(f"CASE WHEN k{i} THEN {q(k)} END" for i, k in enumerate(kws)) + "], lambda x: x IS NOT NULL))"
    base = " + ".join(f"CASE WHEN k{i} THEN {w} ELSE 0 END" for i, w in enumerate(kws.values()))
    neg = " + ".join(f"CAST(n{i} AS INTEGER)" for i in range(len(lex.negative))) or "0"
    cat = "CASE " + " ".join(f"WHEN c{i} THEN {q(c)}" for i, (c, _) in enumerate(rules)) + f" ELSE {q(lex.default_category)} END"
    u = f"SELECT {feed}, n_entries, {uniq} AS uniq, {base} AS base, {neg} AS neg, {cat} AS cat FROM ({g}) g"
    n = "len(uniq)"
    score = (f"CAST(base + CASE WHEN {n} >= 10 THEN 5 WHEN {n} >= 6 THEN 2 ELSE 0 END + CASE WHEN n_entries >= 10 THEN 2 ELSE 0 END "
             f"+ CASE WHEN neg >= 2 THEN -2 * neg ELSE 0 END AS INTEGER)")
    return f"SELECT {feed}, n_entries, {score} AS score, uniq AS matched_keywords, cat AS suggested_category FROM ({u}) u"


@oracle("relevance_score")
def o_relevance_score():
    return f"SELECT feed, n_entries, score FROM ({score_sql(V_BLOBS)}) s"


@oracle("matched_keywords")
def o_matched_keywords():
    return f"SELECT feed, array_to_string(matched_keywords, ',') AS matched FROM ({score_sql(V_BLOBS)}) s"


@oracle("suggest_category")
def o_suggest_category():
    return f"SELECT feed, suggested_category FROM ({score_sql(V_BLOBS)}) s"


def raw_candidates_sql() -> str:
    ent = f"SELECT feed_url AS feed, pos, title, summary FROM ({conv_entries_sql()}) e"
    sc = score_sql(ent)
    meta = f"SELECT DISTINCT feed_url, site_url, channel_title FROM ({conv_entries_sql()}) e"
    ch = D.Chain(f"SELECT m.feed_url, m.site_url, {D.strip_ws('m.channel_title')} AS title, '' AS description, '' AS language, "
                 f"'rss' AS feed_type, s.score, s.matched_keywords, s.suggested_category, 'common_path' AS discovered_via "
                 f"FROM ({meta}) m JOIN ({sc}) s ON m.feed_url = s.feed")
    D.url_hash(ch, "feed_url", "url_hash")
    D.feed_path_rank(ch, "feed_url", "path_rank")
    return ch.select("feed_url, site_url, title, description, language, feed_type, score, matched_keywords, "
                     "suggested_category, discovered_via, url_hash, path_rank")


def site_dedup_sql() -> str:
    norm = f"regexp_replace(lower({D.strip_ws('title')}), {q(_WS + '+')}, ' ', 'g')"
    return (f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY site_url, feed_type, {norm} "
            f"ORDER BY path_rank, feed_url) AS rn FROM ({raw_candidates_sql()}) r) x WHERE rn = 1")


def best_sql(src: str) -> str:
    return (f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY url_hash ORDER BY score DESC, path_rank, feed_url) AS rn "
            f"FROM ({src}) r) x WHERE rn = 1")


def known_sql(src: str) -> str:
    ch = D.Chain(src)
    D.url_key_discovery(ch, "url", "known")
    ch.where("known <> ''")
    return ch.select("DISTINCT known")


def final_sql() -> str:
    best = best_sql(f"SELECT * FROM ({site_dedup_sql()}) s WHERE score >= 6")
    ch = D.Chain(best)
    D.url_key_discovery(ch, "feed_url", "_k")
    known = known_sql(f"SELECT url FROM ({v_catalog()}) c")
    ch.where(f"_k NOT IN ({known})")
    return ch.select("* EXCLUDE (_k)")


def best_of_sites_sql(raw: str) -> str:
    """E5, C6 and E4 on raw candidates."""
    norm = f"regexp_replace(lower({D.strip_ws('title')}), {q(_WS + '+')}, ' ', 'g')"
    site = (f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY site_url, feed_type, {norm} "
            f"ORDER BY path_rank, feed_url) AS rn FROM ({raw}) r) x WHERE rn = 1")
    return best_sql(f"SELECT * FROM ({site}) s WHERE score >= 6")


def bucket_sql(src: str) -> str:
    lex = _V.test_lexicon()
    cat = f"lower({D.strip_ws('suggested_category')})"
    blob = (f"lower(coalesce(title, '') || ' ' || coalesce(description, '') || ' ' || coalesce(site_url, '') || ' ' || "
            f"array_to_string(coalesce(matched_keywords, []), ' ') || ' ' || {cat})")
    case = "CASE "
    for kind, bucket, words in lex.bucket_rules:
        tgt = "_blob" if kind == "blob" else "_cat"
        case += f"WHEN {' OR '.join(f'contains({tgt}, {q(w)})' for w in words)} THEN {q(bucket)} "
    case += f"ELSE {q(lex.default_bucket)} END"
    labels = "MAP {" + ", ".join(f"{q(k)}: {q(v)}" for k, v in BUCKET_LABELS) + "}"
    inner = f"SELECT *, {blob} AS _blob, {cat} AS _cat FROM ({src}) s"
    b = f"SELECT * EXCLUDE (_blob, _cat), {case} AS bucket FROM ({inner}) i"
    return f"SELECT *, coalesce({labels}[bucket], suggested_category) AS bucket_label FROM ({b}) b"


@oracle("candidates")
def o_candidates():
    return (f"SELECT feed_url, site_url, title, feed_type, score, array_to_string(matched_keywords, ',') AS matched, "
            f"suggested_category, url_hash, bucket, bucket_label FROM ({bucket_sql(final_sql())}) c")


@oracle("site_dedup")
def o_site_dedup():
    return f"SELECT feed_url, site_url, path_rank, score FROM ({site_dedup_sql()}) s"


@oracle("candidate_best")
def o_candidate_best():
    return f"SELECT url_hash, feed_url, score, path_rank FROM ({best_sql(raw_candidates_sql())}) b"


@oracle("known_urls")
def o_known_urls():
    return known_sql(f"SELECT url FROM ({v_catalog_dups()}) c")


@oracle("unknown_candidates")
def o_unknown_candidates():
    ch = D.Chain(best_sql(raw_candidates_sql()))
    D.url_key_discovery(ch, "feed_url", "_k")
    known = known_sql(f"SELECT feed_url AS url FROM ({feed_sources_sql()}) s WHERE contains(feed_url, '/rss.xml?')")
    ch.where(f"_k NOT IN ({known})")
    return ch.select("url_hash, feed_url")


def seen_sql() -> str:
    best = best_sql(f"SELECT * FROM ({raw_candidates_sql()}) r WHERE contains(feed_url, '/feed?')")
    return (f"SELECT url_hash, feed_url, site_url, 'old title' AS title, CAST(1700000000 AS BIGINT) AS last_seen_ts, "
            f"score - 1 AS score, feed_type, 'kept' AS note FROM ({best}) b")


@oracle("only_new")
def o_only_new():
    return f"SELECT url_hash, feed_url FROM ({final_sql()}) f WHERE url_hash NOT IN (SELECT url_hash FROM ({seen_sql()}) s)"


@oracle("seen_upsert")
def o_seen_upsert():
    f = final_sql()
    return (f"SELECT coalesce(n.url_hash, o.url_hash) AS url_hash, CASE WHEN n.url_hash IS NOT NULL THEN n.feed_url ELSE o.feed_url END AS feed_url, "
            f"CASE WHEN n.url_hash IS NOT NULL THEN n.title ELSE o.title END AS title, "
            f"CASE WHEN n.url_hash IS NOT NULL THEN n.score ELSE o.score END AS score, "
            f"CASE WHEN n.url_hash IS NOT NULL THEN CAST(1706745600 AS BIGINT) ELSE o.last_seen_ts END AS last_seen_ts, o.note "
            f"FROM ({seen_sql()}) o FULL OUTER JOIN ({f}) n ON o.url_hash = n.url_hash")


def items_sql(src: str) -> str:
    ch = D.Chain(src)
    p = D.tmp()
    D.split(ch, "site_url", p, params=False)
    title = f"coalesce(nullif({D.strip_ws('title')}, ''), {p}_n)"
    cat = D.strip_ws(f"coalesce(nullif(suggested_category, ''), {q('Security (General)')})")
    ch.add(_title=title, _cat=cat)
    return ch.select(f"*, feed_url AS url, _cat AS category_i, _title AS title_i, feed_type AS type_i, "
                     f"{D.item_description('description', '_cat', '_title')} AS description_i")


@oracle("candidate_items")
def o_candidate_items():
    return f"SELECT url, category_i AS category, title_i AS title, type_i AS type, description_i AS description FROM ({items_sql(final_sql())}) i"


@oracle("candidate_bucket")
def o_candidate_bucket():
    return f"SELECT url_hash, bucket, bucket_label FROM ({bucket_sql(final_sql())}) b"


def review_sql() -> str:
    return (f"SELECT url, bucket_label AS category, title_i AS title, type_i AS type, description_i AS description, bucket, "
            f"score, url_hash FROM ({items_sql(bucket_sql(final_sql()))}) i")


@oracle("review_items")
def o_review_items():
    return f"SELECT url, category, title, type, description, score, url_hash FROM ({review_sql()}) r"


def merged_sql() -> str:
    ex = f"SELECT 'alpha-second' AS bucket, feed_url AS url FROM ({feed_sources_sql()}) s WHERE contains(feed_url, '/atom.xml?')"
    return (f"SELECT r.* FROM ({review_sql()}) r WHERE {D.strip_ws('r.url')} <> '' AND NOT EXISTS "
            f"(SELECT 1 FROM ({ex}) e WHERE e.bucket = r.bucket AND {D.strip_ws('e.url')} = {D.strip_ws('r.url')})")


@oracle("bucket_merge")
def o_bucket_merge():
    return f"SELECT url, bucket FROM ({merged_sql()}) m"


@oracle("top_candidates")
def o_top_candidates():
    return f"SELECT url, bucket, score FROM ({merged_sql()}) m"


@oracle("review_record_names")
def o_review_record_names():
    ch = D.Chain(final_sql())
    D.url_host(ch, "site_url", "_hs")
    D.url_host(ch, "feed_url", "_hf")
    base = "coalesce(nullif(title, ''), nullif(_hs, ''), _hf)"
    return ch.select(f"url_hash, {D.slug_short(base)} || '__' || substr(url_hash, 1, 10) AS record_name")


# --- renders and line lists -------------------------------------------------------------------

@oracle("catalog_json_rows")
def o_catalog_json_rows():
    return (f"SELECT url, lower(category) AS k_category, lower(title) AS k_title, lower(url) AS k_url, "
            f"CAST(to_json(struct_pack(url := url, title := title, description := description, type := type, "
            f"category := category)) AS VARCHAR) AS json FROM ({o_catalog_dedup()}) c")


@oracle("opml_blocks")
def o_opml_blocks():
    cat = f"CASE WHEN {D.clean_text('category')} = '' THEN 'Uncategorized' ELSE {D.clean_text('category')} END"
    title = D.clean_text("coalesce(nullif(title, ''), nullif(url, ''), '')")
    ftype = D.clean_text("coalesce(nullif(type, ''), 'rss')")
    desc = D.clean_text("description")

    def attr(name, v):
        return f"CASE WHEN {v} <> '' THEN '{name}=\"' || {D.xml_escape(v)} || '\"' END"

    line = (f"'      <outline ' || concat_ws(' ', {attr('text', '_t')}, {attr('title', '_t')}, {attr('type', '_ty')}, "
            f"{attr('xmlUrl', '_u')}, {attr('htmlUrl', '_u')}, {attr('description', '_d')}) || ' />'")
    base = (f"SELECT {cat} AS category, {title} AS _t, {ftype} AS _ty, coalesce(url, '') AS _u, {desc} AS _d, ord, lower(coalesce(title, '')) AS k_title "
            f"FROM ({o_export_dedup()}) e")
    feeds = f"SELECT category, 1 AS part, k_title, ord, {line} AS line FROM ({base}) b"
    esc = D.xml_escape("category")
    return (f"WITH f AS ({feeds}) SELECT * FROM f UNION ALL "
            f"SELECT DISTINCT category, 0, '', CAST(NULL AS BIGINT), '    <outline text=\"' || {esc} || '\" title=\"' || {esc} || '\">' FROM f "
            f"UNION ALL SELECT DISTINCT category, 2, '', CAST(NULL AS BIGINT), '    </outline>' FROM f")


@oracle("markdown_rows")
def o_markdown_rows():
    url = D.md_escape("url")
    row = (f"'| ' || {D.md_escape('title')} || ' | ' || {D.md_escape('description')} || ' | ' || upper({D.md_escape('type')}) "
           f"|| ' | ' || CASE WHEN {url} <> '' THEN '<' || {url} || '>' ELSE '' END || ' |'")
    rows = (f"SELECT coalesce(category, 'Uncategorized') AS category, 'item' AS kind, lower(coalesce(title, '')) AS k_title, "
            f"coalesce(url, '') AS k_url, {row} AS line FROM ({v_catalog_dups()}) v")
    return (f"WITH r AS ({rows}) SELECT * FROM r UNION ALL SELECT category, 'toc', '', '', "
            f"'- [' || category || '](#' || {D.slug('category')} || ') (' || CAST(count(*) AS VARCHAR) || ')' FROM r GROUP BY category")


@oracle("category_counts_markdown")
def o_category_counts_markdown():
    return (f"SELECT coalesce(CASE WHEN variant = 'flipped' THEN NULL ELSE category END, 'Uncategorized') AS category, "
            f"count(*) AS n FROM ({v_catalog_dups()}) v GROUP BY 1")


@oracle("category_files")
def o_category_files():
    s = D.slug("category", "uncategorized", True)
    return (f"SELECT category, CASE WHEN n > 1 THEN slug || '-' || CAST(n AS VARCHAR) ELSE slug END || '.yaml' AS file FROM "
            f"(SELECT category, slug, row_number() OVER (PARTITION BY slug ORDER BY lower(category), category) AS n FROM "
            f"(SELECT DISTINCT title AS category, {s.replace('category', 'title')} AS slug FROM ({v_catalog()}) v) d) x")


@oracle("seed_urls")
def o_seed_urls():
    ch = D.Chain(f"SELECT page_id AS ord, {D.strip_ws('url')} AS raw FROM pages")
    ch.where("raw <> '' AND NOT starts_with(raw, '#')")
    D.normalize_url_crawl(ch, "raw", "url")
    ch.where("url <> ''")
    return ch.select("url, min(ord) AS ord") + " GROUP BY url"


# --- streaming ------------------------------------------------------------------------------------

@oracle("stream_health")
def o_stream_health():
    return (f"SELECT url, status, consecutive_failures, strftime(down_since, {ISO}) AS down_since, "
            f"strftime(last_seen_active, {ISO}) AS last_seen_active FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY url ORDER BY run_idx DESC, checked_at DESC, event_id DESC) AS rn FROM ({history_sql()}) h) x WHERE rn = 1")


@oracle("stream_new")
def o_stream_new():
    ch = D.Chain("SELECT event_id, ts, 'https://feeds.example.org/u/' || CAST(user_id AS VARCHAR) || '?e=' || event_type AS feed_url FROM events")
    D.url_hash(ch, "feed_url", "url_hash")
    key = "struct_pack(t := ts, e := event_id)"
    return ch.select(f"url_hash, arg_min(feed_url, {key}) AS feed_url, strftime(min(ts), {ISO}) AS first_seen, "
                     f"arg_min(event_id, {key}) AS first_event") + " GROUP BY url_hash"


@oracle("blocked_feeds")
def o_blocked_feeds():
    sites = crawl_sites_sql("pages").replace(f" AND NOT {blocked_cond('host')}", "")
    paths = "[" + ", ".join(q(p) for p in COMMON_FEED_PATHS) + "]"
    common = D.Chain(f"SELECT site_url, unnest({paths}) AS p FROM ({sites}) s")
    D.resolve_url(common, "site_url", "p", "_j")
    D.normalize_url_crawl(common, "_j", "feed_url")
    probes = D.Chain(common.select("DISTINCT site_url, feed_url"))
    D.normalize_url_crawl(probes, "feed_url", "_n")
    bf = "[" + ", ".join(q(f.lower()) for f in BLOCKED_FEEDS) + "]"
    return probes.select(f"site_url, feed_url, list_contains({bf}, lower(_n)) OR list_contains({bf}, lower(feed_url)) AS blocked")


@oracle("review_order")
def o_review_order():
    top = f"SELECT * FROM ({merged_sql()}) m"
    return (f"SELECT bucket, url, CAST(row_number() OVER (PARTITION BY bucket ORDER BY lower(category), lower(title), "
            f"lower(type), url) AS INTEGER) AS rank FROM ({top}) t")


@oracle("stream_health_state")
def o_stream_health_state():
    return o_stream_health()


from . import artifacts_oracle, chain_oracle  # noqa: E402, F401
