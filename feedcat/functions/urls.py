"""URL normalisers and keys (B2-B11, B19, B20) as staged native projections.

Five different keys coexist on purpose (catalog build, export, validation,
discovery, crawl); they are never unified.  A URL is split once with one
RFC-3986 style regex that reads the same in Java regex and RE2; the parts
are materialised as columns and every later stage only references those
columns.  That keeps expression trees linear (nested ``when`` ladders over
raw regex calls grow exponentially) and lets Catalyst keep each stage in
whole-stage codegen.

Every public function here is ``df -> df``: it adds one output column and
drops its scratch columns.
"""
from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..lexicon import (ASSET_EXTENSIONS, FEED_PATH_PREFERENCE,
                       TRACKING_QS_KEYS, TRACKING_QS_PREFIXES)
from .text import strip_ws

# scheme must start with a letter and use letters, digits, + - . only
URL_RE = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"

USES_NETLOC = ["", "ftp", "http", "gopher", "nntp", "telnet", "imap", "wais", "file", "mms",
               "https", "shttp", "snews", "prospero", "rtsp", "rtsps", "rtspu", "rsync", "svn",
               "svn+ssh", "sftp", "nfs", "git", "git+ssh", "ws", "wss", "itms-services"]
USES_PARAMS = ["", "ftp", "hdl", "prospero", "http", "imap", "https", "shttp", "rtsp", "rtsps",
               "rtspu", "sip", "sips", "mms", "sftp", "tel"]
USES_RELATIVE = ["", "ftp", "http", "gopher", "nntp", "imap", "wais", "file", "https", "shttp",
                 "mms", "prospero", "rtsp", "rtsps", "rtspu", "sftp", "svn", "svn+ssh", "ws", "wss"]

FEED_HINT_RE = r"(?i)(rss|atom|feed|\.xml)($|[^\p{L}\p{N}_])"

_ids = itertools.count()


def _tmp() -> str:
    return f"__u{next(_ids)}"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _drop_tmp(df: DataFrame, prefix: str, out: str | None = None) -> DataFrame:
    """Drop scratch columns; with ``out``, also materialise that column.

    The output leaves through a one-row ``inline(array(struct(out)))``
    generator.  Predicates on a generator output are not pushed below it, so
    a later ``where``/join on the key sees one computed column instead of
    Catalyst inlining every staged projection into the filter (which
    duplicates the work and grows the expression tree exponentially).
    """
    df = df.drop(*[c for c in df.columns if c.startswith(prefix + "_")])
    if out is None:
        return df
    keep = [F.col(c) for c in df.columns if c != out]
    return df.select(*keep, F.inline(F.array(F.struct(F.coalesce(F.col(out), F.lit("")).alias(out)))))


# ---------------------------------------------------------------------------
# split / unsplit
# ---------------------------------------------------------------------------

def split_cols(df: DataFrame, src, p: str, split_params: bool = True) -> DataFrame:
    """Add ``{p}_s`` (lower scheme), ``_n`` netloc, ``_path``, ``_params``, ``_q``, ``_f``.

    Mirrors urlsplit: tab/CR/LF removed, leading C0/space stripped, fragment
    then query split off; with ``split_params`` the ';params' of the last
    path segment are split as urlparse does for the schemes that use them.
    """
    df = df.withColumn(f"{p}_u", F.regexp_replace(
        F.regexp_replace(F.coalesce(_c(src), F.lit("")), r"[\t\r\n]", ""), r"^[\x00-\x20]+", ""))
    u = F.col(f"{p}_u")
    df = df.withColumns({
        f"{p}_s": F.lower(F.regexp_extract(u, URL_RE, 1)),
        f"{p}_n": F.regexp_extract(u, URL_RE, 2),
        f"{p}_p0": F.regexp_extract(u, URL_RE, 3),
        f"{p}_q": F.regexp_extract(u, URL_RE, 4),
        f"{p}_f": F.regexp_extract(u, URL_RE, 5),
    })
    p0, s = F.col(f"{p}_p0"), F.col(f"{p}_s")
    if split_params:
        has = s.isin(*USES_PARAMS) & p0.rlike(";[^/]*$")
        df = df.withColumns({
            f"{p}_params": F.when(has, F.regexp_extract(p0, ";([^/]*)$", 1)).otherwise(F.lit("")),
            f"{p}_path": F.when(has, F.regexp_replace(p0, ";[^/]*$", "")).otherwise(p0),
        })
    else:
        df = df.withColumns({f"{p}_params": F.lit(""), f"{p}_path": p0})
    return df.drop(f"{p}_u", f"{p}_p0")


def unsplit(scheme, netloc, path, query, fragment) -> Column:
    """urlunsplit over materialised columns (pass params already joined to path)."""
    scheme, netloc, path, query, fragment = map(_c, (scheme, netloc, path, query, fragment))
    with_net = F.concat(
        F.lit("//"), netloc,
        F.when((path != "") & ~path.startswith("/"), F.lit("/")).otherwise(F.lit("")), path)
    body = (F.when(netloc != "", with_net)
            .when(path.startswith("//"), F.concat(F.lit("//"), path))
            .when((scheme != "") & scheme.isin(*USES_NETLOC) & ((path == "") | path.startswith("/")),
                  F.concat(F.lit("//"), path))
            .otherwise(path))
    return F.concat(
        F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(F.lit("")),
        body,
        F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")),
        F.when(fragment != "", F.concat(F.lit("#"), fragment)).otherwise(F.lit("")))


def join_params(path, params) -> Column:
    path, params = _c(path), _c(params)
    return F.when(params != "", F.concat(path, F.lit(";"), params)).otherwise(path)


def strip_default_port(scheme, netloc) -> Column:
    scheme, n = _c(scheme), F.lower(_c(netloc))
    return (F.when((scheme == "http") & n.endswith(":80"), F.regexp_replace(n, ":80$", ""))
            .when((scheme == "https") & n.endswith(":443"), F.regexp_replace(n, ":443$", ""))
            .otherwise(n))


# ---------------------------------------------------------------------------
# normalisers and keys
# ---------------------------------------------------------------------------

def normalize_url(df: DataFrame, src, out: str, default_scheme: str = "http",
                  drop_fragment: bool = True, force_https: bool = False,
                  strip_trailing_slash: bool = False) -> DataFrame:
    """B2 (B4 with options): the catalog normaliser.

    Lower scheme and host, default scheme, drop ':80' on http and ':443' on
    https, drop ';params', keep the query, optionally force https and strip
    all trailing slashes.  Blank input gives ''.
    """
    p = _tmp()
    df = df.withColumn(f"{p}_in", strip_ws(_c(src)))
    df = split_cols(df, f"{p}_in", p)
    s = F.when(F.col(f"{p}_s") == "", F.lit(default_scheme)).otherwise(F.col(f"{p}_s"))
    if force_https:
        s = F.when(s == "http", F.lit("https")).otherwise(s)
    df = df.withColumn(f"{p}_s2", s)
    path = F.col(f"{p}_path")
    df = df.withColumns({
        f"{p}_n2": strip_default_port(f"{p}_s2", f"{p}_n"),
        f"{p}_path2": F.regexp_replace(path, "(?<!/)/++$", "") if strip_trailing_slash else path,
        f"{p}_f2": F.lit("") if drop_fragment else F.col(f"{p}_f"),
    })
    res = unsplit(f"{p}_s2", f"{p}_n2", f"{p}_path2", f"{p}_q", f"{p}_f2")
    df = df.withColumn(out, F.when(F.col(f"{p}_in") == "", F.lit("")).otherwise(res))
    return _drop_tmp(df, p, out)


def url_key_export(df: DataFrame, src, out: str) -> DataFrame:
    """Export / promotion key (force https, strip all trailing slashes)."""
    return normalize_url(df, src, out, force_https=True, strip_trailing_slash=True)


def normalize_url_crawl(df: DataFrame, src, out: str) -> DataFrame:
    """Discovery normaliser: prefix https:// unless http(s), '' without a host, keeps params."""
    p = _tmp()
    df = df.withColumn(f"{p}_in", strip_ws(_c(src)))
    u = F.col(f"{p}_in")
    df = df.withColumn(f"{p}_pre", F.when(u.rlike("(?i)^https?://"), u)
                       .otherwise(F.concat(F.lit("https://"), u)))
    df = split_cols(df, f"{p}_pre", p)
    df = df.withColumns({
        f"{p}_n2": strip_default_port(f"{p}_s", f"{p}_n"),
        f"{p}_pp": join_params(f"{p}_path", f"{p}_params"),
    })
    res = unsplit(f"{p}_s", f"{p}_n2", f"{p}_pp", f"{p}_q", F.lit(""))
    df = df.withColumn(out, F.when((u == "") | (F.col(f"{p}_n") == ""), F.lit("")).otherwise(res))
    return _drop_tmp(df, p, out)


def _form_decode(col: Column) -> Column:
    """unquote_plus; a value with a malformed escape is kept undecoded."""
    return F.coalesce(F.try_url_decode(col), F.replace(col, F.lit("+"), F.lit(" ")))


def _form_encode(col: Column) -> Column:
    """quote_plus: URLEncoder output with '~' kept and '*' escaped."""
    enc = F.url_encode(col)
    return F.replace(F.replace(enc, F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def url_key_catalog(df: DataFrame, src, out: str) -> DataFrame:
    """Build dedup key host+path[?sorted query], scheme-free.

    One trailing slash goes unless the path is '/'; utm_* and tracking keys
    are dropped case-insensitively; pairs sort by (lower key, value) and are
    form-encoded again.
    """
    p = _tmp()
    df = split_cols(df, src, p)
    path = F.col(f"{p}_path")
    df = df.withColumns({
        f"{p}_n2": F.lower(F.col(f"{p}_n")),
        f"{p}_path2": F.when(path.endswith("/") & (path != "/"),
                             F.regexp_replace(path, "/$", "")).otherwise(path),
        f"{p}_kv": F.transform(
            F.filter(F.split(F.col(f"{p}_q"), "&"), lambda s: s != ""),
            lambda s: F.split(s, "=", 2)),
    })
    df = df.withColumn(f"{p}_pairs", F.transform(F.col(f"{p}_kv"), lambda a: F.struct(
        _form_decode(a[0]).alias("k"),
        F.coalesce(_form_decode(F.try_element_at(a, F.lit(2))), F.lit("")).alias("v"))))

    def keep(kv):
        lk = F.lower(kv["k"])
        cond = ~lk.isin(*TRACKING_QS_KEYS)
        for pfx in TRACKING_QS_PREFIXES:
            cond = cond & ~lk.startswith(pfx)
        return cond

    df = df.withColumn(f"{p}_kept", F.array_sort(F.transform(
        F.filter(F.col(f"{p}_pairs"), keep),
        lambda kv: F.struct(F.lower(kv["k"]).alias("lk"), kv["v"].alias("v"), kv["k"].alias("k")))))
    df = df.withColumn(f"{p}_qs", F.array_join(F.transform(
        F.col(f"{p}_kept"),
        lambda kv: F.concat(_form_encode(kv["k"]), F.lit("="), _form_encode(kv["v"]))), "&"))
    base = F.concat(F.col(f"{p}_n2"), F.col(f"{p}_path2"))
    qs = F.col(f"{p}_qs")
    df = df.withColumn(out, F.when(qs != "", F.concat(base, F.lit("?"), qs)).otherwise(base))
    return _drop_tmp(df, p, out)


def url_key_validate(df: DataFrame, src, out: str) -> DataFrame:
    """Validation key: B4 without scheme and one leading 'www.'; query verbatim."""
    p = _tmp()
    df = url_key_export(df, src, f"{p}_b4")
    df = split_cols(df, f"{p}_b4", p)
    base = F.concat(F.regexp_replace(F.col(f"{p}_n"), r"^www\.", ""), F.col(f"{p}_path"))
    q = F.col(f"{p}_q")
    df = df.withColumn(out, F.when(q != "", F.concat(base, F.lit("?"), q)).otherwise(base))
    return _drop_tmp(df, p, out)


def url_key_discovery(df: DataFrame, src, out: str) -> DataFrame:
    """Discovery key: lower whole URL, https, no 'www.', no trailing '/', no query/fragment."""
    p = _tmp()
    df = df.withColumn(f"{p}_in", F.lower(strip_ws(_c(src))))
    df = split_cols(df, f"{p}_in", p)
    s = F.col(f"{p}_s")
    path = F.regexp_replace(F.col(f"{p}_path"), "(?<!/)/++$", "")
    df = df.withColumns({
        f"{p}_s2": F.when(s.isin("http", "https"), F.lit("https")).otherwise(s),
        f"{p}_n2": F.regexp_replace(F.col(f"{p}_n"), r"^www\.", ""),
        f"{p}_path2": F.when(path == "", F.lit("/")).otherwise(path),
    })
    df = df.withColumn(f"{p}_pp", join_params(f"{p}_path2", f"{p}_params"))
    df = df.withColumn(out, unsplit(f"{p}_s2", f"{p}_n2", f"{p}_pp", F.lit(""), F.lit("")))
    return _drop_tmp(df, p, out)


def url_host(df: DataFrame, src, out: str) -> DataFrame:
    """Lower-cased netloc without one leading 'www.' (port kept)."""
    p = _tmp()
    df = split_cols(df, src, p, split_params=False)
    df = df.withColumn(out, F.regexp_replace(F.lower(F.col(f"{p}_n")), r"^www\.", ""))
    return _drop_tmp(df, p, out)


def url_origin(df: DataFrame, src, out: str) -> DataFrame:
    """B9: 'scheme://netloc' (scheme default https); '' without a netloc."""
    p = _tmp()
    df = split_cols(df, src, p, split_params=False)
    s, n = F.col(f"{p}_s"), F.lower(F.col(f"{p}_n"))
    s = F.when(s == "", F.lit("https")).otherwise(s)
    df = df.withColumn(out, F.when(n == "", F.lit("")).otherwise(F.concat(s, F.lit("://"), n)))
    return _drop_tmp(df, p, out)


def url_hash(df: DataFrame, src, out: str) -> DataFrame:
    """sha1 hex of the discovery key."""
    p = _tmp()
    df = url_key_discovery(df, src, f"{p}_k")
    return _drop_tmp(df.withColumn(out, F.sha1(F.col(f"{p}_k"))), p, out)


def resolve_url(df: DataFrame, base, href, out: str) -> DataFrame:
    """urljoin(base, href) with RFC-3986 dot-segment removal."""
    p = _tmp()
    df = df.withColumns({f"{p}_B": F.coalesce(_c(base), F.lit("")),
                         f"{p}_H": F.coalesce(_c(href), F.lit(""))})
    df = split_cols(df, f"{p}_B", f"{p}b")
    df = split_cols(df, f"{p}_H", f"{p}h")
    bs, bn, bpath, bpar, bq = (F.col(f"{p}b_{x}") for x in ("s", "n", "path", "params", "q"))
    hs, hn, hpath, hpar, hq, hf = (F.col(f"{p}h_{x}") for x in ("s", "n", "path", "params", "q", "f"))
    df = df.withColumn(f"{p}_hs", F.when(hs == "", bs).otherwise(hs))
    s = F.col(f"{p}_hs")
    bparts = F.split(bpath, "/")
    bparts = F.when(F.element_at(bparts, -1) != "",
                    F.slice(bparts, 1, F.size(bparts) - 1)).otherwise(bparts)
    df = df.withColumn(f"{p}_rel", F.concat(bparts, F.split(hpath, "/")))
    rel = F.col(f"{p}_rel")
    n = F.size(rel)
    rel = F.when(n > 2, F.concat(F.slice(rel, 1, 1),
                                 F.filter(F.slice(rel, 2, F.greatest(n - 2, F.lit(0))), lambda x: x != ""),
                                 F.slice(rel, F.greatest(n, F.lit(1)), 1))).otherwise(rel)
    df = df.withColumn(f"{p}_segs", F.when(hpath.startswith("/"), F.split(hpath, "/")).otherwise(rel))
    segs = F.col(f"{p}_segs")
    stack = F.aggregate(segs, F.array().cast("array<string>"), lambda acc, x: (
        F.when(x == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
        .when(x == ".", acc)
        .otherwise(F.concat(acc, F.array(x)))))
    stack = F.when(F.element_at(segs, -1).isin(".", ".."), F.concat(stack, F.array(F.lit("")))) \
        .otherwise(stack)
    df = df.withColumn(f"{p}_j", F.array_join(stack, "/"))
    j = F.col(f"{p}_j")
    in_net = s.isin(*USES_NETLOC)
    df = df.withColumns({
        f"{p}_net": F.when(in_net & (hn != ""), hn).when(in_net, bn).otherwise(hn),
        f"{p}_mode": (F.when(F.col(f"{p}_B") == "", F.lit("href"))
                      .when(F.col(f"{p}_H") == "", F.lit("base"))
                      .when((s != bs) | ~s.isin(*USES_RELATIVE), F.lit("href"))
                      .when(in_net & (hn != ""), F.lit("own"))
                      .when((hpath == "") & (hpar == ""), F.lit("nopath"))
                      .otherwise(F.lit("rel"))),
    })
    mode = F.col(f"{p}_mode")
    df = df.withColumns({
        f"{p}_pp": (F.when(mode == "own", join_params(hpath, hpar))
                    .when(mode == "nopath", join_params(bpath, bpar))
                    .otherwise(join_params(F.when(j == "", F.lit("/")).otherwise(j), hpar))),
        f"{p}_qq": F.when((mode == "nopath") & (hq == ""), bq).otherwise(hq),
    })
    joined = unsplit(s, f"{p}_net", f"{p}_pp", f"{p}_qq", hf)
    df = df.withColumn(out, F.when(mode == "href", F.col(f"{p}_H"))
                       .when(mode == "base", F.col(f"{p}_B")).otherwise(joined))
    return _drop_tmp(_drop_tmp(_drop_tmp(df, p), f"{p}b"), f"{p}h", out)


def feed_path_rank(df: DataFrame, src, out: str) -> DataFrame:
    """Index of the lower-cased, slash-trimmed path in the preference list, else 12."""
    p = _tmp()
    df = df.withColumn(f"{p}_in", F.lower(F.coalesce(_c(src), F.lit(""))))
    df = split_cols(df, f"{p}_in", p)
    path = F.regexp_replace(F.col(f"{p}_path"), "(?<!/)/++$", "")
    path = F.when(path == "", F.lit("/")).otherwise(path)
    pos = F.array_position(F.array(*[F.lit(x) for x in FEED_PATH_PREFERENCE]), path)
    df = df.withColumn(out, F.when(pos > 0, pos - 1)
                       .otherwise(F.lit(len(FEED_PATH_PREFERENCE))).cast("int"))
    return _drop_tmp(df, p, out)


def url_path(df: DataFrame, src, out: str) -> DataFrame:
    """Path component as urlparse gives it (params split off)."""
    p = _tmp()
    df = split_cols(df, src, p)
    return _drop_tmp(df.withColumn(out, F.col(f"{p}_path")), p, out)


def url_scheme(df: DataFrame, src, out: str) -> DataFrame:
    p = _tmp()
    df = split_cols(df, src, p, split_params=False)
    return _drop_tmp(df.withColumn(out, F.col(f"{p}_s")), p, out)


# ---------------------------------------------------------------------------
# predicates and helpers that need no split
# ---------------------------------------------------------------------------

def has_feed_hint(col) -> Column:
    """(rss|atom|feed|.xml) followed by a non-word character or the end."""
    return F.coalesce(_c(col), F.lit("")).rlike(FEED_HINT_RE)


def is_asset_path(path_col) -> Column:
    """C4 asset test on a lower-cased path."""
    cond = F.lit(False)
    for ext in ASSET_EXTENSIONS:
        cond = cond | _c(path_col).endswith(ext)
    return cond


def host_suffixes(host_col) -> Column:
    """The host plus every suffix that follows a '.', for equi-join blocklists."""
    h = _c(host_col)
    parts = F.split(h, r"\.")
    n = F.size(parts)
    tails = F.transform(F.sequence(F.lit(2), F.greatest(n, F.lit(2))),
                        lambda i: F.array_join(F.slice(parts, i, n), "."))
    tails = F.when(n > 1, tails).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(F.array(h), tails))
