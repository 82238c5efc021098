"""DuckDB SQL builders for the oracle queries.

The oracle must be independent SQL that DuckDB runs on the raw driver
tables, so the adaptor views and URL keys are re-stated here in DuckDB's
dialect (RE2 regex, ``lambda x:`` list functions, ``'g'`` for global
replace).  Stages are nested sub-selects, which keeps each URL part computed
once per row.
"""
from __future__ import annotations

import itertools

from ..lexicon import FEED_PATH_PREFERENCE, TRACKING_QS_KEYS
from ..functions.text import WS, WS_CHARS
from ..functions.urls import FEED_HINT_RE, URL_RE, USES_NETLOC, USES_PARAMS, USES_RELATIVE

_ids = itertools.count()


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def qlist(values) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]"


def inlist(expr: str, values) -> str:
    return f"({expr} IN ({', '.join(q(v) for v in values)}))"


class Chain:
    """A chain of projection stages over a base relation."""

    def __init__(self, base: str):
        self.sql = base
        self.n = 0

    def add(self, **cols) -> "Chain":
        self.n += 1
        sel = ", ".join(f"{v} AS {k}" for k, v in cols.items())
        self.sql = f"SELECT *, {sel} FROM ({self.sql}) s{self.n}"
        return self

    def where(self, cond: str) -> "Chain":
        self.n += 1
        self.sql = f"SELECT * FROM ({self.sql}) s{self.n} WHERE {cond}"
        return self

    def select(self, cols: str) -> str:
        self.n += 1
        return f"SELECT {cols} FROM ({self.sql}) s{self.n}"


def tmp() -> str:
    return f"_d{next(_ids)}"


# --- text -------------------------------------------------------------------

def strip_ws(e: str) -> str:
    return f"regexp_replace(coalesce({e}, ''), {q(f'^{WS}+|{WS}+$')}, '', 'g')"


def clean_text(e: str) -> str:
    return f"trim(regexp_replace(coalesce({e}, ''), {q(f'{WS}+')}, ' ', 'g'), ' ')"


def slug(e: str, fallback: str = "", amp: bool = False) -> str:
    v = f"lower({strip_ws(e)})"
    if amp:
        v = f"replace({v}, '&', ' and ')"
    v = f"regexp_replace({v}, {q(f'[^a-z0-9{WS_CHARS}-]+')}, '-', 'g')"
    v = f"regexp_replace({v}, {q(f'[{WS_CHARS}-]+')}, '-', 'g')"
    v = f"regexp_replace({v}, '^-+|-+$', '', 'g')"
    return f"(CASE WHEN {v} = '' THEN {q(fallback)} ELSE {v} END)"


def slug_short(e: str, n: int = 50) -> str:
    v = f"regexp_replace(regexp_replace(lower({strip_ws(e)}), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')"
    return f"(CASE WHEN {v} = '' THEN 'feed' ELSE regexp_replace(substr({v}, 1, {n}), '-+$', '') END)"


def html_escape(e: str) -> str:
    v = f"coalesce(CAST({e} AS VARCHAR), '')"
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        v = f"replace({v}, {q(a)}, {q(b)})"
    return v


def xml_escape(e: str) -> str:
    v = f"coalesce({e}, '')"
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        v = f"replace({v}, {q(a)}, {q(b)})"
    return v


def md_escape(e: str) -> str:
    v = f"replace(replace(coalesce({e}, ''), chr(10), ' '), '|', '\\|')"
    return strip_ws(v)


def item_description(d: str, cat: str, title: str, n: int = 220) -> str:
    s = strip_ws(d)
    col = f"regexp_replace({s}, {q(f'{WS}+')}, ' ', 'g')"
    cat_e = f"lower(coalesce(nullif({cat}, ''), 'security'))"
    return (f"(CASE WHEN {s} = '' THEN 'Updates from ' || coalesce({title}, '') || ' covering ' || {cat_e} || '.' "
            f"WHEN length({col}) > {n} THEN rtrim(substr({col}, 1, {n - 3}), ' ') || '...' ELSE {col} END)")


# --- URL parts ----------------------------------------------------------------

def split(ch: Chain, src: str, p: str, params: bool = True) -> Chain:
    ch.add(**{f"{p}_u": f"regexp_replace(regexp_replace(coalesce({src}, ''), '[\\t\\r\\n]', '', 'g'), '^[\\x00-\\x20]+', '')"})
    u = f"{p}_u"
    ch.add(**{f"{p}_s": f"lower(regexp_extract({u}, {q(URL_RE)}, 1))",
              f"{p}_n": f"regexp_extract({u}, {q(URL_RE)}, 2)",
              f"{p}_p0": f"regexp_extract({u}, {q(URL_RE)}, 3)",
              f"{p}_q": f"regexp_extract({u}, {q(URL_RE)}, 4)",
              f"{p}_f": f"regexp_extract({u}, {q(URL_RE)}, 5)"})
    if params:
        has = f"({inlist(p + '_s', USES_PARAMS)} AND regexp_matches({p}_p0, ';[^/]*$'))"
        ch.add(**{f"{p}_params": f"CASE WHEN {has} THEN regexp_extract({p}_p0, ';([^/]*)$', 1) ELSE '' END",
                  f"{p}_path": f"CASE WHEN {has} THEN regexp_replace({p}_p0, ';[^/]*$', '') ELSE {p}_p0 END"})
    else:
        ch.add(**{f"{p}_params": "''", f"{p}_path": f"{p}_p0"})
    return ch


def unsplit(s: str, n: str, path: str, qy: str, f: str) -> str:
    body = (f"(CASE WHEN {n} <> '' THEN '//' || {n} || (CASE WHEN {path} <> '' AND NOT starts_with({path}, '/') THEN '/' ELSE '' END) || {path} "
            f"WHEN starts_with({path}, '//') THEN '//' || {path} "
            f"WHEN {s} <> '' AND {inlist(s, USES_NETLOC)} AND ({path} = '' OR starts_with({path}, '/')) THEN '//' || {path} "
            f"ELSE {path} END)")
    return (f"((CASE WHEN {s} <> '' THEN {s} || ':' ELSE '' END) || {body} || "
            f"(CASE WHEN {qy} <> '' THEN '?' || {qy} ELSE '' END) || (CASE WHEN {f} <> '' THEN '#' || {f} ELSE '' END))")


def join_params(path: str, params: str) -> str:
    return f"(CASE WHEN {params} <> '' THEN {path} || ';' || {params} ELSE {path} END)"


def strip_port(s: str, n: str) -> str:
    ln = f"lower({n})"
    return (f"(CASE WHEN {s} = 'http' AND ends_with({ln}, ':80') THEN regexp_replace({ln}, ':80$', '') "
            f"WHEN {s} = 'https' AND ends_with({ln}, ':443') THEN regexp_replace({ln}, ':443$', '') ELSE {ln} END)")


def normalize_url(ch: Chain, src: str, out: str, default_scheme="http", force_https=False,
                  strip_slash=False, drop_fragment=True) -> Chain:
    p = tmp()
    ch.add(**{f"{p}_in": strip_ws(src)})
    split(ch, f"{p}_in", p)
    s = f"(CASE WHEN {p}_s = '' THEN {q(default_scheme)} ELSE {p}_s END)"
    if force_https:
        s = f"(CASE WHEN {s} = 'http' THEN 'https' ELSE {s} END)"
    ch.add(**{f"{p}_s2": s})
    ch.add(**{f"{p}_n2": strip_port(f"{p}_s2", f"{p}_n"),
              f"{p}_path2": f"regexp_replace({p}_path, '/+$', '')" if strip_slash else f"{p}_path",
              f"{p}_f2": "''" if drop_fragment else f"{p}_f"})
    ch.add(**{out: f"CASE WHEN {p}_in = '' THEN '' ELSE {unsplit(p + '_s2', p + '_n2', p + '_path2', p + '_q', p + '_f2')} END"})
    return ch


def url_key_export(ch: Chain, src: str, out: str) -> Chain:
    return normalize_url(ch, src, out, force_https=True, strip_slash=True)


def normalize_url_crawl(ch: Chain, src: str, out: str) -> Chain:
    p = tmp()
    ch.add(**{f"{p}_in": strip_ws(src)})
    ch.add(**{f"{p}_pre": f"CASE WHEN regexp_matches({p}_in, '(?i)^https?://') THEN {p}_in ELSE 'https://' || {p}_in END"})
    split(ch, f"{p}_pre", p)
    ch.add(**{f"{p}_n2": strip_port(f"{p}_s", f"{p}_n"), f"{p}_pp": join_params(f"{p}_path", f"{p}_params")})
    ch.add(**{out: f"CASE WHEN {p}_in = '' OR {p}_n = '' THEN '' ELSE {unsplit(p + '_s', p + '_n2', p + '_pp', p + '_q', "''")} END"})
    return ch


def _form_decode(e: str) -> str:
    return f"url_decode(replace({e}, '+', ' '))"


def _form_encode(e: str) -> str:
    return f"replace(url_encode({e}), '%20', '+')"


def url_key_catalog(ch: Chain, src: str, out: str) -> Chain:
    p = tmp()
    split(ch, src, p)
    ch.add(**{f"{p}_n2": f"lower({p}_n)",
              f"{p}_path2": f"CASE WHEN ends_with({p}_path, '/') AND {p}_path <> '/' THEN regexp_replace({p}_path, '/$', '') ELSE {p}_path END",
              f"{p}_kv": f"list_transform(list_filter(string_split({p}_q, '&'), lambda x: x <> ''), lambda x: [split_part(x, '=', 1), CASE WHEN strpos(x, '=') > 0 THEN substr(x, strpos(x, '=') + 1) ELSE '' END])"})
    ch.add(**{f"{p}_pairs": f"list_transform({p}_kv, lambda a: {{'lk': lower({_form_decode('a[1]')}), 'v': {_form_decode('a[2]')}, 'k': {_form_decode('a[1]')}}})"})
    ch.add(**{f"{p}_kept": f"list_sort(list_filter({p}_pairs, lambda kv: NOT starts_with(kv.lk, 'utm_') AND kv.lk NOT IN ({', '.join(q(k) for k in TRACKING_QS_KEYS)})))"})
    ch.add(**{f"{p}_qs": f"array_to_string(list_transform({p}_kept, lambda kv: {_form_encode('kv.k')} || '=' || {_form_encode('kv.v')}), '&')"})
    ch.add(**{out: f"CASE WHEN {p}_qs <> '' THEN {p}_n2 || {p}_path2 || '?' || {p}_qs ELSE {p}_n2 || {p}_path2 END"})
    return ch


def url_key_validate(ch: Chain, src: str, out: str) -> Chain:
    p = tmp()
    url_key_export(ch, src, f"{p}_b4")
    split(ch, f"{p}_b4", p)
    base = f"regexp_replace({p}_n, '^www\\.', '') || {p}_path"
    ch.add(**{out: f"CASE WHEN {p}_q <> '' THEN {base} || '?' || {p}_q ELSE {base} END"})
    return ch


def url_key_discovery(ch: Chain, src: str, out: str) -> Chain:
    p = tmp()
    ch.add(**{f"{p}_in": f"lower({strip_ws(src)})"})
    split(ch, f"{p}_in", p)
    ch.add(**{f"{p}_s2": f"CASE WHEN {p}_s IN ('http', 'https') THEN 'https' ELSE {p}_s END",
              f"{p}_n2": f"regexp_replace({p}_n, '^www\\.', '')",
              f"{p}_path2": f"coalesce(nullif(regexp_replace({p}_path, '/+$', ''), ''), '/')"})
    ch.add(**{f"{p}_pp": join_params(f"{p}_path2", f"{p}_params")})
    ch.add(**{out: unsplit(f"{p}_s2", f"{p}_n2", f"{p}_pp", "''", "''")})
    return ch


def url_host(ch: Chain, src: str, out: str) -> Chain:
    p = tmp()
    split(ch, src, p, params=False)
    ch.add(**{out: f"regexp_replace(lower({p}_n), '^www\\.', '')"})
    return ch


def url_origin(ch: Chain, src: str, out: str) -> Chain:
    p = tmp()
    split(ch, src, p, params=False)
    ch.add(**{out: f"CASE WHEN {p}_n = '' THEN '' ELSE (CASE WHEN {p}_s = '' THEN 'https' ELSE {p}_s END) || '://' || lower({p}_n) END"})
    return ch


def url_hash(ch: Chain, src: str, out: str) -> Chain:
    p = tmp()
    url_key_discovery(ch, src, f"{p}_k")
    ch.add(**{out: f"sha1({p}_k)"})
    return ch


def url_path(ch: Chain, src: str, out: str) -> Chain:
    p = tmp()
    split(ch, src, p)
    ch.add(**{out: f"{p}_path"})
    return ch


def feed_path_rank(ch: Chain, src: str, out: str) -> Chain:
    p = tmp()
    ch.add(**{f"{p}_in": f"lower(coalesce({src}, ''))"})
    split(ch, f"{p}_in", p)
    path = f"coalesce(nullif(regexp_replace({p}_path, '/+$', ''), ''), '/')"
    ch.add(**{out: f"CAST(coalesce(list_position({qlist(FEED_PATH_PREFERENCE)}, {path}) - 1, {len(FEED_PATH_PREFERENCE)}) AS INTEGER)"})
    return ch


def resolve_url(ch: Chain, base: str, href: str, out: str) -> Chain:
    p = tmp()
    ch.add(**{f"{p}_B": f"coalesce({base}, '')", f"{p}_H": f"coalesce({href}, '')"})
    split(ch, f"{p}_B", f"{p}b")
    split(ch, f"{p}_H", f"{p}h")
    b, h = f"{p}b", f"{p}h"
    ch.add(**{f"{p}_hs": f"CASE WHEN {h}_s = '' THEN {b}_s ELSE {h}_s END",
              f"{p}_bp": f"CASE WHEN string_split({b}_path, '/')[-1] <> '' THEN string_split({b}_path, '/')[1:len(string_split({b}_path, '/')) - 1] ELSE string_split({b}_path, '/') END"})
    ch.add(**{f"{p}_rel": f"list_concat({p}_bp, string_split({h}_path, '/'))"})
    rel = f"{p}_rel"
    ch.add(**{f"{p}_rel2": f"CASE WHEN len({rel}) > 2 THEN list_concat(list_concat({rel}[1:1], list_filter({rel}[2:len({rel}) - 1], lambda x: x <> '')), {rel}[len({rel}):len({rel})]) ELSE {rel} END"})
    ch.add(**{f"{p}_segs": f"CASE WHEN starts_with({h}_path, '/') THEN string_split({h}_path, '/') ELSE {p}_rel2 END"})
    segs = f"{p}_segs"
    stack = (f"list_reduce({segs}, lambda acc, x: CASE WHEN x = '..' THEN acc[1:greatest(len(acc) - 1, 0)] "
             f"WHEN x = '.' THEN acc ELSE list_append(acc, x) END, []::VARCHAR[])")
    ch.add(**{f"{p}_st": f"CASE WHEN {segs}[-1] IN ('.', '..') THEN list_append({stack}, '') ELSE {stack} END"})
    ch.add(**{f"{p}_j": f"array_to_string({p}_st, '/')"})
    s = f"{p}_hs"
    in_net = inlist(s, USES_NETLOC)
    ch.add(**{f"{p}_net": f"CASE WHEN {in_net} AND {h}_n <> '' THEN {h}_n WHEN {in_net} THEN {b}_n ELSE {h}_n END",
              f"{p}_mode": (f"CASE WHEN {p}_B = '' THEN 'href' WHEN {p}_H = '' THEN 'base' "
                            f"WHEN {s} <> {b}_s OR NOT {inlist(s, USES_RELATIVE)} THEN 'href' "
                            f"WHEN {in_net} AND {h}_n <> '' THEN 'own' "
                            f"WHEN {h}_path = '' AND {h}_params = '' THEN 'nopath' ELSE 'rel' END")})
    m = f"{p}_mode"
    ch.add(**{f"{p}_pp": (f"CASE WHEN {m} = 'own' THEN {join_params(h + '_path', h + '_params')} "
                          f"WHEN {m} = 'nopath' THEN {join_params(b + '_path', b + '_params')} "
                          f"ELSE {join_params(f"coalesce(nullif({p}_j, ''), '/')", h + '_params')} END"),
              f"{p}_qq": f"CASE WHEN {m} = 'nopath' AND {h}_q = '' THEN {b}_q ELSE {h}_q END"})
    ch.add(**{out: f"CASE WHEN {m} = 'href' THEN {p}_H WHEN {m} = 'base' THEN {p}_B ELSE {unsplit(s, p + '_net', p + '_pp', p + '_qq', h + '_f')} END"})
    return ch


def has_feed_hint(e: str) -> str:
    return f"regexp_matches(coalesce({e}, ''), {q(FEED_HINT_RE)})"
