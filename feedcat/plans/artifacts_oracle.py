"""DuckDB SQL of the artifact queries."""
from __future__ import annotations

from . import duck as D
from . import oracle as O
from .views import NOW

q = D.q
oracle = O.oracle


@oracle("catalog_document")
def o_catalog_document():
    return (f"SELECT CAST(row_number() OVER (ORDER BY lower(category), lower(title), lower(url), url, ord) AS INTEGER) AS item_idx, "
            f"url, title, description, type, category FROM ({O.o_catalog_dedup()}) c")


@oracle("status_document")
def o_status_document():
    return f"SELECT *, {q(NOW)} AS checked_at FROM ({O.o_health_merge()}) h"


@oracle("opml_document")
def o_opml_document():
    return (f"SELECT CAST(row_number() OVER (ORDER BY lower(category), category, lower(title), ord) AS INTEGER) AS n, url, "
            f"coalesce(nullif(title, ''), url) AS title, description, lower(coalesce(nullif(type, ''), 'rss')) AS type, category FROM ({O.o_export_dedup()}) e")


@oracle("markdown_document")
def o_markdown_document():
    head = "# All feeds\n\nEvery feed by category.\n\n**Generated:** `" + NOW + "` (UTC)\n\n\n---\n\n## Contents\n\n"
    table = "| Feed | Description | Type | URL |\n|---|---|---:|---|"
    lit = lambda s: " || chr(10) || ".join(q(x) for x in s.split("\n"))
    return (f"WITH r AS ({O.o_markdown_rows()}), heads AS (SELECT category, {lit(chr(10) + '## ')} || category || {lit(chr(10) * 2 + 'Total: **')} || "
            f"CAST(count(*) AS VARCHAR) || {lit('**' + chr(10) * 2 + table)} AS line FROM r WHERE kind = 'item' GROUP BY category), "
            f"l AS (SELECT 0 AS a, category, 0 AS b, '' AS t, '' AS u, line FROM r WHERE kind = 'toc' UNION ALL "
            f"SELECT 1, '', 0, '', '', {lit(chr(10) + '---')} UNION ALL SELECT 2, category, 0, '', '', line FROM heads UNION ALL "
            f"SELECT 2, category, 1, k_title, k_url, line FROM r WHERE kind = 'item'), "
            f"d AS (SELECT string_split({lit(head)} || string_agg(line || chr(10), '' ORDER BY a, lower(category), category, b, t, u), chr(10)) AS ls FROM l) "
            f"SELECT CAST(unnest(range(len(ls))) AS INTEGER) AS n, unnest(ls) AS line FROM d")


@oracle("opml_items")
def o_opml_items():
    ch = D.Chain(O.v_catalog())
    D.normalize_url(ch, "url", "u")
    ch.add(t=D.clean_text("title"), d=D.clean_text("description"),
           c=f"CASE WHEN {D.clean_text('category')} = '' THEN 'Uncategorized' ELSE {D.clean_text('category')} END")
    return ch.select("CAST(row_number() OVER (ORDER BY ord) AS INTEGER) AS n, u AS url, t AS title, d AS description, lower(type) AS type, c AS category")
