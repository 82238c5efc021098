"""Registered queries of whole artifacts: each is written as a file and read back with its reader."""
from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import catalog as C
from ..session import shared_dir
from ..sources import catalog_files as CF
from ..sources import documents as D
from . import queries as Q
from . import views as V

register = Q.register


def scratch(spark, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _numbered(items):
    """``n``: place in the document, counted from 1."""
    return items.withColumn("n", F.row_number().over(Window.partitionBy("file").orderBy("ord")))


@register("catalog_document")
def q_catalog_document(spark, sf_dir):
    path = scratch(spark, "feeds.json")
    D.write_catalog_json(C.catalog_dedup(Q.items(spark, sf_dir)), path, V.NOW)
    return CF.read_catalog_json(spark, path).select("item_idx", *CF.FIELDS)


@register("status_document")
def q_status_document(spark, sf_dir):
    path = scratch(spark, "status.json")
    D.write_status_json(Q.q_health_merge(spark, sf_dir), path, V.NOW)
    return CF.read_status(spark, path).select("url", "status", "consecutive_failures", "down_since", "last_seen_active", "checked_at")


@register("opml_document")
def q_opml_document(spark, sf_dir):
    path = scratch(spark, "feeds.opml")
    D.write_opml(C.export_dedup(C.clean_items(V.v_catalog_dups(spark, sf_dir), url_policy="export", blank_category="Uncategorized")),
                 path, "All <feeds>")
    return _numbered(CF.read_opml(spark, path)).select("n", *CF.FIELDS)


@register("markdown_document")
def q_markdown_document(spark, sf_dir):
    path = scratch(spark, "page.md")
    D.write_markdown(V.v_catalog_dups(spark, sf_dir), path, V.NOW, "All feeds", ("Every feed by category.",))
    return spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\n")).alias("n", "line"))


@register("opml_items")
def q_opml_items(spark, sf_dir):
    """Every page as a feed in its own category, nested up to twelve outlines deep."""
    p = V.v_catalog(spark, sf_dir)
    depth = (F.col("ord") % 12).cast("int")
    esc = T.xml_attr_escape
    odd = F.col("ord") % 2 == 1
    line = F.concat(
        F.lit('<outline title="'), esc("category"), F.lit('">'), F.repeat(F.lit('<outline text="g">'), depth),
        F.lit('<outline text="'), esc("title"), F.when(odd, F.lit('" url="')).otherwise(F.lit('" xmlUrl="')), esc("url"),
        F.lit('" type="'), esc("type"), F.when(odd, F.lit('" desc="')).otherwise(F.lit('" description="')), esc("description"),
        F.lit('"/>'), F.repeat(F.lit("</outline>"), depth + 1))
    path = scratch(spark, "pages.opml")
    D.write_document(p.select("ord", line.alias("line")), path, ["ord"], '<?xml version="1.0"?>\n<opml><body>\n', "</body></opml>\n")
    return _numbered(CF.read_opml(spark, path)).select("n", *CF.FIELDS)
