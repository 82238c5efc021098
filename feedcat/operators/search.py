"""Catalog search and live-status views.

The status snapshot joins the catalog on the exact URL (left outer, so
missing status reads 'unknown'); the status side is one row per URL and
Spark's size-checked broadcast or a shuffle join is chosen by AQE.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .health import badge_class


def catalog_with_status(catalog: DataFrame, status: DataFrame) -> DataFrame:
    """Catalog rows with status (missing -> 'unknown'), error, badge class, display title."""
    s = status.select("url", F.col("status").alias("__st"), F.col("error").alias("__err"))
    df = catalog.join(s, "url", "left")
    st = F.lower(F.coalesce(F.nullif(F.col("__st"), F.lit("")), F.lit("unknown")))
    return df.withColumns({
        "status": st,
        "error": F.coalesce(F.col("__err"), F.lit("")),
        "badge": badge_class(st),
        "display_title": F.coalesce(F.nullif(F.trim(F.coalesce(F.col("title"), F.lit(""))), F.lit("")),
                                    F.lit("(untitled)")),
    }).drop("__st", "__err")


def catalog_search(catalog: DataFrame, status: DataFrame, q: str = "", type_: str = "",
                   category: str = "", status_filter: str = "") -> DataFrame:
    """C11: conjunctive filters: type equal (case-insensitive), category exact,
    status equal (missing -> unknown), free text contained (case-insensitive)
    in 'url title description type category'."""
    df = catalog_with_status(catalog, status)
    qq, t, c, sf = (q or "").strip().lower(), (type_ or "").strip().lower(), (category or "").strip(), \
        (status_filter or "").lower()
    cond = F.lit(True)
    if t:
        cond = cond & (F.lower(F.coalesce(F.col("type"), F.lit(""))) == t)
    if c:
        cond = cond & (F.coalesce(F.col("category"), F.lit("")) == c)
    if sf:
        cond = cond & (F.col("status") == sf)
    if qq:
        hay = F.concat_ws(" ", *[F.coalesce(F.col(x), F.lit("")) for x in
                                 ("url", "title", "description", "type", "category")])
        cond = cond & F.lower(hay).contains(qq)
    return df.where(cond)


def status_counts(catalog: DataFrame, status: DataFrame) -> DataFrame:
    """Active, down, unknown (everything else, rate_limited included), total."""
    df = catalog_with_status(catalog, status)
    st = F.col("status")
    return df.groupBy().agg(F.count_if(st == "active").alias("active"),
                            F.count_if(st == "down").alias("down"),
                            F.count_if((st != "active") & (st != "down")).alias("unknown"),
                            F.count(F.lit(1)).alias("total"))
