"""Catalog operators: clean, dedup, order, count (A1 projection, E1-E3, E6,
E11-E14, D7, D8, G1-G4).

"First wins" means first in ``ord`` order (file name, item index).  Every
dedup is a hash aggregate on its key with ``min_by`` (partial aggregation,
map-side combine), so a hot key never lands whole in one task and no window
or sort is needed.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import urls as U
from ..functions.text import clean_text, strip_ws

FIELDS = ["title", "description", "type", "category"]


def _first(col: str, cond: Column | None = None, ord_col: str = "ord") -> Column:
    """min_by(col, ord) over rows where ``cond`` holds (NULL ord rows are ignored)."""
    if cond is None:
        return F.min_by(F.col(col), F.col(ord_col))
    return F.min_by(F.when(cond, F.col(col)), F.when(cond, F.col(ord_col)))


def clean_items(items: DataFrame, url_policy: str = "catalog", strict: bool = True,
                blank_category: str | None = None) -> DataFrame:
    """A1 projection: url normalised, text fields cleaned, type lower-cased.

    ``url_policy`` 'catalog' = B2 (build, check), 'export' = B4 (export,
    promotion).  ``strict`` raises on a missing URL, as build and export do.
    """
    df = items.withColumn("__raw", strip_ws(F.col("url")))
    if url_policy == "export":
        df = U.url_key_export(df, "__raw", "__url")
    else:
        df = U.normalize_url(df, "__raw", "__url")
    cat = clean_text("category")
    if blank_category is not None:
        cat = F.when(cat == "", F.lit(blank_category)).otherwise(cat)
    url = F.col("__url")
    if strict:
        url = F.when(url == "", F.raise_error(F.concat(
            F.lit("Missing url in "), F.coalesce(F.col("file"), F.lit("?")), F.lit(" #"),
            F.coalesce(F.col("item_idx").cast("string"), F.lit("?"))))).otherwise(url)
    keep = [c for c in ("file", "item_idx", "ord") if c in items.columns]
    return df.select(*keep, url.alias("url"), clean_text("title").alias("title"),
                     clean_text("description").alias("description"),
                     F.lower(clean_text("type")).alias("type"), cat.alias("category"))


def catalog_dedup(items: DataFrame) -> DataFrame:
    """Dedup by the B5 key; first wins, blanks filled from the first later
    non-blank, an http URL upgraded to the first later https one."""
    df = U.url_key_catalog(items, "url", "key")
    df = df.withColumn("__https", F.col("url").startswith("https:"))
    agg = df.groupBy("key").agg(
        _first("url").alias("__first"),
        _first("url", F.col("__https")).alias("__https_url"),
        *[F.coalesce(_first(f, F.col(f) != ""), F.lit("")).alias(f) for f in FIELDS],
        F.min("ord").alias("ord"),
        F.count(F.lit(1)).alias("n_items"))
    url = F.when(F.col("__first").startswith("http:") & F.col("__https_url").isNotNull(),
                 F.col("__https_url")).otherwise(F.col("__first"))
    return agg.select("key", url.alias("url"), *FIELDS, "ord", "n_items")


def import_dedup(items: DataFrame) -> DataFrame:
    """Dedup by the B2 URL across categories; first keeps its category group,
    blanks (category included) filled from later items; no URL upgrade."""
    agg = items.groupBy("url").agg(
        _first("category").alias("group_category"),
        *[F.coalesce(_first(f, F.col(f) != ""), F.lit("")).alias(f) for f in FIELDS],
        F.min("ord").alias("ord"))
    return agg.select("group_category", "url", *FIELDS, "ord")


def export_dedup(items: DataFrame) -> DataFrame:
    """Dedup by the B4 key; the first item wins whole, its URL replaced by the key;
    a blank key is dropped."""
    df = U.url_key_export(items, "url", "key").where(F.col("key") != "")
    agg = df.groupBy("key").agg(
        F.min_by(F.struct(*FIELDS), F.col("ord")).alias("__it"), F.min("ord").alias("ord"))
    return agg.select(F.col("key").alias("url"), *[F.col("__it")[f].alias(f) for f in FIELDS], "ord")


def check_worklist(items: DataFrame, max_checks: int | None = None) -> DataFrame:
    """Distinct B2 URLs in first-seen order, capped (0/None = no cap)."""
    df = U.normalize_url(items.withColumn("__raw", strip_ws(F.col("url"))), "__raw", "url_norm")
    out = (df.where(F.col("url_norm") != "").groupBy(F.col("url_norm").alias("url"))
           .agg(F.min("ord").alias("ord")))
    if max_checks:
        out = out.orderBy("ord").limit(max_checks)
    return out


def catalog_order(df: DataFrame) -> DataFrame:
    """G1: lower category, lower title, lower URL (range-partitioned global sort)."""
    return df.orderBy(F.lower("category"), F.lower("title"), F.lower("url"))


def category_counts(items: DataFrame, blank_to_uncategorized: bool = False) -> DataFrame:
    """Items per category.  Markdown page: missing -> 'Uncategorized', blank kept;
    OPML export: blank also -> 'Uncategorized'."""
    cat = F.coalesce(F.col("category"), F.lit("Uncategorized"))
    if blank_to_uncategorized:
        cat = F.when(clean_text(cat) == "", F.lit("Uncategorized")).otherwise(clean_text(cat))
    return items.groupBy(cat.alias("category")).agg(F.count(F.lit(1)).alias("n"))


def category_facets(items: DataFrame) -> DataFrame:
    """Distinct non-blank categories (sort case-insensitively at the sink)."""
    return (items.where(F.col("category").isNotNull() & (F.col("category") != ""))
            .select("category").distinct())


def manifest(items: DataFrame) -> DataFrame:
    """Counts by (category, file)."""
    return items.groupBy("category", "file").agg(F.count(F.lit(1)).alias("count"))


def merge_by_url(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Append the new items whose trimmed URL is not already present;
    first wins inside the new batch; existing rows are kept as they are."""
    ex = existing.withColumn("__u", strip_ws(F.col("url")))
    nw = new.withColumn("__u", strip_ws(F.col("url"))).where(F.col("__u") != "")
    known = ex.where(F.col("__u") != "").select("__u").distinct()
    fresh = nw.join(known, "__u", "left_anti")
    cols = [c for c in new.columns if c not in ("ord",)]
    firsts = fresh.groupBy("__u").agg(F.min_by(F.struct(*cols), F.col("ord")).alias("__it"),
                                      F.min("ord").alias("ord"))
    added = firsts.select(*[F.col("__it")[c].alias(c) for c in cols], "ord",
                          F.lit(True).alias("added"))
    return existing.withColumn("added", F.lit(False)).unionByName(added, allowMissingColumns=True)


def promote_candidates(main: DataFrame, candidates: DataFrame) -> DataFrame:
    """Main items plus candidate items whose B4 key is new globally; the first
    candidate wins inside the batch; a promoted item goes to the same-named file."""
    m = U.url_key_export(main, "url", "__k")
    c = U.url_key_export(candidates, "url", "__k")
    fresh = c.join(m.select("__k").distinct(), "__k", "left_anti")
    cols = ["file", "url", "category", "title", "type", "description"]
    firsts = fresh.groupBy("__k").agg(F.min_by(F.struct(*cols), F.col("ord")).alias("__it"),
                                      F.min("ord").alias("ord"))
    promoted = firsts.select(*[F.col("__it")[x].alias(x) for x in cols], "ord",
                             F.lit(True).alias("promoted"))
    return m.select(*cols, "ord", F.lit(False).alias("promoted")).unionByName(promoted)
