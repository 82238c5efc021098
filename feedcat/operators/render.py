"""Artifact rendering.

Every artifact is rendered row by row: each feed becomes one line with sort
keys, and category headers/footers are extra rows with their own keys.  A
sink then writes the lines range-partitioned and sorted
(``sources.sinks.write_lines``), so no category is ever collected into a
single value, whatever its size.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import clean_text, md_escape, slug, xml_attr_escape

FEED_INDENT = "      "
CAT_INDENT = "    "


def catalog_json_rows(items: DataFrame) -> DataFrame:
    """One compact JSON object per catalog item plus its G1 sort keys."""
    obj = F.to_json(F.struct("url", "title", "description", "type", "category"))
    return items.select("url", F.lower("category").alias("k_category"), F.lower("title").alias("k_title"),
                        F.lower("url").alias("k_url"), obj.alias("json"))


def opml_lines(items: DataFrame) -> DataFrame:
    """OPML body lines: one open and one close line per category and one
    <outline/> per feed; keys (k_cat, part, k_title) give the document order."""
    cat = F.when(clean_text("category") == "", F.lit("Uncategorized")).otherwise(clean_text("category"))
    title = clean_text(F.coalesce(F.nullif(F.col("title"), F.lit("")), F.nullif(F.col("url"), F.lit("")), F.lit("")))
    ftype = clean_text(F.coalesce(F.nullif(F.col("type"), F.lit("")), F.lit("rss")))
    desc = clean_text("description")
    url = F.coalesce(F.col("url"), F.lit(""))

    def attr(name, v):
        return F.when(v != "", F.concat(F.lit(f'{name}="'), xml_attr_escape(v), F.lit('"')))

    line = F.concat(F.lit(FEED_INDENT + "<outline "),
                    F.concat_ws(" ", attr("text", title), attr("title", title), attr("type", ftype),
                                attr("xmlUrl", url), attr("htmlUrl", url), attr("description", desc)),
                    F.lit(" />"))
    feeds = items.select(cat.alias("category"), F.lit(1).alias("part"),
                         F.lower(F.coalesce("title", F.lit(""))).alias("k_title"), F.col("ord"), line.alias("line"))
    cats = feeds.select("category").distinct()
    esc = xml_attr_escape(F.col("category"))
    opens = cats.select("category", F.lit(0).alias("part"), F.lit("").alias("k_title"),
                        F.lit(None).cast(feeds.schema["ord"].dataType).alias("ord"),
                        F.concat(F.lit(CAT_INDENT + '<outline text="'), esc, F.lit('" title="'), esc, F.lit('">'))
                        .alias("line"))
    closes = cats.select("category", F.lit(2).alias("part"), F.lit("").alias("k_title"),
                         F.lit(None).cast(feeds.schema["ord"].dataType).alias("ord"), F.lit(CAT_INDENT + "</outline>").alias("line"))
    out = opens.unionByName(feeds).unionByName(closes)
    return out.withColumn("k_cat", F.lower("category"))


def markdown_rows(items: DataFrame) -> DataFrame:
    """Markdown table rows per category (missing category -> 'Uncategorized',
    blank kept) with the per-category sort keys (lower title, raw URL), plus the
    contents line of each category with its count."""
    cat = F.coalesce(F.col("category"), F.lit("Uncategorized"))
    url = md_escape("url")
    row = F.concat(F.lit("| "), md_escape("title"), F.lit(" | "), md_escape("description"), F.lit(" | "),
                   F.upper(md_escape("type")), F.lit(" | "),
                   F.when(url != "", F.concat(F.lit("<"), url, F.lit(">"))).otherwise(F.lit("")), F.lit(" |"))
    rows = items.select(cat.alias("category"), F.lit("item").alias("kind"),
                        F.lower(F.coalesce(F.col("title").cast("string"), F.lit(""))).alias("k_title"),
                        F.coalesce(F.col("url").cast("string"), F.lit("")).alias("k_url"), row.alias("line"))
    counts = rows.groupBy("category").agg(F.count(F.lit(1)).alias("n"))
    toc = counts.select("category", F.lit("toc").alias("kind"), F.lit("").alias("k_title"), F.lit("").alias("k_url"),
                        F.concat(F.lit("- ["), F.col("category"), F.lit("](#"), slug(F.col("category")),
                                 F.lit(") ("), F.col("n").cast("string"), F.lit(")")).alias("line"))
    return rows.unionByName(toc)


def category_files(categories: DataFrame) -> DataFrame:
    """one YAML file per category: slug with '&' -> 'and' (fallback
    'uncategorized'); colliding slugs numbered -2, -3 in category order."""
    c = categories.select("category").distinct().withColumn(
        "slug", slug(F.col("category"), fallback="uncategorized", ampersand_to_and=True))
    w = Window.partitionBy("slug").orderBy(F.lower("category"), F.col("category"))
    n = F.row_number().over(w)
    return c.select("category", F.concat(F.when(n > 1, F.concat(F.col("slug"), F.lit("-"), n.cast("string")))
                                         .otherwise(F.col("slug")), F.lit(".yaml")).alias("file"))
