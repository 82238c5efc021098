"""Line-list sources: blocklists, seed lists, category tables.

Lists are read as whole text files (one row per file), split into numbered
lines with ``posexplode`` so the original line order survives, then cleaned
with native expressions.
"""
from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import urls as U
from ..functions.text import strip_ws

CATEGORY_ROW_RE = r"^\|\s*([^|]+?)\s*\|[^|]*\|\s*`feeds/([^`]+\.yaml)`\s*\|\s*$"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, ord, line) for every line of every file under ``path``; a missing path gives no rows."""
    try:
        raw = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    except AnalysisException as e:  # a missing list means an empty list; other errors are errors
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "file string, ord bigint, line string")
    return raw.select("file", F.posexplode(F.split("value", r"\r?\n")).alias("ord", "line")) \
        .select("file", F.col("ord").cast("bigint"), "line")


def clean_list(lines: DataFrame, lower: bool = True) -> DataFrame:
    """A5: trimmed, non-blank, non-comment lines (lower-cased for blocklists), distinct."""
    v = strip_ws("line")
    out = lines.where((v != "") & ~v.startswith("#")).select((F.lower(v) if lower else v).alias("value"))
    return out.distinct()


def blocklist(spark: SparkSession, path: str, column: str = "domain") -> DataFrame:
    return clean_list(read_lines(spark, path)).withColumnRenamed("value", column)


def seed_urls(lines: DataFrame, max_seeds: int | None = None, fallback: list[str] | None = None,
              spark: SparkSession | None = None) -> DataFrame:
    """Seed lines (ord, line) -> crawl-normalised URLs, first occurrence kept, in line
    order; ``max_seeds``, if given, keeps the first max(1, max_seeds).  With no usable line the ``fallback`` list is used."""
    v = strip_ws("line")
    df = lines.where((v != "") & ~v.startswith("#")).withColumn("__raw", v)
    if fallback and spark is not None:
        fb = spark.createDataFrame([(i, u) for i, u in enumerate(fallback)], "ord bigint, __raw string")
        has = df.limit(1).count() > 0
        df = df if has else fb
    df = U.normalize_url_crawl(df, "__raw", "url").where(F.col("url") != "")
    out = df.groupBy("url").agg(F.min("ord").alias("ord"))
    if max_seeds is not None:
        out = out.orderBy("ord").limit(max(1, max_seeds))
    return out


def canonical_categories(lines: DataFrame) -> DataFrame:
    """(file, category) rows of the Markdown category table; the header row is skipped."""
    m = lines.select(F.regexp_extract("line", CATEGORY_ROW_RE, 1).alias("category"),
                     F.regexp_extract("line", CATEGORY_ROW_RE, 2).alias("file"))
    return m.where((F.col("file") != "") & (F.col("category") != "Category"))
