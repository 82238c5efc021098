"""Catalog validation.

Duplicate reports avoid a window over the key (one hot key would sort in a
single task): the first location per key is a partial ``min_by`` aggregate,
and only keys seen more than once join back to the items.  A report stages the
few columns it needs of the items, so the items are scanned and their keys computed once.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import urls as U
from ..functions.text import strip_ws
from ..lexicon import ALLOWED_TYPES
from ..session import materialize


def _loc() -> F.Column:
    return F.concat(F.col("file"), F.lit(" #"), F.col("item_idx").cast("string"))


def validation_items(items: DataFrame) -> DataFrame:
    """Items as the validator reads them: raw URL, category and type stripped."""
    df = items
    if "is_dict" not in df.columns:
        df = df.withColumn("is_dict", F.lit(True))
    return df.select("file", "item_idx", "ord", "is_dict",
                     strip_ws("url").alias("url_raw"),
                     strip_ws("category").alias("category_v"),
                     F.lower(strip_ws("type")).alias("type_v"),
                     F.lower(strip_ws("title")).alias("title_v"))


def keyed_items(items: DataFrame) -> DataFrame:
    """Validation items with their duplicate keys: ``key`` (B6), ``host`` and the lower title; '' where there is none.

    Everything a report needs of the items, so that one scan serves it (see ``quality_report``)."""
    v = validation_items(items)
    v = U.url_key_validate(v, "url_raw", "key")
    v = U.normalize_url(v, "url_raw", "__n")
    v = U.url_host(v, "__n", "host")
    has_url = F.col("is_dict") & (F.col("url_raw") != "")
    return v.select("file", "item_idx", "ord", "is_dict", "url_raw", "category_v", "type_v", "title_v",
                    F.when(has_url, F.col("key")).alias("key"), F.when(has_url & (F.col("title_v") != ""), F.col("host")).alias("host"))


def repeated(keyed: DataFrame) -> DataFrame:
    """F1 and F2 at once: every later item of a key, with the key's first location.

    The keys of both kinds are stacked, so one aggregate finds the first of each and one join goes back to the items:
    (ord, file, item_idx, url_raw, kind, k1, k2, first_loc), kind 'url' or 'title'."""
    each = F.array_compact(F.array(
        F.when(F.col("key").isNotNull(), F.struct(F.lit("url").alias("kind"), F.col("key").alias("k1"), F.lit("").alias("k2"))),
        F.when(F.col("host").isNotNull(), F.struct(F.lit("title").alias("kind"), F.col("host").alias("k1"), F.col("title_v").alias("k2")))))
    stacked = keyed.select("ord", "file", "item_idx", "url_raw", F.inline(each))
    first = stacked.groupBy("kind", "k1", "k2").agg(
        F.min_by(_loc(), F.col("ord")).alias("first_loc"), F.min("ord").alias("first_ord"), F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    return stacked.join(first.drop("n"), ["kind", "k1", "k2"]).where(F.col("ord") > F.col("first_ord")).drop("first_ord")


def duplicate_urls(items: DataFrame) -> DataFrame:
    """every later item whose B6 key was seen before, pointing at the first location."""
    dup = repeated(keyed_items(items).withColumn("host", F.lit(None).cast("string")))
    return dup.select("ord", "file", "item_idx", "url_raw", F.col("k1").alias("key"), "first_loc")


def duplicate_titles(items: DataFrame) -> DataFrame:
    """later items with the same (host without 'www.', lower title), title not blank."""
    dup = repeated(keyed_items(items).withColumn("key", F.lit(None).cast("string")))
    return dup.select("ord", "file", "item_idx", F.col("k1").alias("host"), F.col("k2").alias("title"), "first_loc")


def _findings(keyed: DataFrame, categories: DataFrame, files: DataFrame) -> DataFrame:
    canon = categories.select(F.col("file").alias("file"), F.col("category").alias("expected"))
    ord_type = keyed.schema["ord"].dataType
    none = [F.lit(None).cast(ord_type).alias("ord"), F.lit(None).cast("bigint").alias("item_idx")]

    def finding(level, rule, detail):
        return F.struct(F.lit(level).alias("level"), F.lit(rule).alias("rule"), detail.alias("detail"))

    listed = files.join(canon, "file", "left")
    per_file = F.when(F.col("state") != "ok", finding("error", "file_unreadable", F.col("state"))) \
        .when(F.col("expected").isNull(), finding("error", "file_not_listed", F.lit("")))
    of_files = listed.select("file", per_file.alias("c")).where("c is not null").select(none[0], "file", none[1], "c.*")
    no_files = files.agg(F.count(F.lit(1)).alias("n")).where("n = 0").select(
        none[0], F.lit("").alias("file"), none[1], F.lit("error").alias("level"), F.lit("no_files").alias("rule"), F.lit("").alias("detail"))
    v = keyed.join(canon, "file", "left")
    has_url = F.col("is_dict") & (F.col("url_raw") != "")
    checks = F.array_compact(F.array(
        F.when(~F.col("is_dict"), finding("error", "not_a_dict", F.lit(""))),
        F.when(F.col("is_dict") & (F.col("url_raw") == ""), finding("error", "missing_url", F.lit(""))),
        F.when(has_url & F.col("expected").isNotNull() & (F.col("category_v") != F.col("expected")),
               finding("error", "category_mismatch",
                       F.concat(F.col("category_v"), F.lit(" != "), F.col("expected")))),
        F.when(has_url & ~F.col("type_v").isin(*ALLOWED_TYPES), finding("warn", "unusual_type", F.col("type_v"))),
    ))
    of_items = v.select("ord", "file", F.col("item_idx").cast("bigint").alias("item_idx"), F.inline(checks))
    is_url = F.col("kind") == "url"
    of_keys = repeated(keyed).select(
        "ord", "file", F.col("item_idx").cast("bigint").alias("item_idx"), F.when(is_url, "error").otherwise("warn").alias("level"),
        F.when(is_url, "duplicate_url").otherwise("possible_duplicate").alias("rule"), F.col("first_loc").alias("detail"))
    return of_files.unionByName(no_files).unionByName(of_items).unionByName(of_keys)


def _files_of(keyed: DataFrame) -> DataFrame:
    return keyed.select("file").distinct().withColumn("state", F.lit("ok"))


def quality_violations(items: DataFrame, categories: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """C12 + F1 + F2: one row per finding (level error|warn, rule, detail).

    ``categories`` holds the canonical (category, file) table (D11, small,
    left-joined); ``files`` (file, state) the catalog's files, also those without an item; they are the
    items' files if it isn't given.  Rules: no file at all, a file that can't be read or isn't a list, a file not listed,
    item not a dict, missing url, category differs from the file's canonical name, unusual
    type (warn), duplicate URL (error), same host+title (warn).  The items are scanned once.
    """
    keyed = materialize(keyed_items(items))
    return _findings(keyed, categories, _files_of(keyed) if files is None else files.select("file", "state"))


def _summary(keyed: DataFrame, findings: DataFrame) -> DataFrame:
    tagged = findings.select(F.col("level").alias("kind"), F.lit(None).cast("string").alias("key")) \
        .unionByName(keyed.select(F.lit("item").alias("kind"), "key"))
    out = tagged.groupBy().agg(
        F.count_if(F.col("kind") == "error").alias("errors"),
        F.count_if(F.col("kind") == "warn").alias("warnings"),
        F.count_if(F.col("kind") == "item").alias("items"),
        F.count_distinct("key").alias("unique_urls"))
    return out.withColumn("passed", F.col("errors") == 0)


def quality_report(items: DataFrame, categories: DataFrame, files: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(findings, one-row summary) from one scan of the items."""
    keyed = materialize(keyed_items(items))
    findings = _findings(keyed, categories, _files_of(keyed) if files is None else files.select("file", "state"))
    return findings, _summary(keyed, findings)


def quality_summary(items: DataFrame, categories: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """Errors, warnings, items, unique URLs (distinct B6 keys), passed.

    Findings and items are tagged and unioned so one global aggregate yields
    every total.
    """
    return quality_report(items, categories, files)[1]


def parse_exclusion_rules(lines) -> list[tuple[str, str]]:
    """Rule-file lines -> (rule_type, value); comments and blanks skipped."""
    out = []
    for line in lines:
        line = line.strip()
        if not line or line.startswith("#") or ":" not in line:
            continue
        kind, value = line.split(":", 1)
        out.append((kind.strip().lower(), value.strip().lower()))
    return out


def exclusion_matches(spark, items: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """Items hit by exclusion rules (domain:/url_contains:/title_contains:).

    Domain rules meet the exploded host suffixes in an equi-join (a rule's
    leading 'www.' is kept as written); the contains rules are literal lists
    tested with ``exists``.  Adds by_domain / by_url / by_title and keeps hits.
    """
    domains = [v for k, v in rules if k == "domain"]
    url_terms = [v for k, v in rules if k == "url_contains"]
    title_terms = [v for k, v in rules if k == "title_contains"]
    df = U.url_host(items.withColumn("__u", strip_ws("url")), "__u", "__host")
    df = df.withColumn("__host", F.lower("__host"))
    if domains:
        dom = spark.createDataFrame([(d,) for d in sorted(set(domains))], "__sfx string")
        sfx = df.select("__host").distinct().select(
            "__host", F.explode(U.host_suffixes(F.col("__host"))).alias("__sfx"))
        hits = sfx.join(dom, "__sfx", "left_semi").select("__host").distinct().withColumn("__dom", F.lit(True))
        df = df.join(hits, "__host", "left")
    else:
        df = df.withColumn("__dom", F.lit(False))
    lu, lt = F.lower(F.col("__u")), F.lower(F.coalesce(F.col("title"), F.lit("")))

    def any_of(col, terms):
        cond = F.lit(False)
        for t in terms:
            cond = cond | col.contains(t)
        return cond

    df = df.withColumns({"by_domain": F.coalesce(F.col("__dom"), F.lit(False)),
                         "by_url": any_of(lu, url_terms), "by_title": any_of(lt, title_terms)})
    return df.where(F.col("by_domain") | F.col("by_url") | F.col("by_title")).drop("__host", "__dom", "__u")
