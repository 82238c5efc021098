"""Candidate assembly, dedup, filtering, ranking and the seen cache
(I1-I3, E4, E5, C6, C7, D3, D4, D5, D9, G2, G5, A18).

Ties the original left to iteration order are fixed here: E4 keeps the best
score, then the lowest path rank, then the smallest feed URL; E5 the lowest
path rank, then the smallest feed URL; top-N ties break on feed URL.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import urls as U
from ..functions.text import WS, item_description, slug_short, strip_ws
from ..lexicon import DEFAULT_CATEGORY, MIN_SCORE

def assemble(feeds: DataFrame, scores: DataFrame, now: str, key: str = "feed_url") -> DataFrame:
    """Feed metadata + type + score + hash for every validated feed.

    ``feeds``: feed_url, site_url, title, description, language, feed_type, discovered_via.
    ``scores``: feed_url, score, matched_keywords, suggested_category.
    """
    df = feeds.join(scores.select(key, "score", "matched_keywords", "suggested_category"), key)
    return _candidate(df, now, key)


def _candidate(df: DataFrame, now: str, key: str = "feed_url") -> DataFrame:
    df = U.url_hash(df, key, "url_hash")
    return df.select(
        key, "site_url", strip_ws("title").alias("title"), strip_ws("description").alias("description"),
        strip_ws("language").alias("language"), "feed_type", "score", "matched_keywords", "suggested_category",
        "discovered_via", *(["entries_sample"] if "entries_sample" in df.columns else []), "url_hash",
        F.lit(now).cast("timestamp_ntz").alias("discovered_at"))


def site_candidates(scored: DataFrame, probes: DataFrame, now: str) -> DataFrame:
    """I1 with all 13 fields: every scored feed for each site that probes it (``feed_url, site_url, discovered_via``)."""
    return _candidate(scored.join(probes.select("feed_url", "site_url", "discovered_via"), "feed_url"), now)


def site_dedup(cands: DataFrame) -> DataFrame:
    """E5: per (site, type, blank-collapsed lower title) keep the lowest path rank."""
    df = U.feed_path_rank(cands, "feed_url", "path_rank")
    norm = F.regexp_replace(F.lower(strip_ws("title")), f"{WS}+", " ")
    df = df.withColumn("__t", norm)
    cols = df.columns
    best = df.groupBy("site_url", "feed_type", "__t").agg(
        F.min_by(F.struct(*cols), F.struct("path_rank", "feed_url")).alias("__b"))
    return best.select(*[F.col("__b")[c].alias(c) for c in cols]).drop("__t")


def min_score(cands: DataFrame, n: int = MIN_SCORE) -> DataFrame:
    """C6."""
    return cands.where(F.col("score") >= n)


def best_by_hash(cands: DataFrame) -> DataFrame:
    """One candidate per url_hash: highest score, then lowest path rank, then feed URL."""
    df = cands if "path_rank" in cands.columns else U.feed_path_rank(cands, "feed_url", "path_rank")
    cols = df.columns
    best = df.groupBy("url_hash").agg(
        F.min_by(F.struct(*cols), F.struct((-F.col("score")).alias("s"), "path_rank", "feed_url")).alias("__b"))
    return best.select(*[F.col("__b")[c].alias(c) for c in cols])


def known_urls(*catalogs: DataFrame) -> DataFrame:
    """Distinct discovery keys (B7) of every catalog's URLs."""
    out = None
    for c in catalogs:
        k = U.url_key_discovery(c.select("url"), "url", "known").where(F.col("known") != "").select("known")
        out = k if out is None else out.unionByName(k)
    return out.distinct()


def unknown_candidates(cands: DataFrame, known: DataFrame) -> DataFrame:
    """D3: drop candidates whose discovery key is already known."""
    df = U.url_key_discovery(cands, "feed_url", "__k")
    return df.join(known.select(F.col("known").alias("__k")), "__k", "left_anti").drop("__k")


def only_new(cands: DataFrame, seen: DataFrame) -> DataFrame:
    """Drop candidates whose url_hash is in the seen cache."""
    return cands.join(seen.select("url_hash"), "url_hash", "left_anti")


def candidate_items(cands: DataFrame) -> DataFrame:
    """Candidate -> catalog item (url, category, title, type, description)."""
    df = U.split_cols(cands, "site_url", "__sp", split_params=False)
    title = F.coalesce(F.nullif(strip_ws("title"), F.lit("")), F.col("__sp_n"))
    cat = strip_ws(F.coalesce(F.nullif(F.col("suggested_category"), F.lit("")), F.lit(DEFAULT_CATEGORY)))
    df = df.withColumns({"__title": title, "__cat": cat})
    return df.select(F.col("feed_url").alias("url"), F.col("__cat").alias("category"), F.col("__title").alias("title"),
                     F.col("feed_type").alias("type"),
                     item_description(F.col("description"), F.col("__cat"), F.col("__title")).alias("description"),
                     *[c for c in cands.columns if c not in ("title", "description")])


def review_items(cands: DataFrame) -> DataFrame:
    """Catalog item whose category is the bucket label, plus a ``discovery`` struct."""
    items = candidate_items(cands)
    return items.select("url", F.col("bucket_label").alias("category"), "title", "type", "description", "bucket",
                        F.struct("discovered_at", "score", "matched_keywords", "discovered_via", "url_hash")
                        .alias("discovery"))


def bucket_merge(items: DataFrame, existing: DataFrame) -> DataFrame:
    """Drop review items whose trimmed URL already sits in the same bucket, or comes again in the batch (the best
    score stays, then the smallest hash)."""
    ex = existing.select("bucket", strip_ws("url").alias("__u")).distinct()
    fresh = items.withColumn("__u", strip_ws("url")).where(F.col("__u") != "").join(ex, ["bucket", "__u"], "left_anti")
    cols = items.columns
    best = F.struct((-F.col("discovery.score")).alias("s"), F.col("discovery.url_hash").alias("h"))
    return fresh.groupBy("bucket", "__u").agg(F.min_by(F.struct(*cols), best).alias("__it")).select("__it.*")


def top_candidates(items: DataFrame, max_new: int | None = None) -> DataFrame:
    """The best ``max_new`` items by score (none or 0: all), ties on URL."""
    ordered = items.orderBy(F.col("discovery.score").desc(), F.col("url"))
    return ordered.limit(max_new) if max_new else ordered


def review_order(items: DataFrame) -> DataFrame:
    """Lower category, lower title, lower type, raw URL (a sink-side global sort)."""
    return items.orderBy(F.lower("category"), F.lower("title"), F.lower("type"), F.col("url"))


def review_rank(items: DataFrame, partitions: int | None = None) -> DataFrame:
    """G2 inside each bucket file: position of every review item.

    Items are dealt by ranges of (bucket, sort keys), ranked inside each range, and moved on by the number of the
    bucket's items in the ranges before, from a table with a row per range and bucket; so no bucket is sorted in one task."""
    from pyspark.sql import Window

    from ..session import materialize
    keys = [F.lower("category"), F.lower("title"), F.lower("type"), F.col("url")]
    n = partitions or int(items.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = materialize(items.repartitionByRange(n, F.col("bucket"), *keys).withColumn("__part", F.spark_partition_id()))
    inside = F.row_number().over(Window.partitionBy("__part", "bucket").orderBy(*keys))
    before = Window.partitionBy("bucket").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy("__part", "bucket").agg(F.count(F.lit(1)).alias("__n")) \
        .withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    return dealt.withColumn("__rank", inside).join(counts, ["__part", "bucket"]) \
        .select(*items.columns, (F.col("__rank") + F.col("__before")).cast("int").alias("rank"))


def review_record_names(cands: DataFrame) -> DataFrame:
    """Per-candidate record name '<slug>__<hash10>', slug of title, else site host, else feed host."""
    df = U.url_host(cands, "site_url", "__hs")
    df = U.url_host(df, "feed_url", "__hf")
    base = F.coalesce(F.nullif(F.col("title"), F.lit("")), F.nullif(F.col("__hs"), F.lit("")), F.col("__hf"))
    return df.select("url_hash", F.concat(slug_short(base), F.lit("__"), F.substring("url_hash", 1, 10))
                     .alias("record_name"))


def seen_upsert(seen: DataFrame, cands: DataFrame, now_ts: int) -> DataFrame:
    """Insert or overwrite the six cached fields per url_hash; other keys survive."""
    fields = ["feed_url", "site_url", "title", "score", "feed_type"]
    new = cands.select("url_hash", F.lit(True).alias("__new"), *[F.col(f).alias(f"__n_{f}") for f in fields])
    j = seen.join(new, "url_hash", "full_outer")
    hit = F.coalesce(F.col("__new"), F.lit(False))
    out = j.select("url_hash", *[F.when(hit, F.col(f"__n_{f}")).otherwise(F.col(f)).alias(f) for f in fields],
                   F.when(hit, F.lit(now_ts).cast("bigint")).otherwise(F.col("last_seen_ts")).alias("last_seen_ts"),
                   *[c for c in seen.columns if c not in fields + ["url_hash", "last_seen_ts"]])
    return out
