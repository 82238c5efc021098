"""End-to-end jobs: the catalog workflows as Spark plans.

Each job reads files, chains the operators and writes artifacts; command
options are parameters.  Outputs are written with Spark sinks (ordered text
part files, JSON lines, YAML per target file, versioned tables), so no job
gathers a catalog on the driver.
"""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import urls as U
from ..functions.text import iso_utc
from ..operators import catalog as C
from ..operators import candidates as K
from ..operators import entries as E
from ..operators import health as H
from ..operators import links as L
from ..operators import quality as Q
from ..operators import render as W
from ..operators import scoring as R
from ..operators.summary import RunSummary
from ..session import materialize
from ..sources import catalog_files as CF
from ..sources import documents as D
from ..sources import lists as LS
from ..sources import sinks as SK
from ..sources.catalog_files import SEEN_COLUMNS
from ..sources.versions import VersionedTable, merge_or_replace
from ..lexicon import DEFAULT_LEXICON, Lexicon, MIN_FEED_BODY_BYTES, MIN_SCORE


def build_catalog_json(spark: SparkSession, feeds_glob: str, out: str, generated_at: str | None = None) -> DataFrame:
    """§3.1: YAML -> clean (B2) -> dedup (E1) -> G1 order -> JSON (A13).  Returns the rows.

    With ``generated_at`` the folder ``out`` gets the whole documents feeds.json and feeds.min.json, else JSON lines."""
    items = C.clean_items(CF.read_yaml_catalog(spark, feeds_glob, strict=True))
    feeds = C.catalog_dedup(items)
    rows = W.catalog_json_rows(feeds)
    if generated_at is not None:
        feeds = materialize(feeds)
        D.write_catalog_json(feeds, f"{out}/feeds.json", generated_at)
        D.write_catalog_json(feeds, f"{out}/feeds.min.json", generated_at, pretty=False)
        return rows
    SK.write_lines(rows.withColumnRenamed("json", "line"), out, ["k_category", "k_title", "k_url"])
    return rows


def validate_catalog(spark: SparkSession, feeds_glob: str, categories_md: str) -> tuple[DataFrame, DataFrame]:
    """(findings, one-row summary); empty, unlisted and unreadable files are findings, and so is no file."""
    files = materialize(CF.read_yaml_files(spark, feeds_glob))
    canon = LS.canonical_categories(LS.read_lines(spark, categories_md))
    return Q.quality_report(CF.items_of_files(files), canon, files)


def export_opml(spark: SparkSession, feeds_glob: str, out: str, status_path: str | None = None,
                only_active: bool = False, candidates_glob: str | None = None, title: str | None = None) -> DataFrame:
    """§3.4 export: [promotion D7] -> clean (B4, blank category 'Uncategorized') -> E3 ->
    [C10 active only] -> OPML (A15): with ``title`` the whole document ``out``, else its body lines in order."""
    items = C.clean_items(CF.read_yaml_catalog(spark, feeds_glob), url_policy="export",
                          blank_category="Uncategorized")
    if candidates_glob:
        cands = C.clean_items(CF.read_yaml_catalog(spark, candidates_glob), url_policy="export",
                              blank_category="Uncategorized")
        items = C.promote_candidates(items, cands).drop("promoted")
    exp = C.export_dedup(items)
    if only_active:
        st = CF.read_status(spark, status_path) if status_path else None
        if st is None:
            exp = exp.limit(0)
        else:
            act = U.url_key_export(st.where(F.col("status") == "active"), "url", "__k")
            exp = exp.join(act.select(F.col("__k").alias("url")).distinct(), "url", "left_semi")
    lines = W.opml_lines(exp)
    if title is not None:
        D.write_opml(exp, out, title)
        return lines
    SK.write_lines(lines, out, ["k_cat", "category", "part", "k_title", "ord"])
    return lines


def promote(spark: SparkSession, folder: str, candidates_glob: str) -> tuple[DataFrame, list[str]]:
    """§3.4 promotion (D7/G3): candidate items whose export key is nowhere in ``folder``/*.yaml go to the file of the
    same name there, first wins. Only files that get an item are written: theirs is the order of category, title and
    URL, all others keep their bytes. Returns (promoted items, names of the files written)."""
    def load(glob):
        return C.clean_items(CF.read_yaml_catalog(spark, glob), url_policy="export", blank_category="Uncategorized")

    both = materialize(C.promote_candidates(load(f"{folder.rstrip('/')}/*.yaml"), load(candidates_glob)))
    added = both.where("promoted")
    touched = both.join(added.select("file").distinct(), "file", "left_semi")
    names = SK.write_yaml_files(touched, folder, ["url", "category", "title", "type", "description"],
                                [F.lower("category"), F.lower("title"), F.lower("url"), "ord"])
    return added, names


def import_opml(spark: SparkSession, opml_path: str, out_dir: str) -> DataFrame:
    """§3.4 import: OPML (A3) -> E2 -> per-category files (F5) -> YAML (A16), title then URL order."""
    items = CF.read_opml(spark, opml_path)
    dedup = C.import_dedup(items)
    files = W.category_files(dedup.select(F.col("group_category").alias("category")))
    out = dedup.join(files.withColumnRenamed("category", "group_category"), "group_category") \
        .withColumn("category", F.col("group_category"))
    SK.write_yaml_files(out, out_dir, ["url", "category", "title", "description", "type"],
                        [F.lower("title"), F.lower("url")], omit_blank=True)
    return out


def markdown_page(spark: SparkSession, feeds_glob: str, out: str, generated_at: str | None = None, **page) -> DataFrame:
    """Contents, then per-category tables, in category / title / URL order: with ``generated_at`` the whole
    page ``out`` (title, intro and note as in ``write_markdown``), else its rows as lines."""
    items = CF.read_yaml_catalog(spark, feeds_glob)
    rows = W.markdown_rows(items)
    if generated_at is not None:
        D.write_markdown(items, out, generated_at, **page)
        return rows
    keyed = rows.withColumn("k_kind", F.when(F.col("kind") == "toc", F.lit(0)).otherwise(F.lit(1))) \
        .withColumn("k_cat", F.lower("category"))
    SK.write_lines(keyed, out, ["k_kind", "k_cat", "category", "k_title", "k_url"])
    return rows


def check_health(spark: SparkSession, fetches: DataFrame, previous: DataFrame | None, now: str,
                 out_base: str, run_id: str) -> DataFrame:
    """§3.3: captured fetch attempts (A11) -> C9 -> E21 -> D6 with the previous state ->
    status snapshot (A14) with totals (E9), as a table and as the whole document status.json."""
    resolved = H.retry_resolution(H.fetch_status(fetches))
    merged = materialize(H.health_merge(resolved, previous, now))
    SK.write_status_snapshot(merged, out_base, run_id)
    texts = {c: iso_utc(c) for c in ("down_since", "last_seen_active")}
    D.write_status_json(merged.withColumns(texts), f"{out_base.rstrip('/')}/run={run_id}/status.json", now)
    return merged


CANDIDATE_FIELDS = ["feed_url", "site_url", "title", "description", "language", "feed_type", "score", "matched_keywords",
                    "suggested_category", "discovered_via", "entries_sample", "url_hash", "discovered_at"]
#: A review item as its file has it.
REVIEW_FIELDS = ["url", "category", "title", "type", "description"]


def discover(spark: SparkSession, pages: DataFrame, fetches: DataFrame, known: DataFrame,
             seen: DataFrame | None, now: str, blocked: DataFrame | None = None,
             blocked_feeds: DataFrame | None = None, lex: Lexicon = DEFAULT_LEXICON,
             max_sites: int | None = None, min_score: int = MIN_SCORE, only_new_items: bool = False,
             max_new: int | None = None, max_entries: int | None = None, seeds: DataFrame | None = None,
             out: str | None = None, merge_existing: bool = True) -> dict:
    """§3.2 on captured tables: seeds, then the sites they link to, then those sites' home pages and feeds.

    ``pages``: captured pages (page_id, url, html[, http_status, content_type]); ``seeds``: the seed list (``url``, A6),
    without it every page is a seed; ``fetches``: captured feed fetches (feed_url,
    http_status, body, body_bytes); ``known``: catalog rows with ``url``; ``seen``: the
    seen cache.  A page that is neither a seed nor a site's home page is not looked at.
    Returns the stages as DataFrames (sites with what they were found on, probes, final candidates of 13 fields,
    review items, top new items, updated seen cache) and ``summary``, a RunSummary.

    With ``out`` the run's outputs are written there: candidates.json (all final candidates), records/ (one record per
    candidate, by hash prefix), review-files/*.yaml (the new items, in the files of their buckets), and the versioned
    tables ``review``, ``discovered`` (merged by URL, or replaced) and ``seen``, which the next run reads; ``seen``
    overrides the table then.
    """
    summary = RunSummary()
    links = materialize(L.page_links(pages))  # HTML is read into tags once, for both hops
    if seeds is not None:
        hop = L.seed_links(links, summary.count("seeds", seeds))
    else:
        hop = summary.count("seeds", links)
    sites = materialize(summary.count("sites", L.linked_sites(hop, blocked, max_sites)))
    homes = L.home_links(links, sites)
    probes = materialize(summary.count("probes", L.probe_urls(sites, L.site_feeds(homes), blocked, blocked_feeds)))
    # only what can be a feed is parsed, and a feed of several sites once
    got = fetches.where((F.col("http_status") == 200) & (F.col("body_bytes") >= MIN_FEED_BODY_BYTES)) \
        .join(probes.select("feed_url").distinct(), "feed_url", "left_semi")
    parsed = E.valid_bodies(E.parse_bodies(got.withColumn("chunk", F.lit(0).cast("bigint")), key="feed_url"))
    raw = K.site_candidates(R.scored_feeds(parsed, lex, now, max_entries=max_entries), probes, now)
    final = K.unknown_candidates(K.best_by_hash(K.min_score(K.site_dedup(raw), min_score)), K.known_urls(known))
    final = materialize(summary.count("kept", final))
    review = K.review_items(R.candidate_bucket(final, lex))
    tables = {name: VersionedTable(spark, f"{out}/{name}") for name in ("review", "discovered", "seen")} if out else {}
    if seen is None and out:
        seen = tables["seen"].read()
    if seen is None:  # the first run starts from an empty cache
        seen = spark.createDataFrame([], SEEN_COLUMNS)
    pick = review
    if only_new_items:
        pick = K.only_new(review.withColumn("url_hash", F.col("discovery.url_hash")), seen).drop("url_hash")
    filed = tables["review"].read() if out else None
    if filed is not None:
        pick = K.bucket_merge(pick, filed)
    else:
        pick = K.bucket_merge(pick, spark.createDataFrame([], "bucket string, url string"))
    top = K.top_candidates(pick, max_new)
    now_ts = int(dt.datetime.fromisoformat(now).replace(tzinfo=dt.timezone.utc).timestamp())
    new_seen = K.seen_upsert(seen, final, now_ts)
    if out:
        top = materialize(summary.count("added", top))
        new_seen = materialize(new_seen)
        D.write_json_array(final, f"{out}/candidates.json", ["url_hash"], CANDIDATE_FIELDS)
        names = K.review_record_names(final)
        records = final.select(*CANDIDATE_FIELDS).join(names, "url_hash").withColumn("prefix", F.substring("url_hash", 1, 2))
        SK.write_json_rows(records, f"{out}/records", "prefix")
        tables["review"].update(lambda old: top if old is None else old.unionByName(top))
        _write_review(tables["review"].read(), top, f"{out}/review-files")
        items = K.candidate_items(final).select(*REVIEW_FIELDS, F.col("url").alias("ord"))
        merge_or_replace(tables["discovered"], items, merge_existing)
        tables["seen"].update(lambda old: new_seen)
    return {"sites": sites, "probes": probes, "candidates": final, "review": review, "top": top,
            "seen": new_seen, "summary": summary}


def _write_review(filed: DataFrame, added: DataFrame, folder: str) -> None:
    """The review files of the buckets that got an item, in G2 order; the others stay."""
    touched = filed.join(added.select("bucket").distinct(), "bucket", "left_semi")
    rows = touched.select(*REVIEW_FIELDS, F.to_json("discovery").alias("discovery"), F.concat("bucket", F.lit(".yaml")).alias("file"))
    SK.write_yaml_files(rows, folder, [*REVIEW_FIELDS, "discovery"],
                        [F.lower("category"), F.lower("title"), F.lower("type"), "url"])
