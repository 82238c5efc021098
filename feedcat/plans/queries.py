"""Registered queries: one per operator of the inventory, over the driver tables.

Each callable takes (spark, sf_dir) and returns a DataFrame whose column
names equal those of the matching DuckDB SQL in ``plans/oracle.py``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import urls as U
from ..operators import catalog as C
from ..operators import links as L
from . import views as V

QUERIES: dict = {}


def register(name):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def items(spark, sf_dir) -> DataFrame:
    return C.clean_items(V.v_catalog_dups(spark, sf_dir))


def _dups(spark, sf_dir):
    return V.v_catalog_dups(spark, sf_dir).select("ord", "url", "title", "description", "category")


# --- 2.B scalars -------------------------------------------------------------

@register("clean_text")
def q_clean_text(spark, sf_dir):
    p = V.table(spark, sf_dir, "pages")
    return p.select("page_id", T.clean_text(F.regexp_extract("html", r"(?is)<h1>(.*?)</h1>", 1)).alias("heading"),
                    T.clean_text(F.regexp_extract("html", r"(?is)<footer>(.*?)</footer>", 1)).alias("footer"),
                    T.clean_text("html").alias("page"))


@register("url_normalize")
def q_url_normalize(spark, sf_dir):
    return U.normalize_url(_dups(spark, sf_dir), "url", "url_norm").select("ord", "url_norm")


@register("url_normalize_crawl")
def q_url_normalize_crawl(spark, sf_dir):
    return U.normalize_url_crawl(_dups(spark, sf_dir), "url", "url_norm").select("ord", "url_norm")


@register("url_key_export")
def q_url_key_export(spark, sf_dir):
    return U.url_key_export(_dups(spark, sf_dir), "url", "url_key").select("ord", "url_key")


@register("url_key_catalog")
def q_url_key_catalog(spark, sf_dir):
    df = U.normalize_url(_dups(spark, sf_dir), "url", "__n")
    return U.url_key_catalog(df, "__n", "url_key").select("ord", "url_key")


@register("url_key_validate")
def q_url_key_validate(spark, sf_dir):
    return U.url_key_validate(_dups(spark, sf_dir), "url", "url_key").select("ord", "url_key")


@register("url_key_discovery")
def q_url_key_discovery(spark, sf_dir):
    return U.url_key_discovery(_dups(spark, sf_dir), "url", "url_key").select("ord", "url_key")


@register("url_host")
def q_url_host(spark, sf_dir):
    return U.url_host(_dups(spark, sf_dir), "url", "host").select("ord", "host")


@register("url_origin")
def q_url_origin(spark, sf_dir):
    return U.url_origin(_dups(spark, sf_dir), "url", "origin").select("ord", "origin")


@register("url_hash")
def q_url_hash(spark, sf_dir):
    return U.url_hash(_dups(spark, sf_dir), "url", "url_hash").select("ord", "url_hash")


@register("slug")
def q_slug(spark, sf_dir):
    d = _dups(spark, sf_dir)
    return d.select("ord", T.slug("title", fallback="uncategorized", ampersand_to_and=True).alias("slug"),
                    T.slug("description").alias("slug_plain"))


@register("slug_short")
def q_slug_short(spark, sf_dir):
    return _dups(spark, sf_dir).select("ord", T.slug_short("title").alias("slug"))


@register("item_description")
def q_item_description(spark, sf_dir):
    d = _dups(spark, sf_dir)
    return d.select("ord", T.item_description("description", "category", "title").alias("description"))


@register("html_escape")
def q_html_escape(spark, sf_dir):
    return _dups(spark, sf_dir).select("ord", T.html_escape("title").alias("title_html"),
                                       T.xml_attr_escape("title").alias("title_xml"),
                                       T.md_escape("title").alias("title_md"))


# --- 2.E catalog -------------------------------------------------------------

@register("catalog_dedup")
def q_catalog_dedup(spark, sf_dir):
    return C.catalog_dedup(items(spark, sf_dir))


@register("import_dedup")
def q_import_dedup(spark, sf_dir):
    return C.import_dedup(items(spark, sf_dir))


@register("export_dedup")
def q_export_dedup(spark, sf_dir):
    return C.export_dedup(C.clean_items(V.v_catalog_dups(spark, sf_dir), url_policy="export",
                                        blank_category="Uncategorized"))


@register("check_worklist")
def q_check_worklist(spark, sf_dir):
    return C.check_worklist(V.v_catalog_dups(spark, sf_dir), max_checks=None)


@register("category_counts")
def q_category_counts(spark, sf_dir):
    return C.category_counts(V.v_catalog(spark, sf_dir))


@register("category_facets")
def q_category_facets(spark, sf_dir):
    return C.category_facets(V.v_catalog(spark, sf_dir))


@register("manifest")
def q_manifest(spark, sf_dir):
    return C.manifest(V.v_catalog(spark, sf_dir))


@register("merge_by_url")
def q_merge_by_url(spark, sf_dir):
    d = items(spark, sf_dir)
    existing = d.where(F.col("category") == "en").drop("file", "item_idx")
    new = d.where(F.col("category") != "en").drop("file", "item_idx")
    return C.merge_by_url(existing, new).select("url", "title", "category", "ord", "added")


@register("promote_candidates")
def q_promote(spark, sf_dir):
    raw = V.v_catalog_dups(spark, sf_dir)
    main = C.clean_items(raw.where(F.col("variant") == "original"), url_policy="export",
                         blank_category="Uncategorized")
    cand = C.clean_items(raw.where(F.col("variant") != "original"), url_policy="export",
                         blank_category="Uncategorized")
    return C.promote_candidates(main, cand).select("file", "url", "title", "ord", "promoted")


# --- 2.A / E8 links ----------------------------------------------------------

@register("resolve_links")
def q_resolve_links(spark, sf_dir):
    return L.resolve_links(V.v_links(spark, sf_dir)).select("page_id", "pos", "href", "resolved")


@register("outbound_links")
def q_outbound_links(spark, sf_dir):
    return L.outbound_links(V.v_links(spark, sf_dir))


@register("html_pages")
def q_html_pages(spark, sf_dir):
    return L.html_pages(V.v_links(spark, sf_dir)).select("page_id", "url")


# --- 2.C / 2.F quality -------------------------------------------------------

from ..operators import health as H  # noqa: E402
from ..operators import quality as Q  # noqa: E402
from ..operators import search as S  # noqa: E402

NOW = "2024-02-01 00:00:00"


@register("quality_violations")
def q_quality_violations(spark, sf_dir):
    return Q.quality_violations(V.v_catalog_dups(spark, sf_dir), V.v_categories(spark))


@register("duplicate_urls")
def q_duplicate_urls(spark, sf_dir):
    return Q.duplicate_urls(V.v_catalog_dups(spark, sf_dir))


@register("duplicate_titles")
def q_duplicate_titles(spark, sf_dir):
    return Q.duplicate_titles(V.v_catalog_dups(spark, sf_dir))


@register("quality_summary")
def q_quality_summary(spark, sf_dir):
    return Q.quality_summary(V.v_catalog_dups(spark, sf_dir), V.v_categories(spark))


@register("exclusion_rules")
def q_exclusion_rules(spark, sf_dir):
    rules = Q.parse_exclusion_rules(V.EXCLUSION_RULES)
    out = Q.exclusion_matches(spark, _dups(spark, sf_dir), rules)
    return out.select("ord", "by_domain", "by_url", "by_title")


# --- search / status ---------------------------------------------------------

def _catalog(spark, sf_dir):
    return C.catalog_dedup(items(spark, sf_dir)).select("url", "title", "description", "type", "category")


@register("catalog_with_status")
def q_catalog_with_status(spark, sf_dir):
    return S.catalog_with_status(_catalog(spark, sf_dir), V.v_status(spark, sf_dir)).select(
        "url", "status", "error", "badge", "display_title")


@register("catalog_search")
def q_catalog_search(spark, sf_dir):
    return S.catalog_search(_catalog(spark, sf_dir), V.v_status(spark, sf_dir), q="Th",
                            status_filter="active").select("url", "title", "status")


@register("status_counts")
def q_status_counts(spark, sf_dir):
    return S.status_counts(_catalog(spark, sf_dir), V.v_status(spark, sf_dir))


@register("active_feeds")
def q_active_feeds(spark, sf_dir):
    """Export items whose B4 key is active in the status snapshot."""
    exp = C.export_dedup(C.clean_items(V.v_catalog_dups(spark, sf_dir), url_policy="export",
                                       blank_category="Uncategorized"))
    st = V.v_status(spark, sf_dir).where(F.col("status") == "active")
    act = U.url_key_export(st, "url", "url_key").select(F.col("url_key").alias("url")).distinct()
    return exp.join(act, "url", "left_semi").select("url", "title", "category")


# --- health ------------------------------------------------------------------

@register("fetch_status")
def q_fetch_status(spark, sf_dir):
    return H.fetch_status(V.v_fetch(spark, sf_dir)).select(
        "url", "run_id", "attempt", "status", "error", "http_status", "bozo", "entries", "content_type")


@register("retry_resolution")
def q_retry_resolution(spark, sf_dir):
    r = H.retry_resolution(H.fetch_status(V.v_fetch(spark, sf_dir)))
    return r.select("url", "run_id", "status", "error", "http_status", "retried")


@register("check_totals")
def q_check_totals(spark, sf_dir):
    return H.check_totals(H.retry_resolution(H.fetch_status(V.v_fetch(spark, sf_dir))))


def _iso(c):
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


@register("health_history")
def q_health_history(spark, sf_dir):
    h = H.health_history(V.v_checks(spark, sf_dir))
    return h.select("event_id", "status", "consecutive_failures",
                    _iso(F.col("down_since")).alias("down_since"),
                    _iso(F.col("last_seen_active")).alias("last_seen_active"))


@register("health_merge")
def q_health_merge(spark, sf_dir):
    """Each URL's latest check merged onto a snapshot built from its earlier checks."""
    log = V.v_checks(spark, sf_dir)
    last = F.struct("run_idx", "checked_at", "event_id")
    latest = log.groupBy("url").agg(F.max_by(F.struct("status", "event_id"), last).alias("r"))
    new = latest.select("url", F.col("r.status").alias("status"), F.col("r.event_id").alias("last_event"))
    earlier = log.join(new.select("url", "last_event"), "url").where(F.col("event_id") != F.col("last_event"))
    prev = earlier.groupBy("url").agg(
        F.count_if(F.col("status") == "down").cast("int").alias("consecutive_failures"),
        F.min(F.when(F.col("status") == "down", F.col("checked_at"))).alias("down_since"),
        F.max(F.when(F.col("status") == "active", F.col("checked_at"))).alias("last_seen_active"))
    m = H.health_merge(new, prev, NOW)
    return m.select("url", "status", "consecutive_failures", _iso(F.col("down_since")).alias("down_since"),
                    _iso(F.col("last_seen_active")).alias("last_seen_active"))


# --- discovery links ---------------------------------------------------------

@register("blocked_hosts")
def q_blocked_hosts(spark, sf_dir):
    pages = U.url_host(V.v_links(spark, sf_dir).select("url"), "url", "host").select("host").distinct()
    return L.blocked_hosts(pages, "host", V.v_blocked(spark))


@register("crawl_sites")
def q_crawl_sites(spark, sf_dir):
    return L.crawl_sites(V.v_links(spark, sf_dir), V.v_blocked(spark))


@register("advertised_feeds")
def q_advertised_feeds(spark, sf_dir):
    return L.advertised_feeds(V.v_pages_with_feeds(spark, sf_dir))


@register("feed_hint_links")
def q_feed_hint_links(spark, sf_dir):
    h = L.page_hrefs(V.v_pages_with_feeds(spark, sf_dir))
    return h.select("page_id", "pos", "href", U.has_feed_hint(F.col("href")).alias("is_hint"))


def _probes(spark, sf_dir):
    from ..session import materialize
    links = materialize(L.page_links(V.v_pages_with_feeds(spark, sf_dir)))  # one pass over the HTML
    sites = L.crawl_sites(links, V.v_blocked(spark))
    return L.probe_urls(sites, L.site_feeds(links), V.v_blocked(spark), V.v_blocked_feeds(spark))


@register("probe_urls")
def q_probe_urls(spark, sf_dir):
    return _probes(spark, sf_dir)


@register("feed_path_rank")
def q_feed_path_rank(spark, sf_dir):
    return U.feed_path_rank(_probes(spark, sf_dir), "feed_url", "rank").select("site_url", "feed_url", "rank")


# --- entries, scoring, candidates ----------------------------------------------------

from ..lexicon import FIRST_ENTRIES, SAMPLE_ENTRIES  # noqa: E402
from ..operators import candidates as K  # noqa: E402
from ..operators import entries as E  # noqa: E402
from ..operators import scoring as R  # noqa: E402


def _bodies(spark, sf_dir):
    ent = V.v_entries(spark, sf_dir)
    src = V.v_feed_sources(spark, sf_dir)
    ent = ent.join(src.select("feed", "feed_url", "channel_title"), "feed")
    bodies = E.render_rss_items(ent, feed="feed_url", pos="pos", title_col="channel_title")
    return bodies.withColumns({"http_status": F.lit(200), "body_bytes": F.octet_length("body")})


def _parsed(spark, sf_dir):
    from ..session import materialize
    parsed = materialize(E.parse_bodies(_bodies(spark, sf_dir), key="feed_url"))  # stage: fetched + parsed
    feeds = E.feeds_of(parsed)
    entries = E.entries_of(parsed).withColumn("pos", F.col("guid").cast("bigint"))
    return parsed, feeds, entries


@register("feed_entries")
def q_feed_entries(spark, sf_dir):
    _, _, entries = _parsed(spark, sf_dir)
    return entries.select("feed_url", "pos", "title", "summary")


@register("valid_feeds")
def q_valid_feeds(spark, sf_dir):
    bodies, feeds, _ = _parsed(spark, sf_dir)
    return E.valid_feeds(bodies, feeds).select("feed_url", "chunk")


@register("feed_type")
def q_feed_type(spark, sf_dir):
    _, feeds, _ = _parsed(spark, sf_dir)
    return E.feed_type(feeds).select("feed_url", "chunk", "version", "feed_type")


@register("first_entries")
def q_first_entries(spark, sf_dir):
    return E.first_entries(V.v_entries(spark, sf_dir), FIRST_ENTRIES).select("feed", "pos", "rank")


@register("entry_sample")
def q_entry_sample(spark, sf_dir):
    first = E.first_entries(V.v_entries(spark, sf_dir).withColumns(
        {"link": F.concat(F.lit("https://chat.example.org/"), F.col("feed").cast("string")),
         "published": F.lit(""), "updated": F.lit(" 2024-01-01 ")}), SAMPLE_ENTRIES)
    return E.entry_sample(first, SAMPLE_ENTRIES).select("feed", "rank", "title", "link", "published")


@register("feed_recency")
def q_feed_recency(spark, sf_dir):
    r = E.feed_recency(V.v_entry_dates(spark, sf_dir), V.NOW)
    return r.select("feed", F.date_format("latest", "yyyy-MM-dd'T'HH:mm:ss").alias("latest"), "age_days",
                    "recency_bonus")


def _scored_blobs(spark, sf_dir):
    return R.relevance_score(V.v_blobs(spark, sf_dir), V.test_lexicon())


@register("relevance_score")
def q_relevance_score(spark, sf_dir):
    return _scored_blobs(spark, sf_dir).select("feed", "n_entries", "score")


@register("matched_keywords")
def q_matched_keywords(spark, sf_dir):
    return _scored_blobs(spark, sf_dir).select("feed", F.array_join("matched_keywords", ",").alias("matched"))


@register("suggest_category")
def q_suggest_category(spark, sf_dir):
    return _scored_blobs(spark, sf_dir).select("feed", "suggested_category")


def _raw_candidates(spark, sf_dir):
    bodies, feeds, entries = _parsed(spark, sf_dir)
    lex = V.test_lexicon()
    valid = E.valid_feeds(bodies, feeds).select("feed_url", "chunk")
    meta = E.feed_type(feeds.join(valid, ["feed_url", "chunk"], "left_semi"))
    meta = meta.groupBy("feed_url").agg(F.min_by(F.struct("title", "description", "language", "feed_type"),
                                                 F.col("chunk")).alias("m"))
    src = V.v_feed_sources(spark, sf_dir).select("feed_url", "site_url")
    meta = meta.join(src, "feed_url").select(
        "feed_url", "site_url", F.col("m.title").alias("title"), F.col("m.description").alias("description"),
        F.col("m.language").alias("language"), F.col("m.feed_type").alias("feed_type"),
        F.lit("common_path").alias("discovered_via"))
    scores = R.relevance_score(entries, lex, feed="feed_url")
    return K.assemble(meta, scores, V.NOW)


def _final_candidates(spark, sf_dir):
    c = K.site_dedup(_raw_candidates(spark, sf_dir))
    c = K.best_by_hash(K.min_score(c))
    known = K.known_urls(V.v_catalog(spark, sf_dir))
    return K.unknown_candidates(c, known)


@register("candidates")
def q_candidates(spark, sf_dir):
    c = R.candidate_bucket(_final_candidates(spark, sf_dir), V.test_lexicon())
    return c.select("feed_url", "site_url", "title", "feed_type", "score",
                    F.array_join("matched_keywords", ",").alias("matched"), "suggested_category", "url_hash",
                    "bucket", "bucket_label")


@register("site_dedup")
def q_site_dedup(spark, sf_dir):
    return K.site_dedup(_raw_candidates(spark, sf_dir)).select("feed_url", "site_url", "path_rank", "score")


@register("candidate_best")
def q_candidate_best(spark, sf_dir):
    return K.best_by_hash(_raw_candidates(spark, sf_dir)).select("url_hash", "feed_url", "score", "path_rank")


@register("known_urls")
def q_known_urls(spark, sf_dir):
    raw = V.v_catalog_dups(spark, sf_dir)
    return K.known_urls(raw.where(F.col("variant") == "original"), raw.where(F.col("variant") != "original"))


@register("unknown_candidates")
def q_unknown_candidates(spark, sf_dir):
    c = K.best_by_hash(_raw_candidates(spark, sf_dir))
    src = V.v_feed_sources(spark, sf_dir)
    known = K.known_urls(src.where(F.col("feed_url").contains("/rss.xml?")).select(F.col("feed_url").alias("url")))
    return K.unknown_candidates(c, known).select("url_hash", "feed_url")


def _seen(spark, sf_dir):
    """A seen cache derived from the raw candidates of the feeds of English pages."""
    c = K.best_by_hash(_raw_candidates(spark, sf_dir).where(F.col("feed_url").contains("/feed?")))
    return c.select("url_hash", "feed_url", "site_url", F.lit("old title").alias("title"),
                    F.lit(1700000000).cast("bigint").alias("last_seen_ts"), (F.col("score") - 1).alias("score"),
                    "feed_type", F.lit("kept").alias("note"))


@register("only_new")
def q_only_new(spark, sf_dir):
    return K.only_new(_final_candidates(spark, sf_dir), _seen(spark, sf_dir)).select("url_hash", "feed_url")


@register("seen_upsert")
def q_seen_upsert(spark, sf_dir):
    out = K.seen_upsert(_seen(spark, sf_dir), _final_candidates(spark, sf_dir), 1706745600)
    return out.select("url_hash", "feed_url", "title", "score", "last_seen_ts", "note")


def _review(spark, sf_dir):
    c = R.candidate_bucket(_final_candidates(spark, sf_dir), V.test_lexicon())
    return K.review_items(c)


@register("candidate_items")
def q_candidate_items(spark, sf_dir):
    c = K.candidate_items(_final_candidates(spark, sf_dir))
    return c.select("url", "category", "title", "type", "description")


@register("candidate_bucket")
def q_candidate_bucket(spark, sf_dir):
    c = R.candidate_bucket(_final_candidates(spark, sf_dir), V.test_lexicon())
    return c.select("url_hash", "bucket", "bucket_label")


@register("review_items")
def q_review_items(spark, sf_dir):
    r = _review(spark, sf_dir)
    return r.select("url", "category", "title", "type", "description", F.col("discovery.score").alias("score"),
                    F.col("discovery.url_hash").alias("url_hash"))


def _existing_bucket_items(spark, sf_dir):
    """Existing review files: the feeds of German pages already sit in the 'alpha-second' bucket."""
    src = V.v_feed_sources(spark, sf_dir)
    return src.where(F.col("feed_url").contains("/atom.xml?")).select(F.lit("alpha-second").alias("bucket"), F.col("feed_url").alias("url"))


@register("bucket_merge")
def q_bucket_merge(spark, sf_dir):
    return K.bucket_merge(_review(spark, sf_dir), _existing_bucket_items(spark, sf_dir)).select("url", "bucket")


@register("top_candidates")
def q_top_candidates(spark, sf_dir):
    items = K.bucket_merge(_review(spark, sf_dir), _existing_bucket_items(spark, sf_dir))
    return K.top_candidates(items).select("url", "bucket", F.col("discovery.score").alias("score"))


@register("review_record_names")
def q_review_record_names(spark, sf_dir):
    return K.review_record_names(_final_candidates(spark, sf_dir))


# --- renders and line lists ----------------------------------------------------------

from ..operators import render as W  # noqa: E402
from ..sources import lists as LS  # noqa: E402


@register("catalog_json_rows")
def q_catalog_json_rows(spark, sf_dir):
    return W.catalog_json_rows(C.catalog_dedup(items(spark, sf_dir)))


@register("opml_blocks")
def q_opml_blocks(spark, sf_dir):
    exp = C.export_dedup(C.clean_items(V.v_catalog_dups(spark, sf_dir), url_policy="export",
                                       blank_category="Uncategorized"))
    return W.opml_lines(exp).select("category", "part", "k_title", "ord", "line")


@register("markdown_rows")
def q_markdown_rows(spark, sf_dir):
    return W.markdown_rows(V.v_catalog_dups(spark, sf_dir))


@register("category_counts_markdown")
def q_category_counts_markdown(spark, sf_dir):
    return C.category_counts(V.v_catalog_dups(spark, sf_dir).withColumn(
        "category", F.when(F.col("variant") == "flipped", F.lit(None)).otherwise(F.col("category"))))


@register("category_files")
def q_category_files(spark, sf_dir):
    return W.category_files(V.v_catalog(spark, sf_dir).select(F.col("title").alias("category")))


@register("seed_urls")
def q_seed_urls(spark, sf_dir):
    lines = V.table(spark, sf_dir, "pages").select(F.col("page_id").alias("ord"), F.col("url").alias("line"))
    return LS.seed_urls(lines)


# --- streaming -----------------------------------------------------------------------

from ..streaming import health_stream as HS  # noqa: E402
from ..streaming import new_candidates as NC  # noqa: E402


@register("stream_health")
def q_stream_health(spark, sf_dir):
    state = HS.run_to_completion(spark, V.checks_of(V.stream_in_batches(spark, sf_dir, "events", "event_id")),
                                 buckets=8, block_runs=8)
    return state.select("url", "status", "consecutive_failures", _iso(F.col("down_since")).alias("down_since"),
                        _iso(F.col("last_seen_active")).alias("last_seen_active"))


@register("stream_new")
def q_stream_new(spark, sf_dir):
    seen = NC.run_to_completion(spark, V.sightings_of(V.stream_in_batches(spark, sf_dir, "events", "event_id")), buckets=16)
    return seen.select("url_hash", "feed_url", _iso(F.col("first_seen")).alias("first_seen"), "first_event")


@register("blocked_feeds")
def q_blocked_feeds(spark, sf_dir):
    sites = L.crawl_sites(V.v_links(spark, sf_dir))
    probes = L.probe_urls(sites)
    return L.blocked_feed_flags(probes, V.v_blocked_feeds(spark)).select("site_url", "feed_url", "blocked")


@register("review_order")
def q_review_order(spark, sf_dir):
    items = K.top_candidates(K.bucket_merge(_review(spark, sf_dir), _existing_bucket_items(spark, sf_dir)))
    return K.review_rank(items).select("bucket", "url", "rank")


@register("stream_health_state")
def q_stream_health_state(spark, sf_dir):
    from ..streaming import health_state as HK
    state = HK.run_to_completion(spark, V.checks_of(V.stream_table(spark, sf_dir, "events")))
    return state.select("url", "status", "consecutive_failures", _iso(F.col("down_since")).alias("down_since"),
                        _iso(F.col("last_seen_active")).alias("last_seen_active"))


from . import artifacts, chain  # noqa: E402, F401
