"""Relevance scoring and classification.

Everything is a native expression: keywords (substring containment) and
category rules (ordered ``rlike`` tests) are tested entry by entry, as bits
of a few longs that meet per feed in a partial ``bit_or``; no text is
gathered or shuffled. Buckets are an ordered ``when``.
"""
from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip_ws
from ..lexicon import BUCKET_LABELS, DEFAULT_LEXICON, Lexicon, SAMPLE_ENTRIES
from .entries import entry_array, feed_recency, feed_type, feeds_of, first_entries, parse_date, recency_bonus

WORD = r"\p{L}\p{N}_"


def word_boundaries(pattern: str) -> str:
    """Rewrite a leading/trailing ``\\b`` next to a word character as an explicit
    Unicode non-word-or-edge class, so Java regex and RE2 agree with a
    Unicode-aware search (only valid for tests of a match, not of its span)."""
    p = re.sub(r"^\\b", lambda m: f"(?:^|[^{WORD}])", pattern)
    return re.sub(r"\\b$", lambda m: f"(?:$|[^{WORD}])", p)


def category_rules_regex(lex: Lexicon) -> list[tuple[str, str]]:
    return [(cat, "(?i)" + "|".join(f"(?:{word_boundaries(p)})" for p in pats)) for cat, pats in lex.category_rules]


BITS = 62


def _hit_masks(text, tests: list) -> list[F.Column]:
    """One long for each ``BITS`` of ``tests`` (functions of ``text``); bit i is set where test i holds."""
    zero = F.lit(0).cast("long")
    return [reduce(lambda acc, t: acc.bitwiseOR(F.when(t[1](text), F.lit(1 << t[0]).cast("long")).otherwise(zero)),
                   enumerate(tests[at:at + BITS]), zero) for at in range(0, len(tests), BITS)]


def _contains(word: str):
    return lambda text: text.contains(word)


def _matches(regex: str):
    return lambda text: text.rlike(regex)


def _tests(lex: Lexicon) -> dict:
    """The tests on an entry's text by kind: keywords, negative keywords and category rules."""
    return {"hits": [_contains(k) for k, _ in lex.weights()], "negs": [_contains(k) for k in lex.negative],
            "rules": [_matches(rx) for _, rx in category_rules_regex(lex)]}


def _entry_text(title, summary) -> F.Column:
    blank = F.lit("")
    return F.lower(F.concat_ws(" ", F.coalesce(strip_ws(title), blank), F.coalesce(strip_ws(summary), blank)))


def _indexes(kind: str, n: int) -> F.Column:
    """The tests of a kind that hold, from its masks."""
    return F.filter(F.array(*[F.when(F.getbit(f"__{kind}{i // BITS}", F.lit(i % BITS)) == 1, F.lit(i)) for i in range(n)])
                    .cast("array<int>"), lambda i: i.isNotNull()).alias(kind)


def entry_hits(entries: DataFrame, lex: Lexicon = DEFAULT_LEXICON, feed: str = "feed") -> DataFrame:
    """Per feed: ``n_entries`` and the indexes ``hits``, ``negs`` and ``rules`` of the keywords, negative
    keywords and category rules that at least one entry matches.

    Every entry counts. Tests run on each entry's lower('title summary') alone, so a phrase that spans two
    entries is no hit; what is grouped is a few longs, combined map-side with ``bit_or``, whatever a feed holds.
    """
    kinds = _tests(lex)
    df = entries.select(feed, _entry_text(F.col("title"), F.col("summary")).alias("__text"))
    masks = {kind: _hit_masks(F.col("__text"), tests) for kind, tests in kinds.items()}
    df = df.select(feed, *[m.alias(f"__{kind}{i}") for kind, ms in masks.items() for i, m in enumerate(ms)])
    g = df.groupBy(feed).agg(F.count(F.lit(1)).alias("n_entries"), *[F.bit_or(c).alias(c) for c in df.columns if c != feed])

    return g.select(feed, "n_entries", *[_indexes(kind, len(tests)) for kind, tests in kinds.items()])


def scored_feeds(parsed: DataFrame, lex: Lexicon = DEFAULT_LEXICON, now: str | None = None, key: str = "feed_url",
                 max_entries: int | None = None, max_keywords: int | None = None, sample: int = SAMPLE_ENTRIES) -> DataFrame:
    """E15-E18, B21 and B22 row by row: (key, title, description, language, feed_type, n_entries, latest,
    entries_sample, score, matched_keywords, suggested_category) of parsed bodies.

    A body's entries are folded where they were parsed, into bit masks, a latest time and a sample of ``sample``
    entries (title, link, published or else updated); nothing is exploded. Bodies of one feed (chunks) meet in one
    aggregate of those few values; title, type and sample are those of its first body. ``max_entries`` counts in a body.
    """
    kinds = _tests(lex)
    entries = entry_array()
    if max_entries is not None:
        entries = F.slice(entries, 1, max_entries)
    meta = feed_type(feeds_of(parsed.withColumn("__entries", entries), key, keep=("__entries",)), key)
    flat = [(f"__{kind}{i}", kind, i) for kind, tests in kinds.items() for i in range(-(-len(tests) // BITS))]
    zero = F.lit(0).cast("long")

    def fold(acc, e):
        masks = {kind: _hit_masks(_entry_text(e["title"], e["summary"]), tests) for kind, tests in kinds.items()}
        return F.struct(*[acc[name].bitwiseOR(masks[kind][i]).alias(name) for name, kind, i in flat])

    masks = F.aggregate("__entries", F.struct(*[zero.alias(name) for name, _, _ in flat]), fold)
    latest = F.array_max(F.transform("__entries", lambda e: F.date_trunc("second", F.greatest(parse_date(e["published"]), parse_date(e["updated"])))))
    first = F.transform(F.slice("__entries", 1, sample), lambda e: F.struct(
        strip_ws(e["title"]).alias("title"), strip_ws(e["link"]).alias("link"),
        strip_ws(F.coalesce(F.nullif(e["published"], F.lit("")), e["updated"])).alias("published")))
    df = meta.select(key, "chunk", "title", "description", "language", "feed_type", F.size("__entries").cast("long").alias("n"),
                     latest.alias("latest"), first.alias("entries_sample"), masks.alias("m"))
    about = ["title", "description", "language", "feed_type", "entries_sample"]
    g = df.groupBy(key).agg(F.min_by(F.struct(*about), F.col("chunk")).alias("a"), F.sum("n").alias("n_entries"), F.max("latest").alias("latest"),
                            *[F.bit_or(f"m.{name}").alias(name) for name, _, _ in flat])
    g = g.select(key, "a.*", "n_entries", "latest", *[_indexes(kind, len(tests)) for kind, tests in kinds.items()])
    if now is not None:
        g = g.withColumn("recency_bonus", recency_bonus(F.col("latest"), now)[1])
    return score_hits(g, lex, feed=key, max_keywords=max_keywords)


def score_hits(found: DataFrame, lex: Lexicon = DEFAULT_LEXICON, recency: DataFrame | None = None,
               feed: str = "feed", max_keywords: int | None = None) -> DataFrame:
    """Score, matched keywords (distinct, sorted; all, or the first ``max_keywords``), category
    (the first rule with a matching entry) from ``entry_hits``."""
    kws = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(w).alias("w")) for k, w in lex.weights()])
    cats = F.array(*[F.lit(c) for c, _ in lex.category_rules]) if lex.category_rules else F.array().cast("array<string>")
    df = found.withColumns({"__hits": F.transform("hits", lambda i: F.get(kws, i)), "__neg": F.size("negs")})
    df = df.withColumns({
        "__base": F.aggregate("__hits", F.lit(0), lambda acc, x: acc + x["w"]),
        "__uniq": F.array_distinct(F.transform("__hits", lambda x: x["k"])),
    })
    n = F.size("__uniq")
    density = F.when(n >= 10, F.lit(5)).when(n >= 6, F.lit(2)).otherwise(F.lit(0))
    freq = F.when(F.col("n_entries") >= 10, F.lit(2)).otherwise(F.lit(0))
    negp = F.when(F.col("__neg") >= 2, -2 * F.col("__neg")).otherwise(F.lit(0))
    if recency is not None:
        df = df.join(recency.select(feed, "recency_bonus"), feed, "left")
    rec = F.coalesce(F.col("recency_bonus"), F.lit(0)) if "recency_bonus" in df.columns else F.lit(0)
    df = df.withColumns({
        "score": (F.col("__base") + density + rec + freq + negp).cast("int"),
        "matched_keywords": F.slice(F.array_sort("__uniq"), 1, max_keywords) if max_keywords else F.array_sort("__uniq"),
        "suggested_category": F.coalesce(F.get(cats, F.get("rules", F.lit(0))), F.lit(lex.default_category)),
    })
    return df.drop("hits", "negs", "rules", "__hits", "__neg", "__base", "__uniq",
                   *(["recency_bonus"] if "recency_bonus" in df.columns else []))


def relevance_score(entries: DataFrame, lex: Lexicon = DEFAULT_LEXICON, now: str | None = None, feed: str = "feed",
                    max_keywords: int | None = None, max_entries: int | None = None) -> DataFrame:
    """E15 end to end: all entries of a feed, or its first ``max_entries`` -> hits -> score (+ recency when
    dated and ``now`` given)."""
    if max_entries is not None:
        entries = first_entries(entries, max_entries, feed=feed)
    rec = None
    if now is not None and "published_ts" in entries.columns:
        rec = feed_recency(entries, now, feed=feed)
    return score_hits(entry_hits(entries, lex, feed), lex, rec, feed=feed, max_keywords=max_keywords)


def candidate_bucket(df: DataFrame, lex: Lexicon = DEFAULT_LEXICON, canonical_labels: bool = False) -> DataFrame:
    """Review bucket from the ordered substring cascade, and its label."""
    cat = F.lower(strip_ws("suggested_category"))
    blob = F.lower(F.concat_ws(" ", F.coalesce(F.col("title"), F.lit("")), F.coalesce(F.col("description"), F.lit("")),
                               F.coalesce(F.col("site_url"), F.lit("")),
                               F.array_join(F.coalesce(F.col("matched_keywords"), F.array().cast("array<string>")), " "),
                               cat))
    df = df.withColumns({"__blob": blob, "__cat": cat})
    out = F.lit(lex.default_bucket)
    for kind, bucket, words in reversed(lex.bucket_rules):
        target = F.col("__blob") if kind == "blob" else F.col("__cat")
        cond = F.lit(False)
        for w in words:
            cond = cond | target.contains(w)
        out = F.when(cond, F.lit(bucket)).otherwise(out)
    labels = dict(BUCKET_LABELS)
    if canonical_labels:
        from ..lexicon import CANONICAL_BUCKET_LABELS
        labels.update(dict(CANONICAL_BUCKET_LABELS))
    lmap = F.create_map(*[x for kv in labels.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    df = df.withColumn("bucket", out)
    return df.withColumn("bucket_label", F.coalesce(F.try_element_at(lmap, F.col("bucket")),
                                                    F.col("suggested_category"))).drop("__blob", "__cat")
