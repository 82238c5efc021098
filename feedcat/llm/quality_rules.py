"""Quality rules by cross-document line frequency, DataFrame functions only.

Per document: word and symbol counts, repeated lines and words inside repeated 5-word windows; a
document with fewer than 10 words, or with over 20 % of its words in repeated windows, fails. Across
documents: lines are normalised (white space folded, lower case) and hashed, each host's distinct
documents with a line are counted, lines in more than ``MAX_DOCS`` documents of a host are removed
there, and a document that keeps less than ``MIN_LEFT`` of its characters in words is depleted and
rejected. The text without the removed lines is ``clean_text``; the query's columns come from it.

Edge cases: a null or empty text has no words and fails, and stays as it is. A null host is a host of its own. A line is
counted once for each row it occurs in, so repeated rows count as documents. Lines without a word are
never counted. Other columns are ignored.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage, with_row_id

#: A line may occur in so many documents of one host.
MAX_DOCS = 50
#: Share of its word characters that a document must keep.
MIN_LEFT = 0.5
#: So many bad lines go along with the plan; more are joined.
FEW = 50_000
WINDOW = 5
SPACE = r"[ \t\n\x0b\f\r]+"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def let(value: Column, body) -> Column:
    """``body`` of a value that is evaluated once for each row."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def repeated_words(hashes: Column) -> Column:
    """Words inside windows that occur twice or more; ``hashes`` are the words' hashes."""
    n = F.size(hashes)

    def window(i):
        return F.xxhash64(*[F.get(hashes, i + j) for j in range(WINDOW)])

    def covered(spots):  # sorted (hash, position) of every window
        last = F.size(spots) - 1
        again = F.filter(spots, lambda s, i: ((i > 0) & (F.get(spots, i - 1)["h"] == s["h"]))
                         | ((i < last) & (F.get(spots, i + 1)["h"] == s["h"])))
        return let(F.array_sort(F.transform(again, lambda s: s["at"])), lambda at: F.aggregate(
            F.transform(at, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(at, i + 1) - p, F.lit(WINDOW)))),
            F.lit(0), lambda a, x: a + x))

    def of(windows):
        spots = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(let(spots, covered))

    return F.when(n < WINDOW + 1, F.lit(0)).otherwise(
        let(F.transform(F.sequence(F.lit(0), n - WINDOW), window), of))


def base_counts(docs: DataFrame, *more: str) -> DataFrame:
    """``rid, doc_id`` and the columns ``more`` with the per-document counts."""
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select("rid", "doc_id", text.alias("text"), words(text).alias("ws"), own_lines().alias("ls"), *more)
    d = d.select(
        "rid", "doc_id", F.size("ws").cast("long").alias("n_words"),
        F.length(F.array_join("ws", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("ls") - F.size(F.array_distinct("ls"))).cast("long").alias("n_dup_lines"),
        let(F.transform("ws", lambda w: F.xxhash64(w)), repeated_words).cast("long").alias("n_repeat_words"), *more)
    return d.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))


def own_lines() -> Column:
    """The text's lines that hold a word."""
    return F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: x.rlike(r"[^ \t\n\x0b\f\r]"))


def line_key(line: Column) -> Column:
    """Hash of the host and the normalised line."""
    return F.xxhash64(F.coalesce("source", F.lit("\0none")), F.lower(F.trim(F.regexp_replace(line, SPACE, " "))))


def _lines() -> Column:
    return F.split("text", "\n")


def _keys(lines: Column) -> Column:
    """Each line's key, null for one without a word."""
    return F.transform(lines, lambda x: F.when(x.rlike(r"[^ \t\n\x0b\f\r]"), line_key(x)))


def _without(lines: Column, hit: Column) -> Column:
    """The text without the lines whose place in ``hit`` is true; the text itself if there is none."""
    kept = F.filter(lines, lambda x, i: ~F.get(hit, i))
    return F.when(F.exists(hit, lambda h: h), F.array_join(kept, "\n")).otherwise(F.col("text"))


def cleaned(docs: DataFrame, bad: DataFrame, few: int = FEW) -> DataFrame:
    """``docs`` with ``clean_text``: the text without its lines whose keys are in ``bad (line)``; lines without a word stay.

    Up to ``few`` bad lines go along with the plan as a set, and every text is cut where it was read. Beyond that
    the bad lines meet the documents' lines in a join, and their documents' texts; both ways are exact."""
    if bad.limit(few + 1).count() <= few:
        found = [str(r["line"]) for r in bad.collect()]  # at most `few` numbers
        if not found:
            return docs.withColumn("clean_text", F.col("text"))
        hit = F.expr(f"transform(__keys, k -> coalesce(k IN ({', '.join(found)}), false))")
        cut = docs.withColumn("__keys", _keys(_lines())).withColumn("__hit", hit)
    else:
        lines = docs.select("rid", F.explode(F.array_distinct(F.transform(own_lines(), line_key))).alias("line"))
        gone = stage(lines.join(bad, "line").groupBy("rid").agg(F.collect_set("line").alias("__gone")), "gone")
        cut = docs.join(gone, "rid", "left").withColumn("__hit", F.transform(
            _keys(_lines()), lambda k: F.coalesce(F.array_contains(F.coalesce("__gone", F.array().cast("array<bigint>")), k), F.lit(False)))).drop("__gone")
        cut = cut.withColumn("__keys", F.lit(None))
    return cut.withColumn("clean_text", _without(_lines(), F.col("__hit"))).drop("__keys", "__hit")


def quality(docs: DataFrame, max_docs: int = MAX_DOCS, min_left: float = MIN_LEFT, few: int = FEW) -> DataFrame:
    """The counts (of the whole text), ``dropped_chars`` (word characters in lines above the limit), ``kept``, and
    ``clean_text``: the text without those lines."""
    docs = with_row_id(docs, "doc_id", "text", "source")
    counts = docs.select(F.explode(F.array_distinct(F.transform(own_lines(), line_key))).alias("line")) \
        .groupBy("line").agg(F.count("*").alias("n"))
    bad = stage(counts.where(F.col("n") > max_docs).select("line"), "lines")
    clean = cleaned(docs, bad, few)
    left = F.length(F.regexp_replace(F.coalesce("clean_text", F.lit("")), SPACE, "")).cast("long")
    out = base_counts(clean, "clean_text").withColumn("left", left) \
        .withColumn("dropped_chars", F.col("word_chars") - F.col("left")) \
        .withColumn("kept", ~F.col("base_failed") & (F.col("left") >= min_left * F.col("word_chars")))
    return out.select("doc_id", *COUNTS, "dropped_chars", "kept", "clean_text")


def op4(spark, docs: DataFrame) -> DataFrame:
    return quality(docs).drop("clean_text")
