"""Benchmark decontamination: a prefix-filtered set join with exact verification.

A window is ``WINDOW`` consecutive words of a benchmark item (the whole item if it has fewer). Its
shingles of ``WIDTH`` words (or of the whole shorter window) are ordered by rarity, the number of
their occurrences in the documents. A document that contains the window contains all its shingles,
so the prefix that must meet is the rarest one alone. The join on it carries positions: the window's
start follows from the shingle's offset, must not lie before the document's first word, and the
window's length must fit; then the words themselves are compared. Documents cross the network only
as the runs of words that could belong to an item: a bitmap of the benchmark's shingles (a filter of
bounded size; false positives only cost rows) cuts them out while the text is read once.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z. Edge cases: null and empty texts
have no words and are clean; a null or empty item has no window; an item with a null id marks words
but isn't listed; equal ids are one item. Each document row gets its own result, repeated rows too.
An empty benchmark leaves all documents clean. Other columns are ignored.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import NOT_ALNUM, U64, WordHash, arrow_batch, binaries, bit_filter, column, mix, passes, small_batches, stage, with_row_id

WINDOW = 13
WIDTH = 5
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: bytes | None) -> list:
    return text.translate(_WORDS).split() if text else []


def hashes(h: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the runs of exactly ``width`` words."""
    n = max(len(h) - width + 1, 0)
    s = np.full(n, U64(width))
    for j in range(width):
        s = s * U64(0x9E3779B97F4A7C15) + h[j:j + n]
    return mix(s)


def item_windows(benchmark: DataFrame, window: int) -> DataFrame:
    """``item, words`` for each window of each item; the words are joined by blanks."""
    schema = T.StructType([T.StructField("item", T.StringType()), T.StructField("words", T.StringType())])

    def rows_of(batches):
        for b in batches:
            items, out = [], []
            for item, text in zip(column(b, "item").to_pylist(), binaries(b, "text")):
                ws = words_of(text)
                for i in range(max(len(ws) - window, 0) + 1 if ws else 0):
                    items.append(item)
                    out.append(b" ".join(ws[i:i + window]).decode("utf-8", "replace"))
            yield arrow_batch(schema, [items, out])

    cols = benchmark.select(F.col("item_id").cast("string").alias("item"), "text")
    return cols.mapInArrow(rows_of, schema).distinct()


def window_shingles(windows: DataFrame, width: int) -> DataFrame:
    """``words, n, width, offset, shingle`` for the distinct windows."""
    w = windows.select("words").distinct().withColumn("a", F.split("words", " ")).withColumn("n", F.size("a")) \
        .withColumn("width", F.least("n", F.lit(width)))
    at = F.posexplode(F.transform(F.sequence(F.lit(1), F.col("n") - F.col("width") + 1),
                                  lambda i: F.array_join(F.slice("a", i, F.col("width")), " "))).alias("offset", "shingle")
    return w.select("words", "n", "width", at)


def shingle_filter(shingles: DataFrame) -> tuple:
    """A bitmap of the shingles' hashes, and the widths that occur."""
    widths = sorted(r[0] for r in shingles.select("width").distinct().collect())  # at most WIDTH of them
    schema = T.StructType([T.StructField("h", T.LongType())])

    def rows_of(batches):
        known = WordHash(NOT_ALNUM)
        for b in batches:
            h = [known.of(s) for s in binaries(b, "shingle")]
            yield arrow_batch(schema, [np.array([hashes(x, len(x))[0] for x in h], U64).view(np.int64)])

    return bit_filter(shingles.select("shingle").mapInArrow(rows_of, schema), "h"), widths


def possible_runs(docs: DataFrame, filter_: tuple) -> DataFrame:
    """``rid, doc_id, n_words, runs``: the maximal runs of words whose shingles pass the filter."""
    run = T.StructType([T.StructField("width", T.IntegerType()), T.StructField("start", T.IntegerType()),
                        T.StructField("words", T.StringType())])
    schema = T.StructType([T.StructField("rid", T.LongType()), docs.schema["doc_id"], T.StructField("n_words", T.LongType()),
                           T.StructField("runs", T.ArrayType(run))])
    shared = docs.sparkSession.sparkContext.broadcast(filter_)

    def rows_of(batches):
        possible, widths = shared.value
        known = WordHash(NOT_ALNUM)
        for b in batches:
            counts, runs = [], []
            for text in binaries(b, "text"):
                h, low, high = known.spans(text)
                own = []
                for width in widths:
                    at = np.flatnonzero(passes(possible, hashes(h, width)))
                    if len(at):
                        cut = np.flatnonzero(np.diff(at) > 1) + 1
                        for s in np.split(at, cut):
                            words = b" ".join(words_of(text[low[s[0]]:high[s[-1] + width - 1]]))
                            own.append({"width": width, "start": int(s[0]), "words": words.decode("utf-8", "replace")})
                counts.append(len(h))
                runs.append(own)
            yield arrow_batch(schema, [column(b, "rid"), column(b, "doc_id"), counts, runs])

    return docs.mapInArrow(rows_of, schema)


def prefix_places(runs: DataFrame, filter_: tuple, window: int) -> DataFrame:
    """``rid, n_words, shingle, pos, lead, near`` for the places of runs whose shingle passes the bitmap of the
    prefixes; ``near`` holds the words around a place, which it begins ``lead`` words into."""
    schema = T.StructType([*(T.StructField(c, T.LongType()) for c in ("rid", "n_words")), T.StructField("shingle", T.StringType()),
                           *(T.StructField(c, T.IntegerType()) for c in ("pos", "lead")), T.StructField("near", T.ArrayType(T.StringType()))])
    shared = runs.sparkSession.sparkContext.broadcast(filter_)

    def rows_of(batches):
        hashed = WordHash(NOT_ALNUM)
        for b in batches:
            texts, starts = binaries(b, "words"), column(b, "start").to_pylist()
            widths = column(b, "width").to_numpy()
            ends = np.cumsum([t.count(b" ") + 1 for t in texts]).astype(np.int64)  # of the runs, in one row of words
            h = hashed.of(b" ".join(texts))
            row, out = [], []
            for width in np.unique(widths).tolist():
                at = np.flatnonzero(passes(shared.value, hashes(h, width)))
                of = np.searchsorted(ends, at, "right")
                own = (widths[of] == width) & (at + width <= ends[of])
                last, ws = -1, []
                for k, place in zip(of[own].tolist(), at[own].tolist()):
                    if k != last:
                        last, ws = k, texts[k].decode("utf-8", "replace").split(" ")
                    i = place - int(ends[k]) + len(ws)
                    low = max(i + width - window, 0)
                    row.append(k)
                    out.append((" ".join(ws[i:i + width]), starts[k] + i, i - low, ws[low:low + 2 * window]))
            at = pa.array(row, pa.int64())
            yield arrow_batch(schema, [column(b, "rid").take(at), column(b, "n_words").take(at), *([r[c] for r in out] for c in range(4))])

    return runs.select("rid", "n_words", "width", "start", "words").mapInArrow(rows_of, schema)


def covered(spans: str) -> Column:
    """Words inside at least one of the spans, which are sorted by start."""
    zero = F.lit(0).cast("long")
    fold = F.aggregate(spans, F.struct(zero.alias("n"), zero.alias("to")), lambda a, s: F.struct(
        (a["n"] + F.greatest(s["end"] - F.greatest(s["start"], a["to"]), zero)).alias("n"),
        F.greatest(a["to"], s["end"]).alias("to")))
    return fold["n"]


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, width: int = WIDTH) -> DataFrame:
    """One row for each of ``docs``: ``rid, doc_id, n_words, n_hit, spans, items``.

    ``spans`` are the hit stretches by start (they may overlap), ``items`` the sorted ids of the items with a
    window in the document.
    """
    small_batches(docs.sparkSession)
    windows = stage(item_windows(benchmark, window), "windows")
    shingles = stage(window_shingles(windows, width), "shingles")
    d = stage(possible_runs(with_row_id(docs, "doc_id", "text"), shingle_filter(shingles)), "runs")
    runs = d.where(F.size("runs") > 0).select("rid", "n_words", F.explode("runs").alias("r")) \
        .select("rid", "n_words", "r.width", "r.start", "r.words", F.split("r.words", " ").alias("ws"))
    known = shingles.select("shingle").distinct()
    rarity = runs.select(F.explode(F.transform(F.sequence(F.lit(1), F.size("ws") - F.col("width") + 1), lambda i: F.array_join(
        F.slice("ws", i, F.col("width")), " "))).alias("shingle")).groupBy("shingle").agg(F.count("*").alias("freq")).join(known, "shingle")
    # a window with a shingle that no document has can't occur: its join partner is missing
    rarest = shingles.join(rarity, "shingle", "left") \
        .groupBy("words", "n").agg(F.min(F.struct(F.coalesce("freq", F.lit(0)).alias("freq"), "shingle", "offset", "width")).alias("p")) \
        .where("p.freq > 0").select("words", "n", "p.shingle", "p.offset", "p.width")
    rarest = stage(rarest, "prefix")
    found = prefix_places(runs, shingle_filter(rarest)[0], window)
    first = F.col("lead") - F.col("offset")
    hits = found.join(rarest, "shingle") \
        .where((F.col("pos") >= F.col("offset")) & (F.col("pos") - F.col("offset") + F.col("n") <= F.col("n_words"))
               & (first >= 0) & (F.size("near") >= first + F.col("n"))) \
        .where(F.array_join(F.slice("near", F.greatest(first, F.lit(0)) + 1, F.col("n")), " ") == F.col("words")) \
        .select("rid", (F.col("pos") - F.col("offset")).alias("start"), "n", "words")
    hits = stage(hits, "hits")
    spans = hits.groupBy("rid", "start").agg(F.max("n").alias("n")).groupBy("rid").agg(F.array_sort(F.collect_list(
        F.struct(F.col("start").cast("long").alias("start"), (F.col("start") + F.col("n")).cast("long").alias("end")))).alias("spans"))
    items = hits.select("rid", "words").distinct().join(windows.where("item is not null"), "words") \
        .groupBy("rid").agg(F.array_sort(F.collect_set("item")).alias("items"))
    return d.drop("runs").join(spans, "rid", "left").join(items, "rid", "left") \
        .withColumns({"spans": F.coalesce("spans", F.array().cast("array<struct<start:bigint,end:bigint>>")),
                      "items": F.coalesce("items", F.array().cast("array<string>"))}) \
        .select("rid", "doc_id", "n_words", covered("spans").alias("n_hit"), "spans", "items")


def is_contaminated():
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def op1(spark, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return decontaminate(docs, benchmark).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), is_contaminated().alias("contaminated"))
