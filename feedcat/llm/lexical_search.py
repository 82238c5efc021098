"""Ranked lexical search over hashed max-sketches.

Terms are hashed to ``2**SPREAD`` coordinates, and every document's sketch keeps, for each coordinate it has, the largest
term frequency of the terms in it. A document's impact of a term grows with the frequency, so this is the coordinatewise
maximum of its impacts; kept as frequencies (up to 254, beyond that the impact's limit is taken) the index depends on
neither the corpus' counts nor the queries. Queries go in batches: a batch of documents looks all of their terms up at
once as a product of two matrices, impacts by coordinate and weights by query. A sum over the maxima is never below the
score, so it bounds it.

Exact scores follow by descending bound. The documents of the highest bounds are scored first; the K-th best of
their scores is the query's threshold, and what remains to be scored are the documents whose bound reaches it (equal to it counts, for ties).
No other document can be among the first K, so results are exact whatever the sketches' width.

A text is scored once, however often it occurs: rows are named by 128 bits of their text's hash, and only its first K
ids matter. Texts are looked up by a bitmap of the names asked for before they are moved, so no other text is shuffled. Items are
a stated query set against all rows; they go to the executors in blocks of about ``ITEM_BYTES``, cut by a hash of the row.

Score: terms are the maximal matches of ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+`` with A-Z lower-cased; N counts the
documents with a term, L all terms, n a document's; ``w = floor(1000 ln((2N+2)/(2df+1)))``, ``m = 10 + 90nN div L``, and
a term adds ``w * (10**9 tf div (1000 tf + 8m))`` to the score of each document that holds it. Bounds and scores are whole
numbers below 2**53, so the product in doubles is exact. Sketches and document frequencies compare 64-bit hashes of terms, scores the terms.

Edge cases: a null text, and one without a term, is no document of N and in no result; an item without terms, or without
a document that scores above 0, has no rows. Rows of equal ids are documents of their own, a null id comes after all
others in a tie; rows with equal ids and texts share a score and take a rank each. Each row of the items is a query of
its own. Long texts are hashed in pieces. Other columns are ignored; empty tables give no rows.
"""
from __future__ import annotations

import math
import re

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import (NOT_ALNUM, U64, WordHash, arrow_batch, binaries, bit_filter, column, drop_stage, passes, small_batches,
                     stage)

K = 10
#: Coordinates of a sketch, as a power of two.
SPREAD = 16
#: Documents of each query that set its threshold, by descending bound.
FIRST = 48
#: Text of the items that is searched for at once.
ITEM_BYTES = 1 << 18
#: A frequency of this stands for itself and all above.
MANY = 255

_TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_LONG = T.LongType()


def _fields(*names, more=()):
    return T.StructType([T.StructField(n, _LONG) for n in names] + list(more))


def named(docs: DataFrame, *cols: str) -> DataFrame:
    """The rows with a text and the 128 bits ``t0, t1`` that name it."""
    return docs.where("text is not null").select(*cols, F.xxhash64("text").alias("t0"), F.xxhash64(F.lit(1), "text").alias("t1"), "text")


def sketches(docs: DataFrame, spread: int = SPREAD) -> DataFrame:
    """``doc_id, t0, t1, n, coords, tops`` of each document with a term: the coordinates it has and their maxima."""
    schema = T.StructType([docs.schema["doc_id"], *_fields("t0", "t1", "n", more=[
        T.StructField(c, T.BinaryType()) for c in ("coords", "tops")])])

    def rows_of(batches):
        known = WordHash(NOT_ALNUM)
        for b in batches:
            got = []
            for text in binaries(b, "text"):
                h, tf = np.unique(known.of(text), return_counts=True)
                coords = (h >> U64(64 - spread)).astype(np.uint16)
                at = np.flatnonzero(np.diff(coords.astype(np.int64), prepend=-1))  # hashes are sorted, and so are coordinates
                tops = np.minimum(np.maximum.reduceat(tf, at), MANY) if len(at) else tf
                got.append((int(tf.sum()), coords[at].tobytes(), tops.astype(np.uint8).tobytes()))
            n, coords, tops = zip(*got) if got else ((), (), ())
            yield arrow_batch(schema, [column(b, "doc_id"), column(b, "t0"), column(b, "t1"), list(n), list(coords), list(tops)])

    return named(docs, "doc_id").mapInArrow(rows_of, schema).where("n > 0")


def frequencies(docs: DataFrame, hashes: np.ndarray) -> dict:
    """Documents that hold each of the sorted ``hashes``, by place; counted by the tasks before they are shuffled."""
    schema = _fields("term", "df")

    def counts(batches):
        known, df = WordHash(NOT_ALNUM), np.zeros(len(hashes) + 1, np.int64)
        for b in batches:
            for text in binaries(b, "text"):
                at = np.searchsorted(hashes, h := known.of(text))
                at[at == len(hashes)] = 0
                df[np.unique(at[hashes[at] == h])] += 1
        yield arrow_batch(schema, [held := np.flatnonzero(df).tolist(), df[held].tolist()])

    got = docs.where("text is not null").select("text").mapInArrow(counts, schema).groupBy("term").agg(F.sum("df").alias("df"))
    return {r["term"]: r["df"] for r in got.collect()}  # a row for each term of the items' block


def impact(tf: int, m: int) -> int:
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


class Queries:
    """Weighted terms of a block of items and the corpus' counts."""

    def __init__(self, texts: list, docs: DataFrame, total: tuple, spread: int) -> None:
        self.n_docs, self.n_terms = total
        own = [sorted({t.lower() for t in _TERM.findall((x or "").encode())}) for x in texts]
        known = WordHash(NOT_ALNUM)
        by_hash = {int(known.of(t)[0]): t for ts in own for t in ts}
        hashes = np.array(sorted(by_hash), U64)
        df = frequencies(docs, hashes) if len(hashes) else {}
        # a term that no document holds adds nothing
        weights = {by_hash[int(hashes[at])]: math.floor(1000 * math.log((2 * self.n_docs + 2) / (2 * k + 1))) for at, k in df.items()}
        self.terms = [{t: weights[t] for t in ts if t in weights} for ts in own]
        self.vocabulary = frozenset(weights)
        coord = {t: h >> (64 - spread) for h, t in by_hash.items()}
        used = sorted({coord[t] for t in self.vocabulary})
        self.place = np.full(1 << spread, -1, np.int64)
        self.place[used] = np.arange(len(used))
        self.weights = np.zeros((len(used), len(texts)))
        for q, ts in enumerate(self.terms):
            for t, w in ts.items():
                self.weights[self.place[coord[t]], q] += w

    def m(self, n: int) -> int:
        return 10 + 90 * n * self.n_docs // self.n_terms

    def bounds(self, batch) -> np.ndarray:
        """Upper bounds of the scores, a row for each document of the batch, a column for each query."""
        coords, tops = batch.column("coords").to_pylist(), batch.column("tops").to_pylist()
        held = np.fromiter(map(len, tops), np.int64, len(tops))
        at = self.place[np.frombuffer(b"".join(coords), np.uint16)]
        tf = np.frombuffer(b"".join(tops), np.uint8).astype(np.int64)
        m = np.repeat(np.array([self.m(n) for n in batch.column("n").to_pylist()], np.int64), held)
        most = np.where(tf < MANY, 1_000_000_000 * tf // (1000 * tf + 8 * m), 1_000_000)
        dense, asked = np.zeros((len(tops), len(self.weights))), at >= 0
        dense[np.repeat(np.arange(len(tops)), held)[asked], at[asked]] = most[asked]
        return dense @ self.weights

    def scores(self, text: bytes, asked: list) -> list:
        tf, n = dict.fromkeys(self.vocabulary, 0), 0
        for t in _TERM.finditer(text):
            n += 1
            t = t.group().lower()
            if t in tf:
                tf[t] += 1
        m = self.m(n)
        return [sum(w * impact(tf[t], m) for t, w in self.terms[q].items() if tf[t]) for q in asked]


PAIR = _fields("q", "t0", "t1", "bound")


def highest(index: DataFrame, queries: Queries, k: int) -> DataFrame:
    """For each query the texts of the ``k`` highest bounds: those of each task, then of all."""
    def scan(batches):
        bound = names = None
        for b in batches:
            x = queries.bounds(b)
            t = np.stack([b.column(c).to_numpy() for c in ("t0", "t1")], axis=1)[:, None, :].repeat(x.shape[1], axis=1)
            if bound is not None:
                x, t = np.concatenate([bound, x]), np.concatenate([names, t])
            top = np.argpartition(-x, k, axis=0)[:k] if len(x) > k else np.arange(len(x))[:, None].repeat(x.shape[1], axis=1)
            bound, names = np.take_along_axis(x, top, 0), np.take_along_axis(t, top[:, :, None], 0)
        if bound is not None:
            i, q = np.nonzero(bound > 0)
            yield arrow_batch(PAIR, [q.tolist(), names[i, q, 0].tolist(), names[i, q, 1].tolist(), bound[i, q].astype(np.int64).tolist()])

    order = Window.partitionBy("q").orderBy(F.desc("bound"), "t0", "t1")
    cols = [c for c in index.columns if c != "doc_id"]
    return index.select(*cols).mapInArrow(scan, PAIR).withColumn("at", F.row_number().over(order)).where(F.col("at") <= k).drop("at")


def reaching(index: DataFrame, queries: Queries, thresholds: np.ndarray) -> DataFrame:
    """All texts whose bound reaches their query's threshold and is above 0."""
    def scan(batches):
        for b in batches:
            x = queries.bounds(b)
            i, q = np.nonzero(x >= np.maximum(thresholds, 1))
            t0, t1 = b.column("t0").to_numpy(), b.column("t1").to_numpy()
            yield arrow_batch(PAIR, [q.tolist(), t0[i].tolist(), t1[i].tolist(), x[i, q].astype(np.int64).tolist()])

    cols = [c for c in index.columns if c != "doc_id"]
    return index.select(*cols).mapInArrow(scan, PAIR)


def rescored(docs: DataFrame, pairs: DataFrame, queries: Queries) -> DataFrame:
    """``q, t0, t1, score`` of the pairs' texts, exact and above 0, staged; the pairs go."""
    pairs = stage(pairs, "bounds")
    asked = stage(pairs.groupBy("t0", "t1").agg(F.collect_set("q").alias("qs")), "asked")  # at most the block's queries
    drop_stage(pairs)
    held = bit_filter(asked, "t0")
    text_schema = _fields("t0", "t1", more=[T.StructField("text", T.StringType())])
    score_schema = _fields("q", "t0", "t1", "score")

    def wanted(batches):
        import pyarrow as pa
        for b in batches:
            yield b.filter(pa.array(passes(held, b.column("t0").to_numpy().view(U64))))

    def score(batches):
        for b in batches:
            out = [[], [], [], []]
            for text, t0, t1, qs in zip(binaries(b, "text"), *(b.column(c).to_pylist() for c in ("t0", "t1", "qs"))):
                for q, s in zip(qs, queries.scores(text, qs)):
                    if s > 0:
                        for col, x in zip(out, (q, t0, t1, s)):
                            col.append(x)
            yield arrow_batch(score_schema, out)

    texts = named(docs).select("t0", "t1", "text").mapInArrow(wanted, text_schema)
    once = texts.groupBy("t0", "t1").agg(F.first("text").alias("text"))
    got = stage(once.join(asked, ["t0", "t1"]).select("t0", "t1", "qs", "text").mapInArrow(score, score_schema), "scores")
    drop_stage(asked)
    return got


def best(scores: DataFrame, ids: DataFrame, k: int) -> DataFrame:
    """``q, rank, doc_id, score`` of the first ``k`` rows of each query; ``ids`` has the first ``k`` ids of each text."""
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return scores.join(ids, ["t0", "t1"]).select("q", "doc_id", "score", F.row_number().over(order).alias("rank")).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = K, spread: int = SPREAD, first: int = FIRST,
           item_bytes: int = ITEM_BYTES) -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's first ``k`` documents."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select("doc_id", "text")
    items = items.select("item_id", "text").where("text is not null")
    index = stage(sketches(docs, spread), "sketches")
    order = Window.partitionBy("t0", "t1").orderBy(F.asc_nulls_last("doc_id"))
    ids = stage(index.select("t0", "t1", "doc_id").withColumn("at", F.row_number().over(order)).where(F.col("at") <= k).drop("at"), "ids")
    total = index.agg(F.count("*"), F.sum("n")).first()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts, found = -(-size // item_bytes), []
    for part in range(parts if total[0] else 0):
        block = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).collect()  # about `item_bytes`
        if not block:
            continue
        queries = Queries([r["text"] for r in block], docs, tuple(total), spread)
        if not queries.vocabulary:
            continue
        seeds = rescored(docs, highest(index, queries, first), queries)
        thresholds = np.zeros(len(block))
        for r in best(seeds, ids, k).where(F.col("rank") == k).collect():  # a row for each query of the block
            thresholds[r["q"]] = r["score"]
        drop_stage(seeds)
        scores = rescored(docs, reaching(index, queries, thresholds), queries)
        names = spark.createDataFrame([(q, r["item_id"]) for q, r in enumerate(block)],
                                      T.StructType([T.StructField("q", _LONG), items.schema["item_id"]]))
        found.append(stage(best(scores, ids, k).join(names, "q").select("item_id", "rank", "doc_id", "score"), "found"))
        drop_stage(scores)
    drop_stage(index, ids)
    out = T.StructType([items.schema["item_id"], T.StructField("rank", T.IntegerType()), docs.schema["doc_id"], T.StructField("score", _LONG)])
    if not found:
        return spark.createDataFrame([], out)
    result = found[0]
    for f in found[1:]:
        result = result.unionByName(f)
    return result


def op11(spark, docs: DataFrame, items: DataFrame) -> DataFrame:
    return search(docs, items)
