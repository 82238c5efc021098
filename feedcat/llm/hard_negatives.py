"""Hard negatives by a vertical scan of decomposed vectors (BOND).

Vectors are stored by dimension: a staged row is a block of vectors (``BLOCK_BYTES``), one contiguous column per
dimension with its least and largest component. For an anchor a block's columns are read in descending magnitude of
the anchor's components. After each few columns every candidate has a partial score, and the columns that remain can
add no less than the sum of their minimal and no more than the sum of their maximal contributions. The candidate bitmap
loses the rows whose interval can't matter any more:

* positives: rows below the anchor's K-th best, which is the K-th exact score found so far or the K-th largest lower
  end of the intervals, whichever is higher;
* negatives: rows that miss the score window of every positive, or that lie below the K-th best of each window they can
  still fall into; rows whose whole interval lies in a window raise its K-th best by their lower ends.

What is left when the columns are read has exact scores. Bounds only drop rows that are strictly worse, so ties are
all kept and the result is exact.

Anchors are a stated query set against all rows; they go to the executors in blocks of about ``ANCHOR_BYTES``, cut by a
hash of the row so that a block has a bounded expected size, whatever their number. For a block of anchors a task keeps the K best rows of
each (anchor, positive) of its own blocks only; they meet in a window that is limited before its shuffle.

A component ``x`` is ``floor(256 * x)``, ``x`` as a double, held between -2**26 and 2**26. Rows with a null label, a null vector, or a null or
non-finite component take no part; vectors shorter than others end in zeros, an empty one scores 0 with all. Rows are
told apart by position, staged with the row, so rows of equal or null ids are rows of their own, and an anchor's copy is
one of its positives. A null ``vec_id`` is no anchor, keeps its label, and comes after all others in a tie; equal ids
and scores are interchangeable. Other columns are ignored; empty tables, and tables without anchors, give no rows.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_batch, drop_stage, small_batches, stage

POSITIVES = 5
NEGATIVES = 10
#: Percent of the positive's score between which a negative's lies.
LEAST, MOST = 30, 90
SCALE = 256
LARGEST = 1 << 26
#: About so much of vectors makes a block, and of anchors goes to the executors at once.
BLOCK_BYTES = 1 << 20
ANCHOR_BYTES = 1 << 20
#: Columns that are read between two looks at the bitmap.
STEP = 8
#: Stands for a null id in the order of ties: after all others.
NO_ID = np.iinfo(np.int64).max
NONE = np.iinfo(np.int64).min

BLOCK = T.StructType([T.StructField(n, t) for n, t in (
    ("size", T.LongType()), ("rids", T.BinaryType()), ("ids", T.BinaryType()), ("named", T.BinaryType()), ("labels", T.BinaryType()),
    ("columns", T.ArrayType(T.BinaryType())), ("least", T.BinaryType()), ("most", T.BinaryType()))])
HIT = T.StructType([T.StructField(n, T.LongType()) for n in ("anchor", "slot", "rid", "score")]
                   + [T.StructField("vec_id", T.LongType())])


def is_anchor(vec_id: Column) -> Column:
    return F.coalesce(vec_id % 100 == 0, F.lit(False))


def usable(vectors: DataFrame) -> DataFrame:
    """``rid, vec_id, label, v`` of the rows that take part, ``v`` as integers."""
    x = F.transform("embedding", lambda e: e.cast("double"))
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != float("inf")))
    whole = F.transform(x, lambda e: F.floor(F.greatest(F.least(e * SCALE, F.lit(float(LARGEST))), F.lit(-float(LARGEST)))).cast("int"))
    label = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    ok = F.col("label").isNotNull() & F.col("embedding").isNotNull()
    return vectors.select(F.monotonically_increasing_id().alias("rid"), F.col("vec_id").cast("long").alias("vec_id"),
                          label.alias("label"), F.when(ok & finite, whole).alias("v")).where("v is not null")


def _dense(lists: pa.Array) -> np.ndarray:
    """Vectors as rows, shorter ones filled with zeros."""
    lengths = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths == lengths[0]).all():
        return flat.reshape(len(lengths), -1)
    out = np.zeros((len(lengths), lengths.max(initial=0)), np.int32)
    out[np.arange(out.shape[1]) < lengths[:, None]] = flat
    return out


def decomposed(rows: DataFrame, block_rows: int) -> DataFrame:
    """Blocks of ``rows``, one column for each dimension."""
    def blocks(batches):
        held, n = [], 0

        def block():
            t = pa.Table.from_batches(held).combine_chunks()
            v = _dense(t.column("v").chunk(0))
            ids = t.column("vec_id")
            one = [t.num_rows, t.column("rid").to_numpy().tobytes(), ids.fill_null(NO_ID).to_numpy().tobytes(),
                   ids.is_valid().to_numpy().tobytes(), t.column("label").to_numpy().tobytes(),
                   [np.ascontiguousarray(c).tobytes() for c in v.T], v.min(axis=0).tobytes(), v.max(axis=0).tobytes()]
            return arrow_batch(BLOCK, [[x] for x in one])

        for b in batches:
            while b.num_rows:
                held.append(b.slice(0, block_rows - n))
                n, b = n + held[-1].num_rows, b.slice(block_rows - n)
                if n == block_rows:
                    yield block()
                    held, n = [], 0
        if n:
            yield block()

    return rows.mapInArrow(blocks, BLOCK)


class Block:
    """A stored block; ``scan`` reads its columns for one anchor."""

    def __init__(self, row: dict) -> None:
        read = lambda name, kind=np.int64: np.frombuffer(row[name], kind)
        self.rids, self.ids, self.named, self.labels = read("rids"), read("ids"), read("named", bool), read("labels")
        self.columns = [np.frombuffer(c, np.int32) for c in row["columns"]]
        self.least, self.most = read("least", np.int32).astype(np.int64), read("most", np.int32).astype(np.int64)

    def scan(self, anchor: np.ndarray, at: np.ndarray, shrink) -> tuple[np.ndarray, np.ndarray]:
        """``(rows, scores)`` left of the rows ``at``; ``shrink(low, high)`` tells which intervals stay."""
        dims = min(len(anchor), len(self.columns))
        a = anchor[:dims].astype(np.int64)
        order = np.argsort(-np.abs(a), kind="stable")
        ends = np.sort(np.stack([a * self.least[:dims], a * self.most[:dims]]), axis=0)[:, order]
        left = ends.sum(axis=1)[:, None] - np.cumsum(ends, axis=1)  # least and most that the later columns add
        score = np.zeros(len(at), np.int64)
        for i in range(0, dims, STEP):
            for d in order[i:i + STEP]:
                if a[d]:
                    score += a[d] * self.columns[d][at]
            j = min(i + STEP, dims) - 1
            keep = shrink(score + left[0, j], score + left[1, j])
            if not keep.all():
                at, score = at[keep], score[keep]
            if not len(at):
                break
        return at, score


class Best:
    """The K best (score, id) of one anchor or window, as found so far by a task."""

    def __init__(self, k: int) -> None:
        self.k = k
        self.scores = self.ids = self.rids = self.named = np.empty(0, np.int64)

    def floor(self, lows: np.ndarray) -> int:
        """A score that the K-th best reaches at least; ``lows`` are lower ends of rows not yet in."""
        both = np.concatenate([self.scores, lows])
        return int(np.partition(both, len(both) - self.k)[len(both) - self.k]) if len(both) >= self.k else NONE

    def add(self, block: Block, at: np.ndarray, scores: np.ndarray) -> None:
        s, i = np.concatenate([self.scores, scores]), np.concatenate([self.ids, block.ids[at]])
        top = np.lexsort((i, -s))[:self.k]
        self.scores, self.ids = s[top], i[top]
        self.rids = np.concatenate([self.rids, block.rids[at]])[top]
        self.named = np.concatenate([self.named, block.named[at]])[top]


def _hits(best: dict):
    """The rows of ``HIT`` for ``{(anchor, slot): Best}``."""
    for (anchor, slot), b in best.items():
        if len(b.scores):
            n = len(b.scores)
            ids = pa.array(b.ids, mask=~b.named.astype(bool))
            yield [np.full(n, anchor), np.full(n, slot), b.rids, b.scores, ids]


def _batches(best: dict):
    cols = list(zip(*_hits(best)))
    if cols:
        *plain, ids = cols
        yield arrow_batch(HIT, [*(pa.array(np.concatenate(c).astype(np.int64)) for c in plain), pa.concat_arrays(ids)])


def _first(hits: DataFrame, k: int) -> DataFrame:
    """Rank of the first ``k`` rows of each (anchor, slot)."""
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "rid")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest_of_label(blocks: DataFrame, anchors: dict, k: int) -> DataFrame:
    """The first ``k`` other rows of each anchor's label; ``anchors: {rid: (label, vector)}``."""
    def scan(batches):
        best = {(rid, 0): Best(k) for rid in anchors}
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row)
                of_label = {x: np.flatnonzero(block.labels == x) for x in np.unique(block.labels).tolist()}
                for rid, (label, vector) in anchors.items():
                    at, top = of_label.get(label), best[rid, 0]
                    if at is not None:
                        at = at[block.rids[at] != rid]
                        top.add(block, *block.scan(vector, at, lambda low, high: high >= top.floor(low)))  # noqa: B023
        yield from _batches(best)

    return _first(blocks.mapInArrow(scan, HIT), k)


def in_windows(blocks: DataFrame, anchors: dict, windows: dict, k: int) -> DataFrame:
    """The first ``k`` rows of other labels in each window; ``windows: {rid: [(slot, least, most), ...]}``."""
    def scan(batches):
        best = {(rid, slot): Best(k) for rid, own in windows.items() for slot, _, _ in own}
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row)
                others = {x: np.flatnonzero(block.labels != x) for x in {anchors[rid][0] for rid in windows}}
                for rid, own in windows.items():
                    label, vector = anchors[rid]

                    def shrink(low, high):
                        keep = np.zeros(len(low), bool)
                        for slot, least, most in own:  # noqa: B023
                            sure = low[(low >= least) & (high <= most)]
                            floor = max(least, best[rid, slot].floor(sure))  # noqa: B023
                            keep |= (high >= floor) & (low <= most)
                        return keep

                    at, scores = block.scan(vector, others[label], shrink)
                    for slot, least, most in own:
                        fits = (scores >= least) & (scores <= most)
                        best[rid, slot].add(block, at[fits], scores[fits])
        yield from _batches(best)

    return _first(blocks.mapInArrow(scan, HIT), k)


def mine(vectors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST, most: int = MOST,
         chosen=is_anchor, block_bytes: int = BLOCK_BYTES, anchor_bytes: int = ANCHOR_BYTES) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``."""
    spark = vectors.sparkSession
    small_batches(spark)
    rows = stage(usable(vectors), "vectors")
    dims = max(rows.agg(F.max(F.size("v"))).first()[0] or 0, 1)
    blocks = stage(decomposed(rows, -(-block_bytes // (4 * dims))), "columns")
    asked = rows.where(chosen(F.col("vec_id")))
    parts = -(-asked.count() * 8 * dims // anchor_bytes)
    out = None
    for part in range(parts):
        own = asked.where(F.pmod(F.xxhash64("rid"), F.lit(parts)) == part).collect()  # about `anchor_bytes`
        anchors = {r["rid"]: (r["label"], np.array(r["v"], np.int64)) for r in own}
        near = stage(nearest_of_label(blocks, anchors, positives), "positives")
        windows = {}
        for r in near.collect():  # `positives` rows for each anchor of the block
            low, high = -(-least * r["score"] // 100), most * r["score"] // 100
            if low <= high:
                windows.setdefault(r["anchor"], []).append((r["rank"], low, high))
        found = in_windows(blocks, anchors, windows, negatives).select(
            F.col("anchor"), F.col("slot").alias("place"), F.col("rank").cast("int").alias("rank"),
            F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
        pairs = near.select("anchor", F.col("rank").cast("long").alias("place"), F.col("vec_id").alias("positive_id"),
                            F.col("score").alias("positive_score"))
        names = rows.where(chosen(F.col("vec_id"))).select(F.col("rid").alias("anchor"), F.col("vec_id").alias("anchor_id"))
        got = stage(found.join(pairs, ["anchor", "place"]).join(names, "anchor").select(
            "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"), "hard-negatives")
        drop_stage(near)
        out = got if out is None else out.unionByName(got)
    if out is None:
        return spark.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, "
                                         "positive_score bigint, negative_score bigint")
    drop_stage(rows, blocks)
    return out


def op12(spark, vectors: DataFrame) -> DataFrame:
    return mine(vectors)
