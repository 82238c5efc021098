"""Connected components and clustering of bucketed candidates, without all pairs of a bucket."""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import RARE, U64, arrow_batch, bit_filter, column, drop_stage, passes, stage


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges (a, b)``; the root is the least node it reaches.

    Alternating large-star and small-star steps; each is two aggregations with map-side combine and
    a join, so a node with many neighbours is never gathered in one task. Every round is staged.
    """
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    seen = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        nxt = stage(large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                    .unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "edges")
        drop_stage(e)
        e = nxt
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == seen:
            out = stage(e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()), "components")
            drop_stage(e)
            return out
        seen = now


def cluster(members: DataFrame, sets, alike: tuple, may_link=None) -> DataFrame:
    """Components ``(node, root)`` of the links among nodes that share a bucket.

    ``members (bucket, node, *attributes)`` has no repeated rows; ``sets(nodes)`` gives ``(node, items)``
    for the nodes asked for, staged where it's dear to compute again; two nodes link when the Jaccard similarity of their items is at least the
    fraction ``alike``; ``may_link(l, r)`` is a cheap necessary condition on the attributes.

    First every member meets its bucket's most copied (attribute ``copies``, if there is one) and most
    connected member only: a star, as many pairs as
    members. Most buckets are one component then. In the others, nodes outside the bucket's largest
    component still have to meet those of other components: bucket mates that share an item of their prefixes
    (``open_pairs``; exact, whatever the bucket holds), so many texts
    that only have a common passage don't meet pairwise. Every link either is verified or joins nodes
    that are connected already.
    """
    attrs = [c for c in members.columns if c not in ("bucket", "node")]
    may_link = may_link or (lambda l, r: F.lit(True))
    sizes = members.groupBy("bucket").agg(F.count("*").alias("n_in")).where("n_in > 1")
    sizes = stage(sizes, "sizes")
    m = stage(members.join(sizes, "bucket"), "members")
    drop_stage(sizes)
    weight = m.groupBy("node").agg(F.sum("n_in").alias("weight"))
    rank = [c for c in ("copies",) if c in attrs] + ["weight", "node"]
    pivots = m.join(weight, "node").groupBy("bucket").agg(F.max(F.struct(*rank, *[c for c in attrs if c not in rank])).alias("p")) \
        .select("bucket", *[F.col(f"p.{c}").alias(c) for c in ["node", *attrs]])
    pivots = stage(pivots, "pivots")
    star = m.alias("l").join(pivots.alias("r"), "bucket") \
        .where((F.col("l.node") != F.col("r.node")) & may_link("l", "r")) \
        .select(F.col("l.node").alias("a"), F.col("r.node").alias("b"))
    links = verified(star, sets, alike)
    drop_stage(pivots)
    comp = components(links)
    named = m.join(comp, "node", "left").withColumn("root", F.coalesce("root", "node"))
    top = named.groupBy("bucket", "root").agg(F.count("*").alias("k")).groupBy("bucket") \
        .agg(F.max(F.struct("k", "root")).alias("top"), F.count("*").alias("c")).where("c > 1") \
        .select("bucket", F.col("top.root").alias("top"))
    top = stage(top, "top")
    open_ = stage(named.join(top, "bucket").select("bucket", "node", "root", (F.col("root") != F.col("top")).alias("outside"), *attrs), "open")
    drop_stage(m, top)
    if open_.isEmpty():
        drop_stage(links, open_)
        return comp
    own = sets(open_.select("node").distinct())
    own = own if hasattr(own, "staged_at") else stage(own, "open-items")
    more = verified(open_pairs(open_, own, alike, may_link), lambda nodes: own, alike)
    drop_stage(open_)
    if not more.isEmpty():
        drop_stage(comp)
        comp = components(links.unionByName(more))
    drop_stage(links, more)
    return comp


#: Items of more open nodes than this come last in the order of items.
HOT = 32


def prefixes(sets: DataFrame, alike: tuple) -> DataFrame:
    """``(node, size, prefix)``: the first items of each set, so many that similar sets share one of them.

    Any order of items that is the same for all sets will do. Items in many sets come last, so that sets which have
    only a common passage don't share; among the others hashes decide. What is frequent is told by a bitmap of
    bounded size, whose false positives are the same for all sets, so a set is put in order where it is."""
    num, den = alike
    often = sets.select(F.explode("items").alias("item")).groupBy("item").agg(F.count("*").alias("c")).where(F.col("c") > HOT)
    often = stage(often, "hot-items")
    hot = bit_filter(often, "item")
    drop_stage(often)
    fields = sets.schema
    schema = T.StructType([fields["node"], T.StructField("size", T.LongType()), T.StructField("prefix", T.ArrayType(T.LongType()))])

    def cut(batches):
        for b in batches:
            lists = column(b, "items")
            flat, ends = lists.flatten().to_numpy(), lists.offsets.to_numpy()
            size, out = np.diff(ends), []
            for at, n in zip(ends[:-1] - ends[0], size):
                items = flat[at:at + n].view(U64)
                order = np.lexsort((items, passes(hot, items)))
                out.append(items[order[:n + (-num * int(n)) // den + 1]].view(np.int64))
            yield arrow_batch(schema, [column(b, "node"), size.astype(np.int64).tolist(), out])

    return sets.select("node", "items").mapInArrow(cut, schema)


def open_pairs(open_: DataFrame, own: DataFrame, alike: tuple, may_link) -> DataFrame:
    """Pairs ``(a, b)`` of bucket mates of different components, one of them outside its bucket's largest, whose prefixes
    share an item and whose common items, by where that stands in both, can still be enough.

    Of a pair the smaller set (then the smaller node) shows only the short prefix that must hold a common item with a
    larger set, the other one its whole prefix. So sets that share most of an order's end, pages of one template say, but
    too little to be similar, never meet on it, however many there are."""
    num, den = alike
    attrs = [c for c in open_.columns if c not in ("bucket", "node", "root", "outside")]
    each = open_.groupBy("node").agg(F.max("outside").alias("outside"), *[F.first(c).alias(c) for c in ["root", *attrs]])
    pre = stage(prefixes(own, alike), "prefixes")
    at = stage(each.join(pre, "node").select("node", "root", "outside", *attrs, "size", F.posexplode("prefix").alias("pos", "item")), "prefix-items")
    drop_stage(pre)
    short = F.col("pos") <= F.col("size") - F.ceil(2 * num * F.col("size") / (num + den))
    met = at.groupBy("item").agg(F.max("outside").alias("o"), F.max(short).alias("s"), F.min("root").alias("x"), F.max("root").alias("y")) \
        .where("o and s and x <> y").select("item")
    met = stage(met, "met-items")
    held = bit_filter(met, "item")
    drop_stage(met)

    def wanted(batches):
        for b in batches:
            yield b.filter(pa.array(passes(held, column(b, "item").to_numpy().view(U64))))

    rows = stage(at.mapInArrow(wanted, at.schema), "met-items")
    drop_stage(at)
    first, second = F.struct("l.size", "l.node"), F.struct("r.size", "r.node")
    total = F.col("l.size") + F.col("r.size")
    left = F.least(F.col("l.size") - F.col("l.pos"), F.col("r.size") - F.col("r.pos"))  # common items from here on, at most
    may = (F.col("l.root") != F.col("r.root")) & (first < second) & (left >= F.ceil(num * total / (num + den))) & may_link("l", "r")

    def pairs(l, r):
        return l.alias("l").join(r.alias("r"), "item").where(may).select(F.col("l.node").alias("a"), F.col("r.node").alias("b"))

    out, into = rows.where(short & F.col("outside")), rows.where(short & ~F.col("outside"))
    found = stage(pairs(out, rows).unionByName(pairs(into, rows.where("outside"))).distinct(), "prefix-pairs")
    drop_stage(rows)
    mates = open_.select("bucket", "node")
    return found.join(mates.withColumnRenamed("node", "a"), "a").join(mates.withColumnRenamed("node", "b"), ["b", "bucket"], "left_semi").select("a", "b")


def verified(pairs: DataFrame, sets, alike: tuple) -> DataFrame:
    """The distinct pairs ``(a, b)`` whose items are similar, staged; the pairs and a staged table of sets go.

    Sets that come with their size ``n`` and parity bits ``sketch`` meet by these first, and only items of pairs that
    these leave are moved."""
    num, den = alike
    pairs = stage(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs")
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    s = sets(nodes)
    items = s
    if "sketch" in s.columns:
        near = stage(sketched(pairs, s, alike), "near-pairs")
        drop_stage(pairs)
        pairs, items = near, of_nodes(s, near)
    x, y = items.select(F.col("node").alias("a"), F.col("items").alias("x")), \
        items.select(F.col("node").alias("b"), F.col("items").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    links = stage(pairs.join(x, "a").join(y, "b").withColumn("both", both)
                  .where(den * F.col("both") >= num * (F.size("x") + F.size("y") - F.col("both"))).select("a", "b"), "links")
    drop_stage(pairs, s)
    return links


def sketched(pairs: DataFrame, s: DataFrame, alike: tuple) -> DataFrame:
    """The pairs that can be similar by sizes and parity bits: sets differ in at least as many items as bits."""
    num, den = alike
    x, y = s.select(F.col("node").alias("a"), F.col("n").alias("n_x"), F.col("sketch").alias("x")), \
        s.select(F.col("node").alias("b"), F.col("n").alias("n_y"), F.col("sketch").alias("y"))
    bits = F.aggregate(F.zip_with("x", "y", lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda t, c: t + c)
    total = F.col("n_x") + F.col("n_y")
    return pairs.join(x, "a").join(y, "b").where(bits <= total - 2 * F.ceil(num * total / (num + den))).select("a", "b")


def of_nodes(s: DataFrame, pairs: DataFrame) -> DataFrame:
    """``node, items`` of the nodes of ``pairs``, and of a bitmap's few false positives."""
    held = bit_filter(pairs.select(F.explode(F.array(F.xxhash64("a"), F.xxhash64("b"))).alias("key")), "key", each=RARE)
    rows = s.select("node", F.xxhash64("node").alias("key"), "items")

    def asked(batches):
        for b in batches:
            yield b.filter(pa.array(passes(held, column(b, "key").to_numpy().view(U64))))

    return rows.mapInArrow(asked, rows.schema).drop("key")
