"""N-gram Jaccard join by partitioning the universe, and its connected components.

A document's set holds the distinct 3-word shingles of its text. Sizes are cut into bands; sets that
are similar enough lie in one band or in neighbouring ones, and a band's largest size bounds how many
elements ``h`` two such sets can differ in. The universe of shingles is hashed into segments, each
allowed 0 or 1 differences (levels 1 and 2). If the levels of all segments add up to ``h + 1``, two
similar sets agree in a segment up to its allowance (pigeonhole). A segment of level 1 is indexed by
the hash of its elements, one of level 2 also by its one-deletion neighbourhood, the hashes that
remain when one element is left out: sets that differ by one element there share such a hash. How
many segments get level 2 is chosen for each band by cost: rows written against the pairs expected
to meet in a segment by chance, from the number of documents in the band. Level-2 segments are fewer
and larger, so crowded bands and short texts use them and long texts don't.

Sets meet in the buckets of the index; ``components.cluster`` verifies candidates exactly, after a
bound on their difference from sizes and 128 parity bits, then one from 1,024. Equal sets are one node
from the start.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; a text of one or two words has its whole
sequence as its only element; one without words (null, empty, blank) has the empty set and links with
nothing. Shingles are compared by 64-bit hashes. Rows with equal ids are documents of their own; a
null id never is a component's smallest id unless no other is there. Other columns are ignored.
"""
from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import (RARE, U64, WordHash, arrow_batch, binaries, bit_filter, column, drop_stage, mix, passes, seeds, shingle_hashes,
                     small_batches, stage, with_row_id)
from .components import cluster

WIDTH = 3
#: Similarity as a fraction.
ALIKE = (90, 100)
#: Bands grow by about this power of the similarity.
SPREAD = 2
#: Cost of a candidate pair in index rows.
PAIR_COST = 1.0
#: Parity bits that come with a set's items; a pair whose bits differ too much is dropped before its items move.
SKETCH = 1024


class Bands:
    """Size bands for a similarity of ``num / den`` and the segments of each."""

    def __init__(self, num: int, den: int) -> None:
        self.num, self.den = num, den
        self.edges = [1]

    def of(self, n: int) -> int:
        """The band of sets of ``n`` elements."""
        while self.edges[-1] <= n:
            e = self.edges[-1]
            self.edges.append(max(e + 1, int(e * (self.den / self.num) ** SPREAD)))
        return int(np.searchsorted(self.edges, n, "right")) - 1

    def top(self, band: int) -> int:
        self.of(self.edges[-1] if band + 1 >= len(self.edges) else 1)
        return self.edges[band + 1] - 1

    def differ(self, band: int) -> int:
        """Most elements in which a set of the band and a similar, not smaller one can differ."""
        return (self.den - self.num) * self.top(band) // self.num

    def probes(self, n: int) -> list:
        """The bands a set of ``n`` elements is indexed under: its own, and the one below if a
        similar set can lie there."""
        own = self.of(n)
        return [own, own - 1] if own and -(-self.num * n // self.den) <= self.top(own - 1) else [own]

    def allocate(self, band: int, sets: int) -> tuple[int, int]:
        """``(double, single)``: segments of level 2 and of level 1, by least expected cost."""
        h = self.differ(band)
        if not h:
            return 0, 0  # only equal sets are similar
        least = self.edges[band]
        best = None
        for double in range((h + 1) // 2 + 1 + (h + 1) % 2):
            single = max(h + 1 - 2 * double, 0)
            size = least / (double + single)
            rows = single + double * (size + 1)
            if best and rows > best[0]:
                break  # more doubles only write more rows
            # two unrelated sets meet where both have no element, or at level 2 one of them
            pairs = sets / 2 * (single + double * (1 + 2 * size)) * math.exp(-2 * size)
            cost = rows + PAIR_COST * pairs
            if best is None or cost < best[0]:
                best = (cost, double, single)
        return best[1:]


def band_plan(docs: DataFrame, bands: Bands) -> dict:
    """The allocation of every band, from the documents' lengths (six bytes taken for a word).

    The estimate only moves cost: any allocation finds all similar pairs.
    """
    step = math.log((bands.den / bands.num) ** SPREAD)
    size = F.greatest(F.octet_length("text") / 6, F.lit(1))
    got = docs.where("text is not null").groupBy(F.floor(F.log(size) / step).alias("k")).count().collect()  # a row for each band
    counts = {}
    for r in got:
        band = bands.of(int(math.exp(r["k"] * step)) + 1)
        counts[band] = counts.get(band, 0) + r["count"]
    return {"counts": counts, "alloc": {}}


def allocation(plan: dict, bands: Bands, band: int) -> tuple[int, int]:
    if band not in plan["alloc"]:
        plan["alloc"][band] = bands.allocate(band, plan["counts"].get(band, 0))
    return plan["alloc"][band]


def signatures(items: np.ndarray, plan: dict, bands: Bands) -> np.ndarray:
    """The buckets of a set of distinct hashed elements."""
    out = []
    for band in bands.probes(len(items)):
        double, single = allocation(plan, bands, band)
        m = double + single
        if not m:
            continue
        seg = ((items >> U64(17)) % U64(m)).astype(np.int64)
        sums = np.zeros(m, U64)
        np.add.at(sums, seg, items)
        own = seeds(m, (band + 1) << 20)
        out.append(mix(sums + own))
        if double:
            for_one = seg < double
            out.append(mix(sums[seg[for_one]] - items[for_one] + own[seg[for_one]]))
    return np.unique(np.concatenate(out)) if out else np.empty(0, U64)


def parity(items: np.ndarray, bits: int = 128) -> np.ndarray:
    """Parity bits: two sets differ in at least as many elements as bits."""
    odd = np.bincount((items & U64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def element_sets(docs: DataFrame, name: str, make, schema: T.StructType, chosen=None) -> DataFrame:
    """``make(row's first columns, distinct hashed shingles)`` as a row for each document, or for those that
    ``chosen(batch)`` tells by column ``key``."""
    def rows_of(batches):
        known = WordHash()
        for b in batches:
            if chosen:
                b = b.filter(pa.array(chosen(b)))
            rows = [make(np.unique(shingle_hashes(known.of(t), WIDTH))) for t in binaries(b, "text")]
            keep = [column(b, n) for n in b.schema.names if n not in ("text", "key")]
            yield arrow_batch(schema, [*keep, *(list(c) for c in zip(*rows))] if rows else [*keep, *[[]] * (len(schema) - len(keep))])

    return docs.mapInArrow(rows_of, schema)


def differ_bound(num: int, den: int):
    """A necessary condition for similarity on sizes and parity bits of two aliases."""

    def may_link(l: str, r: str):
        a, b = F.col(f"{l}.n"), F.col(f"{r}.n")
        common = F.ceil((a + b) * num / (num + den))  # least intersection
        bits = F.bit_count(F.col(f"{l}.p0").bitwiseXOR(F.col(f"{r}.p0"))) + F.bit_count(F.col(f"{l}.p1").bitwiseXOR(F.col(f"{r}.p1")))
        return (den * F.least(a, b) >= num * F.greatest(a, b)) & (bits <= a + b - 2 * common)

    return may_link


def join_components(docs: DataFrame, num: int = ALIKE[0], den: int = ALIKE[1]) -> DataFrame:
    """``rid, doc_id, n_shingles, component_id, root`` for each row of ``docs``; ``root`` is the least ``rid`` of the
    row's component, its own if it is linked with nothing. Ids can be equal or null, so rows go together by ``root``."""
    spark = docs.sparkSession
    small_batches(spark)
    bands = Bands(num, den)
    docs = docs.select("doc_id", "text")
    plan = band_plan(docs, bands)
    longs = T.LongType()
    id_field = docs.schema["doc_id"]
    schema = T.StructType([T.StructField("rid", longs), id_field, T.StructField("tk", longs), *(
        T.StructField(c, longs) for c in ("n", "f0", "f1", "p0", "p1")), T.StructField("sigs", T.ArrayType(longs))])

    def described(items):
        f = np.frombuffer(xxhash.xxh3_128_digest(items.tobytes()), np.int64)
        p = parity(items)
        sigs = signatures(items, plan, bands) if len(items) else items
        return len(items), int(f[0]), int(f[1]), int(p[0]), int(p[1]), sigs.view(np.int64)

    keyed = with_row_id(docs, "doc_id", F.xxhash64("text").alias("tk"), "text")
    sets = stage(element_sets(keyed, "sets", described, schema), "sets")
    narrow = sets.where("n > 0").select("rid", "f0", "f1")
    twins = stage(narrow.groupBy("f0", "f1").agg(F.min("rid").alias("node"), F.count("*").alias("c")).where("c > 1").drop("c"), "twins")
    copies = stage(narrow.join(twins, ["f0", "f1"]).where("rid <> node").select("rid", "node"), "copies")
    drop_stage(twins)
    copied = bit_filter(copies.select(F.xxhash64("rid").alias("key")), "key")
    keyed_sets = sets.where("n > 0").select("rid", F.xxhash64("rid").alias("key"), "n", "p0", "p1", "sigs")
    node_schema = keyed_sets.drop("key").withColumnRenamed("rid", "node").schema

    def nodes(held: tuple | None = None) -> DataFrame:
        """``node, n, p0, p1, sigs``, the first row of each different set, with those of its buckets that pass ``held``. What
        surely is no copy stays where it is; the copies (and a bitmap's few false positives) meet ``copies`` in a join.
        One pass of Python each, so that a task never needs a second worker."""
        def part(maybe: bool):
            def rows_of(batches):
                for b in batches:
                    b = b.filter(pa.array(passes(copied, column(b, "key").to_numpy().view(U64)) == maybe))
                    sigs = column(b, "sigs")
                    if held:
                        ends, flat = sigs.offsets.to_numpy(), sigs.flatten()
                        keep = passes(held, flat.to_numpy().view(U64))
                        kept = np.concatenate([[0], np.cumsum(keep)])[ends - ends[0]]
                        sigs = pa.ListArray.from_arrays(pa.array(kept, pa.int32()), flat.filter(pa.array(keep)))
                    out = arrow_batch(node_schema, [*(column(b, c) for c in ("rid", "n", "p0", "p1")), sigs])
                    yield out.filter(pa.array(np.diff(kept) > 0)) if held else out
            return keyed_sets.mapInArrow(rows_of, node_schema)

        return part(False).unionByName(part(True).join(copies.select(F.col("rid").alias("node")), "node", "left_anti"))

    # of the index only buckets with two sets or more matter; the others go, by a bitmap, before anything is joined
    counted = nodes().select(F.explode("sigs").alias("bucket")).groupBy("bucket").agg(F.count("*").alias("c"))
    shared = stage(counted.where("c > 1").select("bucket"), "shared")
    held = bit_filter(shared, "bucket")
    drop_stage(shared)
    # a bucket that passed by chance has one row, which ``cluster`` leaves out
    members = stage(nodes(held).select("node", "n", "p0", "p1", F.explode("sigs").alias("bucket")), "index") \
        .select("bucket", "node", "n", "p0", "p1")
    rows_of_docs = stage(sets.select("rid", "doc_id", "tk", "n"), "rows")
    drop_stage(sets)  # the buckets are the most of it
    item_schema = T.StructType([T.StructField("node", longs), id_field, T.StructField("tk", longs), T.StructField("items", T.ArrayType(longs)),
                                T.StructField("n", longs), T.StructField("sketch", T.ArrayType(longs))])

    def itemized(items):
        return items.view(np.int64), len(items), parity(items, SKETCH)

    def of_texts(want: DataFrame, key, rows: DataFrame) -> DataFrame:
        """Sets of the ``rows (node, doc_id, tk, text)`` that ``want`` surely or by a bitmap's chance has the ``key`` of."""
        wanted = bit_filter(want.select(key.alias("key")), "key", each=RARE)
        return element_sets(rows.select("node", "doc_id", "tk", key.alias("key"), "text"), "items", itemized, item_schema,
                            lambda b: passes(wanted, column(b, "key").to_numpy().view(U64)))

    def items_of(asked: DataFrame) -> DataFrame:
        """Sets of the nodes asked for (and of few others), from their texts again: they aren't stored for all documents.
        A row of a stored table has the same position again, so sets are written where their texts are read. What isn't
        found by position, as ``docs`` isn't stored, is looked up by text and id."""
        want = stage(rows_of_docs.select(F.col("rid").alias("node"), "tk", "doc_id").join(asked, "node"), "wanted")
        rows = with_row_id(docs, "doc_id", F.xxhash64("text").alias("tk"), "text").withColumnRenamed("rid", "node")
        out = stage(of_texts(want, F.xxhash64("node", "tk"), rows).drop("doc_id", "tk"), "items")
        rest = stage(want.join(out.select("node"), "node", "left_anti"), "not-found")
        if not rest.isEmpty():
            found = of_texts(rest, F.xxhash64("tk", "doc_id"), rows).drop("node")
            found = found.alias("d").join(rest.alias("w"), (F.col("d.tk") == F.col("w.tk")) & F.col("d.doc_id").eqNullSafe(F.col("w.doc_id"))) \
                .select("w.node", "d.items", "d.n", "d.sketch").dropDuplicates(["node"])  # texts with equal ids
            both = stage(out.join(want.select("node"), "node", "left_semi").unionByName(found), "items")
            drop_stage(out)
            out = both
        drop_stage(want, rest)
        return out

    roots = cluster(members, items_of, (num, den), differ_bound(num, den))
    named = copies.join(roots, "node", "left").select("rid", F.coalesce("root", "node").alias("root")) \
        .unionByName(roots.select(F.col("node").alias("rid"), "root")) \
        .unionByName(copies.select(F.col("node").alias("rid"), F.col("node").alias("root")).distinct()
                     .join(roots.select(F.col("node").alias("rid")), "rid", "left_anti"))
    named = stage(named, "roots-of-rows")
    base = rows_of_docs.select("rid", "doc_id", F.col("n").alias("n_shingles"))
    known = base.join(named, "rid", "left")
    smallest = known.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("least"))
    return known.join(smallest, "root", "left") \
        .select("rid", "doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id"), F.coalesce("root", "rid").alias("root"))


def op6(spark, docs: DataFrame) -> DataFrame:
    return join_components(docs).select("doc_id", "n_shingles", "component_id")
