"""Sharding along a Hilbert curve, DataFrame functions only.

Language, source and size are quantised to ``2**BITS`` levels, the point's index on the Hilbert curve
orders the documents, and the order is cut into runs of as many rows (law ``rows``: shard counts at
most one apart). Neighbours on the curve are close in all dimensions, so a shard holds few values of
each and a reader that knows the shards' ranges (``manifest``) skips the rest.

The rank in the order isn't taken in one window: rows of a curve cell are split by a hash of the id
into as many buckets as the cell's count asks for, ranked inside their bucket, and moved by the sum
of the buckets before. There are at most ``2**(3 * BITS)`` cells plus a few buckets for each shuffle
partition, which bounds the table of sums.

Edge cases: a null text has no bytes, a null language or source is the empty one, a null id orders as
the empty text. Equal ids are ordered by checksum and size; rows equal in all of these are alike and
take any of their slots. An empty table gives an empty result; with fewer rows than shards the first
shards hold one row each. Other columns are ignored.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

BITS = 5
SHARDS = 40


def level(value, bits: int = BITS):
    """A category's level: the leading bits of its MD5."""
    return F.conv(F.substring(F.md5(F.coalesce(value.cast("string"), F.lit(""))), 1, 2), 16, 10).cast("int") \
        .bitwiseAND((1 << bits) - 1)


def size_level(size, bits: int = BITS):
    """Two levels for each doubling of the size, from 16 on."""
    n = F.length(F.bin(size))
    half = F.call_function("shiftright", size, n - 2).bitwiseAND(1)
    return F.least(2 * (n - 5) + half.cast("int"), F.lit((1 << bits) - 1)).cast("int")


def hilbert(df: DataFrame, dims: list, bits: int = BITS, out: str = "curve") -> DataFrame:
    """``df`` with the Hilbert index of integer columns ``dims`` (each below ``2**bits``)."""
    n = len(dims)
    xs = [f"_h{i}" for i in range(n)]
    df = df.withColumns({x: F.col(d) for x, d in zip(xs, dims)})
    q = 1 << (bits - 1)
    while q > 1:  # undo the turns of the sub-cubes, from the coarsest level on
        p = q - 1
        for i, x in enumerate(xs):
            set_ = F.col(x).bitwiseAND(q) != 0
            swap = F.col(xs[0]).bitwiseXOR(F.col(x)).bitwiseAND(p)
            new = {xs[0]: F.when(set_, F.col(xs[0]).bitwiseXOR(p)).otherwise(F.col(xs[0]).bitwiseXOR(swap))}
            if i:
                new[x] = F.when(set_, F.col(x)).otherwise(F.col(x).bitwiseXOR(swap))
            df = df.withColumns(new)
        q >>= 1
    for a, b in zip(xs, xs[1:]):  # Gray code
        df = df.withColumn(b, F.col(b).bitwiseXOR(F.col(a)))
    turn = F.lit(0)
    for k in range(bits - 1, 0, -1):
        turn = turn.bitwiseXOR(F.when(F.col(xs[-1]).bitwiseAND(1 << k) != 0, F.lit((1 << k) - 1)).otherwise(0))
    df = df.withColumn("_turn", turn).withColumns({x: F.col(x).bitwiseXOR(F.col("_turn")) for x in xs})
    index = F.lit(0).cast("long")
    for k in range(bits - 1, -1, -1):
        for x in xs:
            index = index * 2 + F.shiftright(F.col(x), k).bitwiseAND(1)
    return df.withColumn(out, index).drop(*xs, "_turn")


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``doc_id, lang, source, size, text_crc32, curve, shard, slot`` for each row of ``docs``."""
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    d = docs.select("doc_id", "lang", "source", (F.octet_length(text) + 16).cast("long").alias("size"),
                    F.crc32(text).alias("text_crc32"))
    d = d.withColumns({"_l": level(F.col("lang")), "_s": level(F.col("source")), "_z": size_level(F.col("size")),
                       "_tie": F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))})
    d = stage(hilbert(d, ["_l", "_s", "_z"]).drop("_l", "_s", "_z"), "curve")
    total = d.count()
    width = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cells = d.groupBy("curve").agg(F.count("*").alias("in_cell")) \
        .select("curve", F.ceil(F.col("in_cell") * width / max(total, 1)).cast("long").alias("parts"))
    d = d.join(stage(cells, "cells"), "curve")  # at most 2**15 cells
    draw = F.conv(F.substring("_tie", 1, 4), 16, 10).cast("long")
    d = d.withColumn("bucket", F.floor(draw * F.col("parts") / 65536).cast("long")).drop("parts")
    sums = d.groupBy("curve", "bucket").agg(F.count("*").alias("n"))
    before = Window.orderBy("curve", "bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("curve", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    own = Window.partitionBy("curve", "bucket").orderBy("_tie", "doc_id", "text_crc32", "size")
    ranked = d.withColumn("at", F.row_number().over(own) - 1).join(stage(sums, "sums"), ["curve", "bucket"]) \
        .withColumn("at", F.col("at") + F.col("before"))
    least, more = divmod(total, shards)
    cut = more * (least + 1)
    late = F.col("at") - cut
    return ranked.select(
        "doc_id", "lang", "source", "size", "text_crc32", "curve",
        F.when(F.col("at") < cut, F.floor(F.col("at") / (least + 1))).otherwise(more + F.floor(late / max(least, 1)))
        .cast("int").alias("shard"),
        F.when(F.col("at") < cut, F.col("at") % (least + 1)).otherwise(late % max(least, 1)).cast("long").alias("slot"))


def manifest(sharded: DataFrame) -> DataFrame:
    """For each shard its rows, bytes and the ranges of its dimensions, for pruning."""
    return sharded.groupBy("shard").agg(
        F.count("*").alias("n_rows"), F.sum("size").alias("n_bytes"), F.min("size").alias("min_size"),
        F.max("size").alias("max_size"), F.min("source").alias("min_source"), F.max("source").alias("max_source"),
        F.min("lang").alias("min_lang"), F.max("lang").alias("max_lang"))


def write_shards(sharded: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """One folder for each shard, its rows in curve order; large shards take several files."""
    (sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.option("maxRecordsPerFile", rows_per_file).partitionBy("shard").parquet(path))


def op10(spark, docs: DataFrame) -> DataFrame:
    return shard(docs).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                              F.lit(None).cast("int").alias("grown_shard"))
