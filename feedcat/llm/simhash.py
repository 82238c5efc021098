"""SimHash near duplicates by meeting in the middle of a ball.

A document's fingerprint is the bitwise majority of the XXH64 hashes (seed 42) of its 3-word shingles, repeats
included. Fingerprints link where they differ in at most ``2 * HALF`` = 2 bits. Every distinct fingerprint emits all
variants within half the radius, itself and its 64 one-bit neighbours; two fingerprints that link have a variant in
common, the one midway, and two that share a variant link. Variants are shuffled, and a bucket is kept as what it is,
the subset of a ball: the variant, one 64-bit mask of the bits in which its members differ from it, and whether the
variant is a member itself. That state has a fixed size and combines on the map side, so no bucket is ever gathered,
however many documents are alike. Members of buckets with two or more are read off the mask, meet the bucket's least
member only (they all link, a star connects them), are made distinct and verified, and ``components`` joins them.

Equal fingerprints are one node from the start, so copies cost nothing after the first aggregation.

Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text after lower-casing A-Z; one or two words are one shingle. A text
without words (null, empty, blank) has fingerprint zero and links like any other. A bit set in exactly half of the
hashes is 0. Long texts are hashed in pieces, so memory beyond the text and its word places doesn't grow with it. Rows
with equal ids are rows of their own; a null id is never a component's smallest id unless no other is there (the
component is null then). Ties don't occur: roots go by the least fingerprint, ids by the least id. Other columns are
ignored; an empty table gives an empty result.
"""
from __future__ import annotations

import re

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import U64, arrow_batch, binaries, column, drop_stage, small_batches, stage
from .components import components

WIDTH = 3
SEED = 42
BITS = 64
#: Fingerprints link at twice this distance. The masks hold one differing bit, so it stays 1.
HALF = 1
#: Shingles that are hashed before their bits are counted.
PIECE = 1 << 15

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def fingerprint(text: bytes | None) -> int:
    """The fingerprint of a UTF-8 text as an unsigned number."""
    words = _WORD.findall(text.lower()) if text else []  # bytes.lower changes A-Z only
    if not words:
        return 0
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    line = b" ".join(words)
    width = min(WIDTH, len(words))
    starts = np.concatenate([[0], ends[:-1] + 1])[:len(words) - width + 1].tolist()
    stops = ends[width - 1:].tolist()
    votes, hashed = np.zeros(BITS, np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(starts), PIECE):
        h = np.fromiter((hashed(line[a:b], SEED) for a, b in zip(starts[at:at + PIECE], stops[at:at + PIECE])), U64)
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(starts), bitorder="little").view(U64)[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fp`` for each row; ``fp`` holds the 64 bits as a signed number."""
    schema = T.StructType([docs.schema["doc_id"], T.StructField("fp", T.LongType())])

    def rows_of(batches):
        for b in batches:
            fps = np.fromiter(map(fingerprint, binaries(b, "text")), U64, b.num_rows)
            yield arrow_batch(schema, [column(b, "doc_id"), fps.view(np.int64).tolist()])

    return docs.select("doc_id", "text").mapInArrow(rows_of, schema)


def _flip(fp, bit):
    return fp.bitwiseXOR(F.expr(f"shiftleft(1L, {bit})"))


def buckets(fps: DataFrame) -> DataFrame:
    """``variant, own, mask`` of the variants with two members or more; ``fps (fp)`` is distinct.

    ``own`` tells whether the variant is a member; bit ``i`` of ``mask`` that the variant with bit ``i`` flipped is."""
    # a fingerprint makes 65 rows, so small partitions of fingerprints aren't merged before that
    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    near = fps.repartition(parts).select("fp", F.explode(F.sequence(F.lit(-1), F.lit(BITS - 1))).alias("bit"))
    flipped = F.col("bit") >= 0
    spread = near.select(F.when(flipped, _flip(F.col("fp"), "bit")).otherwise(F.col("fp")).alias("variant"),
                         F.when(flipped, F.expr("shiftleft(1L, bit)")).otherwise(F.lit(0).cast("long")).alias("mask"),
                         F.when(flipped, 0).otherwise(1).alias("own"))
    return spread.groupBy("variant").agg(F.bit_or("mask").alias("mask"), F.max("own").alias("own")) \
        .where(F.bit_count("mask") + F.col("own") > 1)


def links(fps: DataFrame) -> DataFrame:
    """Distinct verified pairs ``(a, b)`` of fingerprints that connect all that link."""
    members = F.filter(F.transform(F.sequence(F.lit(-1), F.lit(BITS - 1)), lambda i: F.when(
        i < 0, F.when(F.col("own") == 1, F.col("variant"))).when(
        F.col("mask").bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), i)) != 0,
        F.col("variant").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i)))), lambda m: m.isNotNull())
    stars = buckets(fps).select(members.alias("members")) \
        .select(F.array_min("members").alias("a"), F.explode("members").alias("b")).where("a <> b").distinct()
    return stars.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 2 * HALF)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for each row of ``docs``."""
    small_batches(docs.sparkSession)
    rows = stage(fingerprints(docs), "fingerprints")
    nodes = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    found = stage(links(nodes.select("fp")), "ball-links")
    roots = components(found)
    drop_stage(found)
    named = nodes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = stage(named, "fingerprint-roots")
    of_root = named.groupBy("root").agg(F.min("least").alias("component_id"))
    # a row's component: from its own fingerprint's, on rows whose fingerprint is linked, so few are joined
    merged = stage(named.join(of_root, "root").select("fp", "component_id"), "fingerprint-components")
    return rows.join(merged, "fp", "left") \
        .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op13(spark, docs: DataFrame) -> DataFrame:
    return near_duplicates(docs)
