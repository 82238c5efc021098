"""Best-fit packing under conflicts.

Documents are cut into pieces of at most ``CAPACITY`` words and packed into bins of that many. A bin
never holds two pieces of one duplicate cluster, nor two of one source; it carries a bitmap of each.
Pieces come longest first; the search starts at the smallest room that fits (the successor of the
piece's length among the rooms in use) and goes on to the next larger room until a compatible bin is
found, which is then the tightest compatible one. Bins of the same room and the same bitmaps are
alike and tested once.

Packing runs in shards of about ``SHARD_ROWS`` documents dealt by a hash, so a task holds one shard's
lengths, never texts, and a hot source or cluster spreads evenly over the shards.

Edge cases: a null or text without words has no piece and gets one row without a bin. Duplicate
clusters are equal word sequences, A-Z lower-cased; a null source conflicts with other null sources.
Ties in length are packed by id, cluster and row. Repeated rows are one cluster. Other columns are
ignored.
"""
from __future__ import annotations

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_batch, binaries, column, small_batches, stage, with_row_id

CAPACITY = 2048
#: Documents of a shard; a shard is packed by one task.
SHARD_ROWS = 4096


class Bins:
    """Bins in the order of their room; equal (room, bitmaps) share a stack."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.rooms = 0  # bit r: some bin has room r
        self.stacks = [{} for _ in range(capacity + 1)]  # room -> {(sources, clusters): [bin, ...]}
        self.count = 0

    def _successor(self, room: int) -> int:
        """The smallest room in use that is at least ``room``, -1 if none."""
        rest = self.rooms >> room
        return room + (rest & -rest).bit_length() - 1 if rest else -1

    def put(self, length: int, source: int, cluster: int) -> tuple[int, int]:
        """Bin and offset for a piece whose source and cluster are single bits."""
        room = self._successor(length)
        while room >= 0:
            for marks, stack in self.stacks[room].items():
                if not (marks[0] & source or marks[1] & cluster):
                    at = stack.pop()
                    if not stack:
                        del self.stacks[room][marks]
                        if not self.stacks[room]:
                            self.rooms &= ~(1 << room)
                    self._keep(at, room - length, marks[0] | source, marks[1] | cluster)
                    return at, self.capacity - room
            room = self._successor(room + 1)
        self.count += 1
        self._keep(self.count - 1, self.capacity - length, source, cluster)
        return self.count - 1, 0

    def _keep(self, at: int, room: int, sources: int, clusters: int) -> None:
        if room:
            self.stacks[room].setdefault((sources, clusters), []).append(at)
            self.rooms |= 1 << room


def pack(pieces: list, capacity: int) -> list:
    """``(bin, offset)`` of pieces ``(length, source, cluster)``, given longest first."""
    bins, sources, clusters = Bins(capacity), {}, {}
    often = {}
    for _, _, c in pieces:
        often[c] = often.get(c, 0) + 1
    out = []
    for length, source, cluster in pieces:
        s = 1 << sources.setdefault(source, len(sources))
        # a cluster of one piece conflicts with nothing, so it needs no bit
        c = 1 << clusters.setdefault(cluster, len(clusters)) if often[cluster] > 1 else 0
        out.append(bins.put(length, s, c))
    return out


def word_count(text: bytes | None) -> tuple[int, bytes]:
    """The number of words and the digest of the word sequence, A-Z lower-cased."""
    words = text.lower().split() if text else []
    return len(words), xxhash.xxh3_128_digest(b" ".join(words))


def lengths(batch: pa.RecordBatch, schema: T.StructType) -> pa.RecordBatch:
    """The rows of ``measured`` for a batch; the words of one text at a time are held, not those of the batch."""
    counts = [word_count(t) for t in binaries(batch, "text")]
    return arrow_batch(schema, [column(batch, "rid"), column(batch, "doc_id"), column(batch, "source"),
                                [n for n, _ in counts], [d for _, d in counts]])


def measured(docs: DataFrame) -> DataFrame:
    """``rid, doc_id, source, n_words, cluster`` without the texts."""
    schema = T.StructType([T.StructField("rid", T.LongType()), docs.schema["doc_id"], T.StructField("source", T.StringType()),
                           T.StructField("n_words", T.LongType()), T.StructField("cluster", T.BinaryType())])

    def rows_of(batches):
        for b in batches:
            yield lengths(b, schema)

    return with_row_id(docs, "doc_id", F.col("source").cast("string").alias("source"), "text").mapInArrow(rows_of, schema)


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """A row for each piece: ``doc_id, source, piece, first_word, n_words, bin_id, bin_offset``."""
    small_batches(docs.sparkSession)
    rows = stage(measured(docs), "lengths")
    shards = -(-rows.count() // shard_rows) or 1
    # long documents make several pieces; every capacity-sized one fills a bin of its own at once
    cut = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.ceil(F.col("n_words") / capacity).cast("long") - 1, F.lit(0).cast("long"))))
    pieces = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", "rid"), F.lit(shards))).withColumn("piece", cut) \
        .withColumn("length", F.least(F.col("n_words") - F.col("piece") * capacity, F.lit(capacity).cast("long")))
    full = F.col("length").isin(0, capacity)
    id_type = rows.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("rid", T.LongType()), T.StructField("doc_id", id_type), T.StructField("source", T.StringType()),
                           T.StructField("piece", T.LongType()), T.StructField("length", T.LongType()),
                           T.StructField("bin_id", T.StringType()), T.StructField("bin_offset", T.LongType())])

    def packed(shard: pa.Table) -> pa.Table:  # Arrow keeps ids as they are, next to null ids too
        shard = shard.sort_by([("length", "descending"), ("doc_id", "ascending"), ("cluster", "ascending"), ("rid", "ascending")])
        got = pack(list(zip(*(shard.column(c).to_pylist() for c in ("length", "source", "cluster")))), capacity)
        names = [f"{s}-{b}" for s, (b, _) in zip(shard.column("shard").to_pylist(), got)]
        return shard.select([f.name for f in schema][:5]).append_column("bin_id", pa.array(names, pa.string())) \
            .append_column("bin_offset", pa.array([o for _, o in got], pa.int64()))

    rest = pieces.where(~full).groupBy("shard").applyInArrow(packed, schema)
    whole = pieces.where(full).select(
        "rid", "doc_id", "source", "piece", "length",
        F.when(F.col("length") > 0, F.concat_ws("-", F.lit("full"), "rid", "piece")).alias("bin_id"),
        F.when(F.col("length") > 0, F.lit(0).cast("long")).alias("bin_offset"))
    return rest.unionByName(whole).select("doc_id", "source", "piece", (F.col("piece") * capacity).alias("first_word"),
                                          F.col("length").alias("n_words"), "bin_id", "bin_offset")


def op7(spark, docs: DataFrame) -> DataFrame:
    return pack_documents(docs)
