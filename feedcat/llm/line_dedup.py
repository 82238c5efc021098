"""Line dedup against levelled sorted runs of line hashes.

A run holds, sorted and bucketed by key, how many documents of one batch have each line. Level 0
takes the batches' runs; ``FANOUT`` runs of a level are merged into one run of the next. All runs of
a level lie in one table bucketed by the key, so merging and joining them needs no shuffle of what is
stored. A new batch merge-anti-joins the runs' keys that already are over the limit (nothing more is
to be learned about them, so the hottest lines aren't stored again and again) and adds the others as
its own run. A line whose key is found in at least ``MIN_DOCS`` documents goes from every document.

A key is the line without white space at its ends, A-Z in lower case; its 128-bit hash stands for it.
Keys shorter than one character, that is blank lines, never count. Edge cases: a null or empty text
is one empty line and stays as the empty text. A document counts once for a key however often it
repeats the line; repeated rows count as documents. Other columns pass through; an input column
named like a result column is replaced.
"""
from __future__ import annotations

import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import (BROADCAST_ROWS, _delete, arrow_batch, binaries, column, free_name, pin_splits, shared_dir, small, small_batches,
                     stage)

MIN_DOCS = 10
FANOUT = 2
BATCHES = 4
_BLANK = b" \t\n\x0b\x0c\r"
_KEY = T.StructType([T.StructField("lo", T.LongType()), T.StructField("hi", T.LongType())])


def keys_of(text: bytes | None) -> list:
    """The key of each line; blank lines have the empty key."""
    return [x.strip(_BLANK) for x in (text or b"").lower().split(b"\n")]


def digests(keys) -> list:
    return [xxhash.xxh3_128_digest(k) for k in keys]


def line_counts(docs: DataFrame, batches: int, text: str = "text") -> DataFrame:
    """``batch, lo, hi, n``: documents with a line, counted ahead within each Arrow batch."""
    schema = T.StructType([T.StructField("batch", T.IntegerType()), *_KEY.fields, T.StructField("n", T.LongType())])

    def rows_of(parts):
        for b in parts:
            counts = Counter()
            for batch, t in zip(column(b, "batch").to_pylist(), binaries(b, "text")):
                counts.update((batch, d) for d in digests({k for k in keys_of(t) if k}))
            both = np.frombuffer(b"".join(d for _, d in counts), np.int64).reshape(-1, 2)
            yield arrow_batch(schema, [[x for x, _ in counts], pa.array(both[:, 0]), pa.array(both[:, 1]), list(counts.values())])

    dealt = F.pmod(F.xxhash64(text), F.lit(batches)).cast("int").alias("batch")
    return docs.select(dealt, F.col(text).alias("text")).mapInArrow(rows_of, schema)


class LineRuns:
    """Levelled runs under the shared folder: ``add`` a batch's counts, read the ``frequent`` keys."""

    def __init__(self, spark: SparkSession, min_docs: int = MIN_DOCS, fanout: int = FANOUT) -> None:
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list = []  # of [table name, path, number of runs]

    def _append(self, level: int, run: DataFrame) -> None:
        if level == len(self.levels):
            name = f"line_runs_{uuid.uuid4().hex}"
            self.levels.append([name, f"{shared_dir(self.spark)}/{name}", 0])
        own = self.levels[level]
        (run.write.format("parquet").mode("append").bucketBy(self.buckets, "lo", "hi").sortBy("lo", "hi")
         .option("path", own[1]).saveAsTable(own[0]))
        own[2] += 1

    def _drop(self, level: int) -> None:
        name, path, _ = self.levels[level]
        self.spark.sql(f"DROP TABLE {name}")
        _delete(self.spark, path)
        fresh = f"line_runs_{uuid.uuid4().hex}"
        self.levels[level] = [fresh, f"{shared_dir(self.spark)}/{fresh}", 0]

    def counts(self) -> DataFrame:
        """``lo, hi, n`` over all runs."""
        tables = [self.spark.table(name) for name, _, runs in self.levels if runs]
        if not tables:
            return self.spark.createDataFrame([], T.StructType([*_KEY.fields, T.StructField("n", T.LongType())]))
        merged = tables[0]
        for t in tables[1:]:
            merged = merged.unionByName(t)
        return merged.groupBy("lo", "hi").agg(F.sum("n").alias("n"))

    def frequent(self) -> DataFrame:
        return self.counts().where(F.col("n") >= self.min_docs).select("lo", "hi")

    def add(self, counts: DataFrame) -> None:
        """Store one batch's counts ``lo, hi, n`` (rows of a key may repeat) and compact full levels."""
        run = counts.groupBy("lo", "hi").agg(F.sum("n").alias("n"))
        if any(runs for _, _, runs in self.levels):
            run = run.join(self.frequent(), ["lo", "hi"], "left_anti")
        self._append(0, run)
        level = 0
        while self.levels[level][2] >= self.fanout:
            merged = self.spark.table(self.levels[level][0]).groupBy("lo", "hi").agg(F.sum("n").alias("n"))
            self._append(level + 1, merged)
            self._drop(level)
            level += 1

    def close(self) -> None:
        for level in range(len(self.levels)):
            if self.levels[level][2]:
                self._drop(level)


def drop_lines(docs: DataFrame, gone: DataFrame, text: str = "text", rows: int = BROADCAST_ROWS) -> DataFrame:
    """``docs`` without the lines whose keys are in ``gone (lo, hi)``; adds ``n_lines, n_dropped``.

    Up to ``rows`` keys go to the executors as a set; more are joined to the lines' hashes.
    """
    spark = docs.sparkSession
    docs = docs.drop("n_lines", "n_dropped")
    rid_name, gone_name = free_name("_rid", docs), free_name("_gone", docs)
    fields = [*docs.schema.fields, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())]
    schema = T.StructType(fields)

    def rewritten(b, which):
        """``which(i, keys)``: the line numbers of row ``i`` that go."""
        kept, n_lines, n_dropped = [], [], []
        for i, t in enumerate(binaries(b, text)):
            bad = which(i, keys_of(t))
            lines = (t or b"").split(b"\n")
            kept.append((b"\n".join(x for k, x in enumerate(lines) if k not in bad) if bad else t or b"").decode("utf-8", "replace"))
            n_lines.append(len(lines))
            n_dropped.append(len(bad))
        cols = [pa.array(kept, f.type) if f.name == text else column(b, f.name) for f in b.schema if f.name != gone_name]
        return pa.RecordBatch.from_arrays([*cols, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())],
                                          names=[f.name for f in fields])

    if small(gone, rows):
        got = gone.select("lo", "hi").toPandas()
        flat = np.ascontiguousarray(np.stack([got["lo"].to_numpy(np.int64), got["hi"].to_numpy(np.int64)], 1)).tobytes()
        shared = spark.sparkContext.broadcast(flat)

        def with_set(batches):
            bad = {shared.value[i:i + 16] for i in range(0, len(shared.value), 16)}
            for b in batches:
                yield rewritten(b, lambda _, keys: {j for j, (k, d) in enumerate(zip(keys, digests(keys))) if k and d in bad})

        return docs.mapInArrow(with_set, schema)

    spots = T.StructType([T.StructField("rid", T.LongType()), T.StructField("line", T.IntegerType()), *_KEY.fields])

    def lines_of(batches):
        for b in batches:
            at = [(r, j, k) for r, t in zip(column(b, "rid").to_pylist(), binaries(b, text)) for j, k in enumerate(keys_of(t)) if k]
            both = np.frombuffer(b"".join(digests(k for _, _, k in at)), np.int64).reshape(-1, 2)
            yield arrow_batch(spots, [[x[0] for x in at], [x[1] for x in at], pa.array(both[:, 0]), pa.array(both[:, 1])])

    pin_splits(spark)
    numbered = docs.withColumn(rid_name, F.monotonically_increasing_id())
    hit = numbered.select(F.col(rid_name).alias("rid"), text).mapInArrow(lines_of, spots) \
        .join(gone, ["lo", "hi"], "left_semi").groupBy("rid").agg(F.collect_list("line").alias(gone_name))
    hit = stage(hit.withColumnRenamed("rid", rid_name), "line-hits")

    def with_numbers(batches):
        for b in batches:
            gone_of = column(b, gone_name).to_pylist()
            yield rewritten(b, lambda i, _: set(gone_of[i] or ()))

    return numbered.join(hit, rid_name, "left").drop(rid_name).mapInArrow(with_numbers, schema)


def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCS, batches: int = BATCHES, text: str = "text",
                fanout: int = FANOUT, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``docs`` with frequent lines cut from ``text``, and ``n_lines, n_dropped``."""
    spark = docs.sparkSession
    small_batches(spark)
    hashed = stage(line_counts(docs, batches, text), "line-hashes")
    runs = LineRuns(spark, min_docs, fanout)
    for k in range(batches):
        runs.add(hashed.where(F.col("batch") == k).drop("batch"))
    gone = stage(runs.frequent(), "frequent-lines")
    runs.close()
    return drop_lines(docs, gone, text, rows)


def op3(spark, docs: DataFrame) -> DataFrame:
    return dedup_lines(docs.select("doc_id", "text")) \
        .select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))
