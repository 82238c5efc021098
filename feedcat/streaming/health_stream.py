"""Streaming feed health, checks in any order.

The state is the health history itself, the state after every check, in a bucketed table: a partition holds the checks
of a bucket of URLs over a block of runs. A micro-batch may bring runs late, again, or split over batches: for each of
its URLs everything from the earliest run it brings is folded anew (F4), seeded by the state before that run, which is
in the table. Only the partitions from that run's block on, of the batch's buckets, are read and replaced, so a batch
in run order touches the last blocks of its buckets however long the history is. The result is F4's, whatever the order
of arrival. A batch that is tried again finds its number in the table's last version and is left out; checks that were
stored before are told by (url, event_id). Folders that the last versions don't name are deleted as batches go by.
"""
from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import health as H
from ..session import checkpoint_dir, materialize
from ..sources.versions import BucketedTable, bucket

STATE_COLS = ["url", "run_idx", "checked_at", "status", "consecutive_failures", "down_since", "last_seen_active"]
CHECK_COLS = ["event_id", "url", "run_idx", "checked_at", "status"]
BUCKETS = 64
#: Runs of a partition.
BLOCK_RUNS = 64
#: Versions whose folders stay.
KEEP_VERSIONS = 4


def _placed(df: DataFrame, buckets: int, block_runs: int) -> DataFrame:
    block = F.floor(F.col("run_idx") / block_runs).cast("bigint")
    return df.withColumns({"bucket": bucket("url", buckets), "block": block}) \
        .withColumn("part", F.concat("bucket", F.lit("_"), F.col("block").cast("string")))


def absorb(table: BucketedTable, batch: DataFrame, batch_id: int, chunk_runs: int = 16, buckets: int = BUCKETS,
           block_runs: int = BLOCK_RUNS) -> None:
    """Fold a batch of checks into the table of histories."""
    if batch_id <= table.last_batch():
        return
    batch = materialize(batch.select(*CHECK_COLS).dropDuplicates(["url", "event_id"]))
    low = batch.groupBy("url").agg(F.min("run_idx").alias("low"))
    by_bucket = _placed(batch, buckets, block_runs).groupBy("bucket").agg(F.min("run_idx").alias("low_run"))
    first = {r["bucket"]: r["low_run"] for r in by_bucket.collect()}  # a row for each bucket

    def step(version: int) -> None:
        names = [n for n in table.parts(version) for b, _, block in [n.partition("_")]
                 if b in first and int(block) >= (first[b] - 1) // block_runs]
        old = table.read(names, version)
        checks, seed, kept = batch, None, None
        if old is not None:
            old = old.join(low, "url", "left")
            late = F.col("run_idx") >= F.col("low")
            before = old.where(F.col("low").isNotNull() & ~late)
            rec = F.struct("run_idx", "consecutive_failures", "down_since", "last_seen_active")
            seed = before.groupBy("url").agg(F.max_by(rec, F.struct("run_idx", "checked_at", "event_id")).alias("r")).select("url", "r.*")
            checks = old.where(late).select(*CHECK_COLS).unionByName(batch).dropDuplicates(["url", "event_id"])
            kept = old.where(~F.coalesce(late, F.lit(False))).drop("low")
        out = H.health_history(checks, chunk_runs=chunk_runs, seed=seed)
        out = out if kept is None else out.unionByName(kept.select(*out.columns))
        # what was read for its state alone stays as it is
        out = _placed(out, buckets, block_runs).join(by_bucket, "bucket") \
            .where(F.col("block") >= F.floor(F.col("low_run") / block_runs)).drop("bucket", "block", "low_run")
        table.replace(out, "part", batch_id, version)

    table.retry(step)
    table.vacuum(KEEP_VERSIONS)


def start_health_stream(spark: SparkSession, checks: DataFrame, state_dir: str, checkpoint: str,
                        chunk_runs: int = 16, available_now: bool = True, buckets: int = BUCKETS,
                        block_runs: int = BLOCK_RUNS):
    """Run the streaming fold; ``checks`` is a streaming DataFrame of check events."""
    table = BucketedTable(spark, state_dir)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        absorb(table, batch, batch_id, chunk_runs, buckets, block_runs)

    w = checks.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def history(spark: SparkSession, state_dir: str) -> DataFrame:
    """The state after every check seen so far, as F4 gives it."""
    return BucketedTable(spark, state_dir).read()


def latest_state(spark: SparkSession, state_dir: str) -> DataFrame:
    """Each URL's state after its last check."""
    rec = F.struct(*[c for c in STATE_COLS if c != "url"])
    last = F.struct("run_idx", "checked_at", "event_id")
    return history(spark, state_dir).groupBy("url").agg(F.max_by(rec, last).alias("r")).select("url", "r.*")


def run_to_completion(spark: SparkSession, checks: DataFrame, chunk_runs: int = 16, **size) -> DataFrame:
    """Process everything available and return the final state table."""
    base = os.path.join(checkpoint_dir(spark), f"health-{uuid.uuid4().hex}")
    q = start_health_stream(spark, checks, f"{base}/state", f"{base}/checkpoint", chunk_runs, **size)
    q.awaitTermination()
    return latest_state(spark, f"{base}/state")
