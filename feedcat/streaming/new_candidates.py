"""Streaming first-seen candidates.

Sightings are de-duplicated on ``url_hash`` inside an event-time watermark
(``dropDuplicatesWithinWatermark``) to cut volume; the seen table, not the
watermark, decides what is new, because the cache never expires.  The table is
bucketed by the hash.  Each micro-batch keeps its earliest sighting per hash, reads the
buckets of its hashes, and replaces only those in which a hash is new or was sighted
earlier than known, so a batch costs what its hashes' buckets hold, not the history.
A batch that is tried again finds its number in the table and is left out.
"""
from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir, materialize
from ..sources.versions import BucketedTable, bucket

SEEN_COLS = ["url_hash", "feed_url", "first_seen", "first_event"]
BUCKETS = 256
#: Versions whose folders stay.
KEEP_VERSIONS = 4


def absorb(table: BucketedTable, batch: DataFrame, batch_id: int, buckets: int = BUCKETS) -> list[str]:
    """Put a batch of sightings into the seen table; returns the buckets that were replaced."""
    if batch_id <= table.last_batch():
        return []
    earliest = F.struct("first_seen", "first_event")
    first = batch.select("url_hash", "feed_url", F.col("ts").alias("first_seen"), F.col("event_id").alias("first_event"))
    first = materialize(first.groupBy("url_hash").agg(F.min_by(F.struct("feed_url", "first_seen", "first_event"), earliest).alias("f"))
                        .select("url_hash", "f.*", bucket("url_hash", buckets).alias("part")))
    names = [r["part"] for r in first.select("part").distinct().collect()]  # at most `buckets`

    def step(version: int) -> list[str]:
        old, out = table.read(names, version), first
        if old is not None:
            old = old.withColumn("part", bucket("url_hash", buckets))
            known = old.select("url_hash", earliest.alias("known"))
            fresh = materialize(first.join(known, "url_hash", "left").where(F.col("known").isNull() | (earliest < F.col("known"))).drop("known"))
            changed = old.join(fresh.select("part").distinct(), "part", "left_semi")
            out = changed.join(fresh.select("url_hash"), "url_hash", "left_anti").select(*SEEN_COLS, "part") \
                .unionByName(fresh.select(*SEEN_COLS, "part"))
        return table.replace(out.select(*SEEN_COLS, "part"), "part", batch_id, version)

    written = table.retry(step)
    table.vacuum(KEEP_VERSIONS)
    return written


def start_new_stream(spark: SparkSession, sightings: DataFrame, table_dir: str, checkpoint: str,
                     watermark: str = "1 hour", pre_dedup: bool = False, buckets: int = BUCKETS):
    """``sightings``: streaming (url_hash, feed_url, ts, event_id).

    ``pre_dedup`` drops repeated hashes inside the watermark before the batch
    sink (less data, but the kept sighting of a hash is whichever arrived
    first, so first_seen is then 'first delivered' rather than earliest).
    """
    # the watermark needs an instant; ``ts`` itself (any timestamp type) stays the ordering key
    deduped = sightings.withColumn("__event_time", F.col("ts").cast("timestamp")) \
        .withWatermark("__event_time", watermark)
    if pre_dedup:
        deduped = deduped.dropDuplicatesWithinWatermark(["url_hash"])
    table = BucketedTable(spark, table_dir)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        absorb(table, batch, batch_id, buckets)

    return (deduped.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def run_to_completion(spark: SparkSession, sightings: DataFrame, watermark: str = "1 hour",
                      pre_dedup: bool = False, buckets: int = BUCKETS) -> DataFrame:
    base = os.path.join(checkpoint_dir(spark), f"seen-{uuid.uuid4().hex}")
    q = start_new_stream(spark, sightings, f"{base}/table", f"{base}/checkpoint", watermark, pre_dedup, buckets)
    q.awaitTermination()
    return BucketedTable(spark, f"{base}/table").read().select(*SEEN_COLS)
