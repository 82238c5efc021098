"""J1 equals F4 when the log arrives over several micro-batches; J2 keeps the earliest sighting."""
import datetime as dt

from pyspark.sql import functions as F

from feedcat.operators import health as H
from feedcat.streaming import health_stream as HS
from feedcat.streaming import new_candidates as NC

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "event_id bigint, url string, run_idx int, checked_at timestamp_ntz, status string"


def _log_rows():
    pattern = {"u1": "a d d r d a d d", "u2": "d r r a d d d a", "u3": "r d a a - d d r"}
    rows, i = [], 0
    for u, seq in pattern.items():
        for run, s in enumerate(seq.split()):
            if s == "-":
                continue  # absent from this run
            st = {"a": "active", "d": "down", "r": "rate_limited"}[s]
            rows.append((i, u, run, T0 + dt.timedelta(days=run, minutes=i), st))
            i += 1
    return rows


def test_stream_health_equals_history(spark, tmp_path):
    rows = _log_rows()
    full = spark.createDataFrame(rows, SCHEMA)
    src = tmp_path / "checks"
    for lo, hi in ((0, 3), (3, 5), (5, 8)):  # three files -> three micro-batches
        part = full.where((F.col("run_idx") >= lo) & (F.col("run_idx") < hi))
        part.coalesce(1).write.parquet(str(src / f"runs_{lo}_{hi}"))
    files = sorted(str(p) for p in src.glob("runs_*/*.parquet"))
    flat = tmp_path / "flat"
    flat.mkdir()
    import os
    for n, f in enumerate(files):  # the file source orders files by modification time
        dst = flat / f"{n:03d}.parquet"
        dst.write_bytes(open(f, "rb").read())
        os.utime(dst, (1_700_000_000 + n * 60, 1_700_000_000 + n * 60))
    stream = spark.readStream.schema(full.schema).option("maxFilesPerTrigger", 1).parquet(str(flat))
    state = HS.run_to_completion(spark, stream, chunk_runs=2)
    got = {r["url"]: (r["status"], r["consecutive_failures"], r["down_since"], r["last_seen_active"])
           for r in state.collect()}
    exp = {r["url"]: (r["status"], r["consecutive_failures"], r["down_since"], r["last_seen_active"])
           for r in H.latest_state(H.health_history(full)).collect()}
    assert got == exp
    assert got["u1"][1] == 2 and got["u3"][0] == "rate_limited"


def test_stream_new_earliest(spark, tmp_path):
    rows = [(1, T0 + dt.timedelta(hours=5), "https://a.org/f?x=1"), (2, T0, "https://www.a.org/f/"),
            (3, T0 + dt.timedelta(hours=1), "https://b.org/f")]
    df = spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, feed_url string")
    from feedcat.functions import urls as U
    df = U.url_hash(df, "feed_url", "url_hash")
    src = tmp_path / "s"
    df.coalesce(1).write.parquet(str(src))
    stream = spark.readStream.schema(df.schema).parquet(str(src))
    seen = {r["feed_url"]: r["first_event"] for r in NC.run_to_completion(spark, stream).collect()}
    assert seen == {"https://www.a.org/f/": 2, "https://b.org/f": 3}


def test_keyed_state_stream_equals_history(spark, tmp_path):
    import os

    from feedcat.streaming import health_state as HK
    rows = _log_rows()
    full = spark.createDataFrame(rows, SCHEMA)
    flat = tmp_path / "flat"
    flat.mkdir()
    for n, (lo, hi) in enumerate(((0, 3), (3, 5), (5, 8))):
        part = full.where((F.col("run_idx") >= lo) & (F.col("run_idx") < hi)).coalesce(1)
        d = tmp_path / f"p{n}"
        part.write.parquet(str(d))
        src = next(p for p in d.glob("*.parquet"))
        dst = flat / f"{n:03d}.parquet"
        dst.write_bytes(src.read_bytes())
        os.utime(dst, (1_700_000_000 + n * 60, 1_700_000_000 + n * 60))
    stream = spark.readStream.schema(full.schema).option("maxFilesPerTrigger", 1).parquet(str(flat))
    got = {r["url"]: (r["status"], r["consecutive_failures"], r["down_since"], r["last_seen_active"])
           for r in HK.run_to_completion(spark, stream).collect()}
    exp = {r["url"]: (r["status"], r["consecutive_failures"], r["down_since"], r["last_seen_active"])
           for r in H.latest_state(H.health_history(full)).collect()}
    assert got == exp


def _history(df):
    return sorted(tuple(r) for r in df.select("event_id", "url", "run_idx", "checked_at", "status", "consecutive_failures", "down_since",
                                              "last_seen_active").collect())


def test_checks_in_any_order_give_the_history(spark, tmp_path):
    """Late runs, runs split over batches, repeated checks and a repeated batch."""
    import random

    from feedcat.sources.versions import BucketedTable
    rng = random.Random(4)
    rows, i = [], 0
    for u in range(6):
        for run in range(12):
            if rng.random() < 0.15:
                continue
            for _ in range(rng.choice([1, 1, 2, 3])):
                rows.append((i, f"u{u}", run, T0 + dt.timedelta(days=run, minutes=rng.randrange(60)), rng.choice(["active", "down", "down", "rate_limited"])))
                i += 1
    full = spark.createDataFrame(rows, SCHEMA)
    want = _history(H.health_history(full))
    for n in range(2):
        dealt = [rng.randrange(3 + n) for _ in rows]
        table = BucketedTable(spark, str(tmp_path / f"t{n}"))
        for b in range(3 + n):
            part = [r for r, d in zip(rows, dealt) if d == b] + rng.sample(rows, 3)
            HS.absorb(table, spark.createDataFrame(part, SCHEMA), b, chunk_runs=3, buckets=2, block_runs=4)
        HS.absorb(table, full.limit(5).withColumn("status", F.lit("never")), 2, buckets=2, block_runs=4)  # tried again
        assert _history(table.read()) == want
        assert len([p for p in (tmp_path / f"t{n}").iterdir() if p.name.startswith("data-")]) <= 3 + n


def test_a_batch_in_order_leaves_the_early_blocks(spark, tmp_path):
    from feedcat.sources.versions import BucketedTable
    rows = [(u * 100 + run, f"u{u}", run, T0 + dt.timedelta(days=run), "down") for u in range(8) for run in range(40)]
    table = BucketedTable(spark, str(tmp_path / "t"))
    HS.absorb(table, spark.createDataFrame(rows, SCHEMA), 0, buckets=4, block_runs=10)
    old = table.parts()
    HS.absorb(table, spark.createDataFrame([(9000, "u3", 40, T0, "down"), (9001, "u3", 41, T0, "active")], SCHEMA), 1, buckets=4, block_runs=10)
    new = table.parts()
    assert len([n for n in new if new[n] != old.get(n)]) == 1 and {n: new[n] for n in old} == old  # a new block, seeded by the one before
    last = {r["event_id"]: r["consecutive_failures"] for r in table.read().where("url = 'u3'").collect()}
    assert last[339] == 40 and last[9000] == 41 and last[9001] == 0


def test_seen_table_is_replaced_by_bucket(spark, tmp_path):
    from feedcat.sources.versions import BucketedTable
    schema = "url_hash string, feed_url string, ts timestamp_ntz, event_id bigint"
    table = BucketedTable(spark, str(tmp_path / "t"))
    first = [(f"h{i}", f"https://{i}.org", T0 + dt.timedelta(hours=1), i) for i in range(500)]
    NC.absorb(table, spark.createDataFrame(first, schema), 0, buckets=64)
    old = table.parts()
    files = {n: sorted(p.name for p in (tmp_path / "t" / f).iterdir()) for n, f in old.items()}
    batch = [(f"h{i}", f"https://{i}.org/later", T0 + dt.timedelta(hours=2), 900 + i) for i in range(5)] \
        + [(f"h{i}", f"https://{i}.org/earlier", T0, 800 + i) for i in range(5, 8)] + [("new1", "https://n1", T0, 1), ("new2", "https://n2", T0, 2)]
    written = NC.absorb(table, spark.createDataFrame(batch, schema), 1, buckets=64)
    new = table.parts()
    assert 0 < len(written) <= 5 and {n for n in new if new[n] != old.get(n)} == set(written)  # what is known already changes nothing
    assert all(sorted(p.name for p in (tmp_path / "t" / new[n]).iterdir()) == files[n] for n in old if n not in written)
    got = {r["url_hash"]: (r["feed_url"], r["first_event"]) for r in table.read().collect()}
    assert len(got) == 502 and got["h1"] == ("https://1.org", 1) and got["h6"] == ("https://6.org/earlier", 806) and got["new2"] == ("https://n2", 2)
    assert NC.absorb(table, spark.createDataFrame(batch, schema), 1, buckets=64) == [] and table.version() == 2
    for b in range(2, 8):
        NC.absorb(table, spark.createDataFrame([(f"b{b}", "https://b", T0, b)], schema), b, buckets=64)
    assert table.read().count() == 508
