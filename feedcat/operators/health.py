"""Feed health: classify captured fetches, resolve retries, carry history
(A11, C9, E21, D6, F4, E9, B28).

Health history (F4) is a fold over each URL's checks.  A fold maps onto a
window partitioned by URL, but one hot URL would then sort in one task, so
the log is cut into (url, run-chunk) partitions: each chunk is folded
locally with windows, chunk summaries (tiny: one row per url and chunk)
compose the carry-in state with a second window, and the carry patches the
rows of the chunk's first segment.  The result equals the sequential fold.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import strip_ws

def fetch_status(fetches: DataFrame) -> DataFrame:
    """One captured fetch attempt -> status/error/http_status/bozo/entries/...

    429 -> rate_limited/http_429; >=400 -> down/http_N; network error ->
    down with its text; otherwise active unless bozo with no entries, a bozo
    error kept even when active; 'empty_or_unparseable' if down without one.
    """
    net = F.col("net_error")
    http = F.col("http_status")
    got = net.isNull() & http.isNotNull()
    ok = got & (http < 400)
    bozo = F.coalesce(F.col("bozo"), F.lit(False))
    entries = F.coalesce(F.col("entries"), F.lit(0))
    bozo_err = F.when(bozo & F.col("bozo_error").isNotNull(), F.concat(F.lit("bozo:"), F.col("bozo_error"))) \
        .when(bozo, F.lit("bozo"))
    active = ~bozo | (entries > 0)
    status = (F.when(net.isNotNull() | http.isNull(), F.lit("down"))
              .when(http == 429, F.lit("rate_limited"))
              .when(http >= 400, F.lit("down"))
              .when(active, F.lit("active"))
              .otherwise(F.lit("down")))
    error = (F.when(net.isNotNull(), net)
             .when(http.isNull(), F.lit("unexpected:NoResponse"))
             .when(http == 429, F.lit("http_429"))
             .when(http >= 400, F.concat(F.lit("http_"), http.cast("string")))
             .when(active, bozo_err)
             .otherwise(F.coalesce(bozo_err, F.lit("empty_or_unparseable"))))
    ct = F.lower(strip_ws(F.split_part(F.coalesce(F.col("content_type"), F.lit("")), F.lit(";"), F.lit(1))))
    keep = [c for c in ("url", "run_id", "attempt", "checked_at") if c in fetches.columns]
    return fetches.select(
        *keep, status.alias("status"), error.alias("error"),
        F.when(got, http).alias("http_status"),
        F.when(ok, bozo).alias("bozo"),
        F.when(ok, entries).alias("entries"),
        F.when(got, F.col("final_url")).alias("final_url"),
        F.when(got, ct).alias("content_type"),
        F.col("latency_ms"))


def retry_resolution(classified: DataFrame) -> DataFrame:
    """A second attempt replaces the first iff the first was down with a
    transient error (timeout / connection: / request:) and the second is not
    down or carries an HTTP status; ``retried`` marks the replacement."""
    cols = ["status", "error", "http_status", "bozo", "entries", "final_url", "content_type", "latency_ms",
            "checked_at"]
    rec = F.struct(*cols)
    g = classified.groupBy("url", "run_id").agg(
        F.min_by(rec, F.col("attempt")).alias("a1"),
        F.min_by(F.when(F.col("attempt") == 2, rec), F.when(F.col("attempt") == 2, F.col("attempt"))).alias("a2"))
    e = F.coalesce(F.col("a1.error"), F.lit(""))
    transient = (F.col("a1.status") == "down") & ((e == "timeout") | e.startswith("connection:") | e.startswith("request:"))
    use2 = transient & F.col("a2").isNotNull() & ((F.col("a2.status") != "down") | F.col("a2.http_status").isNotNull())
    pick = F.when(use2, F.col("a2")).otherwise(F.col("a1"))
    return g.select("url", "run_id", *[pick[c].alias(c) for c in cols], use2.alias("retried"))


def health_merge(new: DataFrame, prev: DataFrame | None, now, ts_type: str = "timestamp_ntz") -> DataFrame:
    """New results left-joined to the previous state (url, consecutive_failures,
    down_since, last_seen_active); active resets, rate_limited carries, down counts."""
    now_c = F.lit(now).cast(ts_type) if isinstance(now, str) else now
    if prev is None:
        df = new.withColumns({"__cf": F.lit(0), "__ds": F.lit(None).cast(ts_type),
                              "__lsa": F.lit(None).cast(ts_type)})
    else:
        p = prev.select("url", F.col("consecutive_failures").alias("__cf"), F.col("down_since").alias("__ds"),
                        F.col("last_seen_active").alias("__lsa"))
        df = new.join(p, "url", "left")
    st, cf = F.col("status"), F.coalesce(F.col("__cf"), F.lit(0))
    return df.withColumns({
        "consecutive_failures": F.when(st == "active", F.lit(0)).when(st == "rate_limited", cf).otherwise(cf + 1),
        "down_since": F.when(st == "active", F.lit(None).cast(ts_type))
                       .when(st == "rate_limited", F.col("__ds")).otherwise(F.coalesce(F.col("__ds"), now_c)),
        "last_seen_active": F.when(st == "active", now_c).otherwise(F.col("__lsa")),
    }).drop("__cf", "__ds", "__lsa")


def health_history(log: DataFrame, chunk_runs: int = 16, seed: DataFrame | None = None,
                   split_seconds: int | None = None) -> DataFrame:
    """health state after every check of a check log.

    ``log``: (event_id, url, run_idx, checked_at, status).  Checks of a URL are
    folded in (run_idx, checked_at, event_id) order; the state restarts when a
    run is skipped (the URL was absent from the previous run's snapshot).
    ``seed`` (url, run_idx, consecutive_failures, down_since, last_seen_active)
    is a previous state: it enters as a virtual chunk before every real one.

    Chunks are ``chunk_runs`` consecutive runs.  When one URL is checked very
    often inside a run, ``split_seconds`` cuts every run into time slices
    (chunk = (run, slice)), so no window partition holds more than one slice.
    """
    o = ["run_idx", "checked_at", "event_id"]
    if split_seconds:
        epoch = F.lit("1970-01-01 00:00:00").cast(dict(log.dtypes)["checked_at"])
        slice_ = F.floor(F.timestamp_diff("SECOND", epoch, F.col("checked_at")) / split_seconds)
        chunk = F.struct(F.col("run_idx").cast("bigint").alias("rb"), slice_.cast("bigint").alias("tb"))
    else:
        chunk = F.struct(F.floor(F.col("run_idx") / chunk_runs).cast("bigint").alias("rb"),
                         F.lit(0).cast("bigint").alias("tb"))
    df = log.withColumn("chunk", chunk)
    w = Window.partitionBy("url", "chunk").orderBy(*o)
    wrun = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    is_act, is_down = F.col("status") == "active", F.col("status") == "down"
    prev_run = F.lag("run_idx").over(w)
    df = df.withColumn("__brk", (prev_run.isNull() | (F.col("run_idx") - prev_run > 1)).cast("int"))
    df = df.withColumn("lseg", F.sum("__brk").over(wrun))
    ws = Window.partitionBy("url", "chunk", "lseg").orderBy(*o).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    df = df.withColumn("island", F.sum(is_act.cast("int")).over(ws))
    wi = Window.partitionBy("url", "chunk", "lseg", "island").orderBy(*o) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    df = df.withColumns({
        "cf_l": F.sum(is_down.cast("int")).over(wi),
        "ds_l": F.min(F.when(is_down, F.col("checked_at"))).over(wi),
        "lsa_l": F.max(F.when(is_act, F.col("checked_at"))).over(ws),
    })
    df = df.withColumns({
        "cf_l": F.when(is_act, F.lit(0)).otherwise(F.col("cf_l")),
        "ds_l": F.when(is_act, F.lit(None)).otherwise(F.col("ds_l")),
    })
    # chunk summaries: how the chunk maps an incoming state to its outgoing state
    last = F.struct(*[F.col(c) for c in o])
    summ = df.groupBy("url", "chunk").agg(
        F.min("run_idx").alias("first_run"), F.max("run_idx").alias("last_run"),
        F.max("lseg").alias("n_seg"),
        F.max(F.when(F.col("lseg") == 1, F.col("island"))).alias("acts_seg1"),
        F.max_by(F.struct("cf_l", "ds_l", "lsa_l"), last).alias("end"),
        F.sum(F.when((F.col("lseg") == 1) & is_down, 1).otherwise(0)).alias("downs"),
        F.min(F.when((F.col("lseg") == 1) & is_down, F.col("checked_at"))).alias("first_down"))
    if seed is not None:
        ts_t = dict(df.dtypes)["checked_at"]
        summ = summ.unionByName(seed.select(
            "url", F.struct(F.lit(-(2 ** 62)).cast("bigint").alias("rb"), F.lit(0).cast("bigint").alias("tb"))
            .alias("chunk"),
            F.col("run_idx").alias("first_run"), F.col("run_idx").alias("last_run"),
            F.lit(1).cast("bigint").alias("n_seg"), F.lit(1).cast("bigint").alias("acts_seg1"),
            F.struct(F.col("consecutive_failures").cast("bigint").alias("cf_l"),
                     F.col("down_since").cast(ts_t).alias("ds_l"),
                     F.col("last_seen_active").cast(ts_t).alias("lsa_l")).alias("end"),
            F.lit(0).cast("bigint").alias("downs"), F.lit(None).cast(ts_t).alias("first_down")),
            allowMissingColumns=True)
    wc = Window.partitionBy("url").orderBy("chunk")
    summ = summ.withColumn("cont", F.coalesce(F.col("first_run") - F.lag("last_run").over(wc) <= 1, F.lit(False)))
    reset = (F.col("n_seg") > 1) | (F.col("acts_seg1") > 0)
    summ = summ.withColumn("__anchor", F.when(reset | ~F.col("cont"), F.col("chunk")))
    summ = summ.withColumn("__anchor", F.max("__anchor").over(wc.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    # The anchoring chunk (a reset, or a skipped run before it) leaves its local end
    # state; every later chunk up to the next anchor only adds downs.
    wa = Window.partitionBy("url", "__anchor").orderBy("chunk").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    later = F.col("chunk") != F.col("__anchor")
    a_end = F.first("end").over(wa)
    summ = summ.withColumns({
        "out_cf": a_end["cf_l"] + F.sum(F.when(later, F.col("downs")).otherwise(0)).over(wa),
        "out_ds": F.coalesce(a_end["ds_l"], F.min(F.when(later, F.col("first_down"))).over(wa)),
        "out_lsa": a_end["lsa_l"],
    })
    carry = summ.select(
        "url", "chunk", "cont",
        F.lag("out_cf").over(wc).alias("in_cf"), F.lag("out_ds").over(wc).alias("in_ds"),
        F.lag("out_lsa").over(wc).alias("in_lsa"))
    j = df.join(carry, ["url", "chunk"])
    patch = F.col("cont") & (F.col("lseg") == 1)
    fresh = patch & (F.col("island") == 0)
    return j.select(
        "event_id", "url", "run_idx", "checked_at", "status",
        F.when(fresh, F.coalesce(F.col("in_cf"), F.lit(0)) + F.col("cf_l")).otherwise(F.col("cf_l"))
         .cast("int").alias("consecutive_failures"),
        F.when(fresh, F.coalesce(F.col("in_ds"), F.col("ds_l"))).otherwise(F.col("ds_l")).alias("down_since"),
        F.when(fresh, F.coalesce(F.col("lsa_l"), F.col("in_lsa"))).otherwise(F.col("lsa_l")).alias("last_seen_active"))


def latest_state(history: DataFrame) -> DataFrame:
    """State after each URL's last check (the status snapshot's results map)."""
    last = F.struct("run_idx", "checked_at", "event_id")
    rec = F.struct("status", "consecutive_failures", "down_since", "last_seen_active", "checked_at")
    g = history.groupBy("url").agg(F.max_by(rec, last).alias("r"))
    return g.select("url", *[F.col("r")[c].alias(c) for c in
                             ("status", "consecutive_failures", "down_since", "last_seen_active", "checked_at")])


def check_totals(results: DataFrame) -> DataFrame:
    """Total, active, down (everything else), rate_limited."""
    st = F.col("status")
    return results.groupBy().agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(st == "active").alias("active"),
        F.count_if((st != "active") & (st != "rate_limited")).alias("down"),
        F.count_if(st == "rate_limited").alias("rate_limited"))


def badge_class(status_col) -> F.Column:
    """UI badge class from a status (missing -> unknown)."""
    st = F.lower(F.coalesce(status_col, F.lit("unknown")))
    return (F.when(st == "active", F.lit("badge badge-active"))
            .when(st == "down", F.lit("badge badge-down"))
            .otherwise(F.lit("badge badge-unknown")))
