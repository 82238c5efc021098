import datetime as dt

from pyspark.sql import functions as F

from feedcat.operators import health as H

T0 = dt.datetime(2024, 1, 1)


def _log(spark, rows):
    return spark.createDataFrame(
        [(i, u, r, T0 + dt.timedelta(days=r, minutes=m), s) for i, (u, r, m, s) in enumerate(rows)],
        "event_id bigint, url string, run_idx int, checked_at timestamp_ntz, status string")


LOG = ([("u1", r, 0, s) for r, s in enumerate("a d d r d a".split())]
       + [("u2", r, 0, s) for r, s in enumerate("d d r a d".split())]
       + [("u3", r, 0, s) for r, s in enumerate("r d a".split())]
       + [("u4", 0, 0, "d"), ("u4", 1, 0, "d"), ("u4", 3, 0, "d"), ("u4", 4, 0, "a"), ("u4", 6, 0, "d")])
EXPAND = {"a": "active", "d": "down", "r": "rate_limited"}


def _expanded(spark):
    return _log(spark, [(u, r, m, EXPAND[s]) for u, r, m, s in LOG])


def _fold_by_runs(spark, log):
    """Property: F4 equals D6 applied run after run, seeded by the previous run only."""
    runs = sorted({r["run_idx"] for r in log.select("run_idx").distinct().collect()})
    prev = None
    out = {}
    for run in runs:
        new = log.where(F.col("run_idx") == run).select("url", "status", "event_id", "checked_at")
        state = H.health_merge(new, prev, F.col("checked_at"))
        for r in state.collect():
            out[r["event_id"]] = (r["consecutive_failures"], r["down_since"], r["last_seen_active"])
        prev = state
    return out


def test_history_equals_fold_of_merge(spark):
    log = _expanded(spark)
    folded = _fold_by_runs(spark, log)
    for chunk, split in ((1, None), (2, None), (16, None), (1, 60), (1, 1)):
        hist = {r["event_id"]: (r["consecutive_failures"], r["down_since"], r["last_seen_active"])
                for r in H.health_history(log, chunk_runs=chunk, split_seconds=split).collect()}
        assert hist == folded, (chunk, split)


def test_history_known_values(spark):
    hist = {(r["url"], r["run_idx"]): r for r in H.health_history(_expanded(spark), chunk_runs=2).collect()}
    assert [hist[("u1", i)]["consecutive_failures"] for i in range(6)] == [0, 1, 2, 2, 3, 0]
    assert hist[("u1", 4)]["down_since"] == T0 + dt.timedelta(days=1)
    assert hist[("u1", 4)]["last_seen_active"] == T0
    assert hist[("u3", 0)]["consecutive_failures"] == 0 and hist[("u3", 0)]["last_seen_active"] is None
    # run 2 skipped: the state restarts at run 3
    assert hist[("u4", 3)]["consecutive_failures"] == 1
    assert hist[("u4", 3)]["down_since"] == T0 + dt.timedelta(days=3)


def test_two_checks_in_one_run(spark):
    log = _log(spark, [("u", 0, 0, "down"), ("u", 0, 5, "down"), ("u", 1, 0, "active"), ("u", 1, 1, "down")])
    for split in (None, 60):  # with 60 s slices every check of a run is its own chunk
        hist = sorted(H.health_history(log, split_seconds=split).collect(), key=lambda r: r["event_id"])
        assert [r["consecutive_failures"] for r in hist] == [1, 2, 0, 1]
        assert hist[3]["last_seen_active"] == T0 + dt.timedelta(days=1)


def test_hot_url_sliced(spark):
    """One URL with many checks in one run, cut into time slices, equals the unsliced fold."""
    import random
    rnd = random.Random(3)
    rows = [("hot", 0 if i < 300 else 1, i, rnd.choice(["active", "down", "down", "rate_limited"])) for i in range(400)]
    log = _log(spark, rows)
    a = {r["event_id"]: tuple(r[c] for c in ("consecutive_failures", "down_since", "last_seen_active"))
         for r in H.health_history(log).collect()}
    b = {r["event_id"]: tuple(r[c] for c in ("consecutive_failures", "down_since", "last_seen_active"))
         for r in H.health_history(log, split_seconds=600).collect()}
    assert a == b


FETCH = "url string, run_id string, attempt int, checked_at timestamp_ntz, http_status int, net_error string, " \
        "bozo boolean, bozo_error string, entries int, content_type string, final_url string, latency_ms int"


def test_fetch_status_and_retry(spark):
    t = T0
    data = [
        ("ok", "1", 1, t, 200, None, False, None, 5, "application/rss+xml; charset=utf-8", "ok", 10),
        ("bozo_entries", "1", 1, t, 200, None, True, "SAXParseException", 3, None, "x", 10),
        ("bozo_empty", "1", 1, t, 200, None, True, None, 0, "text/xml", "x", 10),
        ("empty", "1", 1, t, 200, None, False, None, 0, "text/xml", "x", 10),
        ("nf", "1", 1, t, 404, None, None, None, None, "text/html", "x", 10),
        ("rl", "1", 1, t, 429, None, None, None, None, "", "x", 10),
        ("to_ok", "1", 1, t, None, "timeout", None, None, None, None, None, 10),
        ("to_ok", "1", 2, t, 200, None, False, None, 2, "text/xml", "x", 10),
        ("to_to", "1", 1, t, None, "timeout", None, None, None, None, None, 10),
        ("to_to", "1", 2, t, None, "timeout", None, None, None, None, None, 10),
        ("to_404", "1", 1, t, None, "connection:ConnectTimeout", None, None, None, None, None, 10),
        ("to_404", "1", 2, t, 404, None, None, None, None, None, "x", 10),
        ("nf_retry", "1", 1, t, 404, None, None, None, None, None, "x", 10),
        ("nf_retry", "1", 2, t, 200, None, False, None, 2, None, "x", 10),
    ]
    df = spark.createDataFrame(data, FETCH)
    st = {(r["url"], r["attempt"]): r for r in H.fetch_status(df).collect()}
    assert (st[("ok", 1)]["status"], st[("ok", 1)]["error"], st[("ok", 1)]["content_type"]) == \
        ("active", None, "application/rss+xml")
    assert (st[("bozo_entries", 1)]["status"], st[("bozo_entries", 1)]["error"]) == ("active", "bozo:SAXParseException")
    assert (st[("bozo_empty", 1)]["status"], st[("bozo_empty", 1)]["error"]) == ("down", "bozo")
    assert (st[("empty", 1)]["status"], st[("empty", 1)]["error"]) == ("active", None)
    assert (st[("nf", 1)]["status"], st[("nf", 1)]["error"], st[("nf", 1)]["bozo"]) == ("down", "http_404", None)
    assert (st[("rl", 1)]["status"], st[("rl", 1)]["error"]) == ("rate_limited", "http_429")
    res = {r["url"]: r for r in H.retry_resolution(H.fetch_status(df)).collect()}
    assert (res["to_ok"]["status"], res["to_ok"]["retried"]) == ("active", True)
    assert (res["to_to"]["status"], res["to_to"]["error"], res["to_to"]["retried"]) == ("down", "timeout", False)
    assert (res["to_404"]["error"], res["to_404"]["retried"]) == ("http_404", True)
    assert (res["nf_retry"]["error"], res["nf_retry"]["retried"]) == ("http_404", False)
    tot = H.check_totals(H.retry_resolution(H.fetch_status(df))).first()
    assert (tot["total"], tot["rate_limited"]) == (10, 1)
