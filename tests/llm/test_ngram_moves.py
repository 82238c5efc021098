"""What op6 moves between tasks, and how many Python workers a task needs."""
import random
import re

import pytest
from pyspark.sql import functions as F

from feedcat.llm import components, ngram_join


def _rows():
    """Two equal texts, near ones, one that shares no more than a part, rows that come twice, null ids."""
    rng = random.Random(12)
    rows = []
    for i in range(40):
        words = [f"w{rng.randrange(9000)}" for _ in range(60)]
        near = [*words, "more"]
        rows += [(10 * i, words), (10 * i + 1, near), (10 * i + 2, [*near, "still"]), (10 * i + 3, words[:40] + [f"x{rng.randrange(9000)}" for _ in range(20)])]
    rows = [(i, " ".join(w)) for i, w in rows]
    return [*rows, (5, rows[0][1]), (5, rows[0][1]), rows[8], rows[8], (None, rows[12][1]), (None, rows[12][1] + " end"), (777, None), (778, "")]


def _want(rows):
    sets = [{tuple(w[j:j + 3]) for j in range(max(len(w) - 2, 1)) if w} for w in ([*(t or "").split()] for _, t in rows)]
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b]):
                group = [group[b] if x == group[a] else x for x in group]
    least = {g: min([rows[k][0] for k in range(len(rows)) if group[k] == g and rows[k][0] is not None], default=None) for g in group}
    return sorted(((i, least[group[k]]) for k, (i, _) in enumerate(rows)), key=repr)


def _got(found):
    return sorted(((r["doc_id"], r["component_id"]) for r in found.collect()), key=repr)


@pytest.fixture()
def plans(monkeypatch):
    """The plan of each staged table, by its name."""
    seen, real = [], ngram_join.stage

    def staged(df, name):
        seen.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return real(df, name)

    for m in (ngram_join, components):
        monkeypatch.setattr(m, "stage", staged)
    return seen


def test_a_task_needs_one_python_worker(spark, plans):
    """No table is made by a pass of Python over the rows of another one in the same task."""
    rows = _rows()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3).cache()
    assert _got(ngram_join.op6(spark, docs)) == _want(rows)
    for name, plan in plans:
        above = []  # (depth, operator) from the root down
        for line in plan.split("\n"):
            depth, op = len(re.match(r"[\s:|+*()\d-]*", line)[0]), re.sub(r"^[\s:|+*()\d-]*", "", line)
            above = [x for x in above if x[0] < depth]
            if op.startswith("MapInArrow"):
                inner = [x for _, x in above]
                inner = inner[max([k for k, x in enumerate(inner) if "Exchange" in x], default=-1) + 1:]
                assert not any(x.startswith("MapInArrow") for x in inner), (name, plan)
            above.append((depth, op))
    assert {"index", "items"} <= {n for n, _ in plans}


def test_items_are_written_where_texts_are_read(spark, plans):
    rows = _rows()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3).cache()
    assert _got(ngram_join.op6(spark, docs)) == _want(rows)
    made = [p.split("InMemoryRelation")[0] for n, p in plans if n == "items"]
    assert made and not any("Exchange" in p for p in made)


def test_rows_that_lie_elsewhere_each_time(spark, plans):
    """Positions don't hold where docs isn't stored: sets are found by text and id."""
    rows = _rows()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").orderBy(F.rand())
    assert _got(ngram_join.op6(spark, docs)) == _want(rows)
    assert sum(n == "items" for n, _ in plans) >= 2


def test_sketches_lose_no_pair(spark):
    import numpy as np

    rng = np.random.default_rng(5)
    sets = []
    for n in (1, 2, 9, 10, 19, 20, 150, 900):
        base = rng.integers(1, 2**62, n).astype(np.uint64)
        for gone in (0, 1, n // 20, n // 10, n // 4):
            own = np.concatenate([base[gone:], rng.integers(1, 2**62, int(rng.integers(0, n // 20 + 2))).astype(np.uint64)])
            sets.append(np.unique(own))
    rows = [(k, x.view(np.int64).tolist(), len(x), ngram_join.parity(x, ngram_join.SKETCH).tolist()) for k, x in enumerate(sets)]
    s = spark.createDataFrame(rows, "node bigint, items array<bigint>, n bigint, sketch array<bigint>").cache()
    pairs = s.select(F.col("node").alias("a")).crossJoin(s.select(F.col("node").alias("b"))).where("a < b")
    want = {(a, b) for b in range(len(sets)) for a in range(b)
            if 100 * len(both := set(rows[a][1]) & set(rows[b][1])) >= 90 * (rows[a][2] + rows[b][2] - len(both))}
    left = {tuple(r) for r in components.sketched(pairs, s, (90, 100)).collect()}
    assert want <= left and len(left) < 2 * len(want)
    for given in (s, s.select("node", "items")):  # as op2 gives them
        assert {tuple(r) for r in components.verified(pairs, lambda nodes: given, (90, 100)).collect()} == want
