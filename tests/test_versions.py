"""Versioned tables: pinned readers, two writers, failures between writing and swapping, and partitions replaced one by one."""
import pytest
from pyspark.sql import functions as F

from feedcat.sources import versions as V

ITEMS = "url string, title string, ord bigint"


def rows(table, version=None):
    return sorted((r["url"], r["title"]) for r in table.read(version=version).collect())


def test_merge_or_replace(spark, tmp_path):
    t = V.VersionedTable(spark, str(tmp_path / "t"))
    assert t.read() is None and t.version() == 0
    one = spark.createDataFrame([("https://a", "A", 1), (" https://b ", "B", 2)], ITEMS)
    two = spark.createDataFrame([("https://b", "again", 1), ("https://c", "C", 3), ("https://c", "C2", 4)], ITEMS)
    assert V.merge_or_replace(t, one) == 1
    pinned = t.read()
    assert V.merge_or_replace(t, two) == 2
    assert rows(t) == [(" https://b ", "B"), ("https://a", "A"), ("https://c", "C")]
    assert V.merge_or_replace(t, two, merge=False) == 3
    assert rows(t) == [("https://b", "again"), ("https://c", "C"), ("https://c", "C2")]
    assert pinned.count() == 2 and len(rows(t, 2)) == 3
    t.vacuum(keep=1)
    assert len(rows(t)) == 3 and len([p for p in (tmp_path / "t").iterdir() if p.name.startswith("data-")]) == 1


def test_a_failure_before_the_swap_leaves_the_old_version(spark, tmp_path, monkeypatch):
    t = V.VersionedTable(spark, str(tmp_path / "t"))
    V.merge_or_replace(t, spark.createDataFrame([("https://a", "A", 1)], ITEMS))

    def lost(*a, **k):
        raise RuntimeError("lost")

    monkeypatch.setattr(V.VersionedTable, "commit", lost)
    with pytest.raises(RuntimeError):
        V.merge_or_replace(t, spark.createDataFrame([("https://b", "B", 1)], ITEMS))
    monkeypatch.undo()
    assert rows(V.VersionedTable(spark, str(tmp_path / "t"))) == [("https://a", "A")] and t.version() == 1
    assert len([p for p in (tmp_path / "t").iterdir() if p.name.startswith("data-")]) == 1


def test_the_second_of_two_writers_works_on_the_first_ones_version(spark, tmp_path):
    t, other = (V.VersionedTable(spark, str(tmp_path / "t")) for _ in range(2))
    V.merge_or_replace(t, spark.createDataFrame([("https://a", "A", 1)], ITEMS))
    seen = []

    def change(old):
        seen.append(old.count())
        if len(seen) == 1:  # the other writer comes between reading and swapping
            V.merge_or_replace(other, spark.createDataFrame([("https://b", "B", 1)], ITEMS))
        return old.unionByName(spark.createDataFrame([("https://c", "C", 1)], ITEMS))

    assert t.update(change) == 3 and seen == [1, 2]
    assert [u for u, _ in rows(t)] == ["https://a", "https://b", "https://c"]
    with pytest.raises(V.Conflict):
        t.commit(1, {"folder": "late"})


def test_a_partition_is_replaced_alone(spark, tmp_path):
    t = V.BucketedTable(spark, str(tmp_path / "t"))
    base = spark.range(1000).withColumn("part", V.bucket("id", 64))
    assert len(t.replace(base, "part", 0, 0)) == 64
    old = t.parts()
    few = spark.createDataFrame([(5,), (7,)], "id bigint").withColumn("part", V.bucket("id", 64))
    touched = t.replace(few, "part", 1, 1)
    assert len(touched) <= 2 and {n for n, f in t.parts().items() if f != old[n]} == set(touched)
    gone = base.where(F.col("part").isin(*touched)).count()
    assert t.read().count() == 1000 - gone + 2 and t.read(version=1).count() == 1000 and t.last_batch() == 1
    assert t.read(["no such"]) is None
