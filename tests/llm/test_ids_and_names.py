"""Ids above 2**53 next to null ids, columns with the operators' own names, one label per row."""
import pytest
from pyspark.sql import functions as F

from feedcat.llm import language_id, line_dedup, packing

BIG = 2 ** 60


def test_packing_keeps_large_ids_next_to_null_ids(spark):
    rows = [(BIG + i, "w " * (i + 3), "s%d" % i) for i in range(5)] + [(None, "w w", "s9"), (None, None, None)]
    got = packing.op7(spark, spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()
    assert sorted((r["doc_id"] or 0, r["n_words"]) for r in got) == sorted((d or 0, len((t or "").split())) for d, t, _ in rows)


@pytest.mark.parametrize("keys", [line_dedup.BROADCAST_ROWS, 0])  # bad lines as a set, and joined
def test_line_dedup_passes_columns_of_any_name(spark, keys):
    rows = [(i, f"own {i}\nshared line", [i], 7 * i, "g") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, _gone array<int>, _rid int, rid string").repartition(3)
    got = line_dedup.dedup_lines(docs, rows=keys)
    assert sorted((r["doc_id"], r["text"], r["_gone"], r["_rid"], r["rid"], r["n_dropped"]) for r in got.collect()) == [
        (i, f"own {i}", [i], 7 * i, "g", 1) for i in range(12)]


def test_training_rows_are_bounded_in_all(spark):
    docs = spark.range(5_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("l"), (F.col("id") % 2_500).cast("string")).alias("lang"), F.lit("t").alias("text"))
    assert 700 < language_id.training_rows(docs, "lang", "doc_id", rows=600, most=1_000).count() < 1_300
    few = docs.withColumn("lang", F.col("doc_id") % 2)
    assert 1_100 < language_id.training_rows(few, "lang", "doc_id", rows=600, most=20_000).count() < 1_300
