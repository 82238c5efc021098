"""Language identification with more labels than a hundred."""
import random

from pyspark.sql import functions as F

from feedcat.llm import language_id


def test_every_label_is_learned(spark):
    rng = random.Random(6)
    rows = []
    for k in range(120):
        words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(12)]
        rows += [(100 * k + i, " ".join(rng.choices(words, k=40)), f"l{k:03d}") for i in range(6)]
    rows += [(90000 + i, rows[0][1], "l000") for i in range(60)] + [(1, "a null label", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3).cache()
    drawn = language_id.training_rows(docs, "lang", "doc_id", 20)
    per = {r["lang"]: r["count"] for r in drawn.groupBy("lang").count().collect()}
    assert len(per) == 120 and drawn.columns == docs.columns
    assert all(per[f"l{k:03d}"] == 6 for k in range(1, 120)) and 8 <= per["l000"] <= 36
    told = language_id.identify(docs.where("lang is not null"), language_id.train(docs))
    assert told.where(F.col("lang") == F.col("lang_pred")).count() >= 0.95 * (len(rows) - 1)
    assert told.select("lang_pred").distinct().count() == 120
