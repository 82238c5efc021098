"""Corpus pipeline: language, repeated lines, near copies, benchmark passages, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor kept; its result is
written and read again as the next one's ``docs``. All but the last return the columns of
``documents``. Rows are told apart by position, so rows with equal or null ids are documents of
their own.
"""
from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedcat.llm import decontamination, language_id, line_dedup, ngram_join, packing
from feedcat.llm.common import U64, bit_filter, column, passes, pin_splits, small_batches, stage, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A text whose language is less sure than this is no prose in a language that was learned.
LEAST_SCORE = 0.1


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` without the rows whose positions are in ``gone (rid)``. A bitmap of bounded size lets rows that surely
    stay pass where they are; only the others (those that go, and its few false positives) meet ``gone`` in a join."""
    pin_splits(docs.sparkSession)
    small_batches(docs.sparkSession)
    held = bit_filter(gone.select(F.xxhash64("rid").alias("key")), "key")
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), *COLUMNS).withColumn("key", F.xxhash64("rid"))

    def told(maybe: bool) -> DataFrame:
        def part(batches):
            for b in batches:
                found = passes(held, column(b, "key").to_numpy().view(U64))
                yield b.filter(pa.array(found if maybe else ~found))
        return rows.mapInArrow(part, rows.schema).drop("key")

    return told(False).unionByName(told(True).join(gone, "rid", "left_anti")).select(*COLUMNS)


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter, or whose language can't be told."""
    docs = docs.select(*COLUMNS)
    model = language_id.train(docs.where(~language_id.held_out()))
    told = language_id.identify(docs, model)
    return told.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE)).select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut lines that many documents share; the text and its length change, every document stays."""
    return line_dedup.dedup_lines(docs.select(*COLUMNS)) \
        .withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by similar word 3-grams the one with the smallest id stays (a null id before any
    other), of equal ids the first row; documents without words are linked with nothing and stay.

    A group is named by its least row, not by ``component_id``: ids can be null, or be those of other texts."""
    rows = stage(ngram_join.join_components(docs).where("n_shingles > 0").select("rid", "doc_id", "root"), "joined")
    keepers = rows.groupBy("root").agg(F.min(F.struct("doc_id", "rid")).alias("k"), F.count("*").alias("n")) \
        .where("n > 1").select("root", F.col("k.rid").alias("keeper"))
    gone = rows.join(stage(keepers, "keepers"), "root").where("rid <> keeper").select("rid")
    return _without(docs, stage(gone, "near-copies"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents with at least a twentieth of their words in benchmark windows."""
    rows = decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return _without(docs, stage(rows.where(decontamination.is_contaminated()).select("rid"), "contaminated"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes."""
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", keep_languages),
    ("line_dedup", drop_repeated_lines),
    ("ngram_join", keep_one_of_each_group),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: The first stage is a trained classifier and the last a packing search: SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
