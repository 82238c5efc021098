"""Language identification: language family first, then one-versus-one linear SVMs inside the family.

Features are hashed character bigrams and trigrams of the whole text (letters only, lower case),
square-rooted and scaled to length one. A one-versus-rest SVM picks the family, then every pair of
the family's languages has its own SVM and the language with most votes (ties: summed margin) wins.

Edge cases: a null text, or one without a letter, is ``und`` with score 0. Without labelled rows
every text is ``und``. Rows with a null label never train. Ties go to the alphabetically first
language. Repeated rows count as often as they occur. Other columns pass through untouched; an input
column named like a result column is replaced.
"""
from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_batch, binaries, column, drop_stage, small_batches, stage

BITS = 12
#: Labelled rows of each language the classifier is fitted on (documented bound); every label is learned.
TRAIN_ROWS = 600
#: Labelled rows that reach the driver in all, however many languages there are.
MOST_ROWS = 20_000
#: One side of a classifier has few rows if it has at most one in so many.
FEW = 10
#: Feature rows that are widened to floats at a time.
PART = 8192
# Languages by family; a language not listed is a family of its own.
FAMILIES = {
    "germanic": ("da", "de", "en", "is", "nl", "no", "sv"),
    "romance": ("ca", "es", "fr", "it", "pt", "ro"),
    "slavic": ("bg", "cs", "hr", "pl", "ru", "sk", "sl", "sr", "uk"),
    "uralic": ("et", "fi", "hu"),
}
_KEEP = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, set(text)))


def features(text: str) -> np.ndarray:
    """Scaled counts of hashed character bigrams and trigrams of the whole text."""
    b = b" " + b" ".join(text.lower().encode("utf-8", "replace").translate(_KEEP).split()) + b" "
    a = np.frombuffer(b, np.uint8).astype(np.uint32)
    two = a[:-1] | (a[1:] << np.uint32(8))
    three = two[:-1] | (a[2:] << np.uint32(16))
    code = np.concatenate([two, three + np.uint32(1 << 24)]) * np.uint32(2654435761)
    x = np.sqrt(np.bincount(code >> np.uint32(32 - BITS), minlength=1 << BITS))
    return (x / (np.linalg.norm(x) or 1)).astype(np.float32)


def fit_svm(x: np.ndarray, y: np.ndarray, rounds: int = 150, reg: float = 1e-4) -> np.ndarray:
    """Weights (dims + 1, classes) of linear SVMs for targets ``y`` in -1, +1; 0 leaves a row out. A side with few
    rows counts as much as the other, so that one of very many classes is learned too."""
    w = np.zeros((x.shape[1] + 1, y.shape[1]), np.float32)
    wide = lambda at: np.hstack([x[at:at + PART].astype(np.float32), np.ones((len(x[at:at + PART]), 1), np.float32)])
    whole = wide(0) if len(x) <= PART else None
    used, yes, no = (np.maximum(side.sum(0), 1) for side in (y != 0, y > 0, y < 0))
    up, down = (np.where(used >= FEW * n, used / n - 1, 1).astype(np.float32) for n in (yes, no))
    mean = np.zeros_like(w)
    for t in range(rounds):
        slope = np.zeros_like(w)
        for at in range(0, len(x), PART):
            own, to = wide(at) if whole is None else whole, y[at:at + PART]
            wrong = (to * (own @ w) < 1) * to
            slope += own.T @ (wrong * np.where(wrong > 0, up, down))
        w += (8 / math.sqrt(1 + t)) * (slope / used - reg * w)
        if t >= rounds // 2:
            mean += w
    return mean / (rounds - rounds // 2)


def fit(x: np.ndarray, labels: list, families: dict | None = None) -> dict | None:
    """The two levels of SVMs from feature rows and their languages."""
    langs = sorted(set(labels))
    if not langs:
        return None
    of = {g: f for f, gs in (families or FAMILIES).items() for g in gs}
    fams = sorted({of.get(g, g) for g in langs})
    got = np.array(labels)
    fam_of = np.array([of.get(g, g) for g in got])
    model = {"langs": langs, "fams": fams, "in": [[i for i, g in enumerate(langs) if of.get(g, g) == f] for f in fams]}
    model["fam_w"] = fit_svm(x, np.stack([np.where(fam_of == f, 1, -1).astype(np.int8) for f in fams], 1)) if len(fams) > 1 else None
    pairs = [p for own in model["in"] for p in itertools.combinations(own, 2)]
    model["pairs"] = pairs
    model["pair_w"] = fit_svm(x, np.stack(
        [np.where(got == langs[i], 1, np.where(got == langs[j], -1, 0)).astype(np.int8) for i, j in pairs], 1)) if pairs else None
    return model


def predict(model: dict, x: np.ndarray) -> tuple[list, np.ndarray]:
    """Language and score of each feature row."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    fam, sure = np.zeros(len(x), int), np.ones(len(x))
    if model["fam_w"] is not None:
        m = x @ model["fam_w"]
        fam = m.argmax(1)
        sure = 1 / (1 + np.exp(-4 * m.max(1)))
    votes = np.zeros((len(x), len(model["langs"])))
    margin = np.zeros_like(votes)
    if model["pair_w"] is not None:
        m = x @ model["pair_w"]
        for k, (i, j) in enumerate(model["pairs"]):
            votes[:, i] += m[:, k] >= 0
            votes[:, j] += m[:, k] < 0
            margin[:, i] += m[:, k]
            margin[:, j] -= m[:, k]
    lang = np.zeros(len(x), int)
    for f, own in enumerate(model["in"]):
        r = np.flatnonzero(fam == f)
        rank = votes[np.ix_(r, own)] + np.tanh(margin[np.ix_(r, own)]) / 4
        lang[r] = np.array(own)[rank.argmax(1)] if len(r) else 0
        if len(own) > 1:
            sure[r] *= 1 / (1 + np.exp(-4 * margin[r, lang[r]] / (len(own) - 1)))
    return [model["langs"][i] for i in lang], sure


def training_rows(docs: DataFrame, lang: str, key: str, rows: int = TRAIN_ROWS, most: int = MOST_ROWS) -> DataFrame:
    """About ``rows`` labelled rows of each language (all, if it has fewer), drawn by a hash of ``key``; in all about
    ``most``, of which each language has the same share if there are so many.

    The counts per language are one aggregation over all labelled rows, staged and joined to them.
    """
    counts = stage(docs.where(F.col(lang).isNotNull()).groupBy(lang).agg(F.count("*").alias("rows_of_lang")), "languages")
    share = min(float(rows), most / max(counts.count(), 1))
    draw = F.pmod(F.xxhash64(key, F.lit("draw")), F.lit(1_000_000)) / 1_000_000
    return docs.join(counts, lang).where(draw < F.least(F.lit(1.0), F.lit(share) / F.col("rows_of_lang"))).select(*docs.columns)


def train(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", rows: int = TRAIN_ROWS) -> dict | None:
    """Fit on a bounded sample: for each language ``rows`` feature rows of 2**BITS half floats (8 kB), about ``MOST_ROWS``
    in all, reach the driver, a staged part at a time."""
    small_batches(docs.sparkSession)
    sample = training_rows(docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang")),
                           "lang", "key", rows).where("text is not null").select("lang", "text")
    schema = T.StructType([T.StructField("lang", T.StringType()), T.StructField("x", T.BinaryType())])

    def rows_of(batches):
        for b in batches:
            got = [(g, features(t).astype(np.float16).tobytes()) for g, t in
                   zip(column(b, "lang").to_pylist(), column(b, "text").to_pylist()) if has_letter(t)]
            yield arrow_batch(schema, [[g for g, _ in got], [x for _, x in got]])

    vectors = stage(sample.mapInArrow(rows_of, schema), "vectors")
    got = sorted(map(tuple, vectors.toLocalIterator()))
    drop_stage(vectors)
    if not got:
        return None
    labels = [r[0] for r in got]
    x = np.stack([np.frombuffer(r[1], np.float16) for r in got])
    del got
    return fit(x, labels)


def identify(docs: DataFrame, model: dict | None, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1) from the text alone."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.drop("lang_pred", "score")
    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    shared = spark.sparkContext.broadcast(model)  # 2**BITS weights for each family and pair of languages

    def rows_of(batches):
        m = shared.value
        for b in batches:
            texts = column(b, text).to_pylist()
            fit_for = [i for i, t in enumerate(texts) if m and t and has_letter(t)]
            lang, score = ["und"] * len(texts), [0.0] * len(texts)
            for part in range(0, len(fit_for), 500):
                at = fit_for[part:part + 500]
                for i, g, s in zip(at, *predict(m, np.stack([features(texts[i]) for i in at]))):
                    lang[i], score[i] = g, float(s)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                                             [*b.schema.names, "lang_pred", "score"])

    return docs.mapInArrow(rows_of, schema)


def held_out(key: str = "doc_id"):
    """True for the third of the documents that never trains: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 3 == 1, F.lit(False))


def op9(spark, docs: DataFrame) -> DataFrame:
    docs = docs.select("doc_id", "text", "lang")
    model = train(docs.where(~held_out()))
    return identify(docs.select("doc_id", held_out().alias("held_out"), "text"), model).drop("text")
