"""Chat formatting with offset-aligned loss masks.

A conversation is rendered whole: for each turn ``### role:`` and a line break, the text, a line
break and ``</turn>`` with another one. Inside texts and roles a backslash goes before every
backslash, ``#`` and the slash of ``</`` (roles also before ``:`` and line breaks), so no text can
hold a control string and removing the backslashes restores it. The rendered text is encoded once,
with character offsets; both the assistant texts' spans and the tokens' spans are sorted, so the
tokens of a span are found by two binary searches. A token is under the loss mask if it overlaps an
assistant text; where it also covers template characters, the offsets tell which are the text's.

Edge cases: a null text or role is the empty one; an empty assistant text has no loss token. Rows of
equal turn number are ordered by role and text, null turns come first, repeated rows are repeated
turns; rows with a null conversation id are one conversation. An empty table gives an empty result.
Other columns are ignored.
"""
from __future__ import annotations

import hashlib
import os
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_batch, column, small_batches

#: A public tokenizer with offsets; read by the driver only.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
OPEN, NAMED, CLOSE = "### ", ":\n", "\n</turn>\n"


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("#", "\\#").replace("</", "<\\/")


def escape_role(role: str) -> str:
    return escape(role).replace(":", "\\:").replace("\n", "\\\n")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def render(turns) -> tuple[str, list]:
    """The formatted conversation and the spans of its assistant texts."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{OPEN}{escape_role(role)}{NAMED}", escape(text)
        if role == "assistant":
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, CLOSE]
        at += len(head) + len(body) + len(CLOSE)
    return "".join(parts), spans


def parse(formatted: str) -> list:
    """The turns ``(role, text)`` of a formatted conversation."""
    out = []
    for turn in formatted.split(CLOSE)[:-1]:
        head, _, body = turn.removeprefix(OPEN).partition(NAMED)
        out.append((unescape(head), unescape(body)))
    return out


def loss_mask(spans: list, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """True for tokens that overlap a span; spans and tokens are sorted."""
    mask = np.zeros(len(starts), bool)
    for low, high in spans:
        if low < high:
            mask[np.searchsorted(ends, low, "right"):np.searchsorted(starts, high, "left")] = True
    return mask


def masked_text(formatted: str, spans: list, starts, ends, mask) -> list:
    """For each span the text that masked tokens cover in it."""
    starts, ends, mask = np.asarray(starts), np.asarray(ends), np.asarray(mask, bool)
    out = []
    for low, high in spans:
        at, piece = low, []
        for i in range(np.searchsorted(ends, low, "right"), np.searchsorted(starts, high, "left")):
            if mask[i]:
                a, b = max(int(starts[i]), at), min(int(ends[i]), high)
                if b > a:  # the bytes of one character can lie in several tokens
                    piece.append(formatted[a:b])
                    at = b
        out.append("".join(piece))
    return out


def format_chats(conversations: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """A row for each conversation: ``conv_id, formatted, token_ids, token_starts, token_ends,
    loss_mask`` and ``spans`` (of the assistant texts in ``formatted``, by characters)."""
    spark = conversations.sparkSession
    small_batches(spark)
    with open(tokenizer, encoding="utf-8") as f:
        shared = spark.sparkContext.broadcast(f.read())  # as large as the vocabulary
    turns = conversations.select("conv_id", F.struct(
        "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).alias("t"))
    turns = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns")) \
        .select("conv_id", "turns.role", "turns.text")
    ints, span = T.ArrayType(T.IntegerType()), T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
    schema = T.StructType([turns.schema["conv_id"], T.StructField("formatted", T.StringType()), T.StructField("token_ids", ints),
                           T.StructField("token_starts", ints), T.StructField("token_ends", ints),
                           T.StructField("loss_mask", T.ArrayType(T.BooleanType())), T.StructField("spans", T.ArrayType(span))])

    def rows_of(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, processors

        encoder = Tokenizer.from_str(shared.value)
        encoder.encode_special_tokens = True  # their strings inside a text are ordinary text
        encoder.post_processor = processors.ByteLevel(trim_offsets=False)  # offsets cover blanks too
        for b in batches:
            rows = []
            for role, text in zip(column(b, "role").to_pylist(), column(b, "text").to_pylist()):
                formatted, spans = render(zip(role, text))
                e = encoder.encode(formatted, add_special_tokens=False)
                at = np.array(e.offsets, np.int64).reshape(-1, 2)
                mask = loss_mask(spans, at[:, 0], at[:, 1])
                rows.append((formatted, e.ids, at[:, 0].tolist(), at[:, 1].tolist(), mask.tolist(),
                             [{"start": s, "end": t} for s, t in spans]))
            yield arrow_batch(schema, [column(b, "conv_id"), *([r[k] for r in rows] for k in range(6))])

    return turns.mapInArrow(rows_of, schema)


def digests(formatted: DataFrame) -> DataFrame:
    """What the formatted rows say: turns by parsing the text, loss text by mask and offsets."""
    schema = T.StructType([formatted.schema["conv_id"], T.StructField("n_turns", T.LongType()), T.StructField("turns_sha256", T.StringType()),
                           T.StructField("loss_chars", T.LongType()), T.StructField("loss_sha256", T.StringType()),
                           T.StructField("formatted_chars", T.LongType())])

    def rows_of(batches):
        for b in batches:
            rows = []
            for r in b.to_pylist():
                turns = parse(r["formatted"])
                text = "".join(f"{role}\n{t}\n" for role, t in turns)
                loss = "".join(unescape(p) for p in masked_text(r["formatted"], [(s["start"], s["end"]) for s in r["spans"]],
                                                               r["token_starts"], r["token_ends"], r["loss_mask"]))
                rows.append((len(turns), hashlib.sha256(text.encode()).hexdigest(), len(loss),
                             hashlib.sha256(loss.encode()).hexdigest(), len(r["formatted"])))
            yield arrow_batch(schema, [column(b, "conv_id"), *([r[k] for r in rows] for k in range(5))])

    return formatted.mapInArrow(rows_of, schema)


def op8(spark, conversations: DataFrame) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    own = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    return digests(format_chats(conversations.select("conv_id", "turn", "role", "text").unionByName(own)))
