"""Token counts: greedy longest-match word pieces by a linear automaton, no piece is ever built.

A word is a run of characters other than white space; it is matched as a blank followed by its UTF-8
bytes, so vocabulary entries with a leading blank start words and the others continue them. The
vocabulary's trie gets failure links and, for each node, the number of pieces popped on the way to
its failure node; reading a byte follows links until an edge fits, adding popped counts. Every byte
is read once and every link shortens what is pending, so the work is linear in the text.

Edge cases: null and empty texts have no words and no tokens. A word with a byte that no piece
covers counts as one unknown token. Repeated rows each get their count. Other columns pass through;
an input column named like a result column is replaced.
"""
from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import binaries, small_batches

#: Vocabulary of a public byte-level tokenizer; read by the driver only.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
#: Words whose counts a task remembers at a time.
REMEMBER = 250_000


def byte_letters() -> dict:
    """The byte that each letter of a byte-level vocabulary stands for."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def load_vocabulary(path: str = VOCABULARY) -> list:
    """The byte strings of a byte-level vocabulary file; entries with other letters are control tokens."""
    with open(path, encoding="utf-8") as f:
        pieces = json.load(f)["model"]["vocab"]
    letters = byte_letters()
    return [bytes(letters[c] for c in p) for p in pieces if all(c in letters for c in p)]


class Automaton:
    """Trie with failure links ``fail`` (-1: none) and popped-piece counts ``pops``; node 0 is the root."""

    def __init__(self, pieces=(), parts: tuple | None = None) -> None:
        if parts:
            self.edge, self.fail, self.pops = parts
            return
        self.edge: dict = {}
        self.fail, self.pops = [-1], [0]
        final, children = set(), [[]]
        for piece in pieces:
            v = 0
            for c in piece:
                key = v << 8 | c
                if key not in self.edge:
                    self.edge[key] = len(children)
                    children[v].append((c, len(children)))
                    children.append([])
                v = self.edge[key]
            if v:
                final.add(v)
        self.fail *= len(children)
        self.pops *= len(children)
        queue = [0]
        for u in queue:
            for c, v in children[u]:
                queue.append(v)
                if v in final:
                    self.fail[v], self.pops[v] = 0, 1
                elif u:
                    z, n = self.fail[u], self.pops[u]
                    while z > 0 and (z << 8 | c) not in self.edge:
                        n += self.pops[z]
                        z = self.fail[z]
                    if z >= 0 and (z << 8 | c) in self.edge:
                        self.fail[v], self.pops[v] = self.edge[z << 8 | c], n

    def count(self, word: bytes) -> int:
        """Pieces of one word, 1 if some part of it matches none."""
        edge, fail, pops, v, n = self.edge, self.fail, self.pops, 0, 0
        for c in word:
            while (to := edge.get(v << 8 | c)) is None:
                n += pops[v]
                v = fail[v]
                if v < 0:
                    return 1
            v = to
        while v > 0:
            n += pops[v]
            v = fail[v]
        return n if v == 0 else 1


class Remembered(dict):
    def __init__(self, automaton: Automaton) -> None:
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        n = self[word] = self.automaton.count(b" " + word)
        return n


def count_tokens(docs: DataFrame, text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """``docs`` with ``n_words`` and ``n_tokens`` of the whole text."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.drop("n_words", "n_tokens")
    a = Automaton(load_vocabulary(vocabulary))
    shared = spark.sparkContext.broadcast((a.edge, a.fail, a.pops))  # as large as the vocabulary
    schema = T.StructType([*docs.schema.fields, T.StructField("n_words", T.LongType()), T.StructField("n_tokens", T.LongType())])

    def rows_of(batches):
        known = Remembered(Automaton(parts=shared.value))
        for b in batches:
            words, tokens = [], []
            for t in binaries(b, text):
                ws = t.split() if t else []
                words.append(len(ws))
                tokens.append(sum(map(known.__getitem__, ws)))
                if len(known) > REMEMBER:
                    known.clear()
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(words, pa.int64()), pa.array(tokens, pa.int64())],
                                             [*b.schema.names, "n_words", "n_tokens"])

    return docs.mapInArrow(rows_of, schema)


def op5(spark, docs: DataFrame) -> DataFrame:
    return count_tokens(docs.select("doc_id", "text")).drop("text")
