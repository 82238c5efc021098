"""Substring dedup: MinHash banding over paragraphs, exact Jaccard, removals by components.

A paragraph is a line of at least ``LEAST`` words, a block of lines up to the next one without a word
that has as many, or a content-defined stretch of any text: places
where a 5-word shingle's hash is the least of ``GAP`` in a row are anchors, and a stretch runs from an
anchor to the first one at least ``SHORT`` shingles on. Any 45 words that two documents share, at
whatever place inside their lines, hold a stretch that is the same in both, so passages pasted into
the middle of other text are found too.

A line or block has ``BANDS`` bands of ``ROWS`` MinHashes of its 5-word shingles: at a similarity of 0.8 two
of them meet with probability 0.983, at 0.2 with 0.15. Those that meet are verified by exact Jaccard and clustered by
connected components. A stretch has less than ``GAP + SHORT`` shingles, of which one changed word takes five, so of
stretches without a repeated shingle only equal ones are similar enough: its one band is the digest of all its shingles.
Where a component spreads over several documents, the one with the smallest id
keeps its paragraphs, the others lose them.

Band keys that occur in one document only are dropped before anything else is built: a first pass over
the texts counts keys, a second one writes only paragraphs whose keys pass a bitmap of the repeated
ones (of bounded size, followed by an exact count), a third one writes the shingles of lines and blocks that
meet a different one, from one document for each.

Words are split at ASCII white space, A-Z lower-cased. Edge cases: null, empty and short texts have
no paragraphs; a document's own repeats don't count; documents with equal ids are ordered by row; a
null id keeps before any other. Repeated rows are copies: one keeps. Other columns are ignored. Short texts are hashed
some 64 KB at once. A very long text is hashed in pieces; what is held of it at once are its words' places and hashes,
some 50 bytes a word.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import (U64, WordHash, arrow_batch, binaries, bit_filter, column, drop_stage, mix, passes, seeds, shingle_hashes,
                     small_batches, stage, with_row_id)
from .components import cluster
from .ngram_join import differ_bound, parity

WIDTH = 5
LEAST = 20
GAP = 16
SHORT = 10
BANDS = 4
ROWS = 2
ALIKE = (80, 100)
#: Bytes of texts that are hashed at once; a longer text goes alone.
TOGETHER = 1 << 16
_SEEDS = seeds(2 * BANDS * ROWS + 1, 77)


def sliding(op, x: np.ndarray, width: int) -> np.ndarray:
    """``op`` (minimum or maximum) of every ``width`` values in a row, by doubling."""
    have = 1
    while have < width:
        step = min(have, width - have)
        x = op(x[:-step], x[step:])
        have += step
    return x


def anchors(order: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Positions that are the least of some ``GAP`` in a row of one text: equal to the largest of the minima of
    the windows they are in."""
    low = sliding(np.minimum, order, GAP)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:-1].tolist()):  # windows that reach into the next text
        low[max(a, b - WIDTH - GAP + 2):b] = 0
    edge = np.zeros(GAP - 1, U64)
    return np.flatnonzero(sliding(np.maximum, np.concatenate([edge, low, edge]), GAP) == order)


def blocks(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last line of each run of two or more lines with words, from the lines' numbers of words."""
    edge = np.diff(np.concatenate([[0], sizes > 0, [0]]).astype(np.int8))
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1
    return first[last > first], last[last > first]


def groups(texts: list):
    """``(first, last)`` of the texts to hash at once: ``TOGETHER`` bytes of them at most, or one."""
    first = held = 0
    for i, t in enumerate(texts):
        n = len(t or b"")
        if i > first and held + n > TOGETHER:
            yield first, i
            first = i
            held = 0
        held += n
    if texts:
        yield first, len(texts)


def paragraphs(texts: list, known: WordHash) -> tuple:
    """``(starts, ends, shingle hashes, bounds)`` of the lines and blocks of texts one after the other; places are by
    shingles. Words of text ``i`` go from ``bounds[i]`` up to ``bounds[i + 1]``; what begins in the last ``WIDTH - 1`` of
    them is no shingle of a text."""
    text = b"\n\n".join([t or b"" for t in texts])  # the empty line between keeps blocks apart
    h, low, _ = known.spans(text)
    bounds = np.searchsorted(low, np.cumsum([0, *(len(t or b"") + 2 for t in texts)]))
    none = np.empty(0, np.int64)
    if len(h) < WIDTH:
        return none, none, np.empty(0, U64), bounds
    after = np.searchsorted(low, np.append(np.flatnonzero(np.frombuffer(text, np.uint8) == 10), len(text)))
    sizes = np.diff(after, prepend=0)
    long_ = sizes >= LEAST
    first, last = blocks(sizes)
    whole = after[last] - (after - sizes)[first] >= LEAST
    starts = np.concatenate([(after - sizes)[long_], (after - sizes)[first[whole]]])
    return starts, np.concatenate([after[long_], after[last[whole]]]) - WIDTH + 1, shingle_hashes(h, WIDTH), bounds


def text_of(places: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.searchsorted(bounds, places, "right") - 1


def bands(s: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Rows of ``BANDS`` keys, each of ``ROWS`` MinHashes, of the shingles from ``starts`` up to ``ends``."""
    keys = np.empty((len(starts), BANDS), U64)
    if len(starts):
        bounds = np.stack([starts, ends], 1).ravel()
        hashed = np.full(len(s) + 1, 2**64 - 1, U64)
        for k in range(BANDS):
            keys[:, k] = k
            for j in range(2 * ROWS * k, 2 * ROWS * (k + 1), 2):
                hashed[:-1] = (s ^ _SEEDS[j]) * (_SEEDS[j + 1] | U64(1))
                keys[:, k] = mix(keys[:, k] + np.minimum.reduceat(hashed, bounds)[::2])
    return keys


def stretches(s: np.ndarray, bounds: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the content-defined stretches, by shingles, of one text or of those that ``bounds`` tells."""
    if len(s) < GAP:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    bounds = np.array([0, len(s) + WIDTH - 1]) if bounds is None else bounds
    at = anchors(s, bounds)
    to = np.searchsorted(at, at + SHORT)
    first, last = at[to < len(at)], at[to[to < len(at)]]
    own = last < bounds[text_of(first, bounds) + 1]
    return first[own], last[own]


def digests(s: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Two 64-bit sums over the shingles from ``starts`` up to ``ends``."""
    sums = np.zeros((len(s) + 1, 2), U64)
    np.cumsum(s, out=sums[1:, 0])
    np.cumsum((s ^ (s >> U64(29))) * _SEEDS[-1], out=sums[1:, 1])
    return sums[ends] - sums[starts]


def stretch_keys(sums: np.ndarray) -> np.ndarray:
    return mix(sums[:, 0] + mix(sums[:, 1]))


def node_names(sums: np.ndarray) -> pa.Array:
    """16 bytes for each digest; the hex digits of a name are those of its numbers."""
    places = np.arange(len(sums) + 1, dtype=np.int32) * np.int32(16)
    return pa.Array.from_buffers(pa.binary(), len(sums), [None, pa.py_buffer(places), pa.py_buffer(sums.astype(">u8").tobytes())])


def turned(key: np.ndarray) -> np.ndarray:
    return (key << U64(32)) | (key >> U64(32))


def twice(keys: DataFrame) -> DataFrame:
    """Both values by which a key is told in a bitmap: of the others about one in 250 has both."""
    low = F.call_function("shiftrightunsigned", "key", F.lit(32))
    return keys.select(F.explode(F.array("key", F.shiftleft("key", 32).bitwiseOR(low))).alias("key"))


def known_key(filter_: tuple, keys: np.ndarray) -> np.ndarray:
    return passes(filter_, keys) & passes(filter_, turned(keys))


def lists(flat: np.ndarray, sizes: np.ndarray) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))


def keys_of(texts: list, known: WordHash) -> np.ndarray:
    """The band keys of all paragraphs of some texts, each once for each text."""
    starts, ends, s, bounds = paragraphs(texts, known)
    first, last = stretches(s, bounds)
    keys = np.concatenate([bands(s, starts, ends).ravel(), stretch_keys(digests(s, first, last))])
    own = np.concatenate([np.repeat(text_of(starts, bounds), BANDS), text_of(first, bounds)])
    order = np.lexsort((keys, own))
    keys, own = keys[order], own[order]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = (keys[1:] != keys[:-1]) | (own[1:] != own[:-1])
    return keys[fresh]


def band_keys(docs: DataFrame) -> DataFrame:
    """``key`` of every band of every paragraph, once for each document."""
    schema = T.StructType([T.StructField("key", T.LongType())])

    def rows_of(batches):
        known = WordHash()
        for b in batches:
            texts = binaries(b, "text")
            got = [keys_of(texts[i:j], known) for i, j in groups(texts)]
            yield arrow_batch(schema, [pa.array(np.concatenate([np.empty(0, U64), *got]).view(np.int64))])

    return docs.select("text").mapInArrow(rows_of, schema)


def met_paragraphs(docs: DataFrame, repeated: tuple) -> DataFrame:
    """``rid, doc_id, start, end, node, keys``: paragraphs with a key that passes the filter; places are by words, a
    stretch has no ``keys``."""
    schema = T.StructType([T.StructField("rid", T.LongType()), docs.schema["doc_id"], T.StructField("start", T.IntegerType()),
                           T.StructField("end", T.IntegerType()), T.StructField("node", T.BinaryType()),
                           T.StructField("keys", T.ArrayType(T.LongType()))])
    shared = docs.sparkSession.sparkContext.broadcast(repeated)

    def rows_of(batches):
        known = WordHash()
        for b in batches:
            row, places, names, kept, sizes = [], [np.empty((0, 2), np.int64)], [np.empty((0, 2), U64)], [np.empty(0, U64)], [np.empty(0, np.int64)]
            texts = binaries(b, "text")
            for i, j in groups(texts):
                starts, ends, s, bounds = paragraphs(texts[i:j], known)
                keys = bands(s, starts, ends)
                ok = known_key(shared.value, keys)
                on = ok.any(1)
                first, last = stretches(s, bounds)
                sums = digests(s, first, last)
                also = known_key(shared.value, stretch_keys(sums))
                own = text_of(np.concatenate([starts[on], first[also]]), bounds)
                row.append(own + i)
                places.append(np.stack([np.concatenate([starts[on], first[also]]), np.concatenate([ends[on], last[also]])], 1) - bounds[own, None])
                names += [digests(s, starts[on], ends[on]), sums[also]]
                kept.append(keys[ok])
                sizes += [ok[on].sum(1), np.zeros(also.sum(), np.int64)]
            if not row:
                continue
            at, places = pa.array(np.concatenate(row)), np.concatenate(places)
            yield arrow_batch(schema, [
                column(b, "rid").take(at), column(b, "doc_id").take(at), pa.array(places[:, 0], pa.int32()),
                pa.array(places[:, 1] + WIDTH - 1, pa.int32()), node_names(np.concatenate(names)),
                lists(np.concatenate(kept), np.concatenate(sizes))])

    return docs.mapInArrow(rows_of, schema)


def shingles_of(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """``node, items`` of the lines and blocks ``asked`` for, with their number and parity bits.

    ``asked (node, owner)`` names one document that has the paragraph, by the hash of its id: other documents are
    passed over, and of the paragraphs of these the others (but for a bitmap's few false positives).
    """
    schema = T.StructType([T.StructField("node", T.BinaryType()), T.StructField("items", T.ArrayType(T.LongType())),
                           *(T.StructField(c, T.LongType()) for c in ("n", "p0", "p1"))])
    low = F.conv(F.hex(F.substring("node", 1, 8)), 16, -10).cast("long")
    spark = docs.sparkSession.sparkContext
    shared = spark.broadcast((bit_filter(asked, "owner"), bit_filter(asked.select(low.bitwiseXOR(F.col("owner")).alias("h")), "h")))

    def rows_of(batches):
        known = WordHash()
        for b in batches:
            owns, wanted = shared.value
            owners = column(b, "owner").to_numpy().view(U64)
            names, items, rest = [np.empty((0, 2), U64)], [np.empty(0, U64)], []
            has = passes(owns, owners)
            texts, owners = binaries(b.filter(pa.array(has)), "text"), owners[has]
            for i, j in groups(texts):
                starts, ends, s, bounds = paragraphs(texts[i:j], known)
                sums = digests(s, starts, ends)
                on = np.flatnonzero(passes(wanted, sums[:, 0] ^ owners[text_of(starts, bounds) + i]))
                names.append(sums[on])
                for k in on:
                    x = np.unique(s[starts[k]:ends[k]])
                    items.append(x)
                    rest.append((len(x), *parity(x)))
            rest = np.array(rest, np.int64).reshape(-1, 3)
            yield arrow_batch(schema, [node_names(np.concatenate(names)), lists(np.concatenate(items), rest[:, 0]),
                                       *(pa.array(rest[:, k]) for k in range(3))])

    return docs.select(F.xxhash64("doc_id").alias("owner"), "text").mapInArrow(rows_of, schema) \
        .join(asked.select("node"), "node").dropDuplicates(["node"])


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``rid, doc_id, start_word, end_word, cluster_id, removed``: the stretches of each document made of
    paragraphs that other documents have too; ``cluster_id`` is the smallest id of a document with one."""
    small_batches(docs.sparkSession)
    docs = with_row_id(docs, "doc_id", "text")
    again = stage(band_keys(docs).groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key"), "band-keys")
    units = stage(met_paragraphs(docs, bit_filter(twice(again), "key")), "paragraphs")
    drop_stage(again)
    met = units.select(F.explode("keys").alias("bucket"), "node", F.xxhash64("doc_id").alias("owner"))
    h = F.xxhash64("node")
    several = met.groupBy("bucket").agg(F.min(h).alias("a"), F.max(h).alias("b")).where("a <> b").select("bucket")
    several = stage(several, "several")
    members = stage(met.join(several, "bucket").groupBy("bucket", "node")
                    .agg(F.count("*").alias("copies"), F.min("owner").alias("owner")), "band-members")
    drop_stage(several)
    asked = stage(members.groupBy("node").agg(F.min("owner").alias("owner")), "asked")
    sets = stage(shingles_of(docs, asked), "shingles")
    drop_stage(asked)
    about = members.drop("owner").join(sets.drop("items"), "node")
    roots = cluster(about, lambda nodes: sets.select("node", "items").join(nodes, "node", "left_semi"), ALIKE, differ_bound(*ALIKE))
    drop_stage(members, sets)
    # one row for each different paragraph, then for each component; the paragraphs themselves move once
    names = units.groupBy("node").agg(F.min(F.struct("doc_id", "rid")).alias("k"), F.min("rid").alias("a"), F.max("rid").alias("b")) \
        .join(roots, "node", "left").where("root is not null or a <> b").withColumn("root", F.coalesce("root", "node"))
    names = stage(names, "names")
    keep = names.groupBy("root").agg(F.min("k").alias("k"), F.min("a").alias("a"), F.max("b").alias("b")).where("a <> b")
    keep = stage(names.select("node", "root").join(keep, "root")
                 .select("node", F.col("k.doc_id").alias("cluster_id"), F.col("k.rid").alias("keeper")), "keepers")
    drop_stage(names, roots)
    spans = units.join(keep, "node") \
        .select("rid", "doc_id", "start", "end", "cluster_id", (F.col("rid") != F.col("keeper")).alias("removed"))
    own = Window.partitionBy("rid", "removed").orderBy("start", "end")
    reach = F.max("end").over(own.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("opens", F.when(F.col("start") <= reach, 0).otherwise(1)) \
        .withColumn("part", F.sum("opens").over(own.rowsBetween(Window.unboundedPreceding, 0)))
    return spans.groupBy("rid", "removed", "part").agg(
        F.min("doc_id").alias("doc_id"), F.min("start").cast("long").alias("start_word"), F.max("end").cast("long").alias("end_word"),
        F.min("cluster_id").alias("cluster_id")).drop("part")


def cut_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``doc_id, text`` of every row of ``docs`` without the words of the stretches that ``repeated_spans`` of the same
    stored table removes; ids may be equal or null."""
    gone = spans.where("removed").groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("start_word", "end_word"))).alias("gone"))
    schema = T.StructType([docs.schema["doc_id"], T.StructField("text", T.StringType())])

    def rows_of(batches):
        for b in batches:
            out = []
            for t, cuts in zip(binaries(b, "text"), column(b, "gone").to_pylist()):
                if t is not None and cuts:
                    bad = {i for c in cuts for i in range(c["start_word"], c["end_word"])}
                    kept, at = [], 0
                    for line in t.split(b"\n"):
                        ws = line.split()
                        own = [w for i, w in enumerate(ws, at) if i not in bad]
                        at += len(ws)
                        if own or not ws:
                            kept.append(line if len(own) == len(ws) else b" ".join(own))
                    t = b"\n".join(kept)
                out.append(None if t is None else t.decode("utf-8", "replace"))
            yield arrow_batch(schema, [column(b, "doc_id"), out])

    return with_row_id(docs, "doc_id", "text").join(gone, "rid", "left").mapInArrow(rows_of, schema)


def op2(spark, docs: DataFrame) -> DataFrame:
    return repeated_spans(docs).select("doc_id", "start_word", "end_word", (F.col("end_word") - F.col("start_word")).alias("n_words"),
                                       "cluster_id", "removed")
