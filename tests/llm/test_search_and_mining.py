"""Lexical search, hard negatives and SimHash against brute force, with every edge case their docstrings name."""
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from feedcat.llm import hard_negatives, lexical_search, simhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Names that the operators use inside.
DOCS = "doc_id bigint, text string, t0 string, q int, fp string, node int, rank int, score string, root int, n string"


def texts():
    rng = random.Random(11)
    vocab = [f"w{i}" for i in range(300)] + ["É", "é", "ß", "İi", "naïve"]
    got = [" ".join(rng.choices(vocab, weights=[1 / (i + 1) for i in range(len(vocab))], k=rng.choice([1, 2, 3, 20, 80]))) for _ in range(150)]
    got += [got[7]] * 30 + [got[8].upper()] * 3 + [None, "", " \t\n", "!!! --", "w1", "W1 w1", "w1 w2 w3 " * 300]
    got.append(" ".join(f"z{rng.randrange(4000)}" for _ in range(120_000)))  # over 256 kB
    return got


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i * 3 if i % 40 else None, t, "x", 1, "y", 2, 3, "s", 4, "n") for i, t in enumerate(texts())]
    rows += [rows[1], rows[1], (3, "w2 w3 w4 another text of id three", *rows[0][2:])]  # repeated rows and ids
    return spark.createDataFrame(rows, DOCS).repartition(5).cache()


def ranked(docs, items, k):
    words = lambda t: [w.translate(LOWER) for w in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", t or "")]
    tf = [(d, Counter(ws), len(ws)) for d, t in docs if (ws := words(t))]
    n, total = len(tf), sum(x[2] for x in tf)
    df = Counter(w for _, c, _ in tf for w in c)
    out = []
    for item, text in items:
        scores = []
        for d, c, size in tf:
            m = 10 + 90 * size * n // total
            scores.append((sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 8 * m))
                               for w in set(words(text)) if c[w]), d))
        top = sorted((s for s in scores if s[0] > 0), key=lambda s: (-s[0], s[1] is None, s[1]))[:k]
        out += [(item, i + 1, d, s) for i, (s, d) in enumerate(top)]
    return sorted(out, key=str)


@pytest.mark.parametrize("spread,first,item_bytes", [(16, 48, 1 << 18), (4, 1, 200)])  # narrow: all coordinates collide
def test_lexical_search(spark, docs, spread, first, item_bytes):
    pairs = [(r["doc_id"], r["text"]) for r in docs.collect()]
    items = [(i, t) for i, t in enumerate(texts()[3:40:4])]
    items += [(1, "w5 W5 É"), (None, "é naïve"), (90, None), (91, ""), (92, "unheard of"), (93, "z17 z18 z19 w1"), (94, "w1 w1 " + "w2 " * 90)]
    bench = spark.createDataFrame([(i, t, 7, "x") for i, t in items], "item_id bigint, text string, q int, rank string")
    got = lexical_search.search(docs, bench, spread=spread, first=first, item_bytes=item_bytes)
    assert got.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert sorted(map(tuple, got.collect()), key=str) == ranked(pairs, items, 10)


def test_lexical_search_on_empty_tables(spark, docs):
    items = spark.createDataFrame([(1, "w1")], "item_id bigint, text string")
    assert lexical_search.search(docs.limit(0), items).collect() == []
    assert lexical_search.search(docs, items.limit(0)).collect() == []
    assert lexical_search.search(docs.where("text is null"), items).collect() == []


def test_search_bounds_are_never_below_scores(spark, docs):
    index = lexical_search.sketches(docs.select("doc_id", "text"), 3).collect()
    known = {}
    for r in index:
        known.setdefault((r["t0"], r["t1"]), (np.frombuffer(r["coords"], np.uint16), np.frombuffer(r["tops"], np.uint8)))
    for r in lexical_search.named(docs).collect():
        if (r["t0"], r["t1"]) not in known:
            continue
        coords, tops = known[r["t0"], r["t1"]]
        tf = Counter(w.lower() for w in lexical_search._TERM.findall(r["text"].encode()))
        words = lexical_search.WordHash(lexical_search.NOT_ALNUM)
        for w, k in list(tf.items())[:50]:
            at = np.flatnonzero(coords == int(words.of(w)[0]) >> 61)
            assert len(at) == 1 and tops[at[0]] >= min(k, 255)


def vectors(seed, n, dims=12, labels=4):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, dims)).astype(np.float32) * 0.3
    v[5:n:9] = v[4]  # copies: ties
    return [(i, [float(x) for x in row], int(rng.integers(labels)), "a", 0) for i, row in enumerate(v)]


VECTORS = "vec_id bigint, embedding array<float>, label int, anchor string, rid int"


def mined(rows, every=100):
    live = [(k, i, (lab + 1) % 10 if i is not None and i % 7 == 0 else lab, [math.floor(256 * x) for x in v])
            for k, (i, v, lab, *_) in enumerate(rows) if lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for k, a, lab, v in live:
        if a is None or a % every:
            continue
        score = {r[0]: sum(x * y for x, y in zip(v, r[3])) for r in live}
        order = sorted((r for r in live if r[0] != k), key=lambda r: (-score[r[0]], r[1] is None, r[1]))
        for p in [r for r in order if r[2] == lab][:5]:
            s = score[p[0]]
            negatives = [r for r in order if r[2] != lab and 30 * s <= 100 * score[r[0]] <= 90 * s][:10]
            out += [(a, p[1], i + 1, r[1], s, score[r[0]]) for i, r in enumerate(negatives)]
    return sorted(out, key=str)


@pytest.mark.parametrize("sizes", [{}, {"block_bytes": 500, "anchor_bytes": 200}])
def test_hard_negatives(spark, sizes):
    rows = vectors(3, 700)
    odd = [(None, rows[4][1], 2, "a", 0), (None, rows[4][1], 1, "a", 0), (900, None, 1, "a", 0), (901, rows[9][1], None, "a", 0),
           (902, [float("nan")] * 12, 1, "a", 0), (903, [float("inf")] + [0.5] * 11, 1, "a", 0), (904, [None] + [0.5] * 11, 1, "a", 0),
           (1000, [0.5, -0.5], 1, "a", 0), (1100, [], 1, "a", 0), (1200, [0.0] * 12, 3, "a", 0), rows[200], rows[200], rows[31]]
    rows += odd
    got = hard_negatives.mine(spark.createDataFrame(rows, VECTORS).repartition(4), **sizes)
    want = mined(rows)
    assert len(want) > 100
    assert sorted(map(tuple, got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()),
                  key=str) == want


def test_hard_negatives_without_rows_or_anchors(spark):
    assert hard_negatives.mine(spark.createDataFrame([], VECTORS)).collect() == []
    assert hard_negatives.mine(spark.createDataFrame(vectors(1, 50)[1:], VECTORS)).collect() == []
    one = spark.createDataFrame([(100, [0.5, 0.25], 1, "a", 0)], VECTORS)
    assert hard_negatives.mine(one).collect() == []


def test_scan_drops_rows_before_the_last_column(spark):
    rows = spark.createDataFrame(vectors(8, 400, dims=64), VECTORS)
    stored = [hard_negatives.Block(r.asDict()) for r in hard_negatives.decomposed(hard_negatives.usable(rows.coalesce(1)), 400).collect()]
    anchor = np.zeros(64, np.int64)
    anchor[[3, 40]] = 900, -900  # all of the score is in two columns
    looks = []

    def shrink(low, high):
        looks.append(len(low))
        return high >= np.partition(low, len(low) - 5)[len(low) - 5]

    at, score = stored[0].scan(anchor, np.arange(400), shrink)
    whole = sum(anchor[d] * stored[0].columns[d].astype(np.int64) for d in (3, 40))
    assert looks[0] == 400 and max(looks[1:]) < 60
    assert set(at) == set(np.flatnonzero(whole >= np.sort(whole)[-5])) and (score == whole[at]).all()


def slow_fingerprint(text):
    ws = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    hs = [xxhash.xxh64_intdigest(" ".join(ws[i:i + 3]).encode(), 42) for i in range(max(len(ws) - 2, 1))] if ws else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def reach(fps, radius=2):
    """Least index that each fingerprint reaches."""
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_simhash(spark, docs):
    base = [f"t{i} " + " ".join(f"u{(i * j) % 97}" for j in range(400)) for i in range(6)]
    near = [b.replace(" u50 ", f" v{k} ", 1) for b in base for k in range(3)]
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()] + [(5000 - i, t) for i, t in enumerate(base + near)] + [(None, "none has an id")] * 2
    extra = spark.createDataFrame([(d, t, 1, "y", "z") for d, t in rows], "doc_id bigint, text string, fp int, variant string, mask string")
    got = simhash.near_duplicates(extra.repartition(3)).collect()
    fps = [slow_fingerprint(t) for _, t in rows]
    least = defaultdict(list)
    roots = reach(fps)
    for r, (d, _) in zip(roots, rows):
        if d is not None:
            least[r].append(d)
    want = [(d, f"{f:016x}", min(least[r], default=None)) for (d, _), f, r in zip(rows, fps, roots)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert len({c for _, _, c in want}) < len({f for _, f, _ in want})  # some link without being equal


def test_simhash_links_within_two_bits_and_not_beyond(spark):
    rng = random.Random(2)
    fps = []
    for _ in range(40):
        x = rng.getrandbits(64)
        fps += [x] + [x ^ sum(1 << b for b in rng.sample(range(64), k)) for k in (1, 2, 3, 3)]
    hub = rng.getrandbits(64)
    fps += [hub ^ (1 << b) for b in range(64)]  # a whole ball: its centre is no member
    fps += [0, 1 << 63, (1 << 63) | 1, (1 << 64) - 1]
    fps = sorted(set(fps))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    pairs = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp bigint")).collect()
    assert all(bin((a ^ b) & ((1 << 64) - 1)).count("1") <= 2 for a, b in pairs)
    assert len(pairs) == len(set(pairs)) < 66 * len(fps)
    at, root = {f: i for i, f in enumerate(signed)}, list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in pairs:
        x, y = sorted((find(at[a]), find(at[b])))
        root[y] = x
    assert [find(i) for i in range(len(fps))] == reach(fps)


def test_simhash_of_an_empty_table(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []
