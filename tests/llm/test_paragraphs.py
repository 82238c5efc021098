"""Substring dedup against all pairs of paragraphs, its recall unit by unit, and what is cut."""
import random

import numpy as np

from feedcat.llm import substring_dedup as S
from feedcat.llm.common import WordHash, shingle_hashes


def own_units(text):
    """``(start, end, is a stretch)`` by words, lines and blocks by a plain loop."""
    out, block, at = [], [], 0
    for line in [*(text or "").split("\n"), ""]:
        n = len(line.split())
        if n >= S.LEAST:
            out.append((at, at + n, False))
        if n:
            block.append(n)
        else:
            if len(block) > 1 and sum(block) >= S.LEAST:
                out.append((at - sum(block), at, False))
            block = []
        at += n
    if at >= S.WIDTH:
        s = shingle_hashes(WordHash().of(text.encode()), S.WIDTH)
        out += [(int(i), int(j) + S.WIDTH - 1, True) for i, j in zip(*S.stretches(s))]
    return out


def brute(rows):
    units = []
    for rid, (doc_id, text) in enumerate(rows):
        ws = (text or "").lower().split()
        for i, j, cut in own_units(text):
            units.append((rid, i, j, cut, tuple(ws[i:j]), {tuple(ws[k:k + 5]) for k in range(i, j - 4)}))
    up = list(range(len(units)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for x, a in enumerate(units):
        for y, b in enumerate(units[:x]):
            both = len(a[5] & b[5])
            if a[4] == b[4] or not a[3] and not b[3] and 100 * both >= 80 * len(a[5] | b[5]):
                up[root(x)] = root(y)
    groups = {}
    for x, u in enumerate(units):
        groups.setdefault(root(x), []).append(u)
    spans = {}
    for g in groups.values():
        docs = {u[0] for u in g}
        if len(docs) > 1:
            keeper = min(docs, key=lambda r: (rows[r][0] is not None, rows[r][0] or 0, r))
            for rid, i, j, *_ in g:
                spans.setdefault((rid, rid != keeper), set()).add((i, j, rows[keeper][0]))
    out = []
    for (rid, removed), got in spans.items():
        parts = []
        for i, j, c in sorted(got, key=lambda x: x[:2]):
            if parts and i <= parts[-1][1]:
                parts[-1][1] = max(parts[-1][1], j)
                parts[-1][2].append(c)
            else:
                parts.append([i, j, [c]])
        out += [(rid, rows[rid][0], i, j, min((c for c in cs if c is not None), default=None), removed) for i, j, cs in parts]
    return sorted(out, key=str)


def planted():
    rng = random.Random(5)
    say = lambda n: [f"w{rng.randrange(4000)}" for _ in range(n)]
    shared, line, block = say(70), say(60), say(48)
    rows = [(3, None), (4, ""), (5, "few words only"), (6, "\n\n \n")]
    for i in range(4):  # a passage inside lines of their own
        rows.append((10 + i, " ".join([*say(15 + i), *shared, *say(12)])))
    for i in range(5):  # a line with one changed word each, in the middle
        rows.append((20 + i, " ".join(say(8)) + "\n" + " ".join([*line[:30], f"new{i}", *line[31:]]) + "\nend " + " ".join(say(4))))
    for i in range(3):  # a block of short lines with its last word changed
        ws = [*block[:-1], f"last{i}"]
        rows.append((30 + i, "\n".join(["Head " + say(1)[0], "", *(" ".join(ws[k:k + 8]) for k in range(0, 48, 8)), " ", "tail"])))
    rows += [(i, " ".join(say(90)) + "\n" + " ".join(say(25))) for i in range(40, 46)]
    rows += [(41, rows[-5][1]), (None, rows[-1][1]), (50, rows[-2][1].upper()), (51, " ".join(line[:20] + say(40)))]
    return rows


def test_against_all_pairs(spark):
    rows = planted()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    got = S.repeated_spans(docs).select("rid", "doc_id", "start_word", "end_word", "cluster_id", "removed").collect()
    want = brute(rows)
    assert sorted(map(tuple, got), key=str) == want
    assert {r[1] for r in want} == {None, 10, 11, 12, 13, 20, 21, 22, 23, 24, 30, 31, 32, 41, 44, 45, 50}


def test_cut_by_row(spark, tmp_path):
    rows = planted()
    spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    cut = S.cut_spans(docs, S.repeated_spans(docs)).collect()
    gone = {}
    for rid, _, i, j, _, removed in brute(rows):
        if removed:
            gone.setdefault(rid, set()).update(range(i, j))
    want = [(d, None if t is None else [w for k, w in enumerate(t.split()) if k not in gone.get(rid, ())]) for rid, (d, t) in enumerate(rows)]
    assert sorted(((r["doc_id"], None if r["text"] is None else r["text"].split()) for r in cut), key=str) == sorted(want, key=str)


def test_bands_find_what_is_just_similar():
    """Pairs of shingle sets at a similarity of exactly 0.8 (72 of 90) share a band in at least 95 of 100 cases."""
    rng = np.random.default_rng(3)
    met = 0
    for _ in range(1000):
        s = rng.integers(0, 2**63, 90, np.uint64)
        a, b = s[:81], np.concatenate([s[:72], s[81:]])
        x, y = (S.bands(v, np.array([0]), np.array([81])) for v in (a, b))
        met += bool((x == y).any())
    assert met >= 950, met


def test_a_changed_word_leaves_no_stretch_similar():
    """What lets equal stretches do: a stretch is too short to stay similar with one word changed."""
    rng = np.random.default_rng(4)
    first, last = S.stretches(rng.integers(0, 2**63, 200_000, np.uint64))
    n = (last - first).max()
    assert n < S.GAP + S.SHORT and S.ALIKE[1] * (n - S.WIDTH) < S.ALIKE[0] * (n + S.WIDTH)
