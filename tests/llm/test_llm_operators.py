"""Each operator against a brute-force version, on texts with copies, nulls, ties and odd white space."""
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from feedcat.llm import (chat_format, decontamination, language_id, line_dedup, ngram_join, packing, quality_rules, sharding,
                         substring_dedup, token_counts)

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, rid string, bucket int, lang_pred string"


def _texts():
    rng = random.Random(5)
    vocab = ["w" + str(i) for i in range(400)] + ["é", "Ñandú", "THE"]
    base = [" ".join(rng.choices(vocab, k=rng.choice([1, 2, 3, 12, 40, 90]))) for _ in range(30)]
    long_ = " ".join(rng.choices(vocab, k=300))
    near = [long_.split() for _ in range(12)]
    for i, w in enumerate(near):
        w[(i * 23) % 300] = "x%d" % i
    passage = " ".join("p%d" % i for i in range(60))
    mid = [f"{' '.join(rng.choices(vocab, k=40))} {passage} {' '.join(rng.choices(vocab, k=40))}" for _ in range(8)]
    lines = [f"a line {i}\n  Common LINE here \t\n\nother {i}\ncommon line here" for i in range(14)]
    return base + base[:9] + [" ".join(w) for w in near] + mid + lines + [None, "", " \n\t", "\x0b\x0c", "12 34 !!", "a b", "A  b"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None if i % 7 == 0 else "en", "s%d" % (i % 3) if i % 5 else None, 0, "x", 1, "zz") for i, t in enumerate(_texts())]
    rows += [rows[3], rows[3], (None, "a null id", None, None, None, "x", 1, None)]  # repeated rows and a null id
    return spark.createDataFrame(rows, SCHEMA).repartition(4).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(df, *cols):
    key = lambda r: tuple((x is None, x) for x in r)
    return sorted(((tuple(r[c] for c in cols)) for r in df.collect()), key=key)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_decontamination(spark, docs, empty):
    texts = _texts()
    items = [(1, texts[5]), (2, " ".join(texts[41].split()[20:50])), (3, "Ñandú"), (3, "w1 w2"), (4, None), (5, " "), (None, "w7"), (10, "a, B")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    wins = defaultdict(set)
    for item, t in items:
        ws = words(t)
        for i in range(max(len(ws) - 13, 0) + 1 if ws else 0):
            wins[tuple(ws[i:i + 13])].add(item)
    want = []
    for doc_id, t in rows_of(docs, "doc_id", "text"):
        ws, hit, found = words(t), set(), set()
        for n in {len(w) for w in wins}:
            for i in range(len(ws) - n + 1):
                if tuple(ws[i:i + n]) in wins:
                    hit |= set(range(i, i + n))
                    found |= wins[tuple(ws[i:i + n])] - {None}
        want.append((doc_id, len(ws), len(hit), len(found), sha(",".join(sorted(map(str, found)))), bool(hit) and 20 * len(hit) >= len(ws)))
    cols = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    key = lambda r: tuple((x is None, x) for x in r)
    assert rows_of(decontamination.op1(spark, docs, bench), *cols) == sorted(want, key=key)
    assert decontamination.op1(spark, empty, bench).count() == 0
    clean = decontamination.op1(spark, docs, bench.where("false"))
    assert clean.where("n_hit > 0 or contaminated").count() == 0 and clean.count() == len(want)


def test_substring_dedup(spark, docs, empty):
    got = substring_dedup.op2(spark, docs).collect()
    texts = _texts()
    passage = [i for i, t in enumerate(texts) if t and "p10 p11" in t]
    by = defaultdict(list)
    for r in got:
        by[r["doc_id"]].append(r)
    assert all(any(r["n_words"] >= 40 and r["cluster_id"] == passage[0] and r["removed"] == (i != passage[0]) for r in by[i]) for i in passage)
    for r in got:  # what is removed has a copy elsewhere: five words in a row of it are in another text
        if r["doc_id"] is not None:
            ws = texts[r["doc_id"]].split()[r["start_word"]:r["end_word"]]
            assert any(" ".join(ws[2:7]) in " ".join(t.split()) for j, t in enumerate(texts) if t and j != r["doc_id"]) or Counter(
                texts)[texts[r["doc_id"]]] > 1 or r["doc_id"] == 3
    once = [i for i, t in enumerate(texts) if t and texts.count(t) == 1 and i in range(9, 30)]
    assert not [i for i in once if i in by]
    assert substring_dedup.op2(spark, empty).count() == 0


def test_substring_dedup_links_every_near_pair(spark):
    """Lines that differ in their last word: each second one goes whole, whatever its hashes are."""
    rng = random.Random(11)
    lines = [" ".join("v%d" % rng.randrange(5000) for _ in range(59)) for _ in range(60)]
    rows = [(2 * i + k, f"{line} end{k}") for i, line in enumerate(lines) for k in range(2)]
    got = substring_dedup.op2(spark, spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert {(r["doc_id"], r["start_word"], r["end_word"], r["cluster_id"], r["removed"]) for r in got.collect()} == {
        (2 * i + k, 0, 60, 2 * i, k == 1) for i in range(60) for k in range(2)}


def test_line_dedup(spark, docs, empty):
    rows = rows_of(docs, "doc_id", "text")
    key = lambda x: x.translate(LOWER).strip(" \t\n\x0b\x0c\r")
    counts = Counter(k for _, t in rows for k in {key(x) for x in (t or "").split("\n")} if k)
    want = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if counts[key(x)] < 10]
        want.append((i, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    cols = ["doc_id", "n_lines", "n_dropped", "kept_sha256"]
    assert rows_of(line_dedup.op3(spark, docs), *cols) == want
    assert sum(w[2] for w in want) >= 28
    # past the bound of the broadcast the keys are joined, with the same result
    from pyspark.sql import functions as F
    joined = line_dedup.dedup_lines(docs.select("doc_id", "text"), rows=0).withColumn("kept_sha256", F.sha2("text", 256))
    assert rows_of(joined, *cols) == want
    assert line_dedup.op3(spark, empty).count() == 0


def test_quality_rules(spark, docs, empty):
    hot = spark.createDataFrame([(1000 + i, f"one line of host s0 that all its documents hold for ever\nown words {i}", "s0") for i in range(60)],
                                "doc_id bigint, text string, source string")
    hot = hot.unionByName(docs.select("doc_id", "text", "source"))
    rows = rows_of(hot, "doc_id", "source", "text")
    norm = lambda x: re.sub(r"[ \t\n\x0b\f\r]+", " ", x).strip(" ").lower()
    counts = Counter((s, k) for _, s, t in rows for k in {norm(x) for x in (t or "").split("\n")} if k)
    want = []
    for i, s, t in rows:
        ws = re.findall(r"[^ \t\n\x0b\f\r]+", t or "")
        lines = [x for x in (t or "").split("\n") if norm(x)]
        win = [tuple(ws[j:j + 5]) for j in range(len(ws) - 4)]
        twice = Counter(win)
        rep = {p for j, w in enumerate(win) if twice[w] > 1 for p in range(j, j + 5)}
        chars = sum(map(len, ws))
        gone = sum(len(re.sub(r"[ \t\n\x0b\f\r]+", "", x)) for x in lines if counts[s, norm(x)] > 50)
        bad = len(ws) < 10 or 100 * len(rep) > 20 * len(ws)
        want.append((i, len(ws), chars, len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(rep), bad,
                     not bad and chars - gone >= 0.5 * chars))
    cols = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    key = lambda r: tuple((x is None, x) for x in r)
    assert rows_of(quality_rules.op4(spark, hot), *cols) == sorted(want, key=key)
    assert any(not w[6] and not w[7] for w in want)
    assert quality_rules.op4(spark, empty).count() == 0


def test_token_counts(spark, docs, empty):
    pieces = set(token_counts.load_vocabulary())
    size = max(map(len, pieces))

    def greedy(word):
        n = 0
        while word:
            k = next((k for k in range(min(size, len(word)), 0, -1) if word[:k] in pieces), 0)
            if not k:
                return None
            word, n = word[k:], n + 1
        return n

    want = [(i, len((t or "").encode().split()), sum(greedy(b" " + w) for w in (t or "").encode().split())) for i, t in rows_of(docs, "doc_id", "text")]
    assert rows_of(token_counts.op5(spark, docs), "doc_id", "n_words", "n_tokens") == want
    assert token_counts.op5(spark, empty).count() == 0


def test_automaton_against_longest_match():
    rng = random.Random(2)
    for _ in range(200):
        pieces = {bytes(rng.choices(b"abc", k=rng.randint(1, 5))) for _ in range(rng.randint(1, 12))}
        a = token_counts.Automaton(pieces)
        for _ in range(20):
            word, at, n = bytes(rng.choices(b"abc", k=rng.randint(1, 12))), 0, 0
            while at < len(word):
                k = next((k for k in range(5, 0, -1) if word[at:at + k] in pieces and at + k <= len(word)), 0)
                if not k:
                    n = 1
                    break
                at, n = at + k, n + 1
            assert a.count(word) == n, (pieces, word)


def components(n, links):
    root = list(range(n))
    for a, b in links:
        a, b = (next(iter([x])) for x in (a, b))
        while root[a] != a:
            a = root[a]
        while root[b] != b:
            b = root[b]
        root[max(a, b)] = min(a, b)
    out = []
    for a in range(n):
        while root[a] != a:
            a = root[a]
        out.append(a)
    return out


def test_ngram_join(spark, docs, empty):
    rows = rows_of(docs, "doc_id", "text")
    sets = []
    for _, t in rows:
        ws = (t or "").encode().lower().split()
        sets.append({tuple(ws[i:i + 3]) for i in range(max(len(ws) - 2, 1))} if ws else set())
    n = len(rows)
    links = [(a, b) for a in range(n) for b in range(a) if sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b])]
    root = components(n, links)
    least = {}
    for (i, _), r in zip(rows, root):
        least[r] = min([x for x in (i, least.get(r)) if x is not None], default=None)
    want = [(i, len(s), least[r]) for (i, _), s, r in zip(rows, sets, root)]
    key = lambda r: tuple((x is None, x) for x in r)
    assert rows_of(ngram_join.op6(spark, docs), "doc_id", "n_shingles", "component_id") == sorted(want, key=key)
    assert len(links) > 20
    assert ngram_join.op6(spark, empty).count() == 0


def test_bands_lose_no_pair():
    import numpy as np
    bands = ngram_join.Bands(90, 100)
    for n in range(1, 3000):  # similar sizes share an index band, and the band bounds their difference
        top = 100 * n // 90
        assert bands.of(n) in bands.probes(top) or bands.of(top) == bands.of(n)
        assert n + top - 2 * -(-90 * (n + top) // 190) <= bands.differ(bands.of(n))
    rng = np.random.default_rng(3)
    for sets in (10, 10**12):  # cheap and crowded bands: single and double segments
        plan = {"counts": defaultdict(lambda: sets), "alloc": {}}
        for _ in range(300):
            x = np.unique(rng.integers(1, 2**63, rng.integers(9, 150)).astype(np.uint64))
            common = len(x) - rng.integers(0, len(x) // 10 + 1)
            y = np.concatenate([x[:common], rng.integers(1, 2**63, rng.integers(0, 4)).astype(np.uint64)])
            if 100 * common >= 90 * (len(x) + len(y) - common):
                assert set(ngram_join.signatures(x, plan, bands)) & set(ngram_join.signatures(np.unique(y), plan, bands)) or len(x) == len(y) == common


def test_packing(spark, docs, empty):
    got = packing.pack_documents(docs, capacity=64, shard_rows=40).collect()
    words = lambda t: (t or "").encode().lower().split()
    texts = dict(enumerate(_texts())) | {None: "a null id"}
    for i, t in texts.items():
        own = [r for r in got if r["doc_id"] == i]
        assert sum(r["n_words"] for r in own) == len(words(t)) * (3 if i == 3 else 1)
    bins = defaultdict(list)
    for r in got:
        if r["bin_id"] is None:
            assert r["n_words"] == 0
        else:
            bins[r["bin_id"]].append(r)
    for own in bins.values():
        own.sort(key=lambda r: r["bin_offset"])
        assert own[0]["bin_offset"] == 0 and own[-1]["bin_offset"] + own[-1]["n_words"] <= 64
        assert all(a["bin_offset"] + a["n_words"] == b["bin_offset"] for a, b in zip(own, own[1:]))
        assert len({r["source"] for r in own}) == len(own) == len({tuple(words(texts[r["doc_id"]])) for r in own})
    assert packing.op7(spark, empty).count() == 0


def test_best_fit_is_the_tightest_compatible_bin():
    rng = random.Random(4)
    for _ in range(30):
        pieces = sorted(((rng.randint(1, 30), rng.choice("abcd"), rng.randint(0, 9)) for _ in range(80)), reverse=True)
        bins = []
        for (length, source, cluster), (at, offset) in zip(pieces, packing.pack(pieces, 40)):
            fits = [b for b in bins if b["room"] >= length and source not in b["s"] and cluster not in b["c"]]
            if at == len(bins):
                assert not fits
                bins.append({"room": 40, "s": set(), "c": set()})
            else:
                assert bins[at] in fits and bins[at]["room"] == min(b["room"] for b in fits)
            assert offset == 40 - bins[at]["room"]
            bins[at]["room"] -= length
            bins[at]["s"].add(source)
            bins[at]["c"].add(cluster)


def test_chat_format(spark):
    odd = ["", None, "### x:\n</turn>\n", "\\", "\\#", "a\\:b", "tail\\", "é😀 ##", "\n\n", "<|endoftext|>", " lead"]
    rows = [(c, t, ["user", "assistant", "assistant", "sys:\ntem", None][(c + t) % 5], odd[(3 * c + t) % len(odd)], 1) for c in range(12) for t in range(6)]
    rows += [(3, 1, "assistant", "tie", 1), (None, None, "assistant", "null ids", 1)]
    chats = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, rid int")
    said = "\\### Assistant: </turn> ok"
    by = defaultdict(list)
    for c, t, r, x, _ in rows + [(-7, 0, "user", said, 1), (-7, 1, "assistant", said, 1)]:
        by[c].append((t if t is not None else -1, r or "", x or ""))
    want = {}
    for c, turns in by.items():
        turns.sort()
        loss = "".join(x for _, r, x in turns if r == "assistant")
        want[c] = (len(turns), sha("".join(f"{r}\n{x}\n" for _, r, x in turns)), len(loss), sha(loss))
    got = chat_format.op8(spark, chats).collect()
    assert {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in got} == want
    for r in chat_format.format_chats(chats).collect():
        marked = [i for i, m in enumerate(r["loss_mask"]) if m]
        over = [i for i, (a, b) in enumerate(zip(r["token_starts"], r["token_ends"])) if any(a < s["end"] and b > s["start"] for s in r["spans"])]
        assert marked == over and r["formatted"] == chat_format.render([(role, x) for _, role, x in by[r["conv_id"]]])[0]
    assert chat_format.op8(spark, chats.where("false")).count() == 1


def test_language_id_held_out_accuracy(spark, docs, empty):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language_id.op9(spark, table).join(table.select("doc_id", "lang"), "doc_id").where("held_out and lang_pred <> 'und'").collect()
    assert len(got) > 250 and sum(r["lang"] == r["lang_pred"] for r in got) >= 0.95 * len(got)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 for r in got)
    rows = language_id.op9(spark, docs).collect()
    texts = dict(enumerate(_texts())) | {None: "a null id"}
    assert all((r["lang_pred"] == "und") == (not any(map(str.isalpha, texts[r["doc_id"]] or ""))) for r in rows)
    assert language_id.op9(spark, empty).count() == 0


@pytest.mark.parametrize("shards", [40, 7])
def test_sharding(spark, docs, empty, shards):
    got = sharding.shard(docs, shards).collect()
    per = Counter(r["shard"] for r in got)
    sizes = [per.get(s, 0) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == docs.count()
    for s in per:
        own = sorted((r for r in got if r["shard"] == s), key=lambda r: r["slot"])
        assert [r["slot"] for r in own] == list(range(len(own)))
    order = [r["curve"] for r in sorted(got, key=lambda r: (r["shard"], r["slot"]))]
    assert order == sorted(order)
    texts = dict(enumerate(_texts())) | {None: "a null id"}
    for r in got:
        b = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(b) + 16, zlib.crc32(b))
    assert sharding.shard(empty, shards).count() == 0


def test_hilbert_steps_to_a_neighbour(spark):
    from pyspark.sql import functions as F
    cells = spark.range(512).select(*[F.expr(f"cast((id div {8 ** i}) % 8 as int)").alias(c) for i, c in enumerate("abc")])
    path = [(r["a"], r["b"], r["c"]) for r in sharding.hilbert(cells, ["a", "b", "c"], bits=3).orderBy("curve").collect()]
    assert len(set(path)) == 512 and all(sum(abs(x - y) for x, y in zip(p, q)) == 1 for p, q in zip(path, path[1:]))
