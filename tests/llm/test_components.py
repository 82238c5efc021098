"""Links among bucket mates: pages of one template, and sets on both sides of the bound."""
import random

from pyspark.sql import functions as F

from feedcat.llm import components, ngram_join


def test_pages_of_one_template_do_not_meet_pairwise(spark):
    """20,000 texts that are equal but for one word: too little in common to link, too much for their buckets."""
    words = " ".join(f"common{i}" for i in range(11))
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.concat(F.lit(words + " own"), F.col("id").cast("string"), F.lit(" end")).alias("text")) \
        .unionByName(spark.createDataFrame([(20_000, words + " own3 end"), (20_001, words + " OWN4  end")], "doc_id bigint, text string"))
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.op6(spark, docs).where("component_id <> doc_id").collect()}
    assert got == {20_000: 3, 20_001: 4}


def test_clusters_equal_brute_force(spark):
    rng = random.Random(6)
    sets = []
    for _ in range(25):  # families around a base: some members link, some are just too far
        base = [rng.getrandbits(62) for _ in range(rng.choice([3, 9, 10, 21, 40]))]
        for _ in range(8):
            own = list(base)
            for _ in range(rng.randrange(4)):
                own[rng.randrange(len(own))] = rng.getrandbits(62)
            sets.append(sorted(set(own)))
    passage = [rng.getrandbits(62) for _ in range(12)]
    sets += [sorted({*passage, *(rng.getrandbits(62) for _ in range(k))}) for k in (0, 1, 1, 2, 3, 14, 14, 14) for _ in range(6)]
    items = spark.createDataFrame([(i, s) for i, s in enumerate(sets)], "node bigint, items array<bigint>").cache()
    members = items.select(F.lit(1).cast("bigint").alias("bucket"), "node").unionByName(  # one bucket of all, and small ones
        items.select((F.col("node") % 5 + 2).alias("bucket"), "node"))
    for alike in ((90, 100), (80, 100), (50, 100)):
        got = {r["node"]: r["root"] for r in components.cluster(members, lambda nodes: items.join(nodes, "node", "left_semi"), alike).collect()}
        root = list(range(len(sets)))

        def find(i):
            while root[i] != i:
                i = root[i]
            return i

        for i, x in enumerate(sets):
            for j, y in enumerate(sets[:i]):
                both = len(set(x) & set(y))
                if alike[1] * both >= alike[0] * (len(x) + len(y) - both):
                    a, b = sorted((find(i), find(j)))
                    root[b] = a
        assert [got.get(i, i) for i in range(len(sets))] == [find(i) for i in range(len(sets))]
