"""Near copies of paragraphs whose lines are short."""
import random

from feedcat.llm import substring_dedup


def test_near_copies_of_blocks_of_short_lines_meet(spark):
    rng = random.Random(12)
    rows = []
    for i in range(60):
        words = [f"v{rng.randrange(9000)}" for _ in range(60)]
        for k in range(2):
            words[30] = f"other{i}x{k}"  # 51 of 61 shingles are equal
            block = "\n".join(" ".join(words[j:j + 10]) for j in range(0, 60, 10))
            rows.append((2 * i + k, f"head{i}x{k}\n \n{block}\n\ntail{i}x{k}"))
    got = substring_dedup.op2(spark, spark.createDataFrame(rows, "doc_id bigint, text string"))
    spans = {(r["doc_id"], r["start_word"], r["end_word"], r["cluster_id"], r["removed"]) for r in got.collect()}
    whole = [i for i in range(60) if {(2 * i, 1, 61, 2 * i, False), (2 * i + 1, 1, 61, 2 * i, True)} <= spans]
    assert len(whole) >= 57, len(whole)
