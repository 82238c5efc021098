"""The text that the quality rules leave."""
import re
from collections import Counter

from feedcat.llm import quality_rules


def test_lines_above_the_limit_leave_the_text(spark):
    rows = [(i, f"own words {i}\n A common   LINE\n\n \t\na common line\nlast {i}", "s0") for i in range(6)]
    rows += [(6, "a common line\nkept in this host", "s1"), (7, "a common line", "s0"), (7, "a common line\n", "s0"),
             (8, None, "s0"), (None, "", None), (9, "\n\n", "s0"), (10, "no such line", "s0")]
    rows += [(20 + i, "null host's line\nown %d" % i, None) for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(3).cache()
    norm = lambda x: re.sub(r"[ \t\n\x0b\f\r]+", " ", x).strip(" ").lower()
    chars = lambda t: len(re.sub(r"[ \t\n\x0b\f\r]", "", t or ""))
    counts = Counter((s, k) for _, t, s in rows for k in {norm(x) for x in (t or "").split("\n")} if k)
    want = []
    for i, t, s in rows:
        clean = None if t is None else "\n".join(x for x in t.split("\n") if not norm(x) or counts[s, norm(x)] <= 3)
        want.append((i, clean, chars(t) - chars(clean)))
    for few in (quality_rules.FEW, 0):  # the bad lines as a set, and joined
        got = quality_rules.quality(docs, max_docs=3, few=few).collect()
        assert sorted(((r["doc_id"], r["clean_text"], r["dropped_chars"]) for r in got), key=repr) == sorted(want, key=repr)
    same = quality_rules.quality(docs, max_docs=100)  # no line is bad
    assert sorted((r["clean_text"] for r in same.collect()), key=repr) == sorted((t for _, t, _ in rows), key=repr)
    assert want[0][1] == "own words 0\n\n \t\nlast 0" and want[7][1] == ""
    assert quality_rules.quality(docs.where("false")).count() == 0
