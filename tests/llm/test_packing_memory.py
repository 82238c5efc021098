"""What packing holds of a batch while it measures its texts."""
import tracemalloc

import pyarrow as pa
import xxhash
from pyspark.sql import types as T

from feedcat.llm import packing

SCHEMA = T.StructType([T.StructField("rid", T.LongType()), T.StructField("doc_id", T.LongType()), T.StructField("source", T.StringType()),
                       T.StructField("n_words", T.LongType()), T.StructField("cluster", T.BinaryType())])


def test_words_of_one_text_at_a_time():
    texts = [" ".join(f"Word{i + j}" for j in range(700)) for i in range(1000)] + [None, "", " \n"]
    ids = pa.array(range(len(texts)), pa.int64())
    batch = pa.RecordBatch.from_arrays([ids, ids, pa.array(["s"] * len(texts)), pa.array(texts, pa.string())], names=["rid", "doc_id", "source", "text"])
    tracemalloc.start()
    got = packing.lengths(batch, SCHEMA)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # the texts themselves are 6 MB; the words of all of them as objects are more than 30 MB
    assert peak < 12e6
    assert got.column(3).to_pylist() == [700] * 1000 + [0, 0, 0]
    assert got.column(4)[7].as_py() == xxhash.xxh3_128_digest(texts[7].lower().encode())
    assert len(set(got.column(4).to_pylist()[-3:])) == 1
