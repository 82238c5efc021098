"""Helpers shared by the training-data operators: staging, row positions, text hashing.

No join is hinted to broadcast: sides that are often small are staged first, so that Spark knows their
size from the files and decides by ``autoBroadcastJoinThreshold``.
"""
from __future__ import annotations

import atexit
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shared_dir

U64 = np.uint64
#: Rows of 16 bytes that may go to the executors as one set; beyond it they are joined.
BROADCAST_ROWS = 500_000
#: Bits of a bitmap for each value where what passes by chance is dear to make or to move.
RARE = 256
_STAGED: list = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch holds: texts can be long, so fewer rows than Spark's default."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet under the shared folder and read it back.

    What was written survives lost executors; the folder is dropped by ``drop_stage`` or when the
    driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/stage-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if not _STAGED:
        atexit.register(_drop_all)
    _STAGED.append((spark, path))
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def drop_stage(*dfs: DataFrame) -> None:
    """Delete staged tables that no later plan reads."""
    for df in dfs:
        path = getattr(df, "staged_at", None)
        if path:
            _delete(df.sparkSession, path)
            _STAGED[:] = [x for x in _STAGED if x[1] != path]


def _drop_all() -> None:
    for spark, path in _STAGED:
        try:
            _delete(spark, path)
        except Exception:  # noqa: BLE001 - the session ended first; the shared folder's owner cleans up
            return


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """True when ``df`` has at most ``rows`` rows; reads no more than that many."""
    return df.limit(rows + 1).count() <= rows


def pin_splits(spark: SparkSession) -> None:
    """Fix the number that file splits are cut by. Unset, Spark takes the cores of the moment, so after
    a lost executor a second plan over the same table would cut it, and number its rows, differently."""
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        spark.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))


def with_row_id(docs: DataFrame, *cols: str) -> DataFrame:
    """``rid`` and the chosen columns; names of other columns can't clash. Over a stored table a row has
    the same ``rid`` in every plan of the session."""
    pin_splits(docs.sparkSession)
    return docs.select(F.monotonically_increasing_id().alias("rid"), *cols)


def free_name(name: str, df: DataFrame) -> str:
    """``name``, or what is like it and no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def binaries(batch: pa.RecordBatch, col: str) -> list:
    """A string column as UTF-8 bytes (None stays None), without decoding."""
    a = batch.column(batch.schema.get_field_index(col))
    return a.cast(pa.large_binary() if pa.types.is_large_string(a.type) else pa.binary()).to_pylist()


def column(batch: pa.RecordBatch, col: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(col))


def arrow_batch(schema: T.StructType, cols: list) -> pa.RecordBatch:
    """A batch of ``schema`` from one array or list per field."""
    from pyspark.sql.pandas.types import to_arrow_schema

    s = to_arrow_schema(schema)
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) and c.type == f.type else pa.array(c, f.type) for c, f in zip(cols, s)], schema=s)


SPACE = b" \t\n\x0b\x0c\r"
NOT_ALNUM = bytes(c for c in range(128) if not chr(c).isalnum())


class WordHash:
    """64-bit hashes of all words of a text at once; words are runs of bytes other than ``apart``, A-Z
    count as a-z. A word's hash is a polynomial of its bytes' random values, taken from running sums."""

    PIECE = 1 << 18

    def __init__(self, apart: bytes = SPACE) -> None:
        values = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
        values[65:91] = values[97:123]
        self.values, self.apart = values, np.zeros(256, bool)
        self.apart[list(apart)] = True
        self.base = 0xD1342543DE82EF95
        self.up = self.down = np.ones(1, U64)

    def _grow(self, n: int) -> None:
        while len(self.up) < n:
            k = len(self.up)
            self.up = np.concatenate([self.up, self.up * U64(pow(self.base, k, 1 << 64))])
            self.down = np.concatenate([self.down, self.down * U64(pow(self.base, -k, 1 << 64))])

    def spans(self, text: bytes | None) -> tuple:
        """``(hashes, starts, ends)``, places by bytes."""
        got, at, n = [], 0, len(text or b"")
        whole = np.frombuffer(text or b"", np.uint8)
        while at < n:  # long texts in pieces that end between words
            to = min(at + self.PIECE, n)
            while to < n and not self.apart[whole[to]]:
                to += 1
            a = whole[at:to]
            self._grow(len(a))
            gap = self.apart[a]
            edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
            if not gap[0]:
                edge = np.concatenate([[0], edge])
            if not gap[-1]:
                edge = np.concatenate([edge, [len(a)]])
            low, high = edge[::2], edge[1::2]
            sums = np.zeros(len(a) + 1, U64)
            np.cumsum(self.values[a] * self.up[:len(a)], out=sums[1:])
            got.append(((sums[high] - sums[low]) * self.down[low], low + at, high + at))
            at = to
        if len(got) == 1:
            return (mix(got[0][0]), *got[0][1:])
        if not got:
            return np.empty(0, U64), np.empty(0, np.int64), np.empty(0, np.int64)
        h, low, high = (np.concatenate(x) for x in zip(*got))
        return mix(h), low, high

    def of(self, text: bytes | None) -> np.ndarray:
        return self.spans(text)[0]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def shingle_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` words, by position; of the whole sequence if it is shorter."""
    n = len(h)
    if not n:
        return h
    w = min(k, n)
    s = np.full(n - w + 1, U64(w))
    for j in range(w):
        s = s * U64(0x9E3779B97F4A7C15) + h[j:n - w + 1 + j]
    return mix(s)


def seeds(n: int, salt: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(salt))


def bit_filter(hashes: DataFrame, name: str, least: int = 16, most: int = 27, each: int = 16) -> tuple[np.ndarray, int]:
    """A bitmap over the leading bits of the distinct 64-bit values of column ``name``, and its size as
    a power of two: ``each`` bits for each value, up to ``2**most`` bits (16 MB), however many there are.

    A value that was put in always passes ``passes``; others pass seldom, so an exact join follows.
    """
    distinct = hashes.select(F.col(name).alias("h")).distinct()
    power = int(min(max(least, np.ceil(np.log2(each * max(distinct.count(), 1)))), most))
    lead = F.call_function("shiftrightunsigned", "h", F.lit(64 - power))
    bits = F.call_function("shiftleft", F.lit(1).cast("long"), lead.bitwiseAND(63).cast("int"))
    slots = distinct.select(F.shiftright(lead, 6).alias("slot"), bits.alias("bits")) \
        .groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    bitmap = np.zeros(1 << (power - 6), np.int64)
    bitmap[slots["slot"].to_numpy()] = slots["bits"].to_numpy()
    return bitmap.view(U64), power


def passes(filter_: tuple, values: np.ndarray) -> np.ndarray:
    bitmap, power = filter_
    lead = values >> U64(64 - power)
    return ((bitmap[lead >> U64(6)] >> (lead & U64(63))) & U64(1)).astype(bool)
