"""Sinks: ordered text artifacts, per-file YAML, JSON rows, status snapshots.

Ordered artifacts are range-partitioned on their sort keys and sorted within
partitions, so part files concatenated in name order give the document in
order; no partition holds more than its key range, whatever a category's
size.  Writes go to a fresh version path (overwrite of a versioned
location), never to machine-local folders.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .documents import write_documents


def _parallelism(df: DataFrame) -> int:
    try:
        return df.sparkSession.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001
        return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def write_lines(df: DataFrame, path: str, keys: list[str], line: str = "line", partitions: int | None = None) -> None:
    """Write ``line`` ordered by ``keys`` as text part files."""
    n = partitions or _parallelism(df)
    (df.repartitionByRange(n, *keys).sortWithinPartitions(*keys).select(line)
       .write.mode("overwrite").text(path))


def yaml_text(items: DataFrame, keys: list[str], omit_blank: bool = False) -> DataFrame:
    """``yaml``, every item as its YAML list entry with a fixed key order
    (``omit_blank`` drops empty optional fields, as the OPML import does).  Values are double-quoted scalars, whose
    escapes YAML shares with JSON, so any text reads back as it was."""
    fields = []
    for k in keys:
        value = F.coalesce(F.col(k).cast("string"), F.lit(""))
        quoted = F.to_json(F.array(value))
        field = F.concat(F.lit(f"{k}: "), F.substring(quoted, F.lit(2), F.length(quoted) - 2))
        fields.append(F.when(value != "", field) if omit_blank and k not in ("url", "category") else field)
    return items.withColumn("yaml", F.concat(F.lit("- "), F.concat_ws("\n  ", *fields)))


def write_yaml_files(items: DataFrame, path: str, keys: list[str], sort_cols: list, file_col: str = "file",
                     omit_blank: bool = False) -> list[str]:
    """The file ``path``/``file`` for each target file, entries in ``sort_cols`` order; every file is put in place of
    the old one at once, files without an item aren't touched.  Returns the files' names."""
    order = {f"__k{i}": (F.col(c) if isinstance(c, str) else c) for i, c in enumerate(sort_cols)}
    y = yaml_text(items, keys, omit_blank).withColumns(order).select(file_col, *order, "yaml")
    return write_documents(y, path, file_col, list(order), "yaml")


def write_json_rows(df: DataFrame, path: str, bucket_col: str | None = None) -> None:
    """JSON lines; with ``bucket_col`` grouped into bucket directories
    (e.g. the first characters of a hash) instead of one file per record."""
    w = df.write.mode("overwrite")
    if bucket_col:
        w = w.partitionBy(bucket_col)
    w.json(path)


def write_status_snapshot(results: DataFrame, base: str, run_id: str) -> str:
    """One status snapshot version: per-URL rows (sorted by URL) and a totals row.

    The original keeps one JSON document with a results map; here the map is the
    row set (ordered by URL, range partitioned) and the totals sit next to it.
    """
    from ..operators.health import check_totals
    out = f"{base.rstrip('/')}/run={run_id}"
    n = _parallelism(results)
    results.repartitionByRange(n, "url").sortWithinPartitions("url").write.mode("overwrite").json(f"{out}/results")
    check_totals(results).coalesce(1).write.mode("overwrite").json(f"{out}/totals")
    return out
