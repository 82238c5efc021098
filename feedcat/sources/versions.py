"""Versioned tables: a log of versions, each swapped in at once (A20, the streams' state).

A version is one entry of a log, created by a rename that never replaces: of two writers that start from the same
version one gets the next number and the other, told so, does its work again on the winner's version. Data folders have
names of their own, so readers who hold a version keep reading it, and whatever fails before the entry is there leaves
the table as it was. ``vacuum`` deletes folders that none of the last entries names. All files are reached through
Hadoop's interface. (On a local file system, as in tests, the rename tests for the target first.)
"""
from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import catalog as C
from .documents import Files


class Conflict(Exception):
    """Another writer has made the version meanwhile."""


class Log:
    """Numbered entries (dicts) under ``base/_log``; the last is the table's state."""

    def __init__(self, spark: SparkSession, base: str) -> None:
        self.spark, self.base, self.files = spark, base.rstrip("/"), Files(spark, base)

    def version(self) -> int:
        """The last version; 0 before the first."""
        return max((int(n) for n in self.files.names(f"{self.base}/_log") if n.isdigit()), default=0)

    def entry(self, version: int) -> dict:
        return json.loads(self.files.read(f"{self.base}/_log/{version:020d}")) if version else {}

    def commit(self, version: int, entry: dict) -> None:
        """Make ``entry`` the version after ``version``, or raise Conflict."""
        draft = f"{self.base}/_log/.{uuid.uuid4().hex}"
        self.files.write(draft, json.dumps(entry))
        if not self.files.move(draft, f"{self.base}/_log/{version + 1:020d}", replace=False):
            self.files.delete(draft)
            raise Conflict(f"version {version + 1} of {self.base}")

    def new_folder(self) -> str:
        return f"data-{uuid.uuid4().hex}"

    def retry(self, step, attempts: int = 20):
        """``step(version)`` until no other writer comes between."""
        for _ in range(attempts):
            try:
                return step(self.version())
            except Conflict:
                continue
        raise Conflict(f"{attempts} attempts on {self.base}")

    def vacuum(self, keep: int = 2) -> None:
        """Delete data folders that none of the last ``keep`` versions names; for when no older version is being read
        or written."""
        last = self.version()
        text = [json.dumps(self.entry(v)) for v in range(max(last - keep + 1, 1), last + 1)]
        for name in self.files.names(self.base):
            if name.startswith("data-") and not any(name in t for t in text):
                self.files.delete(f"{self.base}/{name}")


class VersionedTable(Log):
    """A table whose versions are whole folders."""

    def read(self, version: int | None = None) -> DataFrame | None:
        """The table as of ``version`` (the last): pinned, later versions don't change it. None before the first."""
        entry = self.entry(self.version() if version is None else version)
        return self.spark.read.parquet(f"{self.base}/{entry['folder']}") if entry else None

    def update(self, change) -> int:
        """Write ``change(table or None)`` as the next version; again on the winner's version if a writer came between."""
        def step(version: int) -> int:
            folder = self.new_folder()
            try:
                change(self.read(version) if version else None).write.parquet(f"{self.base}/{folder}")
                self.commit(version, {"folder": folder})
            except BaseException:
                self.files.delete(f"{self.base}/{folder}")
                raise
            return version + 1

        return self.retry(step)


def merge_or_replace(table: VersionedTable, new: DataFrame, merge: bool = True) -> int:
    """The new items appended by D8 to the table's, or in place of them; the new version's number."""
    def change(old):
        if old is None or not merge:
            return new
        return C.merge_by_url(old, new).drop("added")

    return table.update(change)


class BucketedTable(Log):
    """A table in partitions that are replaced one by one: a write touches the partitions of its rows only.

    The entry names every partition's folder, so its size goes with the number of partitions, not with the rows."""

    def parts(self, version: int | None = None) -> dict:
        return self.entry(self.version() if version is None else version).get("parts", {})

    def last_batch(self) -> int:
        return self.entry(self.version()).get("batch", -1)

    def read(self, names=None, version: int | None = None) -> DataFrame | None:
        """The rows of the partitions ``names`` (all); None if they have none."""
        parts = self.parts(version)
        folders = [f"{self.base}/{parts[n]}" for n in (parts if names is None else names) if n in parts]
        return self.spark.read.parquet(*folders) if folders else None

    def replace(self, rows: DataFrame, part: str, batch: int, version: int) -> list[str]:
        """Put ``rows`` in place of the partitions named in their column ``part``; returns those."""
        folder = self.new_folder()
        try:
            rows.repartition(part).write.partitionBy(part).parquet(f"{self.base}/{folder}")
            prefix = f"{part}="
            written = [n.removeprefix(prefix) for n in self.files.names(f"{self.base}/{folder}") if n.startswith(prefix)]
            parts = self.parts(version) | {n: f"{folder}/{prefix}{n}" for n in written}
            self.commit(version, {"batch": batch, "parts": parts})
        except BaseException:
            self.files.delete(f"{self.base}/{folder}")
            raise
        return written


def bucket(key: str, buckets: int):
    """The bucket of a key, as text."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("string")
