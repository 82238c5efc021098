"""Whole documents: one file with a head, lines in order and a tail.

Written in two phases. Tasks write the lines as ordered part files beside the target, through Spark's own committer, so
a lost executor only repeats its parts. The commit step then joins the parts in order and puts the document in place of
the old one by a rename that replaces it: readers see the old document or the new one, never a part, and a run that
fails before that leaves the old one as it was. Where the file system can concatenate (HDFS), joining moves no
bytes; elsewhere the parts are streamed through a buffer of fixed size. No line passes through the driver's memory.
"""
from __future__ import annotations

import uuid
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import UnsupportedOperationException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import health as H
from ..operators import render as W
from ..session import materialize

BUFFER = 1 << 20


class Files:
    """A file system as the driver sees it, by Hadoop's interface."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.jvm, self.conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self.gateway = spark.sparkContext._gateway
        self.fs = self.path(path).getFileSystem(self.conf)

    def path(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def names(self, folder: str) -> list[str]:
        """Names of a folder's entries in order; none if there is no such folder."""
        p = self.path(folder)
        return sorted(f.getPath().getName() for f in self.fs.listStatus(p)) if self.fs.exists(p) else []

    def write(self, path: str, text: str) -> None:
        out = self.fs.create(self.path(path), True)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()

    def read(self, path: str) -> str:
        source = self.fs.open(self.path(path))
        try:
            return bytes(source.readAllBytes()).decode("utf-8")
        finally:
            source.close()

    def join(self, parts: list[str], target: str) -> None:
        """All ``parts`` in order as one file; the parts go, or are left for their folder to be deleted."""
        first, *rest = parts
        try:
            self.fs.rename(self.path(first), self.path(target))
            if not rest:
                return
            sources = self.gateway.new_array(self.jvm.org.apache.hadoop.fs.Path, len(rest))
            for i, p in enumerate(rest):
                sources[i] = self.path(p)
            self.fs.concat(self.path(target), sources)
            return
        except UnsupportedOperationException:
            pass
        self.fs.rename(self.path(target), self.path(first))
        out = self.fs.create(self.path(target), True)
        try:
            for p in parts:
                source = self.fs.open(self.path(p))
                try:
                    self.jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, BUFFER, False)
                finally:
                    source.close()
        finally:
            out.close()

    def move(self, source: str, target: str, replace: bool) -> bool:
        """Rename at once; without ``replace`` an existing target stays and the result is False."""
        kind = getattr(self.jvm, "org.apache.hadoop.fs.Options$Rename")
        how = self.gateway.new_array(kind, 1)
        how[0] = kind.OVERWRITE if replace else kind.NONE
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.path(source).toUri(), self.conf)
        try:
            context.rename(self.fs.makeQualified(self.path(source)), self.fs.makeQualified(self.path(target)), how)
        except Py4JJavaError as e:
            if replace or "FileAlreadyExists" not in e.java_exception.getClass().getName():
                raise
            return False
        return True

    def delete(self, path: str) -> None:
        self.fs.delete(self.path(path), True)


def write_document(lines: DataFrame, path: str, keys: list[str], head: str = "", tail: str = "", sep: str = "\n",
                   last_sep: str | None = None, line: str = "line", partitions: int | None = None) -> None:
    """``head``, every ``line`` in the order of ``keys`` and ``sep`` after each, ``tail``.

    With ``last_sep`` that is what stands after the last line."""
    spark = lines.sparkSession
    files = Files(spark, path)
    work = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    n = partitions or spark.sparkContext.defaultParallelism
    try:
        if last_sep is not None:
            lines = materialize(lines.withColumn("__row", F.monotonically_increasing_id()))
            keys = [*keys, "__row"]
            last = lines.agg(F.max_by(F.struct(F.col(line).alias("line"), "__row"), F.struct(*keys)).alias("r")).first()["r"]  # one line
            if last is not None:
                lines, tail = lines.where(F.col("__row") != last["__row"]), last["line"] + last_sep + tail
        lines.repartitionByRange(n, *keys).sortWithinPartitions(*keys).select(F.col(line).alias("value")) \
            .write.option("lineSep", sep).text(f"{work}/body")
        files.write(f"{work}/head", head)
        files.write(f"{work}/tail", tail)
        body = [f"{work}/body/{f}" for f in files.names(f"{work}/body") if f.startswith("part-")]
        files.join([f"{work}/head", *body, f"{work}/tail"], f"{work}/whole")
        files.move(f"{work}/whole", path, replace=True)
    finally:
        files.delete(work)


def write_documents(lines: DataFrame, folder: str, name: str, keys: list[str], line: str = "line",
                    partitions: int | None = None) -> list[str]:
    """The file ``folder``/``name`` for each value of the column ``name``, its lines in the order of ``keys``; each is put
    in place of the old one by itself, other files stay. Returns the names."""
    spark = lines.sparkSession
    files = Files(spark, folder)
    folder = folder.rstrip("/")
    work = f"{folder}/.{uuid.uuid4().hex}"
    n = partitions or spark.sparkContext.defaultParallelism
    try:
        lines.repartitionByRange(n, name, *keys).sortWithinPartitions(name, *keys) \
            .select(F.col(name).alias("__name"), F.col(line).alias("value")).write.partitionBy("__name").text(f"{work}/body")
        names = []
        for entry in files.names(f"{work}/body"):
            if entry.startswith("__name="):
                parts = [f"{work}/body/{entry}/{f}" for f in files.names(f"{work}/body/{entry}") if f.startswith("part-")]
                names.append(unquote(entry.removeprefix("__name=")))
                files.join(parts, f"{work}/{len(names)}")
                files.move(f"{work}/{len(names)}", f"{folder}/{names[-1]}", replace=True)
    finally:
        files.delete(work)
    return names


def _json(value: Column) -> Column:
    """A value as JSON text; null is ``null``."""
    wrapped = F.to_json(F.array(value), {"ignoreNullFields": "false"})
    return F.substring(wrapped, F.lit(2), F.length(wrapped) - 2)


def json_object(df: DataFrame, fields: list[str], indent: int | None, optional: tuple = ()) -> Column:
    """Fields as a JSON object in their order; pretty with ``indent`` blanks before its end, else compact. Those of
    ``optional`` are left out where null."""
    colon, gap = (": ", "\n" + " " * (indent + 2)) if indent is not None else (":", "")
    parts = [F.when(F.col(f).isNotNull(), part) if f in optional else part for f in fields
             for part in [F.concat(F.lit(gap + f'"{f}"{colon}'), _json(F.col(f)))]]
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("\n" + " " * indent + "}" if indent is not None else "}"))


def _quoted(text: str) -> str:
    import json
    return json.dumps(text, ensure_ascii=False)


ITEM_FIELDS = ["url", "title", "description", "type", "category"]


def write_catalog_json(items: DataFrame, path: str, generated_at: str, pretty: bool = True) -> None:
    """``{generated_at, total, feeds: [...]}`` in G1 order, pretty or minified."""
    items = items.withColumns({f: F.coalesce(F.col(f), F.lit("")) for f in ITEM_FIELDS})
    keyed = items.select(F.lower("category").alias("k_category"), F.lower("title").alias("k_title"), F.lower("url").alias("k_url"),
                         F.col("url").alias("k_raw"), *ITEM_FIELDS)
    keys = [c for c in keyed.columns if c.startswith("k_")]
    obj = json_object(keyed, ITEM_FIELDS, 4 if pretty else None)
    lines = materialize(keyed.select(*keys, F.concat(F.lit("    " if pretty else ""), obj).alias("line")))
    total = lines.count()
    if pretty:
        head = f'{{\n  "generated_at": {_quoted(generated_at)},\n  "total": {total},\n  "feeds": ['
        head, tail = (head + "\n", "  ]\n}\n") if total else (head + "]\n}\n", "")
    else:
        head, tail = f'{{"generated_at":{_quoted(generated_at)},"total":{total},"feeds":[', "]}\n"
    write_document(lines, path, keys, head, tail, *((",\n", "\n") if pretty else (",", "")))


def write_json_array(rows: DataFrame, path: str, keys: list[str], fields: list[str]) -> None:
    """The rows as objects of one JSON array, in the order of ``keys``."""
    order = {f"__k{i}": F.col(k) for i, k in enumerate(keys)}
    obj = F.to_json(F.struct(*fields), {"ignoreNullFields": "false", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss"})
    lines = materialize(rows.select(*[c.alias(k) for k, c in order.items()], F.concat(F.lit("  "), obj).alias("line")))
    empty = lines.isEmpty()
    write_document(lines, path, list(order), "[]\n" if empty else "[\n", "" if empty else "]\n", ",\n", "\n")


STATE_FIELDS = ["status", "http_status", "error", "bozo", "entries", "final_url", "content_type", "latency_ms", "retried",
                "consecutive_failures", "down_since", "last_seen_active"]


def write_status_json(results: DataFrame, path: str, checked_at: str) -> None:
    """``{checked_at, total, active, down, rate_limited, results: {url: state}}`` sorted by URL, one state per URL.

    Times are text (ISO); ``retried`` is written where it is set."""
    import json
    have = [f for f in STATE_FIELDS if f in results.columns]
    lines = materialize(results.select("url", "status", F.concat(
        F.lit("    "), _json(F.col("url")), F.lit(": "), json_object(results, have, 4, optional=("retried",))).alias("line")))
    totals = H.check_totals(lines).first()
    head = json.dumps({"checked_at": checked_at, **{k: totals[k] for k in ("total", "active", "down", "rate_limited")}},
                      ensure_ascii=False, indent=2).removesuffix("\n}") + ',\n  "results": {'
    head, tail = (head + "\n", "  }\n}\n") if totals["total"] else (head + "}\n}\n", "")
    write_document(lines.select("url", "line"), path, ["url"], head, tail, ",\n", "\n")


def write_opml(items: DataFrame, path: str, title: str) -> None:
    """Prologue, head with the escaped title, body with a group of outlines for each category."""
    escaped = title
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        escaped = escaped.replace(a, b)
    head = ('<?xml version="1.0" encoding="UTF-8"?>\n<opml version="2.0">\n  <head>\n'
            f"    <title>{escaped}</title>\n  </head>\n  <body>\n")
    write_document(W.opml_lines(items), path, ["k_cat", "category", "part", "k_title", "ord"], head, "  </body>\n</opml>\n")


TABLE_HEAD = "| Feed | Description | Type | URL |\n|---|---|---:|---|"


def write_markdown(items: DataFrame, path: str, generated_at: str, title: str = "Feeds — Full List",
                   intro: tuple = (), note: str = "") -> None:
    """Title, intro, time, contents with counts, and for each category a heading, its total and a table."""
    rows = materialize(W.markdown_rows(items))
    text = lambda c: F.lit(c).alias
    counts = rows.where("kind = 'item'").groupBy("category").agg(F.count("*").cast("string").alias("n"))
    heads = counts.select("category", text("head")("kind"), text("")("k_title"), text("")("k_url"), F.concat(
        F.lit("\n## "), F.col("category"), F.lit("\n\nTotal: **"), F.col("n"), F.lit("**\n\n" + TABLE_HEAD)).alias("line"))
    rule = items.sparkSession.createDataFrame([("", "rule", "", "", "\n---")], "category string, kind string, k_title string, k_url string, line string")
    kind = F.col("kind")
    keyed = rows.unionByName(heads).unionByName(rule).withColumns({
        "k_kind": F.when(kind == "toc", 0).when(kind == "rule", 1).otherwise(2), "k_cat": F.lower("category"),
        "k_part": F.when(kind == "head", 0).otherwise(1)})
    blocks = [f"# {title}", *intro, f"**Generated:** `{generated_at}` (UTC)", *([f"> {note}"] if note else [])]
    head = "".join(b + "\n\n" for b in blocks) + "\n---\n\n## Contents\n\n"
    write_document(keyed, path, ["k_kind", "k_cat", "category", "k_part", "k_title", "k_url"], head)
