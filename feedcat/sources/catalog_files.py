"""Catalog sources: YAML files, the JSON artifact, OPML, status snapshots and the
seen cache (A1, A2, A3, A4, A9).

Files are read whole (one row per file, ``_metadata.file_name`` keeps the
name); YAML is parsed per file with ``mapInPandas`` (the only Python-side
parsing in the library), JSON with ``from_json``, and OPML is cut into its tags.
A missing file reads as empty.
"""
from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from ..functions import markup as M
from ..functions import urls as U
from ..functions.text import clean_text

ITEM_SCHEMA = ("file string, item_idx int, url string, title string, description string, type string, "
               "category string, is_dict boolean")
FIELDS = ["url", "title", "description", "type", "category"]


def _whole_files(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), "value")
    except AnalysisException as e:  # missing input reads as empty; other errors are errors
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _yaml_list(text: str) -> tuple[str, list]:
    """How a catalog file reads: its state (ok, corrupt or not_a_list) and its items."""
    import yaml
    try:
        data = yaml.safe_load(text)
    except yaml.YAMLError:
        return "corrupt", []
    if data is None:
        return "ok", []
    return ("ok", data) if isinstance(data, list) else ("not_a_list", [])


def _yaml_item(item) -> tuple:
    """The item's fields and whether it is a mapping. A missing key is None (e.g. the Markdown page files it under
    'Uncategorized'), a YAML null ''."""
    if not isinstance(item, dict):
        return (*[None] * len(FIELDS), False)
    return (*[None if k not in item else ("" if item[k] is None else str(item[k])) for k in FIELDS], True)


def _parse_yaml_items(strict: bool):
    def parse(batches):
        import pandas as pd
        for pdf in batches:
            out = []
            for name, text in zip(pdf["file"], pdf["value"]):
                state, data = _yaml_list(text)
                if strict and state != "ok":
                    raise ValueError(f"Invalid YAML in {name} ({'expected list' if state == 'not_a_list' else 'corrupt'})")
                out += [(name, idx, *_yaml_item(it)) for idx, it in enumerate(data, start=1)]
            yield pd.DataFrame(out, columns=["file", "item_idx", *FIELDS, "is_dict"])
    return parse


def _with_ord(items: DataFrame) -> DataFrame:
    """``ord``: the order of file names, then of places in the file; no number has to be dealt out for that."""
    return items.withColumn("ord", F.struct("file", "item_idx"))


def read_yaml_catalog(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """A1: one row per YAML list item with (file, item_idx, ord); ``ord`` orders by file
    name then position.  ``strict`` fails on a corrupt or non-list file (build/export); lenient
    mode reads it as empty (discovery).  A missing field is NULL, a YAML null ''."""
    raw = _whole_files(spark, path)
    if raw is None:
        return _with_ord(spark.createDataFrame([], ITEM_SCHEMA))
    return _with_ord(raw.mapInPandas(_parse_yaml_items(strict), ITEM_SCHEMA))


FILE_SCHEMA = ("file string, bytes bigint, state string, n_items int, items array<struct<item_idx:int, url:string, title:string, "
               "description:string, type:string, category:string, is_dict:boolean>>")


def read_yaml_files(spark: SparkSession, path: str) -> DataFrame:
    """A1 by file: one row per catalog file, empty, corrupt and non-list ones too, with how it reads (``state``: ok,
    corrupt, not_a_list), its size and its items. No file gives no row."""
    raw = _whole_files(spark, path)
    if raw is None:
        return spark.createDataFrame([], FILE_SCHEMA)

    def parse(batches):
        import pandas as pd
        names = ["item_idx", *FIELDS, "is_dict"]
        for pdf in batches:
            out = []
            for name, text in zip(pdf["file"], pdf["value"]):
                state, data = _yaml_list(text)
                items = [dict(zip(names, (idx, *_yaml_item(it)))) for idx, it in enumerate(data, start=1)]
                out.append((name, len(text.encode()), state, len(items), items))
            yield pd.DataFrame(out, columns=["file", "bytes", "state", "n_items", "items"])

    parsed = raw.mapInPandas(parse, FILE_SCHEMA)
    # scans leave files without a byte out, so names come from the scan's own listing
    names = [(unquote(f.rsplit("/", 1)[-1]),) for f in raw.inputFiles()]
    return spark.createDataFrame(names, "file string").join(parsed, "file", "left").select(
        "file", F.coalesce("bytes", F.lit(0).cast("bigint")).alias("bytes"), F.coalesce("state", F.lit("ok")).alias("state"),
        F.coalesce("n_items", F.lit(0)).alias("n_items"), "items")


def items_of_files(files: DataFrame) -> DataFrame:
    """The items of ``read_yaml_files`` as ``read_yaml_catalog`` gives them."""
    return _with_ord(files.select("file", F.inline("items")))


CATALOG_JSON_SCHEMA = ("generated_at string, total bigint, "
                       "feeds array<struct<url:string,title:string,description:string,type:string,category:string>>")


def read_catalog_json(spark: SparkSession, path: str) -> DataFrame:
    """A2: the catalog artifact {generated_at, total, feeds[]} -> one row per feed with ord."""
    raw = _whole_files(spark, path)
    if raw is None:
        return spark.createDataFrame([], "file string, item_idx int, ord bigint, url string, title string, "
                                         "description string, type string, category string")
    doc = raw.select("file", F.from_json("value", CATALOG_JSON_SCHEMA).alias("d"))
    ex = doc.select("file", F.posexplode("d.feeds").alias("i", "f"))
    return ex.select("file", (F.col("i") + 1).cast("int").alias("item_idx"), F.col("i").cast("bigint").alias("ord"),
                     *[F.col(f"f.{k}").alias(k) for k in FIELDS])


STATE_FIELDS = ("status string, http_status int, error string, bozo boolean, entries int, final_url string, "
                "content_type string, latency_ms int, retried boolean, consecutive_failures int, "
                "down_since string, last_seen_active string")
STATUS_SCHEMA = ("checked_at string, total bigint, results map<string, struct<status:string, http_status:int, "
                 "error:string, bozo:boolean, entries:int, final_url:string, content_type:string, latency_ms:int, "
                 "retried:boolean, consecutive_failures:int, down_since:string, last_seen_active:string>>")


def read_status(spark: SparkSession, path: str) -> DataFrame:
    """A4: status snapshot -> one row per URL (url, status, error, ..., checked_at).
    Missing or corrupt files give no rows."""
    raw = _whole_files(spark, path)
    if raw is None:
        return spark.createDataFrame([], "url string, " + STATE_FIELDS + ", checked_at string")
    doc = raw.select(F.from_json("value", STATUS_SCHEMA).alias("d"))
    ex = doc.select(F.col("d.checked_at").alias("checked_at"), F.explode("d.results").alias("url", "r"))
    cols = [c.split()[0] for c in STATE_FIELDS.split(", ")]
    return ex.select("url", *[F.col(f"r.{c}").alias(c) for c in cols], "checked_at")


SEEN_SCHEMA = ("map<string, struct<feed_url:string, site_url:string, title:string, last_seen_ts:bigint, "
               "score:int, feed_type:string>>")

SEEN_COLUMNS = "url_hash string, feed_url string, site_url string, title string, last_seen_ts bigint, score int, feed_type string"


def read_seen(spark: SparkSession, path: str) -> DataFrame:
    """Seen cache {url_hash: {...}} -> rows; missing or corrupt reads as empty."""
    raw = _whole_files(spark, path)
    if raw is None:
        return spark.createDataFrame([], SEEN_COLUMNS)
    ex = raw.select(F.explode(F.from_json("value", SEEN_SCHEMA)).alias("url_hash", "r"))
    return ex.select("url_hash", *[F.col(f"r.{c}").alias(c) for c in
                                   ("feed_url", "site_url", "title", "last_seen_ts", "score", "feed_type")])


# what an OPML document is cut into; comments, CDATA and instructions hold no outlines
XML_SKIP_RE = r"(?s)<!--(?:.*?-->|.*+)|<!\[CDATA\[(?:.*?\]\]>|.*+)|<\?(?:.*?\?>|.*+)"
OUTLINE = "outline"
OPML_COLUMNS = ("file string, ord struct<file:string,pos:int>, url string, title string, description string, type string, "
                "category string")


def _opml_value(tag, *names: str):
    """The first of the attributes that isn't empty; '' if all are."""
    values = [F.nullif(M.attribute(tag, n, OUTLINE, "s"), F.lit("")) for n in names]
    return F.coalesce(*values, F.lit(""))


def read_opml(spark: SparkSession, path: str) -> DataFrame:
    """A3: OPML -> feed items, outlines nested to any depth, in document order (``ord``).

    Top-level outlines are categories; their descendants with xmlUrl|url|href are feeds. Without <body> the
    root's outlines are used; a document with no feed under any category yields all outlines with a URL as
    'Uncategorized'. A document is cut into its tags; an outline's depth is the number of outlines open
    before it, a running sum over the document's tags."""
    raw = _whole_files(spark, path)
    if raw is None:
        return spark.createDataFrame([], OPML_COLUMNS)
    cut = M.tags(F.regexp_replace("value", XML_SKIP_RE, " "), "/?(?:outline|body)", "s")
    tag = F.col("tag")
    t = raw.select("file", F.posexplode(cut).alias("pos", "tag"))
    outline, ends = tag.startswith("<outline"), tag.startswith("</")
    alone = tag.rlike(r"/>$")
    t = t.select("file", "pos", "tag", outline.alias("is_outline"),
                 F.when(tag.contains("body"), F.when(ends, -1).when(alone, 0).otherwise(1)).otherwise(0).alias("body"),
                 F.when(outline & ~alone, 1).when(tag.startswith("</outline"), -1).otherwise(0).alias("step")) \
        .withColumn("body", F.when(F.col("is_outline"), 0).otherwise(F.col("body")))
    whole = Window.partitionBy("file")
    before = whole.orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    so_far = whole.orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    t = t.select("file", "pos", "tag", "is_outline", F.coalesce(F.sum("step").over(before), F.lit(0)).alias("depth"),
                 F.coalesce(F.sum("body").over(before), F.lit(0)).alias("inside"),
                 F.max(F.when(F.col("body") == 1, True)).over(whole).alias("has_body"))
    t = t.withColumn("inside", F.col("has_body").isNull() | (F.col("inside") > 0))
    top = F.when(F.col("is_outline") & F.col("inside") & (F.col("depth") == 0), _opml_value(tag, "title", "text"))
    t = t.withColumn("group", F.last(top, ignorenulls=True).over(so_far)).where("is_outline")
    t = t.withColumn("raw_url", _opml_value(tag, "xmlUrl", "url", "href")).where("raw_url <> ''")
    t = t.withColumn("filed", F.col("inside") & (F.col("depth") > 0))
    t = t.withColumn("any_filed", F.max("filed").over(whole)).where(F.col("filed") | ~F.col("any_filed"))
    named = clean_text(F.when(F.col("filed") & (F.col("group") != ""), F.col("group")).otherwise(F.lit("Uncategorized")))
    out = t.select("file", "raw_url", F.struct("file", "pos").alias("ord"), clean_text(_opml_value(tag, "title", "text")).alias("title"),
                   clean_text(_opml_value(tag, "description", "desc")).alias("description"),
                   F.lower(clean_text(_opml_value(tag, "type"))).alias("type"), named.alias("category"))
    out = U.normalize_url(out, "raw_url", "url")
    return out.select("file", "ord", "url", "title", "description", "type", "category")
