import json

import pytest

from feedcat.operators import catalog as C
from feedcat.operators import render as W
from feedcat.sources import catalog_files as CF
from feedcat.sources import lists as LS
from feedcat.sources import sinks as SK

YAML_A = """- url: http://feeds.example.org/a/
  title: Alpha
  type: RSS
  category: Cat A
- url: https://feeds.example.org/a
  title:
  description: later desc
- just a string
"""
YAML_B = """- url: https://b.example.org/feed
  title: Beta & Co
  category: Cat B
"""


def test_yaml_catalog(spark, tmp_path):
    d = tmp_path / "feeds"
    d.mkdir()
    (d / "b.yaml").write_text(YAML_B)
    (d / "a.yaml").write_text(YAML_A)
    (d / "empty.yaml").write_text("")
    items = CF.read_yaml_catalog(spark, str(d / "*.yaml"))
    got = sorted((r["file"], r["item_idx"], r["ord"], r["url"], r["title"], r["is_dict"]) for r in items.collect())
    assert got[0][:2] == ("a.yaml", 1) and got[0][2] < got[3][2]
    assert got[1][4] == "" and got[2][5] is False
    assert got[3][0] == "b.yaml"
    dedup = C.catalog_dedup(C.clean_items(items.where("is_dict")))
    row = dedup.where("key = 'feeds.example.org/a'").first()
    assert row["url"] == "https://feeds.example.org/a" and row["description"] == "later desc"


def test_yaml_non_list(spark, tmp_path):
    d = tmp_path / "bad"
    d.mkdir()
    (d / "x.yaml").write_text("key: value\n")
    assert CF.read_yaml_catalog(spark, str(d / "*.yaml"), strict=False).count() == 0
    with pytest.raises(Exception):
        CF.read_yaml_catalog(spark, str(d / "*.yaml"), strict=True).collect()


def test_catalog_json_status_seen(spark, tmp_path):
    doc = {"generated_at": "2024", "total": 2, "feeds": [
        {"url": "https://a.org/f", "title": "A", "description": "", "type": "rss", "category": "C"},
        {"url": "https://b.org/f", "title": "B", "description": "", "type": "", "category": "C"}]}
    (tmp_path / "feeds.json").write_text(json.dumps(doc, indent=2))
    rows = CF.read_catalog_json(spark, str(tmp_path / "feeds.json")).orderBy("ord").collect()
    assert [r["url"] for r in rows] == ["https://a.org/f", "https://b.org/f"]
    status = {"checked_at": "2024-01-01T00:00:00+00:00", "total": 2, "results": {
        "https://a.org/f": {"status": "active", "http_status": 200, "consecutive_failures": 0},
        "https://b.org/f": {"status": "rate_limited", "http_status": 429, "error": "http_429"}}}
    (tmp_path / "status.json").write_text(json.dumps(status))
    st = {r["url"]: r for r in CF.read_status(spark, str(tmp_path / "status.json")).collect()}
    assert st["https://b.org/f"]["error"] == "http_429" and st["https://a.org/f"]["status"] == "active"
    (tmp_path / "corrupt.json").write_text("{not json")
    assert CF.read_status(spark, str(tmp_path / "corrupt.json")).count() == 0
    assert CF.read_status(spark, str(tmp_path / "missing.json")).count() == 0
    seen = {"abc": {"feed_url": "https://a.org/f", "site_url": "https://a.org", "title": "A",
                    "last_seen_ts": 1700000000, "score": 9, "feed_type": "rss"}}
    (tmp_path / "seen.json").write_text(json.dumps(seen))
    s = CF.read_seen(spark, str(tmp_path / "seen.json")).first()
    assert (s["url_hash"], s["score"], s["last_seen_ts"]) == ("abc", 9, 1700000000)


OPML = """<?xml version="1.0"?><opml version="2.0"><head><title>t</title></head><body>
<outline text="News &amp; Blogs" title="News &amp; Blogs">
  <outline text="A" xmlUrl="https://a.example.org/feed" type="RSS" description=" d  a "/>
  <outline text="Group"><outline title="B" url="https://b.example.org/rss" desc="db"/>
    <outline text="Deep"><outline text="C" href="https://c.example.org/atom"/></outline></outline>
</outline>
<outline text="Empty"/>
<outline title="Other"><outline text="A again" xmlUrl="https://a.example.org/feed"/></outline>
</body></opml>"""
FLAT = """<opml version="1.0"><body><outline text="X" xmlUrl="https://x.example.org/f"/></body></opml>"""


def test_opml(spark, tmp_path):
    (tmp_path / "a.opml").write_text(OPML)
    items = CF.read_opml(spark, str(tmp_path / "a.opml"))
    got = [(r["category"], r["url"], r["title"], r["description"], r["type"]) for r in items.orderBy("ord").collect()]
    assert got == [("News & Blogs", "https://a.example.org/feed", "A", "d a", "rss"),
                   ("News & Blogs", "https://b.example.org/rss", "B", "db", ""),
                   ("News & Blogs", "https://c.example.org/atom", "C", "", ""),
                   ("Other", "https://a.example.org/feed", "A again", "", "")]
    imp = C.import_dedup(items.select("file", "ord", "url", "title", "description", "type", "category"))
    assert imp.count() == 3
    (tmp_path / "flat.opml").write_text(FLAT)
    flat = CF.read_opml(spark, str(tmp_path / "flat.opml")).collect()
    assert [(r["category"], r["url"]) for r in flat] == [("Uncategorized", "https://x.example.org/f")]


def test_lists_and_categories(spark, tmp_path):
    (tmp_path / "blocked.txt").write_text("# comment\n\nBad.org\nbad.org\n  spam.example  \n")
    bl = sorted(r["domain"] for r in LS.blocklist(spark, str(tmp_path / "blocked.txt")).collect())
    assert bl == ["bad.org", "spam.example"]
    assert LS.blocklist(spark, str(tmp_path / "nope.txt")).count() == 0
    (tmp_path / "seeds.txt").write_text("# seeds\nexample.org/list\nhttps://EXAMPLE.org/list\nhttps://b.org\n")
    seeds = LS.seed_urls(LS.read_lines(spark, str(tmp_path / "seeds.txt")), max_seeds=1).collect()
    assert [r["url"] for r in seeds] == ["https://example.org/list"]
    md = ("| Category | Purpose | YAML file |\n|---|---|---|\n"
          "| General Security & Blogs | broad | `feeds/general-security-and-blogs.yaml` |\n")
    (tmp_path / "categories.md").write_text(md)
    cats = LS.canonical_categories(LS.read_lines(spark, str(tmp_path / "categories.md"))).collect()
    assert [(r["file"], r["category"]) for r in cats] == [("general-security-and-blogs.yaml", "General Security & Blogs")]


def test_sinks_roundtrip(spark, tmp_path):
    items = spark.createDataFrame([("f.yaml", 1, "https://a.org/x", "Zed", "", "rss", "C"),
                                   ("f.yaml", 2, "https://a.org/y", "alpha", "d", "", "C")],
                                  "file string, ord bigint, url string, title string, description string, type string, category string")
    out = str(tmp_path / "yaml")
    SK.write_yaml_files(items, out, ["url", "category", "title", "type", "description"], ["title"])
    back = CF.read_yaml_catalog(spark, out + "/*.yaml")
    assert [(r["file"], r["title"]) for r in back.orderBy("ord").collect()] == [("f.yaml", "Zed"), ("f.yaml", "alpha")]
    lines = str(tmp_path / "opml")
    SK.write_lines(W.opml_lines(items), lines, ["k_cat", "category", "part", "k_title", "ord"])
    text = "".join(p.read_text() for p in sorted((tmp_path / "opml").glob("part-*")))
    assert text.index("alpha") < text.index("Zed") and text.strip().endswith("</outline>")


def test_observe_and_timestamps(spark, tmp_path):
    from pyspark.sql import functions as F

    from feedcat.functions.text import display_timestamp, iso_utc
    from feedcat.operators.summary import observe_counts
    from feedcat.sources.sinks import write_status_snapshot
    df = spark.createDataFrame([("https://a.org", "active"), ("https://b.org", "down"), ("https://c.org", "rate_limited")],
                               "url string, status string")
    observed, obs = observe_counts(df, "check_run", active=F.col("status") == "active")
    observed.write.format("noop").mode("overwrite").save()
    assert obs.get == {"rows": 3, "active": 1}
    out = write_status_snapshot(df, str(tmp_path / "status"), "1")
    tot = spark.read.json(out + "/totals").first()
    assert (tot["total"], tot["active"], tot["down"], tot["rate_limited"]) == (3, 1, 1, 1)
    t = spark.createDataFrame([("2024-01-02T03:04:05",), ("garbage",), (None,)], "s string")
    got = [r[0] for r in t.select(display_timestamp("s")).collect()]
    assert got == ["Jan 2, 2024, 03:04", "unknown", "unknown"]
    iso = spark.createDataFrame([(1,)], "x int").select(iso_utc(F.lit("2024-01-02 03:04:05").cast("timestamp_ntz"))).first()[0]
    assert iso == "2024-01-02T03:04:05.000000Z"
