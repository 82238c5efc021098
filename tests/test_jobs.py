"""End-to-end jobs on small fixture files."""
import json

from pyspark.sql import functions as F

from feedcat.plans import jobs as J

YAML_A = """- url: http://feeds.example.org/a/
  title: Alpha
  type: RSS
  category: News & Blogs
- url: https://feeds.example.org/a
  description: later desc
- url: https://z.example.org/feed
  title: zeta | pipe
  category: News & Blogs
"""
YAML_B = """- url: https://b.example.org/feed
  title: Beta
  category: Wrong Name
"""
CATS = ("| Category | Purpose | YAML file |\n|---|---|---|\n"
        "| News & Blogs | x | `feeds/a.yaml` |\n| Vendors | y | `feeds/b.yaml` |\n")


def _catalog(tmp_path):
    d = tmp_path / "feeds"
    d.mkdir()
    (d / "a.yaml").write_text(YAML_A)
    (d / "b.yaml").write_text(YAML_B)
    (tmp_path / "categories.md").write_text(CATS)
    return str(d / "*.yaml")


def _text(path):
    return "".join(p.read_text() for p in sorted(path.glob("part-*")))


def test_build_validate_export_markdown(spark, tmp_path):
    glob = _catalog(tmp_path)
    rows = J.build_catalog_json(spark, glob, str(tmp_path / "json"))
    lines = [json.loads(x) for x in _text(tmp_path / "json").splitlines()]
    assert [x["url"] for x in lines] == ["https://feeds.example.org/a", "https://z.example.org/feed",
                                         "https://b.example.org/feed"]
    assert rows.count() == 3
    findings, summary = J.validate_catalog(spark, glob, str(tmp_path / "categories.md"))
    rules = sorted((r["rule"], r["item_idx"]) for r in findings.collect())
    assert rules == [("category_mismatch", 1), ("category_mismatch", 2), ("duplicate_url", 2)]
    s = summary.first()
    assert (s["errors"], s["items"], s["unique_urls"], s["passed"]) == (3, 4, 3, False)
    J.export_opml(spark, glob, str(tmp_path / "opml"))
    opml = _text(tmp_path / "opml")
    assert opml.index('text="News &amp; Blogs"') < opml.index('text="Wrong Name"')  # blank-category twin deduped away
    assert opml.count("<outline ") == 2 + 3
    J.markdown_page(spark, glob, str(tmp_path / "md"))
    md = _text(tmp_path / "md").splitlines()
    assert md[:3] == ["- [News & Blogs](#news-blogs) (2)", "- [Uncategorized](#uncategorized) (1)",
                      "- [Wrong Name](#wrong-name) (1)"]
    assert "| zeta \\| pipe |  |  | <https://z.example.org/feed> |" in md


def test_validation_goes_by_file(spark, tmp_path):
    glob = _catalog(tmp_path)
    cats = str(tmp_path / "categories.md")
    extra = {"c.yaml": "", "d.yaml": "- url: [unclosed", "e.yaml": "key: value", "f.yaml": "- url: https://f.example.org/\n  type: rss\n- text"}
    for name, text in extra.items():
        (tmp_path / "feeds" / name).write_text(text)
    findings, summary = J.validate_catalog(spark, glob, cats)
    by_file = sorted((r["file"], r["rule"], r["detail"]) for r in findings.where("file > 'b.yaml'").collect())
    assert by_file == [("c.yaml", "file_not_listed", ""), ("d.yaml", "file_unreadable", "corrupt"), ("e.yaml", "file_unreadable", "not_a_list"),
                       ("f.yaml", "file_not_listed", ""), ("f.yaml", "not_a_dict", "")]
    s = summary.first()
    assert (s["errors"], s["items"], s["passed"]) == (3 + 5, 6, False)
    files = {r["file"]: (r["state"], r["n_items"], r["bytes"]) for r in J.CF.read_yaml_files(spark, glob).collect()}
    assert files["c.yaml"] == ("ok", 0, 0) and files["f.yaml"] == ("ok", 2, len(extra["f.yaml"])) and files["d.yaml"][0] == "corrupt"
    # a listed file may be empty
    (tmp_path / "listed").mkdir()
    (tmp_path / "listed" / "a.yaml").write_text("# nothing yet\n")
    findings, summary = J.validate_catalog(spark, str(tmp_path / "listed" / "*.yaml"), cats)
    assert findings.count() == 0 and summary.first()["passed"]
    # no files at all
    findings, summary = J.validate_catalog(spark, str(tmp_path / "none" / "*.yaml"), cats)
    assert [(r["level"], r["rule"]) for r in findings.collect()] == [("error", "no_files")]
    assert tuple(summary.first()) == (1, 0, 0, 0, False)


def test_whole_documents(spark, tmp_path):
    glob = _catalog(tmp_path)
    J.build_catalog_json(spark, glob, str(tmp_path / "out"), generated_at="2024")
    doc = json.loads((tmp_path / "out" / "feeds.json").read_text())
    assert doc == json.loads((tmp_path / "out" / "feeds.min.json").read_text())
    assert (doc["generated_at"], doc["total"], [f["title"] for f in doc["feeds"]]) == ("2024", 3, ["Alpha", "zeta | pipe", "Beta"])
    J.export_opml(spark, glob, str(tmp_path / "feeds.opml"), title="T")
    assert J.CF.read_opml(spark, str(tmp_path / "feeds.opml")).count() == 3
    J.markdown_page(spark, glob, str(tmp_path / "page.md"), generated_at="2024", title="T")
    assert (tmp_path / "page.md").read_text().startswith("# T\n\n**Generated:** `2024` (UTC)\n\n\n---\n\n## Contents\n\n- [News & Blogs]")


def test_import_opml(spark, tmp_path):
    (tmp_path / "in.opml").write_text(
        '<opml><body><outline text="A &amp; B"><outline text="x" xmlUrl="https://x.example.org/f"/></outline>'
        '<outline text="A and B"><outline text="y" xmlUrl="https://y.example.org/f"/></outline></body></opml>')
    J.import_opml(spark, str(tmp_path / "in.opml"), str(tmp_path / "out"))
    assert sorted(p.name for p in (tmp_path / "out").iterdir() if not p.name.startswith(".")) == ["a-and-b-2.yaml", "a-and-b.yaml"]
    back = J.CF.read_yaml_catalog(spark, str(tmp_path / "out" / "*.yaml"))
    assert sorted((r["file"], r["category"], r["title"], r["type"]) for r in back.collect()) == [
        ("a-and-b-2.yaml", "A and B", "y", None), ("a-and-b.yaml", "A & B", "x", None)]


def test_promotion_touches_its_files_only(spark, tmp_path):
    _catalog(tmp_path)
    d = tmp_path / "feeds"
    (d / "c.yaml").write_text("# by hand\n- {url: https://c.example.org/f, title: C}\n")
    cand = tmp_path / "feeds" / "_candidates"
    cand.mkdir()
    (cand / "a.yaml").write_text("- url: http://new.example.org/x/\n  title: 'it''s: \\new \"q\"'\n  category: aaa\n- url: http://c.example.org/f/\n"
                                 "- url: https://www.b.example.org/other\n  category: News & Blogs\n  title: beta\n")
    (cand / "n.yaml").write_text("- url: https://new.example.org/x\n- url: https://n.example.org/\n  title: é ✓\n")
    before = {n: (d / n).read_bytes() for n in ("b.yaml", "c.yaml")}
    added, names = J.promote(spark, str(d), str(cand / "*.yaml"))
    assert sorted(names) == ["a.yaml", "n.yaml"]
    assert sorted((r["file"], r["url"]) for r in added.collect()) == [
        ("a.yaml", "https://new.example.org/x"), ("a.yaml", "https://www.b.example.org/other"), ("n.yaml", "https://n.example.org")]
    assert {n: (d / n).read_bytes() for n in before} == before
    import yaml
    a = yaml.safe_load((d / "a.yaml").read_text())
    assert [list(x) for x in a] == [["url", "category", "title", "type", "description"]] * 5
    assert [(x["category"], x["title"]) for x in a] == [("aaa", 'it\'s: \\new "q"'), ("News & Blogs", "Alpha"), ("News & Blogs", "beta"),
                                                       ("News & Blogs", "zeta | pipe"), ("Uncategorized", "")]
    assert yaml.safe_load((d / "n.yaml").read_text())[0]["title"] == "é ✓"
    added, names = J.promote(spark, str(d), str(cand / "*.yaml"))  # nothing is new any more
    assert names == [] and added.isEmpty()


def test_check_health_job(spark, tmp_path):
    import datetime as dt
    t = dt.datetime(2024, 1, 1)
    fetch = spark.createDataFrame(
        [("https://a.org/f", "1", 1, t, 200, None, False, None, 3, "text/xml", "x", 5),
         ("https://b.org/f", "1", 1, t, None, "timeout", None, None, None, None, None, 5)],
        "url string, run_id string, attempt int, checked_at timestamp_ntz, http_status int, net_error string, "
        "bozo boolean, bozo_error string, entries int, content_type string, final_url string, latency_ms int")
    prev = spark.createDataFrame([("https://b.org/f", 2, t, None)],
                                 "url string, consecutive_failures int, down_since timestamp_ntz, last_seen_active timestamp_ntz")
    out = {r["url"]: r for r in J.check_health(spark, fetch, prev, "2024-01-02 00:00:00", str(tmp_path / "st"), "1").collect()}
    assert out["https://b.org/f"]["consecutive_failures"] == 3 and out["https://a.org/f"]["status"] == "active"
    tot = spark.read.json(str(tmp_path / "st" / "run=1" / "totals")).first()
    assert (tot["active"], tot["down"]) == (1, 1)
    back = {r["url"]: r for r in J.CF.read_status(spark, str(tmp_path / "st" / "run=1" / "status.json")).collect()}
    assert back["https://b.org/f"]["down_since"] == "2024-01-01T00:00:00.000000Z" and len(back) == 2


def test_discover_job(spark):
    home = ('<html><head><link rel="alternate" type="application/rss+xml" href="/news.xml"></head>'
            '<body><a href="https://other.example.org/">o</a></body></html>')
    seed = '<a href="https://site.example.org/about">s</a><a href="https://github.com/x">g</a>'
    pages = spark.createDataFrame([(1, "https://seed.example.org/list", seed), (2, "https://site.example.org/", home)],
                                  "page_id bigint, url string, html string")
    items = "".join(f"<item><title>t{i}</title><description>malware exploit cve campaign</description>"
                    f"<pubDate>Mon, 01 Jan 2024 10:00:00 GMT</pubDate></item>" for i in range(12))
    body = f'<?xml version="1.0"?><rss version="2.0"><channel><title>Site News</title>{items}</channel></rss>'
    fetches = spark.createDataFrame([("https://site.example.org/news.xml", 200, body),
                                     ("https://site.example.org/feed", 404, "")],
                                    "feed_url string, http_status int, body string") \
        .withColumn("body_bytes", F.octet_length("body"))
    known = spark.createDataFrame([("https://known.example.org/feed",)], "url string")
    out = J.discover(spark, pages, fetches, known, None, "2024-01-10T00:00:00")
    sites = {r["site_url"] for r in out["sites"].collect()}
    assert sites == {"https://site.example.org", "https://other.example.org"}
    c = out["candidates"].collect()
    assert [(r["feed_url"], r["discovered_via"], r["feed_type"]) for r in c] == \
        [("https://site.example.org/news.xml", "rel=alternate", "rss")]
    # malware, exploit, cve are strong (3 each), campaign 1; newest entry 8 days old +3; 12 entries +2
    assert c[0]["score"] == 15 and c[0]["matched_keywords"] == ["campaign", "cve", "exploit", "malware"]
    assert c[0]["suggested_category"] == "Vulnerabilities, CVEs"  # first matching rule wins
    top = out["top"].collect()
    assert [r["url"] for r in top] == ["https://site.example.org/news.xml"]
