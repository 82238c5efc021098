"""Whole documents: exact bytes, read back with the readers, and swapped at once."""
import json

import pytest

from feedcat.operators import catalog as C
from feedcat.operators import health as H
from feedcat.sources import catalog_files as CF
from feedcat.sources import documents as D

ITEMS = "file string, item_idx int, ord bigint, url string, title string, description string, type string, category string"


def items(spark, n=40):
    rows = [("a.yaml", i, i, f"https://a.example.org/{i:03d}", ["Zed", "alpha", 'q"u\\o\tte', "é ✓ <&>", "l s"][i % 5] + str(i), None if i % 7 == 0 else f"d {i}",
             ["rss", "", "atom"][i % 3], ["News & Blogs", "vendors", "Cat|B"][i % 3]) for i in range(n)]
    return spark.createDataFrame(rows, ITEMS).repartition(3)


def ordered(df):
    got = [{k: r[k] or "" for k in D.ITEM_FIELDS} for r in df.collect()]
    return sorted(got, key=lambda r: (r["category"].lower(), r["title"].lower(), r["url"].lower()))


@pytest.mark.parametrize("n", [0, 1, 40])
def test_catalog_json(spark, tmp_path, n):
    df = items(spark, n)
    want = {"generated_at": "2024-01-01T00:00:00+00:00", "total": n, "feeds": ordered(df)}
    D.write_catalog_json(df, str(tmp_path / "feeds.json"), "2024-01-01T00:00:00+00:00")
    D.write_catalog_json(df, str(tmp_path / "feeds.min.json"), "2024-01-01T00:00:00+00:00", pretty=False)
    assert (tmp_path / "feeds.json").read_text() == json.dumps(want, ensure_ascii=False, indent=2) + "\n"
    assert (tmp_path / "feeds.min.json").read_text() == json.dumps(want, ensure_ascii=False, separators=(",", ":")) + "\n"
    for name in ("feeds.json", "feeds.min.json"):
        back = CF.read_catalog_json(spark, str(tmp_path / name)).orderBy("item_idx").collect()
        assert [{k: r[k] for k in D.ITEM_FIELDS} for r in back] == want["feeds"]
    assert sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["feeds.json", "feeds.min.json"]


def test_status_json(spark, tmp_path):
    state = ("url string, status string, http_status int, error string, bozo boolean, entries int, final_url string, content_type string, "
             "latency_ms int, retried boolean, consecutive_failures int, down_since string, last_seen_active string")
    rows = [(f"https://s.example.org/{i}?a=\"b", ["active", "down", "rate_limited"][i % 3], 200 + i, None if i % 2 else "http_x", i % 2 == 0, i, None,
             "text/xml", 5, True if i % 4 == 0 else None, i, None, "2024-01-01T00:00:00Z") for i in range(12)]
    df = spark.createDataFrame(rows, state)
    D.write_status_json(df.repartition(4), str(tmp_path / "status.json"), "2024-02-01")
    names = [c.split()[0] for c in state.split(", ")][1:]
    results = {r[0]: {k: v for k, v in zip(names, r[1:]) if k != "retried" or v} for r in sorted(rows)}
    want = {"checked_at": "2024-02-01", "total": 12, "active": 4, "down": 4, "rate_limited": 4, "results": results}
    assert (tmp_path / "status.json").read_text() == json.dumps(want, ensure_ascii=False, indent=2) + "\n"
    back = CF.read_status(spark, str(tmp_path / "status.json"))
    assert sorted(map(tuple, back.select(*df.columns).collect()), key=str) == sorted(rows, key=str)
    D.write_status_json(df.limit(0), str(tmp_path / "status.json"), "2024-02-02")
    assert json.loads((tmp_path / "status.json").read_text())["results"] == {}
    assert H.check_totals(CF.read_status(spark, str(tmp_path / "status.json"))).first()["total"] == 0


def test_opml_document(spark, tmp_path):
    df = items(spark)
    D.write_opml(df, str(tmp_path / "feeds.opml"), 'All "feeds" <&>')
    text = (tmp_path / "feeds.opml").read_text()
    assert text.startswith('<?xml version="1.0" encoding="UTF-8"?>\n<opml version="2.0">\n  <head>\n    <title>All &quot;feeds&quot; &lt;&amp;&gt;</title>\n'
                           '  </head>\n  <body>\n    <outline text="Cat|B" title="Cat|B">\n      <outline ')
    assert text.endswith("    </outline>\n  </body>\n</opml>\n")
    import xml.etree.ElementTree as ET
    tree = [(g.get("title"), o.get("xmlUrl")) for g in ET.fromstring(text.encode()).find("body") for o in g]
    back = CF.read_opml(spark, str(tmp_path / "feeds.opml"))
    assert [(r["category"], r["url"]) for r in back.orderBy("ord").collect()] == tree
    plain = {(r["url"], r["title"], r["description"] or "", r["type"] or "rss", r["category"])
             for r in C.clean_items(df, url_policy="export").collect()}
    assert {(r["url"], r["title"], r["description"], r["type"], r["category"]) for r in back.collect()} == plain


def test_markdown_document(spark, tmp_path):
    rows = [("f", 1, 1, "https://b.example.org/", "b | x", "d", "rss", "Zoo"), ("f", 2, 2, "https://a.example.org/", "a", None, None, "zoo and"),
            ("f", 3, 3, "", "B", "", "atom", "Zoo"), ("f", 4, 4, "https://c.example.org/", None, "", "", None)]
    D.write_markdown(spark.createDataFrame(rows, ITEMS), str(tmp_path / "page.md"), "2024", "Feeds", ("First.", "Second."), "A note.")
    table = "| Feed | Description | Type | URL |\n|---|---|---:|---|\n"
    assert (tmp_path / "page.md").read_text() == (
        "# Feeds\n\nFirst.\n\nSecond.\n\n**Generated:** `2024` (UTC)\n\n> A note.\n\n\n---\n\n## Contents\n\n"
        "- [Uncategorized](#uncategorized) (1)\n- [Zoo](#zoo) (2)\n- [zoo and](#zoo-and) (1)\n\n---\n\n"
        f"## Uncategorized\n\nTotal: **1**\n\n{table}|  |  |  | <https://c.example.org/> |\n\n"
        f"## Zoo\n\nTotal: **2**\n\n{table}| B |  | ATOM |  |\n| b \\| x | d | RSS | <https://b.example.org/> |\n\n"
        f"## zoo and\n\nTotal: **1**\n\n{table}| a |  |  | <https://a.example.org/> |\n")


def test_a_failed_write_leaves_the_old_document(spark, tmp_path, monkeypatch):
    path = tmp_path / "feeds.json"
    D.write_catalog_json(items(spark, 3), str(path), "old")
    old = path.read_bytes()

    def fails(*a, **k):
        raise RuntimeError("lost")

    monkeypatch.setattr(D.Files, "move", fails)
    with pytest.raises(RuntimeError):
        D.write_catalog_json(items(spark, 5), str(path), "new")
    assert path.read_bytes() == old
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["feeds.json"]
    monkeypatch.undo()
    D.write_catalog_json(items(spark, 5), str(path), "new")
    assert json.loads(path.read_text())["total"] == 5


def test_opml_of_any_depth(spark, tmp_path):
    nest = "".join(f'<outline text="g{i}"><outline text="f{i}" xmlUrl="https://x.example.org/{i}"/>' for i in range(2, 13))
    text = ('<?xml version="1.0"?><opml><head><title>t</title></head><!-- <outline text="no" url="https://no.example.org"/> --><body>'
            f'<outline title="Top &amp; more" text="t">{nest}{"</outline>" * 11}<outline text="a > b"\n url=\'https://y.example.org/\' desc="x&#10;y"></outline></outline>'
            '<outline text="" title=""><outline href="https://z.example.org/" title="Z"/></outline><outline text="flat" xmlUrl="https://not.example.org/"/>'
            '</body></opml>')
    (tmp_path / "deep.opml").write_text(text)
    got = [(r["category"], r["title"], r["url"], r["description"]) for r in CF.read_opml(spark, str(tmp_path / "deep.opml")).orderBy("ord").collect()]
    assert got == [("Top & more", f"f{i}", f"https://x.example.org/{i}", "") for i in range(2, 13)] + [
        ("Top & more", "a > b", "https://y.example.org/", "x y"), ("Uncategorized", "Z", "https://z.example.org/", "")]
    (tmp_path / "bare.opml").write_text('<opml><outline text="c"><outline text="d"><outline text="e" url="https://e.example.org/"/></outline></outline></opml>')
    (tmp_path / "flat.opml").write_text('<opml><head/><body><outline text="x" url="https://x.example.org/f"/><outline text="y"/></body></opml>')
    (tmp_path / "empty.opml").write_text("")
    got = [(r["file"], r["category"], r["url"]) for r in CF.read_opml(spark, str(tmp_path / "[bfe]*.opml")).orderBy("ord").collect()]
    assert got == [("bare.opml", "c", "https://e.example.org/"), ("flat.opml", "Uncategorized", "https://x.example.org/f")]
    assert CF.read_opml(spark, str(tmp_path / "missing.opml")).collect() == []
