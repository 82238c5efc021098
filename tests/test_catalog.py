from pyspark.sql import functions as F

from feedcat.operators import catalog as C

SCHEMA = "file string, item_idx int, ord bigint, url string, title string, description string, type string, category string"


def _items(spark):
    data = [
        ("a.yaml", 1, 1, "http://Feeds.Example.org/rss/", "", "first", "RSS", "Cat A"),
        ("a.yaml", 2, 2, "https://feeds.example.org/rss?utm_source=x", "Title later", "", "", ""),
        ("a.yaml", 3, 3, "https://feeds.example.org/rss", "Other", "d3", "atom", "Cat B"),
        ("b.yaml", 1, 4, "https://blog.example.net/feed?b=2&a=1", " Blog  one ", "", "json", "Cat B"),
        ("b.yaml", 2, 5, "https://blog.example.net/feed/?a=1&b=2&ref=tw", "", "desc", "", "Cat C"),
    ]
    return spark.createDataFrame(data, SCHEMA)


def test_catalog_dedup_fill_and_upgrade(spark):
    out = {r["key"]: r for r in C.catalog_dedup(C.clean_items(_items(spark))).collect()}
    a = out["feeds.example.org/rss"]
    assert a["url"] == "https://feeds.example.org/rss?utm_source=x"  # first https later item
    assert (a["title"], a["description"], a["type"], a["category"]) == ("Title later", "first", "rss", "Cat A")
    assert a["n_items"] == 3
    b = out["blog.example.net/feed?a=1&b=2"]
    assert b["url"] == "https://blog.example.net/feed?b=2&a=1"
    assert (b["title"], b["description"], b["type"]) == ("Blog one", "desc", "json")


def test_dedup_invariant_under_repartition(spark):
    base = C.catalog_dedup(C.clean_items(_items(spark)))
    shuffled = C.catalog_dedup(C.clean_items(_items(spark).repartition(5).orderBy(F.rand(7))))
    assert sorted(map(tuple, base.collect())) == sorted(map(tuple, shuffled.collect()))
    keys = [r["key"] for r in base.collect()]
    assert len(keys) == len(set(keys))


def test_export_import_worklist(spark):
    items = C.clean_items(_items(spark), url_policy="export", blank_category="Uncategorized")
    exp = {r["url"]: r for r in C.export_dedup(items).collect()}
    assert "https://feeds.example.org/rss" in exp and exp["https://feeds.example.org/rss"]["title"] == ""
    assert exp["https://feeds.example.org/rss?utm_source=x"]["category"] == "Uncategorized"
    wl = C.check_worklist(_items(spark), max_checks=2).collect()
    assert [r["ord"] for r in wl] == [1, 2]


def test_strict_missing_url_raises(spark):
    import pytest
    bad = spark.createDataFrame([("x.yaml", 1, 1, "  ", "t", "", "", "c")], SCHEMA)
    with pytest.raises(Exception, match="Missing url in x.yaml #1"):
        C.clean_items(bad).collect()


def test_merge_and_promote(spark):
    items = C.clean_items(_items(spark))
    existing = items.where("file = 'a.yaml'").drop("file", "item_idx")
    new = items.where("file = 'b.yaml'").drop("file", "item_idx")
    merged = C.merge_by_url(existing, new)
    assert merged.where("added").count() == 2
    prom = C.promote_candidates(items.where("file = 'a.yaml'"), items.where("file = 'b.yaml'"))
    assert prom.where("promoted").count() == 2  # export keys keep the query verbatim, so both are new


def test_import_dedup_fill_and_slug_collisions(spark):
    from feedcat.operators import render as W
    items = spark.createDataFrame([
        ("o.opml", 1, "https://a.org/f", "", "", "", "News & Views"),
        ("o.opml", 2, "https://a.org/f", "Title", "desc", "rss", "Other"),
        ("o.opml", 3, "https://b.org/f", "B", "", "", "News and Views")],
        "file string, ord bigint, url string, title string, description string, type string, category string")
    out = {r["url"]: r for r in C.import_dedup(items).collect()}
    a = out["https://a.org/f"]
    assert (a["group_category"], a["title"], a["description"], a["type"], a["category"]) == \
        ("News & Views", "Title", "desc", "rss", "News & Views")
    files = {r["category"]: r["file"] for r in W.category_files(items.select("category")).collect()}
    assert files == {"News & Views": "news-and-views.yaml", "News and Views": "news-and-views-2.yaml",
                     "Other": "other.yaml"}
