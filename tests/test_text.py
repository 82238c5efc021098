from pyspark.sql import functions as F

from feedcat.functions import text as T


def _one(spark, col_fn, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r["o"] for r in df.select("i", col_fn(F.col("v")).alias("o")).orderBy("i").collect()]


def test_clean_text_unicode_whitespace(spark):
    got = _one(spark, T.clean_text, ["  a  b\tc\n", "　x y ", None, "\x1cz\x1f"])
    assert got == ["a b c", "x y", "", "z"]


def test_slugs(spark):
    got = _one(spark, lambda c: T.slug(c, fallback="uncategorized", ampersand_to_and=True),
               ["Malware & Threat Research", "  ", "Vulnerabilities, CVEs & Exploits", "Ünïcode -- x"])
    assert got == ["malware-and-threat-research", "uncategorized", "vulnerabilities-cves-and-exploits", "n-code-x"]
    got = _one(spark, T.slug_short, ["Hello, World!", "", "x" * 49 + "-y", "a" * 60])
    assert got == ["hello-world", "feed", "x" * 49, "a" * 50]


def test_item_description(spark):
    df = spark.createDataFrame([("d" * 220, "C", "T"), ("d" * 221, "C", "T"), ("", "Threat Intel", "Blog"),
                                ("  a \n b ", "", "T"), ("", None, "T")], "d string, c string, t string")
    got = [r[0] for r in df.select(T.item_description("d", "c", "t")).collect()]
    assert got[0] == "d" * 220
    assert got[1] == "d" * 217 + "..."
    assert got[2] == "Updates from Blog covering threat intel."
    assert got[3] == "a b"
    assert got[4] == "Updates from T covering security."


def test_escapes(spark):
    got = _one(spark, T.html_escape, ["<a href=\"x\">'&'</a>"])
    assert got == ["&lt;a href=&quot;x&quot;&gt;&#39;&amp;&#39;&lt;/a&gt;"]
    got = _one(spark, T.xml_attr_escape, ["a&b<c>\"d'"])
    assert got == ["a&amp;b&lt;c&gt;&quot;d'"]
    got = _one(spark, T.md_escape, [" a|b\nc "])
    assert got == ["a\\|b c"]
