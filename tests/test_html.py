"""Character references and nested tables."""
import html
import random

from pyspark.sql import functions as F

from regiolake.sources import html as H

from conftest import rows


def decoded(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r["u"] for r in df.select("i", H.unescape(F.col("t")).alias("u")).orderBy("i").collect()]


def test_references_as_html_reads_them(spark):
    texts = ["&#1114112;", "&#55296;", "&#0;", "&#128;", "&aacute", "&aacute;", "&notit; &notin; &not", "&amp;lt;", "a&b", "&", "&&amp", "&nosuch;",
             "&#xD800;x", "&#x41", "&#65 &#65;&#0065", "&#99999999999999999999;", "&#x00000000000041;", "&#;", "&#x;", "&#11;&#1;|", "&#129;",
             "&#xFFFE;&#x1FFFF;!", "&CounterClockwiseContourIntegral;", "&frac12x", "&AMP;&gtx", "&lt;b&gt", "&#13;", "&ThickSpace;|",
             "&quot;é&eacute;&#233", "&aMp;", "&Aacutes;", "&#xFDD0;|", "&#127;|", "&#xG;", "", "plain"]
    assert decoded(spark, texts) == [html.unescape(t) for t in texts]


def test_random_references(spark):
    rnd = random.Random(1)
    pool = [*random.Random(2).sample(sorted(H.html5), 60), "#", "#x", "&", ";", "1", "80", "ff", " ", "é", "amp", "not", "gt", "a"]
    texts = ["".join(("&" if rnd.random() < 0.5 else "") + rnd.choice(pool) for _ in range(rnd.randrange(1, 7))) for _ in range(400)]
    assert decoded(spark, texts) == [html.unescape(t) for t in texts]


def cells(spark, *pages):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "id int, html string")
    return rows(H.nested_table_cells(df, "id"))


def test_nested_tables(spark):
    page = ("<table><tr><td>a</td><td>before<table class='x'><tr><td>in1</td></tr><tr><th>i<b>n</b>2</th></tr></table> after</td></tr>"
            "<tr><td>b &amp; c</td><td>2</td></tr></table><p>out</p><table><tr><td> second\n table </td></tr></table>")
    assert cells(spark, page) == sorted([(0, 0, 0, 0, "a"), (0, 0, 0, 1, "before after"), (0, 1, 0, 0, "in1"), (0, 1, 1, 0, "in2"),
                                         (0, 0, 1, 0, "b & c"), (0, 0, 1, 1, "2"), (0, 2, 0, 0, "second table")])


def test_broken_and_empty_pages(spark):
    assert cells(spark, None, "", "no tags", "<p>1 < 2</p>") == []
    stray = "</table></table><table><tr><td>x<td>y<tr><td>z</table></table><table><tr><td>1 < 2</td>tail</tr></table>"
    assert cells(spark, stray) == [(0, 0, 0, 0, "x"), (0, 0, 0, 1, "y"), (0, 0, 1, 0, "z"), (0, 1, 0, 0, "1 < 2")]
    hidden = "<table><tr><td>a<!-- <td>no</td> --><script>var t='</td>';</script><STYLE>td{}</STYLE></td></tr></table>"
    assert cells(spark, hidden) == [(0, 0, 0, 0, "a")]
    deep = "<table><tr><td>" * 30 + "core" + "</td></tr></table>" * 30
    got = cells(spark, deep)
    assert len(got) == 30 and (0, 29, 0, 0, "core") in got and (0, 0, 0, 0, "") in got


def test_pages_with_one_id_stay_apart(spark):
    df = spark.createDataFrame([(1, "<table><tr><td>a</td></tr></table>")] * 2, "id int, html string")
    assert rows(H.nested_table_cells(df, "id")) == [(1, 0, 0, 0, "a")] * 2
