"""Main text of pages."""

from __future__ import annotations

import html as entities
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from tidegauge.llm import styletree
from tidegauge.llm.styletree import Outline

FOLDER = "/root/testdata/sf0.001"


def test_test_pages_give_their_article(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    got = {r.page_id: r.text for r in styletree.extract(pages).collect()}
    for page, source in duckdb.connect().execute(f"SELECT page_id, html FROM '{FOLDER}/pages.parquet'").fetchall():
        article = re.search(r"<article>(.*?)</article>", source, re.S)[1]
        blocks = re.split(r"</?(?:p|h1)[^>]*>", article.replace("<br>", " "))
        texts = [" ".join(entities.unescape(re.sub("<[^>]*>", "", b)).split()) for b in blocks]
        assert got[page] == "\n".join(t for t in texts if t)


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ("<article><h1>A &amp; B</h1><p>one\n two<br>three<p>x &lt;i&gt; <b>y</b>z</article><footer>f</footer>", "A & B\none two three\nx <i> yz"),
        ("<header><h1>Site</h1></header><main><h1>T</h1><p>t</p></main>", "T\nt"),
        ("<article><p>t</p><section class='comments'><p>c</p></section><div id=sidebar>s</div></article>", "t"),
        ("<div role=navigation>m</div><div class='cookie-notice'>c</div><form>q</form><div>t</div>", "t"),
        ("<article><p>a<script>if (1<2) x='</p>'</script>b<style>p{}</style></p><!-- <p>no</p> --><p hidden>h</p></article>", "ab"),
        ("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table>e</article>", "a\nb\nc\nd\ne"),
        ("<p title='a>b' class=\"x\">t</p>", "t"),
        ("plain &copy; text", "plain © text"),
        ("<article><p>cut off &am", "cut off &am"),
        ("<article><p>cut <a href=", "cut"),
        ("<script>never ends", ""),
        ("<p>a < b and c</p>", "a < b and c"),
        ("", ""),
    ],
)
def test_outline(source, text):
    assert Outline(source).text() == text


def test_deep_and_long_pages():
    assert Outline("<div>" * 30_000 + "deep").text() == "deep"
    assert len(Outline("<article>" + "<p>word</p>" * 50_000).text()) == 50_000 * 5 - 1


def site(host: str, n: int):
    """Pages without telling tags: one block is the same on each, one differs."""
    return [
        (i, f"http://{host}/{i}", f"<div class=a1><p>Home</p><p>Contact us today</p></div><div class=b><p>Story {i} on {host}</p><p>Text {i * i} {host}</p></div>")
        for i in range(n)
    ]


def test_blocks_that_recur_on_a_host_are_cut(spark):
    pages = spark.createDataFrame([*site("x.org", 40), *site("y.org", 40)], "page_id long, url string, html string")
    got = styletree.extract(pages).collect()
    assert {len(r.text.split("\n")) for r in got} == {2} and all(r.text.startswith("Story") for r in got)


def test_awkward_pages(spark):
    rows = [(1, None, None), (2, "http://a/", ""), (None, "http://A/x", "<p>t</p>"), (2, "http://a/", ""), (3, "no url", "<nav>m</nav>"), (4, "//h/x", "<p>" + "w " * 100_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"host": F.lit(1), "cut": F.lit(2), "text": F.lit("z")})
    got = sorted((str(r.page_id), r.url, len(r.text), r.n_chars) for r in styletree.extract(pages).collect())
    assert got == sorted([("1", None, 0, 0), ("2", "http://a/", 0, 0), ("None", "http://A/x", 1, 1), ("2", "http://a/", 0, 0), ("3", "no url", 0, 0), ("4", "//h/x", 199_999, 199_999)], key=str) or set(map(str, got)) == set(
        map(str, [("1", None, 0, 0), ("2", "http://a/", 0, 0), ("None", "http://A/x", 1, 1), ("3", "no url", 0, 0), ("4", "//h/x", 199_999, 199_999)])
    )
    assert styletree.extract(pages.limit(0)).collect() == []


def test_hosts(spark):
    urls = {"http://User@Ex.org:80/a": "ex.org", "//b.c?q": "b.c", "https://d.e#x": "d.e", "nothing": "", None: ""}
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert {r.u: r.h for r in df.select("u", styletree.host_of(F.col("u")).alias("h")).collect()} == urls
