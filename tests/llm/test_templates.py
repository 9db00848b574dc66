"""Page extraction: parsing cases by hand, template removal on a small site, both ways of carrying templates."""

from __future__ import annotations

import pytest

from strata.llm import templates
from strata.llm.queries import QUERIES
from tests.conftest import SF_SMALL

SCHEMA = "page_id long, url string, html string"


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ("", ""),
        ("plain &amp; <b>simple</b>\n text", "plain & simple text"),
        ("<p>a<p>b <i>c</i>\n d<br>e", "a\n\nb c d e"),
        ("<ul><li>x<li>y</ul><table><tr><td>1<td>2<tr><td>3</table>", "x\n\ny\n\n1 2\n\n3"),
        ("a &lt b &amp;amp; <!-- x > y --> z<script>if(a<b)'</p>'</script> <3 5 <", "a < b &amp; z <3 5 <"),
        ('<p title="a>b">q</p>&#233;&nbsp;&#x41;', "q\n\né A"),
        ("<p>cut &am", "cut &am"),
        ("<p>open tag <a href='x", "open tag"),
        ("<p>never <!-- closed", "never"),
        ("<div>out</div><article><header><h1>T</h1></header><p>in</article><p>after", "T\n\nin"),
        ("<article>a<article class='comment'>no</article></article>", "a"),
        ("<main>m<nav>n</nav><form>f</form><aside>s</aside><div role='alert'>r</div><p id='cookie-bar'>c</p></main>", "m"),
        ("<header>h</header><p>t</p><footer>f</footer><div class='ad'>x</div><div class='shadow'>kept</div>", "t\n\nkept"),
        ("<p>x</article></div></p></b>y", "x\n\ny"),
        ("<div>" * 3000 + "deep", "deep"),
    ],
)
def test_text_of_a_page(source, text):
    assert templates.Page(source).text(set()) == text


def site(n: int) -> list[tuple]:
    pages = [
        (i, f"http://h.example/{i}", f"<body><div>Site <b>menu</b></div><div><p>text {i}</p><p>common line</p></div><div>bottom</div>")
        for i in range(n)
    ]
    copies = [(100 + i, f"http://c.example/{i}", "<body><div>same page</div>") for i in range(9)]
    articles = [(200 + i, f"http://a.example/{i}", f"<article><p>own {i}<p>said again<div>teaser</div></article>") for i in range(9)]
    odd = [(300, None, "<p>no url"), (301, "http://h.example/x", None), (302, "::", "<p>odd"), (None, "http://h.example/y", "<div>bottom</div>")]
    return [*pages, *copies, *articles, *odd]


@pytest.mark.parametrize("broadcast_rows", [200_000, 0])
def test_templates_of_a_host_go_and_copies_and_prose_stay(spark, broadcast_rows):
    df = spark.createDataFrame([(*r, "x") for r in [*site(8), site(8)[0]]], SCHEMA + ", subtree string")
    got = [tuple(r) for r in templates.extract(df, broadcast_rows=broadcast_rows).collect()]
    assert len(got) == df.count() and all(n == len(t) for *_, t, n in got)
    by = {page: t for page, _, t, _ in got}
    assert [by[i] for i in range(8)] == [f"text {i}" for i in range(8)]  # also the common line: outside an article
    assert {by[100 + i] for i in range(9)} == {"same page"}
    assert [by[200 + i] for i in range(9)] == [f"own {i}\n\nsaid again\n\nteaser" for i in range(9)]  # an article keeps what is not marked
    assert (by[300], by[301], by[302], by[None]) == ("no url", "", "odd", "")


def test_empty_table(spark):
    assert templates.extract(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query_keeps_exactly_the_article(spark):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
    got = QUERIES["op10_site_templates"](spark, SF_SMALL).collect()
    assert sorted(r["page_id"] for r in got) == sorted(pages)
    for r in got:
        source = pages[r["page_id"]]["html"] or ""
        article = source.partition("<article>")[2].partition("</article>")[0]
        assert r["text"] == templates.Page(article).text(set())
        assert not r["text"].startswith("©")
