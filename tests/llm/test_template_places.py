"""Article text that recurs stays; templates go by their place; counts against a plain count of neighbours."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest

from strata.llm import templates

SCHEMA = "page_id long, url string, html string"


def texts_of(spark, sources: list[str], url="http://h.example/{}", **options) -> list[str]:
    rows = [(i, url and url.format(i), s) for i, s in enumerate(sources)]
    got = {r["page_id"]: r["text"] for r in templates.extract(spark.createDataFrame(rows, SCHEMA), **options).collect()}
    return [got[i] for i in range(len(sources))]


BODY = "".join(f"<p>Sentence {i} of an article that is printed on several pages of its host.</p>" for i in range(9))


@pytest.mark.parametrize(
    "page",
    [
        "<nav>n{0}</nav><article><h1>Title</h1><div class='body'>" + BODY + "</div></article><footer>f{0}</footer>",
        "<article><p>own {0}</p><table><tr><td>1<td>2</table><ul><li>a<li>b</ul><div>box</div></article>",
        "<div>menu</div><div>" + BODY + "</div><div>foot {0}</div>",
    ],
)
def test_an_article_on_several_pages_keeps_its_text(spark, page):
    sources = [page.format(i) for i in range(7)]
    got = texts_of(spark, sources)
    for i, text in enumerate(got):
        for part in ("Sentence 8 of an article", "Title") if "Sentence" in page and "Title" in page else ("Sentence 8 of",) if "Sentence" in page else (f"own {i}", "1 2", "a\n\nb", "box"):
            assert part in text
    assert all("menu" not in text for text in got)


def test_headings_between_different_texts_stay(spark):
    page = "<div>menu</div><h2>Introduction</h2><p>intro {0}</p><div>Note</div><p>more {0}</p><h2>Methods</h2><p>how {0}</p><div>bottom</div>"
    assert texts_of(spark, [page.format(i) for i in range(9)]) == [
        f"Introduction\n\nintro {i}\n\nNote\n\nmore {i}\n\nMethods\n\nhow {i}" for i in range(9)
    ]


@pytest.mark.parametrize("url", [None, "no url {}", "/path/{}"])
def test_pages_without_a_host_share_no_template(spark, url):
    sources = [f"<p>text {i}</p><p>Thank you for reading.</p>" for i in range(7)]
    assert texts_of(spark, sources, url) == [f"text {i}\n\nThank you for reading." for i in range(7)]


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ("<article>a<p class='notice-of-death'>b</p><p class='share-price'>c</p><div id='toolbar'>d</div></article>", "a\n\nb\n\nc\n\nd"),
        ("<article>a<p class='share-buttons'>b</p><div class='x related-posts'>c</div><div class='ad'>d</div><div id='comments-2'>e</div></article>", "a"),
        ("<article>a<p hidden>b</p><p style='color:red; display : none'>c</p><p class='hidden-gems'>d</p><p title='x hidden y'>e</p></article>", "a\n\nd\n\ne"),
        ("<p>a</p><div hidden='until-found'>b</div><p style='visibility:hidden'>c</p><p data-class='ad'>d</p>", "a\n\nd"),
    ],
)
def test_names_inside_an_article(source, text):
    assert templates.Page(source).text(set()) == text


@pytest.mark.parametrize(("seed", "broadcast_rows"), [(1, 200_000), (2, 0)])
def test_templates_equal_a_plain_count_of_neighbours(spark, seed, broadcast_rows):
    """Flat pages: a block goes if it follows, or precedes, the same block on five different pages of the host."""
    rng = random.Random(seed)
    pool = [("div", f"block {i}") for i in range(9)] + [("h2", "Head"), ("p", "said")]
    pages = [[rng.choice(pool) if rng.random() < 0.6 else ("p", f"own {rng.random()}") for _ in range(rng.randint(0, 7))] for _ in range(60)]
    hosts = [rng.choice(["a.example", "b.example"]) for _ in pages]
    seen: dict = defaultdict(set)

    def pairs(page):
        framed = [("first",), *page, ("last",)]
        return [((framed[i], framed[i + 1], "<"), (framed[i + 1], framed[i + 2], ">")) for i in range(len(page))]

    for host, page in zip(hosts, pages, strict=True):
        for both in pairs(page):
            for pair in both:
                seen[host, pair].add(tuple(page))
    expected = [
        "\n\n".join(t for (tag, t), both in zip(page, pairs(page), strict=True) if tag == "h2" or all(len(seen[host, p]) < 5 for p in both))
        for host, page in zip(hosts, pages, strict=True)
    ]
    rows = [(i, f"http://{h}/{i}", "<body>" + "".join(f"<{tag}>{t}</{tag}>" for tag, t in page)) for i, (h, page) in enumerate(zip(hosts, pages, strict=True))]
    got = {r["page_id"]: r["text"] for r in templates.extract(spark.createDataFrame(rows, SCHEMA), broadcast_rows=broadcast_rows).collect()}
    assert [got[i] for i in range(len(pages))] == expected
    assert any(e != "\n\n".join(t for _, t in page) for e, page in zip(expected, pages, strict=True))
