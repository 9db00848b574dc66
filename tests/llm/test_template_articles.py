"""Templates are counted on pages with an article too; inside one, menus of links go by the number of articles."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest

from strata.llm import templates
from tests.llm.test_template_places import SCHEMA, texts_of

MENU = "<div><a href='/'>Home</a> | <a href='/n'>News</a> | <a href='/s'>Shop</a></div>"


@pytest.mark.parametrize("broadcast_rows", [200_000, 0])
def test_a_menu_inside_articles_goes(spark, broadcast_rows):
    sources = [f"<nav>n</nav><main><article>{MENU}<h1><a href='/{i}'>T {i}</a></h1><p>own {i}</p>{MENU}</article></main>" for i in range(5)]
    assert texts_of(spark, sources, broadcast_rows=broadcast_rows) == [f"T {i}\n\nown {i}" for i in range(5)]
    menu = "Home | News | Shop"
    assert texts_of(spark, sources[:4], broadcast_rows=broadcast_rows) == [f"{menu}\n\nT {i}\n\nown {i}\n\n{menu}" for i in range(4)]


def test_links_of_one_article_on_many_pages_stay(spark):
    sources = [f"<p>page {i}</p><article><h1>Title</h1><p>words</p>{MENU}</article><footer>f {i}</footer>" for i in range(9)]
    assert texts_of(spark, sources) == ["Title\n\nwords\n\nHome | News | Shop"] * 9


def test_an_article_of_links_and_prose_with_links_stay(spark):
    links = "".join(f"<li><a href='/{i}'>a work that many articles refer to, number {i}</a>" for i in range(20))
    sources = [f"<article><p>on {i}</p><ul>{links}</ul><div>as said <a href='/x'>here</a> before</div></article>" for i in range(7)]
    for i, text in enumerate(texts_of(spark, sources)):
        assert text.startswith(f"on {i}\n\na work") and text.endswith("number 19\n\nas said here before")


def test_pages_with_an_article_count_for_those_without(spark):
    sources = [f"<div>Site menu</div><article>own {i}</article>" for i in range(4)] + ["<div>Site menu</div><p>no article</p>"]
    assert texts_of(spark, sources) == [*(f"own {i}" for i in range(4)), "no article"]
    assert texts_of(spark, sources[1:])[-1] == "Site menu\n\nno article"


def test_what_stands_around_an_article_stays(spark):
    sources = [f"<div><article>teaser</article></div><div><article>own {i}</article></div>" for i in range(7)]
    assert texts_of(spark, sources) == [f"teaser\n\nown {i}" for i in range(7)]


@pytest.mark.parametrize(("seed", "broadcast_rows"), [(1, 200_000), (2, 0)])
def test_templates_in_articles_equal_a_plain_count(spark, seed, broadcast_rows):
    """A block of links goes if it follows, or precedes, the same block in five articles with different own words."""
    rng = random.Random(seed)
    pool = [("link", f"menu {i}") for i in range(6)] + [("div", "said"), ("p", "once more")]
    pages = [[("p", f"own {rng.randrange(30)}")] + [rng.choice(pool) for _ in range(rng.randint(0, 6))] for _ in range(60)]
    hosts = [rng.choice(["a.example", "b.example"]) for _ in pages]
    seen: dict = defaultdict(set)

    def pairs(page):
        framed = [("first",), *page, ("last",)]
        return [((framed[i], framed[i + 1], "<"), (framed[i + 1], framed[i + 2], ">")) for i in range(len(page))]

    for host, page in zip(hosts, pages, strict=True):
        for pair in (p for both in pairs(page) for p in both):
            seen[host, pair].add(tuple(t for tag, t in page if tag != "link"))
    expected = [
        "\n\n".join(t for (tag, t), both in zip(page, pairs(page), strict=True) if tag != "link" or all(len(seen[host, p]) < 5 for p in both))
        for host, page in zip(hosts, pages, strict=True)
    ]
    written = {"link": "<div><a href='/'>{}</a></div>", "div": "<div>{}</div>", "p": "<p>{}</p>"}
    rows = [(i, f"http://{h}/{i}", "<article>" + "".join(written[tag].format(t) for tag, t in page)) for i, (h, page) in enumerate(zip(hosts, pages, strict=True))]
    got = {r["page_id"]: r["text"] for r in templates.extract(spark.createDataFrame(rows, SCHEMA), broadcast_rows=broadcast_rows).collect()}
    assert [got[i] for i in range(len(pages))] == expected
    assert any(e != "\n\n".join(t for _, t in page) for e, page in zip(expected, pages, strict=True))
