"""Names of an article, of main and of what is around them; names of other elements still mark noise."""

from __future__ import annotations

import pytest

from strata.llm import templates


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ("<div class='content-sidebar-wrap'><article>a</article><div class='sidebar'>s</div></div>", "a"),
        ("<main class='with-sidebar'><p>m</p><div class='widget-2'>w</div></main>", "m"),
        ("<article class='post comment-open'>a</article>", "a"),
        ("<article id='social-policy'>a</article>", "a"),
        ("<div class='has-header'><div id='no-menu'><article>a</article></div></div>", "a"),
        ("<div class='menu'><main>m</main></div>", "m"),
        ("<article class='post social'>a<p class='share'>s</p></article>", "a"),
        ("<article>a</article><div id='comments'><article>c</article></div>", "a"),
        ("<div class='sidebar'><article>teaser</article></div><article>a</article>", "a"),
        ("<article>a<div class='related'><article class='post'>r</article></div></article>", "a"),
        ("<div class='sidebar'><aside><article>s</article></aside></div><p>t</p>", "t"),
        ("<div class='page-header'>h</div><p>t</p>", "t"),
    ],
)
def test_text_of_a_page(source, text):
    assert templates.Page(source).text(set()) == text
