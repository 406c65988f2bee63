"""Pages whose markup leaves out end tags, closes elements itself, or names layouts."""

from __future__ import annotations

from itertools import product

import pytest

from shelfcast.llm.html_text import main_text, second_pass

SAID = "The text of the article is long enough to be told from the menu, and it has the words of a text."


@pytest.mark.parametrize(
    "page",
    [
        f"<html><head><title>t</title><body><article><p>{SAID}</p></article></body></html>",
        f"<head><meta charset=utf-8><title>t</title><article><p>{SAID}</p></article>",
        f"<head><title>t</title>{SAID}",
        f"<body><article><svg width='1'/><p>{SAID}</p></article></body>",
        f"<div class='layout with-sidebar'><article><p>{SAID}</p></article></div>",
        f"<div class='has-header'><article><p>{SAID}</p></article></div>",
        f"<div class='header-layout'><div>Menu</div><main><p>{SAID}</p></main></div>",
        f"<div class='elementor-widget'><article><p>{SAID}</p></article></div>",
        f"<div class='elementor-widget'><p>{SAID}</p><p>Menu</p></div>",
        f"<div class='menu-open'><article><p>{SAID}</p></article></div>",
        f"<div class='nav-collapse-page'><main><p>{SAID}</p></main></div>",
        f"<form id=aspnetForm><nav>Menu</nav><main><p>{SAID}</p></main></form>",
        f"<form id=aspnetForm><nav>Menu</nav><div><p>{SAID}</p></div></form>",
        f"<body><nav><a href=/>Home</a><main><p>{SAID}</p></main></body>",
        f"<article><section class='related-work'><p>{SAID}</p></section></article>",
        f"<div class='widget'><main><p>{SAID}</p></main></div>",
    ],
)
def test_the_article_stays(page):
    assert main_text(page) == SAID


def test_boilerplate_still_goes():
    page = f"<body><article><p>{SAID}</p></article><div class='comment-list'><article>{SAID}</article></div><div class='site-footer'>{SAID}</div>"
    assert main_text(page) == SAID
    assert main_text(f"<head><title>t</title></head><body><svg><text>no</text></svg><article>{SAID}</article>") == SAID


@pytest.mark.parametrize(
    "other",
    [
        "<div class='related-posts'><article>{}</article></div>",
        "<aside><article>{}</article></aside>",
        "<footer><article>{}</article></footer>",
        "<div class='widget'><p>{}</p></div>",
        "<div id=comments><main>{}</main></div>",
        "<form class=comment-form><p>{}</p></form>",
        "<form><p>{}</p></form>",
        "<div class='main-menu'><a href=/>{}</a></div>",
        "<div class='ad-slot'><article>{}</article></div>",
    ],
)
def test_what_is_beside_the_article_goes(other):
    page = f"<body><article><p>{SAID}</p><p>{SAID}</p></article>{other.format(SAID)}</body>"
    assert main_text(page) == f"{SAID} {SAID}"
    page = f"<body><article><p>{SAID}</p><p>{SAID}</p><div class='related-posts'><a href=/>{SAID}</a></div></article></body>"
    assert main_text(page) == f"{SAID} {SAID}"


def test_second_pass_equals_a_plain_search():
    for labels in product([None, "text", "boilerplate"], repeat=6):
        want = []
        for i, label in enumerate(labels):
            near = {}
            for side in (-1, 1):
                at = i
                while 0 <= at < len(labels) and not labels[at]:
                    at += side
                if 0 <= at < len(labels):
                    near[side] = (abs(at - i), labels[at])
            least = min((far for far, _ in near.values()), default=0)
            told = {said for far, said in near.values() if far == least}
            want.append(label or ("boilerplate" if told == {"boilerplate"} else "text"))
        assert second_pass(list(labels)) == want
