"""Wrapped articles, and lines that belong to a text without one."""

import pytest

from matchlens.llm.html_text import main_text

LONG = "A paragraph of the text that is long enough to be found without any help, as most of them are in pages like this one."
FRAME = "<ul class=menu><li>Home<li>News</ul>{}<div class=sidebar><p>Read also this</div><footer>(c)</footer>"


@pytest.mark.parametrize("start", ["<div class='content has-sidebar'>", "<div class='page with-ads'>", "<div class='post share-enabled'>", "<form action=/x>"])
@pytest.mark.parametrize("inner", ["<article><h1>T</h1><p>{}</p></article>", "<main><h1>T</h1><p>{}</p></main>", "<div><h1>T</h1><p>{}</p></div>"])
def test_hinted_wrappers(start, inner):
    body = FRAME.format(inner.format(LONG))
    assert main_text(f"<body>{start}{body}</{start[1:5].strip()}>") == f"T {LONG}"


def test_hints_inside_an_article_and_comments():
    comments = "<div class=comments>" + f"<article class=comment><p>{LONG}</p></article>" * 5 + "</div>"
    assert main_text(f"<article><div class='body share-enabled'><p>{LONG}</p><div class=share>Share</div></div></article>{comments}") == LONG
    assert main_text(f"<div class='page with-ads'><p>{LONG}</p>{comments}</div>") == LONG
    assert main_text(f"<div class=story><p>{LONG}</p></div><div class=related><article><p>Teaser</p></article></div>") == LONG


def test_headings_and_short_paragraphs():
    adverts = "<div class=advert>Buy</div>" * 3
    page = f"<div><h2><a href=/1>Headline</a></h2><p>{LONG}</p>{adverts}<p>Short end.</p><p><a href=/2>Source</a></p></div><footer>(c)</footer>"
    assert main_text(page) == f"Headline {LONG} Short end. Source"
    links = "<ul><li><a href=/1>One</a><li><a href=/2>Two</a><li><a href=/3>Three</a></ul>"
    assert main_text(f"{links}<div><p>{LONG}</p>{links}<p>Short end.</p></div>{links}") == f"{LONG} Short end."


@pytest.mark.parametrize("page", [f"<article>Teaser</article><div>{LONG}</div>", f"<div><p>{LONG}</p></div><article>Other story</article>"])
def test_teasers_beside_a_story(page):
    assert main_text(page) == LONG
    assert main_text(f"<main>{page}</main>") == LONG


def test_the_article_is_a_prior():
    teaser = "<article><h2><a href=/1>Another one to read</a></h2>Soon</article>"
    assert main_text(f"<article><p>{LONG}</p></article>{teaser}") == LONG
    assert main_text(f"<div>{LONG}</div><article><h1>T</h1><p>{LONG}</p></article><div>{LONG}</div>") == f"T {LONG}"
    assert main_text(f"<main><h1>T</h1><article><p>{LONG}</p></article><section><p>Other</p></section></main>") == f"T {LONG}"
    assert main_text("<div class=cookie-notice>" + LONG * 9 + "</div><article><p>Short.</p></article>") == "Short."
    assert main_text("<article></article><div class=ad>Buy this now</div>") == ""


def test_window_sums_decide_inside_an_article():
    links = "".join(f"<li><a href=/{i}>Link {i}</a>" for i in range(4))
    story = f"<h1><a href=/0>T</a></h1><p>{LONG}</p>{{}}<p>Short end.</p>"
    assert main_text(f"<article>{story.format(f'<ul>{links}</ul>')}<div><a href=/1>Read more</a></div><div><a href=/2>Tweet</a></div></article>") == f"T {LONG} Short end."
    assert main_text(f"<article>{story.format('<div><a href=/3>Source</a></div>')}</article>") == f"T {LONG} Source Short end."
    assert main_text(f"<article><ul>{links}</ul></article>") == "Link 0 Link 1 Link 2 Link 3"


@pytest.mark.parametrize("name", ["ad-free-zone", "share-price", "notice-of-meeting", "no-sidebar", "expert-commentary", "socialScience"])
def test_classes_that_only_hold_such_a_word(name):
    assert main_text(f"<article><p>{LONG}</p><div class='{name}'>Kept.</div></article>") == f"{LONG} Kept."


@pytest.mark.parametrize("name", ["ad", "ad-slot", "share-buttons", "relatedPosts", "cookie-policy", "newsletter-cta", "comment-list", "site-header", "box ads"])
def test_classes_of_boilerplate(name):
    assert main_text(f"<article><p>{LONG}</p><div class='{name}'>Gone.</div></article>") == LONG
