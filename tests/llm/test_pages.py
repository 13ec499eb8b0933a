"""Pages that are built in different ways give their article."""

from __future__ import annotations

import time

import pytest

from tablewharf.llm import html_text

BODY = "<h1>The title</h1><p>" + "Some words of the first paragraph stand here. " * 6 + "</p><p>" + "And more of them follow. " * 6 + "</p>"
TEXT = "The title\n" + ("Some words of the first paragraph stand here. " * 6).strip() + "\n" + ("And more of them follow. " * 6).strip()
NAV = "<nav><ul>" + "".join(f'<li><a href="/{i}">menu entry {i}</a></li>' for i in range(8)) + "</ul></nav>"
FOOT = "<footer>&copy; a company, all rights reserved</footer>"
COMMENTS = "<div class='comments'>" + "<p>I like what was said here, and I say so at length.</p>" * 3 + "</div>"

PAGES = {
    "form around the page": f"<form id=aspnet method=post>{NAV}<div>{BODY}</div>{FOOT}</form>",
    "header never closed": f"<header class=top><div>{BODY}</div>",
    "sidebar in a wrapper's name": f'{NAV}<div class="content right-sidebar"><div>{BODY}</div></div>a stray line',
    "search in a wrapper's name": f'{NAV}<div class="search-results-article">{BODY}</div>{FOOT}',
    "apart names around h1": f'{NAV}<div class="widget-area-1 sidebar-x">{BODY}</div>{FOOT}',
    "comments after the article": f"{NAV}<article>{BODY}</article>{COMMENTS}{FOOT}",
    "only divs": f"<div class=nav>{NAV}</div><div class=main>{BODY}</div><div class=footer>about us</div>",
    "aside inside": f"<main>{BODY.replace('</p><p>', '</p><aside>Buy this now</aside><p>')}</main>{FOOT}",
    "table layout": f"<table><tr><td>{NAV}</td><td>{BODY}</td></tr></table>",
    "no closing tags": f"<html><body>{NAV}<div>{BODY.replace('</p>', '')}",
    "upper case": f"<BODY>{NAV.upper()}<DIV ID=CONTENT>{BODY.replace('<p>', '<P CLASS=x>')}</DIV></BODY>",
}


@pytest.mark.parametrize("name", sorted(PAGES))
@pytest.mark.parametrize("weights", [{}, {"word p": 1.0, "word h1": 1.0, "tag article": -2.0, "tag p": -0.1, "word linked": -0.5}])
def test_articles_survive_their_markup(name, weights):
    assert html_text.main_text(PAGES[name], weights) == TEXT


def test_quotes_open_values_only_after_an_equals_sign():
    page = "<p title=it's>one two three</p><p>four five six</p><p>don't stop here</p>"
    assert html_text.main_text(page, {}) == "one two three\nfour five six\ndon't stop here"
    page = '<p title="a > b" data-x = \'c > d\'>one two</p><p title="never closed>three</p><p>four</p>'
    assert html_text.main_text(page, {}) == "one two\nthree\nfour"
    assert html_text.main_text('<p data-id="comments">real words here</p>', {}) == "real words here"


def test_comments_longer_than_the_article_stay_apart():
    long = COMMENTS.replace("I like", "I like " + "very much " * 200)
    assert html_text.main_text(f"<article>{BODY}</article>{long}", {}) == TEXT


@pytest.mark.parametrize("opening", ["<div>", "<span>", "<i>", "<p>", "<div><span>", "<a href=x>", "<x title='"])
def test_deep_pages_take_linear_time(opening):
    start = time.perf_counter()
    html_text.main_text(opening * 60_000 + "words " * 1000, {})
    assert time.perf_counter() - start < 8


def test_long_pages():
    page = "<div>" * 500 + "<p>word and word</p>" * 100_000 + "</div>" * 500
    start = time.perf_counter()
    assert html_text.main_text(page, {}).count("\n") == 99_999
    assert time.perf_counter() - start < 20
