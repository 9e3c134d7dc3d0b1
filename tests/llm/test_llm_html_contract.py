"""Pages without an article element, several articles, names met inside an article, and markup made to be slow."""

import gc
import time

import pytest

from panelscope.llm import html

LONG = "This is the text of the article, with commas, and it goes on for more than a few words. " * 3
TEXT = LONG.strip()


def test_container_without_article_keeps_all_its_running_text():
    page = f"<div><section><p>{LONG}</p></section><h2>Two</h2><section><p>short</p></section><ul><li>one</li></ul><p>also short</p><pre>x = 1</pre></div>"
    assert html.extract(page) == f"{TEXT}\nTwo\nshort\none\nalso short\nx = 1"
    links = "".join(f'<li><a href="/{i}">link number {i} of the list</a></li>' for i in range(9))
    assert html.extract(f'<body><div><div><ul>{links}</ul></div><div><p>{LONG}</p></div><div>All rights reserved</div></div></body>') == TEXT


def test_main_with_several_articles_is_kept_whole():
    page = f"<main><article><h1>One</h1><p>{LONG}</p></article><article><h2>Two</h2><p>brief</p></article></main>"
    assert html.extract(page) == f"One\n{TEXT}\nTwo\nbrief"
    teaser = '<article><a href="/x">Another story that one may read</a></article>'
    assert html.extract(f"<main><article><h1>One</h1><p>{LONG}</p></article>{teaser}</main>") == f"One\n{TEXT}"


@pytest.mark.parametrize("name", ["share-price", "menu-item", "header-image", "bannerStory", "notice-period"])
def test_words_within_a_name_do_not_drop_a_part_of_an_article(name):
    assert html.extract(f'<article><p>{LONG}</p><div class="{name}">Some more text</div></article>') == f"{TEXT}\nSome more text"


@pytest.mark.parametrize("name", ["share", "share-box", "social_icons", "post-footer", "ad ad-728x90", "sidebarLeft", "top-nav"])
def test_names_that_say_what_a_part_is_drop_it(name):
    assert html.extract(f'<article><p>{LONG}</p><div class="{name}">Some more text</div></article>') == TEXT


def test_hinted_parts_go_if_they_hold_links_or_controls():
    for inner in ('<a href="/a">one</a> <a href="/b">two</a>', 'Write to us <form><input name="q"></form>'):
        assert html.extract(f'<article><p>{LONG}</p><div class="share-story-now">{inner}</div></article>') == TEXT


@pytest.mark.parametrize("page", [
    lambda n: "<div>" * n + "</article>" * n,
    lambda n: "<div>" * n + "<li>x</li>" * n,
    lambda n: "<i><div>" + "<b>" * n + "</i>" * n,
    lambda n: "<p><x>" + "<b>" * n + "<div></div>" * n,
    lambda n: '<div class="menu">' * n + "text" + "</div>" * n,
    lambda n: f"<div><p>{LONG}</p>" * (n // 8),
    lambda n: "<header>" * n + "<article>" * n + "text",
    lambda n: "<article>" * n + "text",
    lambda n: "<table><tr><td>" * n + LONG,
    lambda n: "<!--x-->" * n + "<" * n], ids=range(10))
def test_time_is_linear_in_the_page(page):
    def seconds(n):
        text = page(n)
        gc.collect()
        gc.disable()  # full collections grow with all that lives, not with the page
        try:
            start = time.process_time()
            html.extract(text)
            return time.process_time() - start
        finally:
            gc.enable()
    seconds(1000)
    assert seconds(40_000) < 20 * max(seconds(5_000), 0.02)  # eight times the page; quadratic would be 64 times
