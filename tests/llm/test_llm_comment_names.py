"""Names that begin with or hold "comment" on elements of the article itself, and on readers' comments."""

import pytest

from panelscope.llm import html

LONG = "This is the text of the article, with commas, and it goes on for more than a few words. " * 3


@pytest.mark.parametrize("page", [
    '<article class="commentary"><h1>Title</h1><p>{0}</p></article>',
    '<article class="post comments-open"><h1>Title</h1><p>{0}</p></article>',
    '<div class="commentary"><article><h1>Title</h1><p>{0}</p></article></div>',
    '<div class="comments-open"><article><h1>Title</h1><p>{0}</p></article></div>'])
def test_article_named_for_comments_stays(page):
    assert html.extract(page.format(LONG)) == "Title\n" + LONG.strip()


@pytest.mark.parametrize("name", ["comments", "comment-list", "commentlist", "post-comment", "disqus_thread"])
def test_comments_of_readers_go(name):
    page = f'<article><h1>Title</h1><p>{LONG}</p></article><div class="{name}"><article class="comment"><p>{LONG}{LONG}</p></article></div>'
    assert html.extract(page) == "Title\n" + LONG.strip()
