"""Main text of pages whose class names mislead, and of pages with very many stray end tags."""

import time

import pytest

from colsight.llm import op7_html as op7

TEXT = "The council met on Monday and decided, after a long debate, to build the new bridge."


@pytest.mark.parametrize(
    "open_, close",
    [
        ('<div class="content no-sidebar">', "</div>"),
        ('<article class="post has-comments">', "</article>"),
        ('<article class="post tag-legal">', "</article>"),
        ('<main><section class="popular-science">', "</section></main>"),
        ('<div class="post withSidebar">', "</div>"),
    ],
)
def test_classes_that_say_something_else(open_, close):
    page = f'<body><nav>Home News</nav>{open_}<p>{TEXT}</p>{close}<div class="sidebar">More of this</div></body>'
    assert op7.main_text(page) == TEXT


def test_header_of_an_article_is_its_title():
    page = f'<body><article><div class="article-header"><h1>A bridge</h1></div><p>{TEXT}</p></article></body>'
    assert op7.main_text(page) == f"A bridge\n{TEXT}"


@pytest.mark.parametrize("name", ["sidebar", "main-nav", "site-header", "related-posts", "popular-articles", "socialLinks", "post-comments", "legal", "footer-links", "cookie-banner"])
def test_boilerplate_names(name):
    page = f'<body><article><p>{TEXT}</p></article><div class="{name}"><p>{TEXT} Again.</p></div></body>'
    assert op7.main_text(page) == TEXT


def test_stray_end_tags_cost_no_walk():
    page = "<div>" * 40_000 + "</em2>" * 120_000 + f"<p>{TEXT}</p>"
    before = time.process_time()
    assert op7.main_text(page) == TEXT
    assert time.process_time() - before < 5
