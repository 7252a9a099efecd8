"""Reader comments and side columns of any size leave the article whole."""

import pytest

from openends.llm.html_text import main_text


def sentence(kind, i, n):
    return " ".join(f"{kind}{i}x{j}" for j in range(n))


def comments(kind, count, size):
    """Comments in one of six mark-ups."""
    body = [sentence("said", i, size) for i in range(count)]
    if kind == "list":
        items = "".join(f'<li class="comment"><p>{t}</p></li>' for t in body)
        return f'<div id="comments"><h3>{count} Comments</h3><ol class="commentlist">{items}</ol></div>'
    if kind == "bare list":
        return '<ol class="commentlist">' + "".join(f"<li>{t}</li>" for t in body) + "</ol>"
    if kind == "heading":
        return '<div id="comments"><h2>Comments</h2>' + "".join(f"<p>{t}</p>" for t in body) + "</div>"
    if kind == "thread":
        return '<div id="disqus_thread">' + "".join(f'<div class="post"><p>{t}</p></div>' for t in body) + "</div>"
    if kind == "articles":
        items = "".join(f'<article class="comment"><div>{t}</div></article>' for t in body)
        return f'<section class="comments-area"><h2>Responses</h2>{items}</section>'
    return '<div class="reply-list">' + "".join(f"<div class='reply'><p>{t}</p></div>" for t in body) + "</div>"


@pytest.mark.parametrize("inside", [False, True])
@pytest.mark.parametrize("kind", ["list", "bare list", "heading", "thread", "articles", "replies"])
@pytest.mark.parametrize("count, size", [(1, 32), (3, 80), (4, 80), (5, 80), (10, 80), (40, 80)])
def test_comments_go_and_the_article_stays(kind, inside, count, size):
    article = "".join(f"<p>{sentence('told', i, 40)}</p>" for i in range(8))
    said = comments(kind, count, size)
    head = '<div class="top"><a href="/">Home</a></div>'
    if inside:
        page = f"<html><body>{head}<article><h1>Title</h1>{article}{said}</article></body></html>"
    else:
        page = f'<html><body>{head}<div class="story"><h1>Title</h1>{article}</div>{said}</body></html>'
    text = main_text(page)
    assert "said" not in text
    for i in range(8):
        assert sentence("told", i, 40) in text


@pytest.mark.parametrize("count", [1, 5, 20, 100])
def test_a_side_column_of_any_size_goes(count):
    article = "".join(f"<p>{sentence('told', i, 40)}</p>" for i in range(8))
    side = "".join(f"<p>{sentence('side', i, 30)}</p>" for i in range(count))
    page = f'<body><div id="story"><h1>Title</h1>{article}</div><div id="sidebar">{side}</div></body>'
    text = main_text(page)
    assert "side" not in text and all(sentence("told", i, 40) in text for i in range(8))


@pytest.mark.parametrize("name", ["comments-open", "has-sidebar", "discussion", "widget reply"])
def test_a_mark_on_everything_marks_nothing(name):
    article = "".join(f"<p>{sentence('told', i, 40)}</p>" for i in range(8))
    notice = '<div class="cookie-notice"><p>We use cookies.</p></div>'
    text = main_text(f'<body>{notice}<div class="{name}"><div><h1>Title</h1>{article}</div></div></body>')
    assert all(sentence("told", i, 40) in text for i in range(8))
