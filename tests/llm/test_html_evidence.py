"""HTML extraction: the clusters choose the lines, marks are evidence; linear time; odd tables."""

import time

import numpy as np
import pytest

from stratalake.llm import html_text

LONG = ("A long paragraph of the article with many words so that its ratio is high. " * 5).strip()
RUNNING = "This is running text of the article in a part with an odd name."


@pytest.mark.parametrize("part", [
    f'<section id="register"><p>{RUNNING}</p></section>',
    f'<section class="search"><p>{RUNNING}</p></section>',
    f'<p class="related">{RUNNING}</p>',
    f'<div class="widget">{RUNNING}</div>',
    f'<aside>{RUNNING}</aside>',
])
def test_ambiguous_words_inside_an_article_drop_no_running_text(part):
    page = f"<body><nav>Menu</nav><article><p>{LONG}</p>{part}<p>{LONG}</p></article><footer>x</footer></body>"
    assert html_text.extract(page) == "\n\n".join([LONG, RUNNING, LONG])


@pytest.mark.parametrize("part", [
    f'<div class="ad">{RUNNING}</div>', f'<section class="comments"><p>{RUNNING}</p></section>',
    '<div class="related"><ul>' + '<li><a href="/x">Another story</a></li>' * 6 + "</ul></div>",
    '<aside><a href="/y">Read this as well</a></aside>', f'<div class="newsletter">{RUNNING}</div>',
    f'<aside class="sidebar">{RUNNING}</aside>', f'<form>{RUNNING}</form>',
])
def test_boilerplate_inside_an_article_goes(part):
    page = f"<body><article><p>{LONG}</p>{part}<p>{LONG}</p></article></body>"
    assert html_text.extract(page) == "\n\n".join([LONG, LONG])


# no article, no class: the ratios of the lines around decide
BARE = [f"<body><ul><li><a href=/a>A</a><li><a href=/b>B</a><li><a href=/c>C</a></ul><p>Lead.</p><p>{LONG}</p>"
        f"<p><a href=/d>A paragraph that is one link</a></p><p>{LONG}</p><p>End.</p></body>"]
WANT = ["\n\n".join(["Lead.", LONG, "A paragraph that is one link", LONG, "End."])]


def test_smoothing_and_threshold_choose_the_lines(monkeypatch):
    assert [html_text.extract(p) for p in BARE] == WANT
    with monkeypatch.context() as m:
        m.setattr(html_text, "smooth", lambda v: v)
        assert html_text.extract(BARE[0]) == "\n\n".join([LONG, LONG])
    with monkeypatch.context() as m:
        m.setattr(html_text, "threshold", lambda v: 0.0)
        assert "Menu" in html_text.extract(f"<nav>Menu</nav><article><p>{LONG}</p></article>")
    assert html_text.extract(f"<nav>Menu</nav><article><p>{LONG}</p></article>") == LONG


def test_one_giant_paragraph_does_not_raise_the_cut():
    parts = ["Short.", LONG, "word " * 200_000 + "end", "List item", LONG, "x"]
    article = "<article>" + "".join(f"<p>{p}</p>" for p in parts) + "</article>"
    assert html_text.extract(f"<nav>Menu</nav>{article}") == "\n\n".join(parts)


def test_time_is_linear_in_open_and_stray_tags():
    n = 100_000
    for page in ("<div>x" * n, "<p>x<b>" * n, "<div>" * n + "</section>" * n,
                 "<li><ul>" + "<section>" * n + "<li>a</li>" * n, "<div class=ad>x" * n):
        start = time.time()
        html_text.extract(page)
        assert time.time() - start < 20


def test_two_means_keeps_zero_in_the_lower_cluster():
    assert 0 < html_text.threshold(np.array([100.0, 120.0, 200.0])) < 100
    assert html_text.threshold(np.array([0.0, 200.0])) <= html_text.HIGHEST_CUT


def test_odd_tables(spark):
    schema = "page_id long, html string, text string, n_chars int, `a.b` string, `c``d` int, __key int"
    rows = [(1, None, "x", 1, "p", 5, 6), (2, "", None, None, None, None, None),
            (None, f"<article><p>{LONG}</p></article>", "y", 2, "q", 7, 8),
            (None, f"<article><p>{LONG}</p></article>", "y", 2, "q", 7, 8)]
    out = html_text.extract_pages(spark.createDataFrame(rows, schema))
    assert out.columns == ["page_id", "a.b", "c`d", "__key", "text", "n_chars"]
    got = sorted((r["page_id"] or 0, r["text"], r["n_chars"], r["a.b"], r["c`d"]) for r in out.collect())
    assert got == [(0, LONG, len(LONG), "q", 7)] * 2 + [(1, "", 0, "p", 5), (2, "", 0, None, None)]
    empty = html_text.extract_pages(spark.createDataFrame([], schema))
    assert empty.columns == out.columns and empty.count() == 0
