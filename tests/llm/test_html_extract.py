"""Main text of pages: the given pages against their article element, other layouts, odd input."""

import html
import re

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from caselight.llm import html_extract as H
from caselight.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
LONG = "Words of an article that go on for a while, so that the line is clearly one of text. "


def test_given_pages(spark):
    pages = pd.read_parquet(f"{SF}/pages.parquet").set_index("page_id")
    found = QUERIES["op2_html_main_text"](spark, SF).collect()
    assert len(found) == len(pages)
    for row in found:
        article = re.search(r"<article>(.*?)</article>", pages.html[row.page_id], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("</?b>", "", b)).split()) for b in re.split("</?(?:h1|p|br)>", article)]
        assert row.text == "\n".join(b for b in blocks if b)
        assert row.n_chars == len(row.text) and row.url == pages.url[row.page_id]


def test_page_without_article_element():
    page = f"""<body><header><h1>Site</h1></header><ul class="menu"><li><a href=x>Home</a><li><a href=y>About us</a></ul>
    <div id="content"><h2>Title</h2><p>{LONG}caf&eacute; &#8217;x&#8217; &mdash;<p>{LONG}<b>bold</b><p class="cookie-notice">{LONG}
    <p>Ok.</p><script>var a = "</p>";</script><form><input>{LONG}</form></div><div class="comments"><p>{LONG}</p></div>
    <aside>{LONG}</aside><div id="footer">c</div></body>"""
    text = LONG.strip()
    assert H.main_text(page).split("\n") == ["Title", f"{LONG}café ’x’ —", f"{LONG}bold", "Ok."]
    assert text in H.main_text(page)


@pytest.mark.parametrize("block", ["div", "section", "blockquote", "pre", "ul><li"])
def test_dominant_block_of_a_page_without_article(block):
    """One block holds over 90% of the text; the heading and the paragraphs beside it belong to the article as well."""
    menu = "".join(f"<li><a href=x>A page of the site {i}</a>" for i in range(12))
    page = f"""<body><ul>{menu}</ul><div><h2>Title</h2><p>{LONG}</p><{block}>{LONG * 40}</{block.split(">")[0]}><p>{LONG}</p></div></body>"""
    text = LONG.strip()
    assert H.main_text(page).split("\n") == ["Title", text, (LONG * 40).strip(), text]


def test_comments_inside_an_article_and_teasers():
    page = f"""<main><article><header><h1>Head</h1></header><p>{LONG * 3}</p><section class="comments"><p>{LONG}</p></section>
    <footer>by me</footer></article><article><p>teaser</p></article></main>"""
    assert H.main_text(page) == "Head\n" + (LONG * 3).strip()


def test_odd_pages():
    assert H.main_text(None) == H.main_text("") == H.main_text("<div><br><!-- x --></div>") == ""
    assert H.main_text("plain  text\n only &amp; &am") == "plain text only & &am"
    assert H.main_text("<p>a<p>b") == "a\nb"
    deep = "<p>" * 20_000 + LONG + "</div>" * 20_000
    assert H.main_text(deep) == LONG.strip()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<div class='ad'>", "</div>", "<article>", "</article>", "a b", "<b", "&lt", "<!--", "-->", "<br/>", "</", "<script>", "</script>"]), max_size=30).map("".join))
def test_never_fails_on_broken_markup(page):
    text = H.main_text(page)
    assert all(line and line == " ".join(line.split()) for line in text.split("\n")) or text == ""


def test_smoothing_and_threshold():
    import numpy as np

    assert np.allclose(H.smooth(np.full(7, 3.0)), 3.0)
    assert H.split_point(np.array([1.0, 1.0])) == 1.0
    assert 2 < H.split_point(np.array([1.0, 2.0, 50.0, 60.0])) < 50


def test_table_with_nulls_copies_and_extra_columns(spark):
    rows = [(1, "u", None, 3), (2, None, "", 3), (3, "u", f"<p>{LONG}</p>", 3), (3, "u", f"<p>{LONG}</p>", 3), (None, "u", LONG * 5000, 3)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = sorted(map(tuple, H.extract(frame).collect()), key=str)
    assert len(got) == 5 and got[-1][0] is None and got[-1][3] == len((LONG * 5000).strip())
    assert (1, "u", "", 0) in got and (2, None, "", 0) in got
    assert H.extract(frame.limit(0)).count() == 0
