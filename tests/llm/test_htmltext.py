"""HTML extraction: the tree against its table, the operator against an article-tag reading, odd pages."""

import html
import re
import time

import pandas as pd
import pytest

from refloom.llm import htmltext as H

LONG = "This is the text of the page in one of its paragraphs, which has some twenty to thirty words in it, as paragraphs of an article mostly have."


def read(page):
    return H.main_text(page, H.trained_tree())


def test_tree_agrees_with_its_table():
    rows, labels = H.labelled_rows()
    tree = H.trained_tree()
    assert [H.says(tree, r) for r in rows] == [bool(y) for y in labels] and len(rows) < 300


def test_fitted_tree_is_the_best_single_split():
    rows = [[float(x), float(x % 3)] for x in range(20)]
    tree = H.fit_tree(rows, [int(x > 12) for x in range(20)], depth=1)
    assert tree == H.Split(0, 12.5, False, True)
    assert H.fit_tree([[1.0]] * 3, [1, 0, 1]) is True and H.fit_tree([[1.0]] * 3, [0, 0, 0]) is False


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_whole_table_against_the_article_tag(spark, sf):
    """Brute force: on these pages the main text is what stands between the article tags."""
    pages = spark.read.parquet(f"/root/testdata/{sf}/pages.parquet")
    out = {r.page_id: r.text for r in H.extract_main_text(pages).collect()}
    rows = pages.collect()
    assert len(out) == len(rows)
    for r in rows:
        article = re.search(r"(?s)<article>(.*?)</article>", r.html)[1]
        cut = re.split(r"</?(?:p|h1)>", article.replace("<br>", " "))
        blocks = (" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in cut)
        assert out[r.page_id] == "\n".join(b for b in blocks if b)


FURNITURE = [
    "<nav><ul><li><a href=1>Home</a><li><a href=2>News</a></ul></nav>",
    f"<header><p>{LONG}</p></header>",
    f"<footer>{LONG}</footer>",
    f"<aside><p>{LONG}</p></aside>",
    f'<div class="sidebar"><p>{LONG}</p></div>',
    f"<div id='cookie-notice'>{LONG}</div>",
    f'<div class="ad">{LONG}</div>',
    f"<form><p>{LONG}</p><input><select><option>One</select><button>Send</button></form>",
    f"<script>var t='<p>{LONG}</p>'</script>",
    f"<style>p{{margin:0}} /* {LONG} */</style>",
    f"<!-- <p>{LONG}</p> -->",
    f"<noscript><p>{LONG}</p></noscript>",
    f"<section class='comments'><article class='comment'><p>{LONG}</p></article></section>",
    f"<p hidden>{LONG}</p>",
    f'<p style="display: none">{LONG}</p>',
    f"<div role=complementary>{LONG}</div>",
]


@pytest.mark.parametrize("piece", FURNITURE)
@pytest.mark.parametrize("holder", ["<article>", "<main>", "<div class=content>", "<div class='page with-sidebar'><div>"])
def test_furniture_goes_and_the_article_stays(piece, holder):
    close = "".join(f"</{t}>" for t in reversed(re.findall(r"<(\w+)", holder)))
    page = f"<html><body class='has-sidebar'>{piece}{holder}<h1>A fine title</h1><p>{LONG}</p><p>Short one.</p><p>{LONG}</p>{close}{piece}</body></html>"
    assert read(page) == f"A fine title\n{LONG}\nShort one.\n{LONG}"


def test_links_decide_where_no_container_is_known():
    menu = "<div>" + "".join(f"<div><a href={k}>Item number {k}</a></div>" for k in range(6)) + "</div>"
    page = f"{menu}<div>{LONG}</div><div>He said no.</div><div>{LONG} <a href=x>link</a></div>{menu}<div>All rights reserved</div>"
    assert read(page) == f"{LONG}\nHe said no.\n{LONG} link"


def test_containers_named_like_an_article():
    menu = "<ul>" + "".join(f"<li><a href={k}>Item {k}</a>" for k in range(5)) + "</ul>"
    page = f"<div id='page'>{menu}<div class='post-content'><h2>Title</h2><p>Short.</p><p>Two words</p>{menu}<div class=share>Tell all of your friends</div></div><div>Loose end</div></div>"
    assert read(page) == "Title\nShort.\nTwo words"


def test_white_space_references_and_inline_tags():
    page = "<article><p> a&nbsp;&amp;amp; <b>b</b>c\n\t d<br>e <a\nhref='x>y'>f</a>&#x41;&lt;p&gt;</p><p></p><p>x&am</article>"
    assert read(page) == "a &amp; bc d e fA<p>\nx&am"


def test_unclosed_and_nested_markup():
    assert read(f"<article><p>{LONG}<p>two<li>three<td>four</article><footer>no") == f"{LONG}\ntwo\nthree\nfour"
    assert read(f"<div><form><main><p>{LONG}</main></form></div>") == LONG
    assert read("<script>never closed <p>text</p>") == "" and read("<article>a < b <3 c</article>") == "a < b <3 c"


@pytest.mark.parametrize("piece", ["<a <a ", '<a x="', "<div class='x' ", "<div>", "</div>", "<!--", "<script>", "&", "<p>x", "<", "&#", "<h1 a=b", "<p title='\"", "a "])
def test_long_pages_take_linear_time(piece):
    began = time.time()
    read("<article>" + piece * (1_000_000 // len(piece)))
    assert time.time() - began < 10


def test_rows_columns_and_nulls(spark):
    page = f"<article><p>{LONG}</p></article>"
    rows = [(1, page, "x", 5), (1, page, "x", 5), (2, None, None, None), (3, "", "y", 1), (None, "<nav>a</nav>", "z", 2)]
    df = spark.createDataFrame(rows, "page_id int, html string, TEXT string, extracted int")
    out = H.extract_main_text(df)
    assert out.columns == ["page_id", "html", "extracted", "text"]
    assert sorted((str(r.page_id), r.text) for r in out.collect()) == sorted([("1", LONG), ("1", LONG), ("2", ""), ("3", ""), ("None", "")])
    assert H.extract_main_text(df, into="html").columns == ["page_id", "TEXT", "extracted", "html"]
    assert H.extract_main_text(df.limit(0)).collect() == []


def test_one_page_a_row_in_pandas_too(spark):
    df = spark.createDataFrame(pd.DataFrame({"html": [f"<p>{k} {LONG}</p>" for k in range(1200)]}))
    assert {r.text for r in H.extract_main_text(df).collect()} == {f"{k} {LONG}" for k in range(1200)}
