"""Main text against pages whose article is known."""

import html
import re
import time

import numpy as np
import pytest

from kontor.llm import maintext
from kontor.llm.blocks import blocks

SF = "/root/testdata/sf0.001"
TREE = maintext.grow(*maintext.labelled())


def article_of(page):
    """The table's pages have one article, of h1 and p with inline tags."""
    inner = page.split("<article>")[1].split("</article>")[0]
    parts = [html.unescape(re.sub(r"<[^>]*>", "", one.replace("<br>", " "))) for one in re.split(r"</?(?:p|h1)>", inner)]
    return "\n\n".join(text for text in (" ".join(part.split()) for part in parts) if text)


def test_tree_learns_its_table():
    rows, labels = maintext.labelled()
    assert len(rows) < 200
    assert np.mean([TREE.decide(list(row)) == label for row, label in zip(rows, labels)]) > 0.97


def test_table_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    rows = maintext.extract(pages).select("page_id", "text").collect()
    want = {row.page_id: article_of(row.html) for row in pages.collect()}
    assert {row.page_id: row.text for row in rows} == want


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("<article>", ""), ("<article><p> \n </p></article>", ""),
    ("<article><p>a &quot;q&quot; <!-- c --> b</p><p>cut <a href='x", 'a "q" b\n\ncut'),
    ("<article><p>one</p><script>var a='</article>';</script><p>two &am</p>", "one\n\ntwo &am"),
    ("<article><p>x<br>y<br/>z</p> loose <div>in<p>p1<p>p2</div></article>", "x y z\n\nloose\n\nin\n\np1\n\np2"),
    ("<article><p title='a>b'>kept &lt;b&gt; &#233;&nbsp;x</p></article>", "kept <b> é x"),
    ("<header><p>site</p></header><article><header><h1>T</h1></header><p>b</p><form>f</form><aside>s</aside></article>", "T\n\nb"),
    ("<main><p>b c d</p><section class='reader-comments'><p>says a reader</p></section></main><footer>f</footer>", "b c d"),
    ("<div class='logo'>Site</div><div id='content'><h1>T</h1><p>a b</p><div class='ad'>x</div><p>c</p></div><div id='footer'>f</div>", "T\n\na b\n\nc"),
    ("<ul class='menu'><li>m</li></ul><h1>T</h1><p>some words here</p><p>and some more</p><div class='sidebar'><p>s</p></div>", "T\n\nsome words here\n\nand some more"),
    ("<div class='page with-sidebar'><article><p>b</p></article></div><div class='cookie-bar'>We use cookies</div>", "b"),
])
def test_pages(page, text):
    assert maintext.main_text(page, TREE) == text


@pytest.mark.parametrize("page, text", [
    ("<article><p>a</p><svg class='i'/><p>b c d</p></article>", "a\n\nb c d"),
    ("<article><p>a</p><math/><p>b c</p><svg><text>no</text></svg><p>d</p></article>", "a\n\nb c\n\nd"),
    ("<article><p>a</p><video src='x'><p>b c d</p></article>", "a\n\nb c d"),
    ("<html><head><title>no</title><meta name='a'><style>no</style><body><article><p>a b</p></article>", "a b"),
    ("<head><title>no</title><link rel='x'><article><p>a b</p></article>", "a b"),
    ("<head><title>no</title><script>no</script></head><body><article><p>a b</p></article>", "a b"),
    ("<article><p>a</p><script>var x = '<p>no</p>'", "a"), ("<article><p>a</p><textarea><p>no</p>", "a"),
])
def test_raw_elements_without_end_tag(page, text):
    assert maintext.main_text(page, TREE) == text


def test_unclosed_raw_elements_stay_linear():
    start = time.perf_counter()
    for part in ("<svg>", "<svg/>", "<select>", "<video>x", "<head>", "<title>", "<svg x=\""):
        blocks(part * 20_000)
    assert time.perf_counter() - start < 30


def test_nothing_is_capped():
    page = "<article>" + "".join(f"<p>{'w' * 50} {i}</p>" for i in range(5_000)) + "</article>"
    assert maintext.main_text(page, TREE).count("\n\n") == 4_999


def test_null_repeated_and_clashing(spark):
    rows = [(1, None, "x"), (1, None, "x"), (None, "<article><p>a b</p></article>", None)]
    found = maintext.extract(spark.createDataFrame(rows, "page_id long, html string, text string"))
    assert sorted(((row.page_id, row.text) for row in found.collect()), key=repr) == [(1, ""), (1, ""), (None, "a b")]
    assert maintext.extract(spark.createDataFrame([], "page_id long, html string")).count() == 0


def test_broken_markup_stays_linear():
    start = time.perf_counter()
    for part in ("<p title=\"", "<", "<a ", "<!--", "<script", "<div>", "&", "<p class='a b' ", "</", "<p>x"):
        blocks(part * 20_000)
    assert time.perf_counter() - start < 30
