import html
import re
import time

import pytest

from tests.llm.conftest import SF_DIR
from viewtide.llm import html_text
from viewtide.llm.queries import op10_main_text

PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style>
<script>var t="</p><article>no</article>";</script></head><body class="has-sidebar">
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav>
<!-- <article>hidden</article> --><div class="ad">Buy</div>
<div class="cookie-notice">We use cookies</div>
<article><header><h1>A <b>title</b></h1></header><p>One&nbsp;&amp; two<br>three &#x41;
  four <p>3 < 4 <a href="x>y">link</a>ed<aside>side</aside>
<form><input value="q"><label>Search</label></form><ul><li>x<li>y</ul>
<section id="comments"><article class="comment"><p>first!</p></article></section></article>
<aside class="sidebar">more</aside><footer>&copy; us</footer></body></html>"""


def test_article_of_a_whole_page():
    assert html_text.extract(PAGE) == "A title\nOne & two three A four\n3 < 4 linked\nx\ny"


@pytest.mark.parametrize("page", [None, "", " ", "<html></html>", "<script>x", "<!-- open",
                                  "<nav>menu</nav>", "<div class='ad'>x</div>"])
def test_pages_without_text(page):
    assert html_text.extract(page) == ""


def test_broken_markup():
    assert html_text.extract("<article><p>a<p>b</div></p>c") == "a\nb\nc"
    assert html_text.extract("<div class=ad>x<article>kept</article>") == "kept"
    assert html_text.extract("just text & more &lt;b>") == "just text & more <b>"
    assert html_text.extract('<article><p title="a>b" data-x="unclosed>t</p>') != ""
    assert html_text.extract("<article>" + "<p>word</p>" * 30_000).count("\n") == 29_999


def test_lines_between_surge_and_dive():
    lines = [0, 0, 5, 0, 0, 0, 40, 100, 0, 80, 3, 0, 0, 0, 10]
    kept = html_text.main_lines(lines, 3, 86)
    assert [i for i, keep in enumerate(kept) if keep and lines[i]] == [6, 7, 9, 10]


def test_page_without_article_element():
    page = ("<div><a>Menu</a></div><div>x</div><div></div><div></div><div></div><h2>Head</h2>"
            "<div>" + "long text " * 20 + "</div><div>tail</div>")
    assert html_text.extract(page) == "Head\n" + ("long text " * 20).strip() + "\ntail"


def test_query_returns_the_article_blocks(spark, table):
    rows = {r["page_id"]: r for r in op10_main_text(spark, SF_DIR).collect()}
    assert len(rows) == table("pages").count()
    for page in table("pages").collect():
        article = re.search(r"<article>(.*?)</article>", page["html"], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", part)).split())
                  for part in re.split(r"</?(?:h1|p)>", article)]
        row = rows[page["page_id"]]
        assert row["text"] == "\n".join(filter(None, blocks))
        assert (row["url"], row["n_chars"]) == (page["url"], len(row["text"]))


def test_awkward_rows(spark):
    pages = spark.createDataFrame(
        [(1, None, None, "x"), (None, "u", "<p>a", "x"), (2, "u", "", None), (2, "u", "", None)],
        "page_id LONG, url STRING, html STRING, text STRING")
    rows = html_text.extract_pages(pages)
    assert rows.columns == pages.columns
    assert sorted(r["text"] for r in rows.collect()) == ["", "", "", "a"]
    assert html_text.extract_pages(pages.filter("false")).count() == 0


@pytest.mark.parametrize("tag", ["button", "select", "noscript", "svg", "object", "video"])
def test_unclosed_element_does_not_cut_the_page(tag):
    assert html_text.extract(f"<body><{tag}>x<article><p>kept</p></article>") == "kept"
    assert html_text.extract(f"<article><p>a</p><div><{tag}></div><p>b</p></article>") == "a\nb"
    assert html_text.extract(f"<article><p>a<{tag}>x</{tag}>b</p></article>") == "ab"
    assert html_text.extract(f"<body><{tag}><p>plain") == "plain"


def test_text_of_formulas_stays():
    page = "<article><p>a <math><mi>x</mi><mo>=</mo><mn>1</mn></math> b</p></article>"
    assert html_text.extract(page) == "a x=1 b"


def test_short_blocks_without_article():
    long, short = "long text " * 20, "a paragraph of fifty characters, more or less, here"
    page = "".join(f"<div><div><p>{text}</p></div></div>" for text in (long, short, long))
    assert html_text.extract(page) == "\n".join((long.strip(), short, long.strip()))
    rows = "".join(f"<tr><td>row {i}</td></tr>" for i in range(9))
    page = f"<div><p>{long}</p></div><table><tbody>{rows}</tbody></table>"
    assert html_text.extract(page).split("\n")[1:] == [f"row {i}" for i in range(9)]
    page = f"<p>{long}</p><div class=ad>" + "<p>Buy</p>" * 4 + "</div><p>tail</p>"
    assert html_text.extract(page) == long.strip()


@pytest.mark.parametrize("page", [
    "<article><p>One.</p><script src=a.js />var x = 1;</script><p>Two.</p></article>",
    "<article><p>One.</p><div class=sidebar/>Offers</div><p>Two.</p></article>",
    "<article><p>One.</p><p><a href=/docs/>Two.</a></p></article>",
    "<article><p>One.</p><nav/><a href='x'>Menu</a></nav><p>Two.</p></article>",
    '<article><p>One.</p><svg/><p>Two.</p></article>',
    '<article><p>One.</p><a name="x"/><p>Two.</p></article>',
    '<article><p>One.</p><svg><path d="m"/><circle/></svg><p>Two.</p></article>'])
def test_a_slash_closes_foreign_elements_only(page):
    assert html_text.extract(page) == "One.\nTwo."


@pytest.mark.parametrize("piece", ["<b>", "</i>", "<b></i>", "<div>", "</div>", "<p>x", "<nav>"])
def test_unpaired_tags_take_linear_time(piece):
    page = piece * (400_000 // len(piece)) + "<article><p>Text of the page.</p></article>"
    start = time.process_time()
    html_text.extract(page)
    assert time.process_time() - start < 8
