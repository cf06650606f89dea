"""Main text of pages: markup, noise by meaning, noise by entropy."""

import html
import re

import pytest

from conftest import SF_SMALL
from trip_engine.llm import html_tree


@pytest.mark.parametrize("page, text", [
    ("<p>a<b>b</b>c<p>d", "abc d"),
    ("<p>&lt;x&gt; &amp;&nbsp;&eacute;&#x41;</p>", "<x> & éA"),
    ("<article><h1>T</h1><p>one<br>two</article><div>outside</div>", "T one two"),
    ("<script>if (a < b) { '</p>' }</script><style>p{}</style><!-- <p>no</p> --><p>yes", "yes"),
    ("<SCRIPT>x</SCRIPT ><P CLASS=a>Y</P>", "Y"),
    ("<nav><ul><li>menu</ul></nav><header><h1>Site</h1></header><p>x</p><footer>f</footer>", "x"),
    ("<div class='site-sidebar'><article>in</article></div>text", "text"),
    ("<body class=has-sidebar><article><header><h1>H</h1></header>b<div class=comments>c</div></article>", "H b"),
    ("<article>a<form>f<input></form><aside>s</aside><div id=commentList>c</div>z</article>", "a z"),
    ("<div style='display: none'>no</div><div hidden>no</div><div aria-hidden=true>no</div>yes", "yes"),
    ("<ul><li>a<li>b<ul><li>c</ul></ul><table><tr><td>1<td>2<tr><td>3</table>", "a b c 1 2 3"),
    ("a < b and c > d", "a < b and c > d"),
    ("<p title='a > b'>x</p><p title=\"broken>y</p>", "x y"),
    ("<article><p>kept <a href=/x>link</a>.</p>", "kept link."),
    ("<article><p>cut off <sc", "cut off"),
    ("<article><div class=cookie-notice>n</div><div class='ad'>a</div><p>t</p></article>", "t"),
    ("</div></p></article>x", "x"),
    ("<title>t</title><noscript>n</noscript><textarea>t</textarea><p>p", "p"),
])
def test_pages(page, text):
    assert html_tree.main_text(page) == text


STORY = "a story that is told in some more words than all that stands around it"


@pytest.mark.parametrize("page", [
    f"<body><div class='layout has-sidebar'><article><p>{STORY}</article><div class=sidebar>s</div></div>",
    f"<div id='search-page'><main><h1>{STORY}</h1></main></div><div>(c)</div>",
    f"<div class='social-post'><article><header>{STORY}</header></article></div>",
    f"<form id=aspnetForm><nav>menu</nav><div id=content><p>{STORY}</p></div><div class=comments>c</div></form><p></p>",
    f"<form id=aspnetForm><div class=pageMenu><article>{STORY}</article></div></form>",
    f"<main><div class='has-sidebar'><div class=text>{STORY}</div><aside>{STORY} aside</aside></div></main>",
    f"<article class='social-post'>{STORY}</article><footer>{STORY}</footer>",
])
def test_a_noise_name_does_not_swallow_the_page(page):
    assert html_tree.main_text(page) == STORY


def test_a_noise_name_holds_beside_the_text():
    assert html_tree.main_text(f"<article>{STORY}</article><div class=comments><article>c</article></div>") == STORY
    assert html_tree.main_text(f"<p>{STORY}</p><div class=comments>{STORY} twice as long {STORY}</div>") == STORY
    assert html_tree.main_text(f"<nav>{STORY}</nav>") == ""


def test_lifted_branches_are_measured(spark):
    """Under a wrapper with a noise name, too, blocks that repeat over a host go."""
    rows = [(i, f"http://one.org/{i}", f"<body><div class=has-sidebar><div class=x1>Call us now {i % 2}</div>"
             f"<div class=y><p>Unique story number {i} with its own words</p></div></div></body>") for i in range(12)]
    got = {r["text"] for r in html_tree.op1_html_extraction(
        spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {f"Unique story number {i} with its own words" for i in range(12)}


def test_template_noise_goes_by_entropy(spark):
    """Blocks without telling names that repeat over a host's pages go; the
    same words on another host, or articles that repeat, stay."""
    rows = []
    for i in range(12):
        rows.append((i, f"http://one.org/{i}", f"<body><div class=x1>Call us now {i % 2}</div>"
                     f"<div class=y><p>Unique story number {i} with its own words</p></div></body>"))
    for i in range(12, 24):
        rows.append((i, f"http://copies.org/{i}", "<body><article><p>The same article everywhere</p></article></body>"))
    rows.append((99, "http://lonely.org/", "<body><div class=x1>Call us now 0</div></body>"))
    got = {r["page_id"]: r["text"] for r in html_tree.op1_html_extraction(
        spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[3] == "Unique story number 3 with its own words"
    assert got[12] == "The same article everywhere" and got[99] == "Call us now 0"


def test_host_is_the_same_in_sql(spark):
    urls = ["http://A.b/c", "https://u:p@h:80/x", "//h/x", "h/x", "", None, "ftp://x?y", "http://", " http://s.t#f", "mailto:a@b"]
    frame = spark.createDataFrame([(u,) for u in urls], "url string")
    got = [r[0] for r in frame.select(html_tree._host_column()).collect()]
    assert got == [html_tree.host_of(u) for u in urls]


def test_whole_table_against_a_plain_reader(spark):
    """The given pages have one article each: a reader that knows this gives the same text."""
    def plain(page):
        m = re.search(r"<article>(.*?)(</article>|<footer>|\Z)", page, re.DOTALL)
        inner = re.sub(r"<!--.*?-->", "", m[1], flags=re.DOTALL)
        inner = re.sub(r"</?(p|h1|br)\b[^>]*>", " ", inner)
        return " ".join(html.unescape(re.sub(r"</?[a-z][^>]*>", "", inner)).split())

    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    want = {r["page_id"]: plain(r["html"]) for r in pages.collect()}
    got = html_tree.op1_html_extraction(pages).collect()
    assert {r["page_id"]: r["text"] for r in got} == want
    assert all(r["n_chars"] == len(r["text"]) for r in got)
