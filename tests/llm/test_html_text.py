"""Main text of pages: given pages against a plain reading of their article, rules by hand."""

from __future__ import annotations

import html
import re
import time

import pyarrow.parquet as pq
import pytest

from siltbed.llm.html_text import extract_text, page_text

PROSE = "This is the text of the article and it has all of the words that one would expect to be in it. " * 3
PLAIN = " ".join(PROSE.split())


def plain_article(page: str) -> str:
    """The article element of the given pages, which hold headings, paragraphs and <b> only."""
    inner = re.search(r"<article>(.*)</article>", page, re.DOTALL)[1]
    blocks = [re.sub(r"<[^>]*>", "", b.replace("<br>", " ")) for b in re.split(r"</?(?:p|h1)>", inner)]
    return "\n".join(t for t in (" ".join(html.unescape(b).split()) for b in blocks) if t)


def test_given_pages(spark):
    path = "/root/testdata/sf0.01/pages.parquet"
    rows = {r["page_id"]: r for r in pq.read_table(path).to_pylist()}
    got = extract_text(spark.read.parquet(path)).collect()
    assert len(got) == len(rows)
    for r in got:
        want = plain_article(rows[r["page_id"]]["html"])
        assert (r["url"], r["text"], r["n_chars"]) == (rows[r["page_id"]]["url"], want, len(want))


@pytest.mark.parametrize(
    "around",
    [
        "<nav>{}</nav>",
        "<header>{}</header>",
        "<footer>{}</footer>",
        "<aside>{}</aside>",
        "<form action=x><p>{}</p><select><option>{}</select></form>",
        "<div class='cookie-notice'>{}</div>",
        '<div id="sidebar"><div><p>{}</div></div>',
        "<section class=comments><p>{}</p></section>",
        "<div style='display: none'>{}</div>",
        "<p hidden>{}</p>",
        "<div role=navigation>{}</div>",
        "<script>var x = '</p>{}';</script>",
        "<style>{}</style>",
        "<!-- {} -->",
        "<noscript>{}</noscript>",
        "<ul><li><a href=a>{}</a><li><a href=b>{}</a></ul>",
    ],
)
@pytest.mark.parametrize("marked", [True, False])
def test_what_is_not_the_article(around, marked):
    out = around.replace("{}", PROSE)
    article = f"<p>{PROSE}</p>"
    page = f"<body>{out}{'<article>' + article + '</article>' if marked else article}{out}</body>"
    assert page_text(page) == PLAIN


@pytest.mark.parametrize("around", ["<div class=ad>{}</div>", "<div class='comment-list'><p>{}</div>", "<footer>{}</footer>"])
def test_inside_an_article(around):
    page = f"<article><header><h1>Head line</h1></header><p>{PROSE}{around.replace('{}', PROSE)}<p>The end.</article>"
    assert page_text(page) == f"Head line\n{PLAIN}\nThe end."


def test_ambiguous_blocks_follow_their_neighbours():
    menu = "<ul><li><a href=x>Home page</a></li></ul>"
    page = f"<body>{menu}<p>Between.</p>{menu}<h2>Heading</h2><p>{PROSE}</p><p>Short line.</p><p>{PROSE}</p>{menu}<p>Last.</p>{menu}"
    assert page_text(page) == f"Heading\n{PLAIN}\nShort line.\n{PLAIN}"
    # Few stop words: not prose.
    assert page_text("<body><p>" + "word list item price " * 20 + "</p></body>") == ""
    # A page of short blocks in a marked article keeps them all.
    assert page_text("<article><h1>A</h1><p>b</p><p><a href=x>more</a></article>") == "A\nb"


def test_names_of_the_whole_page_and_of_what_an_element_has():
    assert page_text(f"<body class='nav-open'><div class='has-sidebar'><p>{PROSE}</p></div></body>") == PLAIN
    assert page_text(f"<main class='with-ads'><p>{PROSE}</p></main>") == PLAIN


def test_text_of_blocks():
    page = "<article><p>a &amp; b&nbsp;c &lt;d&gt; &#233;&#x41; <b>x</b>y\n\n z<br>w<br><br>v</p><p> \n </p>tail < 3</article>"
    assert page_text(page) == "a & b c <d> éA xy z w\nv\ntail < 3"
    assert page_text("<article><p><b>Head.<br><p>One <i>two</i></article>") == "Head.\nOne two"


@pytest.mark.parametrize("page", ["", " ", "plain", "<", "<p", "<!--", "</", "<a b='", "<script>", "&", "<p>x</q></p></p>"])
def test_broken_pages(page):
    assert page_text(page) in ("", "plain", "x", "<", "&")


@pytest.mark.parametrize("piece", ["<a b='", "<", "<a ", "<!--", "<div>", "<ul><li>", '<p a="', "<b>", "</p>x", "&amp", "<p>x"])
def test_time_is_linear(piece):
    start = time.perf_counter()
    page_text(piece * 100_000)
    assert time.perf_counter() - start < 10


def test_awkward_rows(spark):
    rows = [(1, None, None, 0, "x"), (1, "u", "", 0, "x"), (None, "u", f"<p>{PROSE}</p>", 0, "x"), (2, "v", "<article>" + "<p>é 😀</p>" * 200_000, 1, "y")]
    rows.append(rows[2])
    table = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int, text string")
    got = sorted(map(tuple, extract_text(table).collect()), key=repr)
    whole = "\n".join(["é 😀"] * 200_000)
    assert got == sorted([(1, None, "", 0), (1, "u", "", 0), *[(None, "u", PLAIN, len(PLAIN))] * 2, (2, "v", whole, len(whole))], key=repr)
    empty = extract_text(table.limit(0))
    assert empty.columns == ["page_id", "url", "text", "n_chars"] and empty.count() == 0
