"""Main text of pages: the article whole, the rest of the page left out."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from waybill.llm.main_text import extract, main_text

PROSE = "This is the text of the author, and it has many of the words that are in any text of this kind, so it is kept by the rules."
REST = {
    "menu": '<nav><ul><li><a href="/a">The news of the day</a></li><li><a href="/b">About the authors and the site</a></ul></nav>',
    "header": "<header><div>The Daily Page, the site of it all, with news of the world</div></header>",
    "footer": "<footer>&copy; 2020 this is the end of the page and all of it is ours</footer>",
    "sidebar": '<div class="sidebar"><p>This is what the others have read on the site, and it was to their liking.</p></div>',
    "aside": "<aside><p>More of the same that you would like to read after this.</p></aside>",
    "notice": '<div id="cookie-notice">We use cookies on this site, and if you are here you agree to all of it.</div>',
    "advert": '<div class="ad">Buy the best of the best now, it is what you want for the house.</div>',
    "form": '<form action="/s"><label>Your name and the name of your dog</label><input name=q><button>Send it to us</button></form>',
    "script": "<script>var t = '</p> the text of a script that is not to be seen in it';</script>",
    "style": "<style>p > a { content: 'the text of it' }</style>",
    "comment": "<!-- the text of a comment that is not to be seen in the page > -->",
    "readers": '<section id="comments"><article class="comment"><p>I think that this is the best text of the year and I want more of it.</p></article></section>',
    "links": '<ul><li><a href="/1">Another text of the same author</a></li><li><a href="/2">And one more of those</a></li></ul>',
}


@pytest.mark.parametrize("kind", REST)
@pytest.mark.parametrize("shell", ["<article>{}</article>", "<div class='post-content'>{}</div>", '<div role="main">{}</div>'])
def test_what_is_not_the_article_is_left_out(kind, shell):
    article = shell.format(f"<h1>A title</h1><p>{PROSE}</p><p>Yes.</p><p>{PROSE}</p>")
    want = "\n\n".join(["A title", PROSE, "Yes.", PROSE])
    for page in (REST[kind] + article, article + REST[kind], REST[kind] + article + REST[kind]):
        assert main_text(f"<!DOCTYPE html><html><head><title>T</title></head><body>{page}</body></html>") == want


def test_within_the_article():
    page = f'<main><h2>T</h2><div class="ad">Buy the best of all.</div><p>Short</p><p>{PROSE}</p><aside>{PROSE}</aside><p>End</p></main>'
    assert main_text(page) == f"T\n\nShort\n\n{PROSE}\n\nEnd"


def test_short_blocks_go_with_their_neighbours():
    links = '<div><a href="/1">One of the texts of the site that are here</a></div>'
    page = f"<body>{links}<div>Menu of it</div>{links}<h2>A title</h2><p>{PROSE}</p><p>Short</p><p>{PROSE}</p></body>"
    assert main_text(page) == f"A title\n\n{PROSE}\n\nShort\n\n{PROSE}"


def test_references_space_and_order():
    page = "<article><p>a &lt;b&gt; &amp;amp; &eacute;&#233;&#xe9; &copy\n\t c&nbsp; d<br>e</p>\n<p>f <b>g</b>h</p><pre>i\n j</pre><table><tr><td>1<td>2<tr><td>3</table></article>"
    assert main_text(page) == "a <b> &amp; ééé © c d e\n\nf gh\n\ni j\n\n1 2\n\n3"


@pytest.mark.parametrize("page, want", [
    ("", ""), ("<p>", ""), ("only text", "only text"), ("a < b and c", "a < b and c"), ('<p title="x>y">z', "z"), ("<p>one<!-- never closed", "one"),
    ("<p>one<script>never closed", "one"), ("<article><p>one</article", "one"), ('<p class="x>one</p><p>two', "one\n\ntwo"), ("<!-->x", "x"),
    ("<ARTICLE><P>One</P></ARTICLE>", "One"), ("<p>one</div></nav></p>two", "one\n\ntwo"), ("<article></article>", ""),
    ("<article><p>Enough.<p>Said.</article><footer>x</footer>", "Enough.\n\nSaid."), ("<nav><ul><li>a<article><p>not a menu</article>", "not a menu"),
])
def test_odd_markup(page, want):
    assert main_text(page) == want


@pytest.mark.parametrize("part", ['<a "', "<", "<!-- ", "<div ", "<nav><main>", "<article>", "<div></p>", "<li><a>", "<span class=ad><a></a>", "&amp;", "<p class=ad>"])
def test_time_in_proportion(part):
    start = time.perf_counter()
    main_text(part * 100_000 + "x")
    assert time.perf_counter() - start < 15


def test_table_with_odd_rows(spark):
    rows = [(1, "u", f"<article><p>{PROSE} \U0001f600</p></article>"), (2, None, None), (None, "v", ""), (1, "u", f"<article><p>{PROSE}</p></article>")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)
    pages = pages.withColumns({c: F.lit("x") for c in ("text", "n_chars", "k0", "k1", "id")})
    found = extract(pages)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    got = sorted(tuple(r) for r in found.fillna({"page_id": -1, "url": ""}).collect())
    assert got == [(-1, "v", "", 0), (1, "u", PROSE, len(PROSE)), (1, "u", PROSE + " \U0001f600", len(PROSE) + 2), (2, "", "", 0)]
    assert extract(pages.where(F.lit(False))).count() == 0


def test_long_page():
    page = "<article>" + f"<p>{PROSE}</p>" * 40_000 + "</article>"
    assert main_text(page) == "\n\n".join([PROSE] * 40_000)
