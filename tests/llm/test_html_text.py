"""Main text of pages: a plain version on the table, hand-made pages."""

import html
import re

import pytest
from pyspark.sql import functions as F

from starmart.llm.html_text import content_lines, extract, main_text

SF = "/root/testdata/sf0.01"


def brute(page):
    """The article's blocks by regex; holds for the table's plain pages."""
    article = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = re.split(r"</?(?:h1|p)>", article)
    texts = (" ".join(html.unescape(re.sub(r"<[a-z/][^>]*>", " " if "br" in b else "", b)).split())
             for b in blocks)
    return "\n".join(t for t in texts if t)


def test_against_the_table(spark):
    rows = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: r.text for r in extract(rows).collect()}
    pages = rows.collect()
    assert len(got) == len(pages)
    for r in pages:
        assert got[r.page_id] == brute(r.html), r.page_id


LONG = "This is a long paragraph of the article, with many words and hardly any markup in it. " * 3
PAGE = f"""<html><head><title>T</title><style>p{{}}</style></head><body class="has-sidebar">
<header><h1>Site name</h1><a href=/>Home</a></header>
<ul class=menu><li><a href=/a>One</a><li><a href=/b>Two</a></ul>
<div id="cookie-notice"><p>We use cookies. {LONG}</p></div>
<div id=content><h1>Head&shy;line &amp; more</h1>
<p>{LONG}<p>Short.
<div class="ad-box">Buy now. {LONG}</div>
<p>A <b>bold</b><i>word</i> and<br>a&nbsp;break</p>
<form><p>Your name <input name=x></p></form>
<p>{LONG}</p><script>var a = "<p>no</p>";</script></div>
<aside><p>{LONG}</p></aside>
<section id=comments><p>{LONG}</p></section>
<footer>&copy; me</footer></body></html>"""


def test_page_without_article():
    one = " ".join(LONG.split())
    assert main_text(PAGE).split("\n") == ["Head\xadline & more", one, "Short.",
                                           "A boldword and a break", one]


@pytest.mark.parametrize("page,want", [
    (None, ""), ("", ""), ("   ", ""), ("plain text only", "plain text only"),
    ("<article><h1>Hi</h1><p>A.</p><p>B &lt; C</article><footer>x</footer>", "Hi\nA.\nB < C"),
    ("<nav>menu</nav>", ""), ("<p>unclosed <b>bold", "unclosed bold"),
    ("<article><p>x</p><!-- <p>no</p> --></article>", "x"),
    ("<main><ul><li><a>a</a><li><a>b</a><li><a>c</a></ul><p>text here</p></main>", "text here"),
    ("<article><ul><li>one</li><li>two</li><li>three</li></ul></article>", "one\ntwo\nthree"),
    ("<article><div class='comments'><p>no</p></div><p>yes</p></article>", "yes"),
    ("<div hidden>no</div><p>yes</p>", "yes"),
])
def test_small_pages(page, want):
    assert main_text(page) == want


@pytest.mark.parametrize("page", [
    "<div class='content-sidebar-wrap'><main><article>{}</article></main></div>",
    "<div class='page right-sidebar'>{}</div>", "<div class='container no-sidebar'>{}</div>",
    "<div id='layout with-header'><article>{}</article></div>",
    "<form id=aspnetForm><div>{}</div><input name=x></form>",
    "<article><div class='widget'>{}</div></article>",
    "<div class='page right-sidebar'><div>{}</div><div class=sidebar><p>Other. " + LONG + "</p></div></div>",
])
def test_marked_wrappers_keep_the_page(page):
    one = " ".join(LONG.split())
    text = f"<div class='post-header'><h1>Headline</h1></div><p>{LONG}</p><p>Short.</p><p>{LONG}</p>"
    page = ("<body><div class=header><h1>Site</h1></div>" + page.format(text)
            + f"<ol class=comments><li><article class=comment><p>{LONG * 3}</p></article></ol></body>"
            if "article" in page else page.format(text))
    assert main_text(page).split("\n") == ["Headline", one, "Short.", one]


@pytest.mark.parametrize("page", [
    "<div id=content><h1>Headline</h1><section>{0}{0}</section><section><p>Short.</p>{0}</section></div>",
    "<h1>Headline</h1><div id=a><div>{0}{0}</div><div><p>Short.</p>{0}</div></div>",
    "<div><h1>Headline</h1></div><table><tr><td>{0}{0}</td><td><p>Short.</p>{0}</td></tr></table>",
])
def test_whole_content_without_article(page):
    one = " ".join(LONG.split())
    page = f"<body><nav>menu</nav>{page.format(f'<p>{LONG}</p>')}<footer>x</footer></body>"
    assert main_text(page).split("\n") == ["Headline", one, one, "Short.", one]


def test_content_line_outside_the_region():
    one = " ".join(LONG.split())
    page = f"<h2>Top</h2><div>{f'<p>{LONG}</p>' * 60}</div><div><p>{LONG * 3}</p></div><div><a>x</a></div>"
    assert main_text(page).split("\n") == ["Top", *[one] * 60, " ".join([one] * 3)]


def test_very_long_page():
    page = "<nav>x</nav><article>" + "<p>word &amp; word</p>" * 50000 + "</article>"
    assert main_text(page).count("\n") == 49999


def test_threshold_finds_the_upper_cluster():
    import numpy as np
    flags = content_lines(np.array([1, 2, 1, 90, 80, 3, 85, 95, 1, 2, 1.0]))
    assert flags.tolist() == [False] * 3 + [True] * 5 + [False] * 3


def test_corner_tables(spark):
    pages = spark.createDataFrame([(1, None, None), (None, "u", "<p>a</p>"), (1, "v", "<p>a</p>"),
                                   (1, "v", "<p>a</p>")], "page_id long, url string, html string")
    pages = pages.withColumn("text", F.lit("mine"))
    assert sorted(r.text for r in extract(pages).collect()) == ["", "a", "a", "a"]
    assert extract(pages.limit(0)).count() == 0


PARAGRAPHS = [f"This is paragraph {n} of an article, with quite a few words in one long sentence."
              for n in range(6)]
BODY = "".join(f"<p>{t}</p>" for t in PARAGRAPHS)


@pytest.mark.parametrize("html, text", [
    ("<p>Real sentence here. <select><option>Pick</option></select> more.</p>",
     "Real sentence here. more."),
    ("<p>Real sentence. <span hidden>not shown</span> <button>Subscribe</button></p>", "Real sentence."),
    ("<p>One <textarea>t</textarea>two <noscript><div>n</div></noscript>three <svg><text>s</text></svg>"
     "four <template><p>x</p></template>five <span class=advert>Buy</span>six</p>",
     "One two three four five six"),
    ("<p hidden>gone<p>kept text", "kept text"),
    ("<p>before <span style='display: none'><b>x</b></span>after<br>end</p>", "before after end"),
    ("<aside><p>x<ul><li>a<li>b</ul></aside><p>stays</p>", "stays")])
def test_each_piece_of_text_has_its_own_fate(html, text):
    assert main_text(html) == text
    # The same inside an article.
    whole = main_text(f"<article>{BODY}{html}</article>")
    assert whole == "\n".join([*PARAGRAPHS, text])


@pytest.mark.parametrize("section", [
    "<section class='related-work'><h2>Related work</h2><p>{}</p></section>",
    "<section id='market-share'><p>{}</p></section>",
    "<section id='comments-on-method-text'><p>{}</p></section>",
    "<ul><li><a href=a>{}</a></li><li><a href=b>Source two</a></li><li><a href=c>Three</a></li></ul>"])
def test_sections_of_an_article_stay(section):
    words = "Some words that are long enough to be a paragraph of their own here."
    text = main_text(f"<article>{BODY}{section.format(words)}</article>")
    assert words in text.split("\n") and text.startswith("\n".join(PARAGRAPHS))


@pytest.mark.parametrize("box", [
    "<div class='comments'><p>{}</p></div>", "<div id='user-comments'><p>{}</p></div>",
    "<div class='related-posts'><a href=x>{}</a></div>", "<div class='share-buttons'>{}</div>",
    "<div class='newsletter-signup'><p>{}</p></div>", "<form><p>{}</p></form>",
    "<div class='advert-box'><p>{}</p></div>", "<aside><p>{}</p></aside>"])
def test_furniture_of_an_article_goes(box):
    words = "Some words that are long enough to be a paragraph of their own here."
    assert main_text(f"<article>{BODY}{box.format(words)}</article>") == "\n".join(PARAGRAPHS)
