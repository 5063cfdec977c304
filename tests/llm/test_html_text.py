import html
import re

import numpy as np

from newsmart.llm import html_text as H
from newsmart.llm.queries import op9_html_extraction

P1 = "A long paragraph with text &amp; more &eacute; text in <a href=x>links</a> and <i>so</i> on, long enough to count as content."
P2 = "Another&nbsp;long paragraph,\n  with <b>text</b> and more text and so on, long enough to count as content for real now."
T1 = "A long paragraph with text & more é text in links and so on, long enough to count as content."
T2 = "Another long paragraph, with text and more text and so on, long enough to count as content for real now."
JUNK = "<p>This is a rather long text that looks like content but is not the article, it goes on for a while to be sure.</p>"


def test_pages_match_their_articles(spark):
    pages = {r["page_id"]: r for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    for r in op9_html_extraction(spark, "/root/testdata/sf0.01").collect():
        inner = re.search(r"<article>(.*?)</article>", pages[r["page_id"]]["html"], re.S)[1]
        blocks = re.split(r"</?(?:p|h1|h2|ul|li|div)\b[^>]*>", inner.replace("<br>", " "))
        want = "\n".join(x for b in blocks if (x := " ".join(html.unescape(re.sub(r"<[^>]+>", "", b)).split())))
        assert (r["text"], r["n_chars"], r["url"]) == (want, len(want), pages[r["page_id"]]["url"])


def test_markup_that_is_not_the_article():
    for junk in (
        f"<nav>{JUNK}</nav>", f"<header>{JUNK}</header>", f"<footer>{JUNK}</footer>", f"<aside>{JUNK}</aside>", f"<form>{JUNK}</form>",
        f'<div class="cookie-notice">{JUNK}</div>', f'<div id="sidebarLeft sidebar">{JUNK}</div>', f'<div class="ad-box">{JUNK}</div>',
        f'<section id="comments">{JUNK}</section>', f'<div role="navigation">{JUNK}</div>', f'<div style="display: none">{JUNK}</div>',
        "<script>if (a < b) { '<p>x</p>' }</script>", "<style>p > a {}</style>", "<!-- <p>x</p> -->",
    ):
        for body in (f"{junk}<article><h1>Title</h1><p>{P1}</p><p>Short.</p><p>{P2}</p></article>{junk}",
                     f'<div id="page">{junk}<div class="story"><h1>Title</h1><p>{P1}<p>Short.<p>{P2}</div>{junk}</div>',
                     f"<article><h1>Title</h1><p>{P1}</p>{junk}<p>Short.</p><p>{P2}</p></article>"):
            if junk.startswith("<header") and body.startswith("<article><h1"):
                continue  # an article's own header is part of it
            page = f"<!DOCTYPE html><html><head><title>Site - Title</title></head><body>{body}</body></html>"
            assert H.main_text(page) == f"Title\n{T1}\nShort.\n{T2}", body


def test_misleading_names():
    inner = f'<h1>Title</h1><p>{P1}</p><p>{P2}</p>'
    want = f"Title\n{T1}\n{T2}"
    for page in (
        f'<body><div class="wrap has-sidebar"><article>{inner}</article></div></body>',
        f'<body><form id="aspnetForm"><div>{inner}</div></form></body>',
        f'<article><div class="article-header"><h1>Title</h1></div><p>{P1}</p><p>{P2}</p></article>',
        f'<div class="comment-less sidebarish">{inner}</div>',
        f'<article>{inner}<div class="adslot">{JUNK}</div><div id="cookieBanner">{JUNK}</div></article>',
        f'<article>{inner}<footer>{JUNK}</footer><div class="user-comments"><p>{JUNK}</p></div></article>',
    ):
        assert H.main_text(page) == want, page


def test_regions_find_the_article_without_any_name():
    links = "".join(f"<li><a href=/{i}>Link {i}</a></li>" for i in range(12))
    page = f"<body><div><div><ul>{links}</ul></div><div><h2>Title</h2><p>{P1}</p><p>{P2}</p><p>End.</p></div><div><ul>{links}</ul></div></div></body>"
    assert H.main_text(page) == f"Title\n{T1}\n{T2}\nEnd."


def test_blocks_and_lists():
    page = f"<article><h1> A\n title </h1><ul><li>One<li>Two <b>bold</b></ul><table><tr><td>c1<td>c2</table><p>{P1}<br>tail</article>"
    assert H.main_text(page) == f"A title\nOne\nTwo bold\nc1\nc2\n{T1} tail"


def test_smoothing_and_threshold():
    assert np.allclose(H.smooth(np.ones(5)), 1)
    assert 1 < H.threshold(np.array([0.0, 1, 1, 9, 10])) < 9
    assert H.threshold(np.array([2.0, 2.0])) < 2


def test_broken_and_empty_pages():
    for page in (None, "", "<html></html>", "<script>x", "<p></p>"):
        assert H.main_text(page) == ""
    assert H.main_text("just text &lt;3") == "just text <3"
    assert H.main_text("<article><p>One two three.</b></div><p>Four") == "One two three.\nFour"
    deep = "<div>" * 3000 + "<p>deep text</p>"
    assert H.main_text(deep) == "deep text"


def test_rows(spark):
    rows = [(1, "u", "<p>a</p>"), (1, "u", "<p>a</p>"), (None, None, None), (2, "u", "")]
    frame = spark.createDataFrame([(*r, "c", "c") for r in rows], "page_id bigint, url string, html string, text string, n_chars string")
    got = sorted(((r["page_id"], r["url"], r["text"], r["n_chars"]) for r in H.extract(frame).collect()), key=repr)
    assert got == sorted([(1, "u", "a", 1), (1, "u", "a", 1), (None, None, "", 0), (2, "u", "", 0)], key=repr)
    assert H.extract(frame.limit(0)).count() == 0


def test_title_and_lead_outside_a_nested_body():
    lead, want = "<p>The lead, in a few words.</p>", f"Title\nThe lead, in a few words.\n{T1}\n{T2}"
    links = "".join(f"<li><a href=/{i}>Link {i}</a></li>" for i in range(12))
    body, more = f"<p>{P1}</p><p>{P2}</p>", f"<div><ul>{links}</ul></div>"
    for page in (
        f'<article><h1>Title</h1>{lead}<div class="entry-content">{body}</div></article>',
        f'<article><div class="post"><h1>Title</h1>{lead}<div class="entry-content">{body}</div></div></article>',
        f'<main><article><h1>Title</h1>{lead}<article class="text">{body}</article></article></main>',
        f"<main><h1>Title</h1>{lead}<article>{body}</article></main>",
        f'<div class="post"><h1>Title</h1>{lead}<div class="entry-content">{body}</div></div>',
        f'<div><h1>Title</h1>{lead}<div class="entry-content">{body}</div></div>',
        f"<div><h1>Title</h1>{lead}<section>{body}</section></div>",
        f"<div><h1>Title</h1>{lead}<div><div>{body}</div></div></div>",
        f"<div><h1>Title</h1>{lead}<blockquote>{body}</blockquote></div>",
    ):
        for around in (page, f"<body>{more}{page}{more}</body>", f"<body><div>{more}<div>{page}</div>{more}</div></body>"):
            assert H.main_text(around) == want, around


def test_paragraphs_beside_a_long_section():
    long = " ".join([P1] * 5)
    links = "".join(f"<li><a href=/{i}>Link {i}</a></li>" for i in range(12))
    got = H.main_text(f"<body><ul>{links}</ul><div><p>{P1}</p><section><p>{long}</p><p>{long}</p></section><p>{P2}</p></div></body>")
    assert got == "\n".join([T1, " ".join([T1] * 5), " ".join([T1] * 5), T2])


PARA = "The committee met on Tuesday to decide on the new line, and nobody was surprised at what it said. " * 2


def test_names_do_not_remove_prose_within_the_article():
    body = (
        f'<h2 class="side">A side matter</h2><p>{PARA}</p><p class="legal">What the law says on it.</p><p class="share-price">Shares rose.</p>'
        f'<fieldset><legend>In short</legend><p>Three points.</p></fieldset><div class="trending"><p>{PARA}</p></div><p>{PARA}</p>'
    )
    page = f"<html><body><nav><a href=x>Home</a></nav><article><h1>Title</h1>{body}</article><footer>Imprint</footer></body></html>"
    para = PARA.strip()
    assert H.main_text(page).split("\n") == [
        "Title", "A side matter", para, "What the law says on it.", "Shares rose.", "In short", "Three points.", para, para
    ]


def test_banners_comments_and_link_lists_go():
    page = (
        f'<body><article><h1>Title</h1><div class="js-cookie-banner"><p>We use cookies.</p></div><p>{PARA}</p><p class="ad">Buy this.</p>'
        f'<div class="related"><ul><li><a href=a>Another story of the day</a></li><li><a href=b>One more of them</a></li></ul></div>'
        f'<div class="responses"><p>{PARA} I read this twice.</p></div><ul class="feedback-list"><li>{PARA} Great!</li></ul></article></body>'
    )
    assert H.main_text(page).split("\n") == ["Title", PARA.strip()]


def test_a_text_in_two_articles_of_one_main():
    page = (
        f"<body><nav>Menu</nav><main><article><h2>First part</h2><p>{PARA}</p><p>{PARA}</p></article>"
        f"<article><h2>Second part</h2><p>{PARA}</p></article></main><aside>More</aside></body>"
    )
    para = PARA.strip()
    assert H.main_text(page).split("\n") == ["First part", para, para, "Second part", para]


def test_a_very_long_page():
    page = "<body><nav>Menu</nav><article>" + f"<p>{PARA}</p>" * 20_000 + "</article></body>"
    assert H.main_text(page) == "\n".join([PARA.strip()] * 20_000)
