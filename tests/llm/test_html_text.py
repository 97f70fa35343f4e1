from __future__ import annotations

import html
import re

from tempora.llm.html_text import extract_text, lines, main_text


def test_article_of_test_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    raw = {r.page_id: r.html for r in pages.collect()}
    got = extract_text(pages).collect()
    assert len(got) == len(raw)
    for r in got:
        body = raw[r.page_id].split("<article>")[1].split("</article>")[0]
        body = re.sub("<(?:p|/p|h1|/h1|br)>", " ", body)
        assert r.text == " ".join(html.unescape(re.sub("<[^>]*>", "", body)).split()) and r.n_chars == len(r.text)


def test_structure():
    page = """<html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header>
    <nav><ul><li><a href=/>Home</a></li></ul></nav><div class="cookie-notice">We use cookies</div>
    <main><h1>Head&amp;line</h1><p>First <b>bold</b>\n\t text.<p>Short.<script>var a="</p>";</script>
    <div class="ad">Buy!</div><aside>See also</aside><ul><li>one<li>two</ul><form>Name <input></form><p>a &lt;b&gt; c</p>
    <section id="comments"><p>Nice article, thank you very much for writing all of this.</p></section></main>
    <div class=sidebar>Side</div><footer>(c)</footer></body></html>"""
    assert main_text(page) == "Head&line First bold text. Short. one two a <b> c"


def test_density_where_nothing_marks_the_article():
    long = "A sentence of the real text that goes on for a good while, with commas. " * 3
    page = (f"<div><a href=1>Home</a> <a href=2>News</a></div><div>Top</div><div></div><div class=x><p>{long}</p><p>Short one.</p><p>{long}</p></div>"
            "<div id=footer>Imprint</div>")
    got = main_text(page)
    assert "real text" in got and "Short one." in got and "Imprint" not in got and "Home" not in got


def test_odd_pages(spark):
    cases = [None, "", "   ", "<", "<p", "plain text", "<p>unclosed <b>x", "<!-- only -->", "<script>x", "<article>" + "<p>w</p>" * 20000 + "</article>",
             "a < b & c &eacute; &#x41;", "<div" * 500, '<p title="a>b">q</p>']
    df = spark.createDataFrame([(i, None, h) for i, h in enumerate(cases)] + [(1, "u", "")], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in extract_text(df.selectExpr("*", "1 AS text")).collect()}
    assert got[0] == got[1] == got[2] == got[7] == got[8] == ""
    assert got[5] == "plain text" and got[6] == "unclosed x" and got[9] == " ".join(["w"] * 20000) and got[10] == "a < b & c é A" and got[12] == "q"
    assert extract_text(df.limit(0)).count() == 0


def test_windows_choose_where_tags_mark_an_article_too():
    long = "A sentence of the real text that goes on for a good while, with commas. " * 8
    page = f"<article><p>Teaser.</p></article><div><p>{long}</p><p>Short one.</p><p>{long}</p></div><div>Imprint</div>"
    got = main_text(page)
    assert got.count("real text") == 16 and "Teaser." in got and "Short one." in got
    got = main_text(f"<div>Top</div><article><p>{long}</p><p>Of.</p></article><div>Imprint 2020</div>")
    assert got == " ".join(f"{long} Of.".split())  # short lines outside do not surge
    got = main_text(f"<article><p>{long}</p>" + "<div class=ad>Buy</div>" * 4 + "<p>End.</p></article>")
    assert got.endswith("End.")


def test_test_pages_without_article_tags(spark):
    for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect():
        assert main_text(re.sub("(</?)(?:article|main)>", r"\1div>", r.html)) == main_text(r.html)


def test_names_around_the_article_do_not_drop_it():
    body = "<h1>Title</h1>" + "<p>A sentence of the real text, with commas, that goes on for a while.</p>" * 5
    want = main_text(f"<article>{body}</article>")
    assert want.startswith("Title A sentence") and want.count("real text") == 5
    for page in (f'<div class="content has-sidebar"><article>{body}</article></div>',
                 f'<div id="page" class="no-comments"><article>{body}</article></div>',
                 f'<article class="post share-enabled">{body}</article>',
                 f'<div class="widget"><article class="share">{body}</article></div>',
                 f'<div title="the hidden truth"><article>{body}</article></div>',
                 f'<div class="has-sidebar" title="the hidden truth">{body}</div>',
                 f'<div class="menu"><div id=share>{body}</div></div>',
                 f'<form id=aspnet><div class=ad>Buy</div>{body}</form>'):
        assert main_text(page) == want, page
    for part in ("<div hidden>{}</div>", "<div hidden=''>{}</div>", "<div class='cookie-notice'>{}</div>", "<div id=ad-1>{}</div>",
                 "<section id='comments'><article class=x>{}</article></section>", "<form>{}</form>"):
        assert main_text(f"<main>{body}{part.format('<p>Some other text that is long enough to count.</p>')}</main>") == want, part


def test_deep_and_unmatched_tags_take_linear_time():
    import time

    n = 60_000  # about a megabyte each
    body = "<article><p>" + "some words of an article that goes on " * 20 + "</p></article>"
    for page in ("<i>" * n + "</b>" * n + body, "<i>" * n + "<div></div>" * n + body, "<i>" * n + "</i>" * n + body, "<li><p>" * n + body, "<div>" * n + "<td>" * n + body):
        start = time.process_time()
        assert main_text(page).startswith("some words of an article")
        assert time.process_time() - start < 4


def test_links_and_headings_count_at_any_depth():
    nested = "<article><h1><b><i><u><em>A heading deep down</em></u></i></b></h1>" + "<p>" + "words of the text " * 30 + "</p></article>"
    assert main_text(nested).startswith("A heading deep down words")
    assert [x[3] for x in lines(nested)] == [True, False]
    assert lines("<div><a href='x'><b><i><u><em>all of it a link</em></u></i></b></a></div>")[0][4] == len("all of it a link")
