from __future__ import annotations

from tempora.llm.urls import alias_edges, filter_urls, rules_table

PAGES = [
    (1, "http://a.net/x", '<link rel="canonical" href="https://www.example.org/es/1">'),
    (2, "http://b.net/y?q=1#f", '<meta http-equiv="refresh" content="0; url=http://a.net/x">'),
    (3, "https://c.net/d/e.html", '<LINK href=/z rel="alternate canonical"/>'),
    (4, "http://c.net/z", None),
    (5, "http://C.net/z", '<meta http-equiv=refresh content="5;URL=//x.org/ok">'),
    (6, None, "<link rel=canonical href=http://z>"),
    (7, "nonsense", ""),
    (8, "http://q.net/p/", '<!-- <link rel=canonical href="http://x.example.org/es/"> --><link rel=canonical href="r&amp;s">'),
    (9, "http://example.org/en/12", ""),
    (10, "http://u.net/", '<link rel=canonical href="http://example.org/en/12">'),
    (11, "http://t.org/", '<link rel=canonical href="http://u.net/">'),
    (12, "http://M.Example.COM/de/1?x://y", ""),
    (13, "http://example.com/fr/", ""),
    (14, "http://notexample.org/es/1", ""),
    (15, "http://example.org", ""),
    (None, "x://H.Example.ORG/ES/", ""),
]
WANT = {1: "block", 2: "block", 3: "allow", 4: "allow", 5: "allow", 6: "allow", 7: "allow", 8: "allow", 9: "block", 10: "allow", 11: "allow",
        12: "block", 13: "allow", 14: "allow", 15: "allow", None: "allow"}


def pages(spark, rows=PAGES):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_rules_and_aliases(spark):
    df = pages(spark, [*PAGES, PAGES[0]]).selectExpr("*", "'x' AS verdict", "'y' AS rule", "'z' AS node")
    got = filter_urls(df, rules_table(spark)).collect()
    assert len(got) == len(PAGES) + 1
    by = {r.page_id: r for r in got}
    assert {k: r.verdict for k, r in by.items()} == WANT
    assert (by[9].rule, by[12].rule, by[13].rule, by[14].rule, by[1].rule, by[15].rule) == ("example.org/en/1", "com/de/", "com/fr/", "org/", None, None)
    assert (by[12].host, by[12].path) == ("m.example.com", "/de/1") and (by[6].host, by[6].path) == ("", "")


def test_edges(spark):
    got = {(r.u, r.v) for r in alias_edges(pages(spark)).collect()}
    assert ("://q.net/p/", "://q.net/p/r&s") in got and ("://b.net/y?q=1", "://a.net/x") in got and len(got) == 7


def test_given_redirects_and_empty_table(spark):
    df = pages(spark, [(1, "http://a.net/", ""), (2, "http://b.net/", "")])
    redirects = spark.createDataFrame([("http://a.net/#x", "http://example.org/es/"), (None, "http://b.net/")], "src string, dst string")
    got = {r.page_id: r.verdict for r in filter_urls(df, rules_table(spark), redirects).collect()}
    assert got == {1: "block", 2: "allow"}
    assert filter_urls(df.limit(0), rules_table(spark)).count() == 0
