"""Main text of web pages by the distribution of text over line blocks.

Markup is stripped to lines, one per block of the page; lines whose place in
the page says that they are not the article (menus, headers, footers,
sidebars, notices, adverts, forms, comments) go like scripts. A line counts
with the length of its text times a weight: more inside article or main and
for a main heading, less outside on a page that has one, nothing for lists of
links. The sums over
windows of a few lines say on every page where text starts (they surge) and
ends (they dive), and the lines in between are kept.
"""

from __future__ import annotations

import html as entities
import re
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempora.llm.common import map_arrow

WINDOW = 3  # lines of a block
SURGE = 60  # weighted characters in a block where text starts
DIVE = 10  # fewer end it
MARKED, OUTSIDE = 8, 0.25  # weights of headings and lines in an article, and of others on a page that has one; else 1
TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+|[^>]*)(?:>|\Z)""", re.S)
NAMED = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
# Elements and names.
RAW = {"script", "style", "noscript", "template", "textarea", "iframe", "object", "svg", "title", "xmp", "select"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCKS = {"address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "div", "dl", "dt", "fieldset",
          "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "li", "main", "menu",
          "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
ASIDE = {"nav", "aside", "footer", "form", "menu", "dialog", "button", "head"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "menu", "menubar"}
NAMES = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion", "banner",
         "cookie", "cookies", "consent", "gdpr", "notice", "notices", "alert", "newsletter", "subscribe", "signup", "login", "sidebar",
         "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "footer", "masthead", "topbar", "toolbar", "comment",
         "comments", "commentlist", "respond", "disqus", "replies", "social", "share", "sharing", "related", "recommended", "popup",
         "modal", "overlay", "widget", "pagination", "pager"}
ARTICLE = {"article", "main"}
SPLIT = re.compile(r"[-_]+")


def _named(name: str, names: set[str]) -> bool:
    """A whole class name: one of ``names``, or several of them and numbers joined (cookie-notice, ad-1; not has-sidebar)."""
    parts = [x for x in SPLIT.split(name) if x and not x.isdigit()]
    return bool(parts) and all(x in names for x in parts)


def _boilerplate(tag: str, attributes: str, in_article: bool) -> int:
    """2 where the element itself says so, 1 where only its names, role, style or form do (see ``lines``), else 0."""
    if tag in ASIDE or tag == "header" and not in_article:
        return 1 if tag == "form" else 2
    if not attributes or tag in ("html", "body", "main", "article"):
        return 0
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in NAMED.finditer(attributes)}
    names = f"{found.get('class', '')} {found.get('id', '')}".lower().split()
    if any(_named(x, NAMES) for x in names) or "header" in names and not in_article:
        return 1
    return int(found.get("role", "").lower() in ROLES or found.get("aria-hidden", "").lower() == "true" or "hidden" in found
               or "display:none" in found.get("style", "").replace(" ", "").lower())


def lines(page: str) -> list[tuple[str, bool, bool, bool, int]]:
    """(text, is boilerplate, is in an article, is a main heading, characters of links) of every block with text, in page order.

    Names, roles, styles and forms are no boilerplate around the page itself:
    an element that holds an article or main (not one inside another), or
    most of the page's text without links, in ``WINDOW`` lines or more.
    """
    out: list[tuple[str, int, bool, bool, int]] = []  # with the innermost element that may be boilerplate
    stack: list[tuple[str, int, bool]] = []  # tag, such an element or 0, article: as they hold inside
    sure, outer, whole = [0], [0], {0}  # of such elements, from 1: 2 if the tag says so, the one around, those that hold an article
    tags: dict[str, int] = {}  # how many of a tag are open
    blocks: list[int] = []  # where in the stack the block elements are
    text: list[str] = []
    linked = 0
    at, n = 0, len(page)

    def end_line():
        nonlocal linked
        if text:
            line = " ".join(entities.unescape("".join(text)).split())
            if line:
                _, bad, art = stack[-1] if stack else ("", 0, False)
                out.append((line, bad, art, tags.get("h1", 0) > 0, linked))
            text.clear()
        linked = 0

    def cut(k: int):
        for s in stack[k:]:
            tags[s[0]] -= 1
        del stack[k:]
        while blocks and blocks[-1] >= k:
            blocks.pop()

    def close(k: int):
        end_line()
        cut(k)

    while at < n:
        m = TAG.search(page, at)
        got = page[at:m.start()] if m else page[at:]
        if got:
            text.append(got)
            if tags.get("a", 0):
                linked += len(got)
        if not m:
            break
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if tag == "br":
            text.append(" ")
        elif m[1]:
            if tags.get(tag, 0):
                k = next(k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag)
                if tag in BLOCKS or blocks and blocks[-1] >= k or stack[k][1] != (k > 0 and stack[k - 1][1]):
                    close(k)
                else:
                    cut(k)
            elif tag in BLOCKS:
                end_line()
        else:
            if tag in ("li", "dt", "dd", "tr", "td", "th"):  # these end an open one of their kind, and a paragraph on the way
                for k in reversed(blocks):
                    if stack[k][0] == tag or tag in ("td", "th") and stack[k][0] in ("td", "th"):
                        close(k)
                        break
                    if stack[k][0] != "p":
                        break
            elif tag in BLOCKS and blocks and stack[blocks[-1]][0] == "p":  # a block ends an open paragraph
                close(blocks[-1])
            if tag in RAW:
                end = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
                at = end.end() if end else n if tag in ("script", "style", "template", "xmp", "textarea", "title") else at
                continue
            _, bad, art = stack[-1] if stack else ("", 0, False)
            doubt = _boilerplate(tag, m[3], art)
            if tag in BLOCKS or doubt:
                end_line()
            if tag not in VOID and not m[3].endswith("/"):
                if tag in ARTICLE and not art:
                    k = bad
                    while k not in whole:
                        whole.add(k)
                        k = outer[k]
                if doubt:
                    sure.append(doubt)
                    outer.append(bad)
                    bad = len(sure) - 1
                stack.append((tag, bad, art or tag in ARTICLE))
                tags[tag] = tags.get(tag, 0) + 1
                if tag in BLOCKS:
                    blocks.append(len(stack) - 1)
    end_line()
    own = [[0, 0] for _ in sure]  # lines and their characters
    for line, k, _, _, linked in out:
        if 2 * linked <= len(line):
            own[k][0] += 1
            own[k][1] += len(line)
    for k in range(len(sure) - 1, 0, -1):  # the ones inside come later
        own[outer[k]][0] += own[k][0]
        own[outer[k]][1] += own[k][1]
    gone = [False] * len(sure)
    for k in range(1, len(sure)):
        most = own[k][0] >= WINDOW and 2 * own[k][1] > own[0][1]
        gone[k] = gone[outer[k]] or sure[k] == 2 or not (most or k in whole)
    return [(line, gone[k], art, head, linked) for line, k, art, head, linked in out]


def _text(size: list[float], surge: float) -> list[int]:
    """The lines from surge to dive, every time the window sums rise to ``surge``; lines without size are left out."""
    sums = [sum(size[i:i + WINDOW]) for i in range(max(1, len(size) - WINDOW + 1))]
    kept, inside, done = [], False, 0
    for i, total in enumerate(sums):
        inside = total > 0 and (total >= surge or inside and total >= min(DIVE, surge))
        if inside:  # the window's lines, but for those of the window before
            kept += [k for k in range(max(i, done), min(i + WINDOW, len(size))) if size[k]]
            done = i + WINDOW
    return kept


def main_text(page: str | None) -> str:
    """The article of a page; empty for a null or empty page."""
    found = [x for x in lines(page) if not x[1]] if page else []
    article = any(art for _, _, art, _, _ in found)
    plain = OUTSIDE if article else 1
    size = [len(line) * (MARKED if art else 0 if 2 * linked > len(line) else MARKED * plain if head else plain)
            for line, _, art, head, linked in found]
    kept, start = [], 0
    for art, some in groupby(found, key=lambda x: x[2]):  # no window reaches over an article's edge
        stretch = size[start:start + len(list(some))]
        # Short pages and short articles: the most that a window holds.
        most = max((sum(stretch[i:i + WINDOW]) for i in range(len(stretch))), default=0)
        kept += [found[start + k][0] for k in _text(stretch, min(SURGE, most) if art or not article else SURGE)]
        start += len(stretch)
    return " ".join(kept)


def extract_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page's main text, from the whole html.

    Other columns are ignored. Null and empty pages have an empty text;
    repeated rows are answered one by one; no pages give no rows. A block must
    hold ``SURGE`` weighted characters to start the text (or the most that one
    holds in a shorter article or page) and ``DIVE`` to go on with it; article,
    main and h1 only weigh on the lines.
    """

    def run(batches):
        for b in batches:
            texts = [main_text(h) for h in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()),
                                              pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return map_arrow(rows, run, "page_id long, url string, text string, n_chars long")
