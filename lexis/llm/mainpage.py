"""Main text of web pages by line-block distribution.

Markup is stripped into lines (one per block element, in page order).  A line's
weight is the length of its text, less what is link text; lines inside menus,
headers, footers, sidebars, notices, adverts, forms and comments weigh nothing,
and where a page marks its article, tags and classes alone decide: lines outside it
weigh nothing and all others stay.

On other pages the lines with weight are taken together in blocks of ``WINDOW`` lines
around each, and the weights of a block are added up.  Levels come from the page's own
distribution, the length of the line that an average character stands in (``LONG`` at
most): where the sums surge over half of it a stretch of text begins, and it goes on
both ways to the points where they dive under a quarter of it.  At the ends of a stretch short
lines that are neither headings above the text nor end as a sentence are cut off; what
stands between two ends stays, and boxes that weigh nothing do not interrupt a
stretch, so short closing parts stay.  A line that is link text by half or more weighs
nothing, unless it ends as a sentence does.

White space inside a line becomes one space, lines are joined by a line feed,
character references are decoded.  Null and empty pages and pages without main
text give an empty text; repeated rows each get theirs; unclosed elements end
with their parent; columns beside id, url and html are ignored.
"""

from __future__ import annotations

import re
from html import unescape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexis.llm.common import col, map_texts

WINDOW = 5              # lines of a block: a line and its neighbours
SURGE, DIVE = 1 / 2, 1 / 4   # of the page's level
LONG = 240              # a level is this at most: one huge line must not hide ordinary ones
SENTENCE = tuple(".!?:;\u2026\u3002\uff01\uff1f\"'\u201d\u2019\xbb)")   # ends of a line of running text

# fixed values of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg math object select".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol p pre section summary table
tbody td tfoot th thead tr ul""".split())
ARTICLE = frozenset(("article", "main"))
APART = frozenset("nav aside footer form dialog menu button fieldset head".split())
ENDS_P = BLOCK - {"body", "html", "head"}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
SAME_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
             "td": ("td", "th"), "th": ("td", "th")}   # all of them blocks
# words of class and id that mark what is not the article
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar".split())
MARKS = frozenset("""ad ads adv advert advertisement advertising adbox banner breadcrumb breadcrumbs comment comments
commentlist consent cookie cookies disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice
outbrain pagination popup promo promotion related reply replies respond share sharing sidebar signup social sponsor
sponsored subscribe subscription taboola toolbar widget widgets""".split())

TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"<]*\"|'[^'<]*')*+)>")
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
WORD = re.compile(r"[a-z]+")


def _apart(name: str, attributes: str, in_article: bool) -> bool:
    """Does this element hold something else than the article?"""
    if name in APART or name == "header" and not in_article:
        return True
    if "=" in attributes and name not in ("body", "html", *ARTICLE):
        for key, *value in ATTRIBUTE.findall(attributes):
            words = WORD.findall("".join(value).lower())
            if key.lower() == "role":
                if not ROLES.isdisjoint(words):
                    return True
            elif not MARKS.isdisjoint(words):
                return True
    return False


def lines(html: str) -> list[tuple[str, int, bool, bool, bool]]:
    """(text, length of its link text, stands apart, stands in an article, is a heading)."""
    out: list[tuple[str, int, bool, bool, bool]] = []
    stack: list[tuple[str, bool]] = []      # open elements: name, whether it stands apart
    places: dict[str, list[int]] = {}       # where the open elements of a name stand
    blocks: list[int] = []                  # where the open blocks stand
    apart = articles = links = heads = linked = 0
    held: list[str] = []

    def close_line():
        nonlocal linked
        text = " ".join(unescape("".join(held)).split()) if held else ""
        if text:
            out.append((text, min(linked, len(text)), apart > 0, articles > 0, heads > 0))
        held.clear()
        linked = 0

    def leave(i: int):
        nonlocal apart, articles, links, heads
        while len(stack) > i:
            name, off = stack.pop()
            places[name].pop()
            if name in BLOCK:
                blocks.pop()
            apart -= off
            articles -= name in ARTICLE
            links -= name == "a"
            heads -= name in HEADINGS

    i, n = 0, len(html)
    while i < n:
        j = html.find("<", i)
        if j != i:
            text = html[i:j if j >= 0 else n]
            held.append(text)
            if links:
                linked += len(text.strip())
            if j < 0:
                break
            i = j
        if html.startswith("<!--", i):
            k = html.find("-->", i + 4)
            i = k + 3 if k >= 0 else n
            continue
        m = TAG.match(html, i)
        if m is None:
            if html[i + 1:i + 2] in ("!", "?") or html[i + 1:i + 3].replace("/", "").isalpha():
                k = html.find(">", i)
                i = k + 1 if k >= 0 else n
            else:          # a plain < in the text
                held.append("&lt;")
                i += 1
            continue
        i = m.end()
        name, shut, attributes = m[2].lower(), m[1], m[3]
        if shut:
            if name in BLOCK:
                close_line()
            if open_ := places.get(name):   # other elements end inside their block only
                if name in BLOCK or not blocks or open_[-1] > blocks[-1]:
                    leave(open_[-1])
        elif name in RAW:
            k = _find(html, name, i)
            i = n if k < 0 else (html.find(">", k) + 1 or n)
        elif name in VOID:
            if name in BLOCK:
                close_line()
            elif name in ("br", "img", "input", "wbr"):
                held.append(" " if name != "wbr" else "")
        else:
            if name in BLOCK:
                close_line()
                if blocks:
                    last = stack[blocks[-1]][0]
                    if last == "p" and name in ENDS_P or last in SAME_ENDS.get(name, ()):
                        leave(blocks[-1])
            if not attributes.endswith("/"):
                off = _apart(name, attributes, articles > 0)
                places.setdefault(name, []).append(len(stack))
                if name in BLOCK:
                    blocks.append(len(stack))
                stack.append((name, off))
                apart += off
                articles += name in ARTICLE
                links += name == "a"
                heads += name in HEADINGS
    close_line()
    return out


def _find(html: str, name: str, i: int) -> int:
    m = re.compile(f"</{name}", re.IGNORECASE).search(html, i)
    return m.start() if m else -1


def block_sums(weight: list[int]) -> list[int]:
    """The weights of each line and its neighbours, added up."""
    half = WINDOW // 2
    upto = [0]
    for w in weight:
        upto.append(upto[-1] + w)
    n = len(weight)
    return [upto[min(n, i + half + 1)] - upto[max(0, i - half)] for i in range(n)]


def page_level(weight: list[int]) -> float:
    return min(LONG, sum(w * w for w in weight) / (sum(weight) or 1))


def stretches(weight: list[int]) -> list[tuple[int, int]]:
    """Stretches ``[start, end)`` of lines: sums over the surge level somewhere, over the dive level all along."""
    level, sums = page_level(weight), block_sums(weight)
    found, start, risen = [], None, False
    for i in range(len(weight) + 1):
        if i < len(weight) and sums[i] > DIVE * level:
            start = i if start is None else start
            risen |= sums[i] >= SURGE * level
        else:
            if risen:
                found.append((start, i))
            start, risen = None, False
    return found


def main_text(html: str) -> str:
    found = lines(html)
    if any(inside and not apart for _, _, apart, inside, _ in found):   # the page marks its article
        return "\n".join(t for t, _, apart, inside, _ in found if inside and not apart)
    heavy = [(t, len(t) - linked, head) for t, linked, apart, _, head in found
             if not apart and (2 * linked < len(t) or t.endswith(SENTENCE) and linked < len(t))]
    weight = [w for _, w, _ in heavy]
    level, kept = page_level(weight), []
    for a, b in stretches(weight):
        text = [w > DIVE * level or t.endswith(SENTENCE) for t, w, _ in heavy[a:b]]
        first, last = text.index(True) + a if any(text) else b, b - text[::-1].index(True) if any(text) else b
        while first > a and heavy[first - 1][2]:    # headings above
            first -= 1
        kept += [t for t, _, _ in heavy[first:last]]
    return "\n".join(kept)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, main`` of every page."""
    src = pages.select(col(id_col).alias("page_id"), col(url_col).alias("url"),
                       F.coalesce(col(html_col).cast("string"), F.lit("")).alias("text"))
    return map_texts(src, [T.StructField("main", T.StringType())], lambda: lambda texts: [list(map(main_text, texts))])
