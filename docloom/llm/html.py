"""Main text of HTML pages: flat text blocks, told apart by a decision tree.

A page is cut into blocks wherever a block-level tag begins or ends. Each block knows its word count and link density and
those of the blocks before and after it, whether it is a heading or a list item, whether an article or main element is
around it, and its sign: 2 if an element around it is a menu, footer, form and the like by its element, role or a name
that has no other use (adverts, reader comments), 1 if only a class or id hints at such a thing, else 0. Names say nothing
about headings, paragraphs, list items and cells inside an article, nor do ids of its sections, which are anchors there.
A tree (CART, Gini) trained on the labelled pages below decides which blocks are main text; a hint is one feature of it.

Time grows with the length of the page, whatever its markup. Defined results: a null or empty page has an empty text;
character references are decoded, white space inside a block becomes one space, blocks are joined by one line feed in page
order; nothing is cut off. Unclosed elements end where HTML ends them, at the next block; an unclosed comment, script or
tag takes the rest. Other columns pass through, but for one that is named `_html_text`, which the result replaces; repeated
rows give the same text; an empty table gives none.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.functions.arrow import appended

_NAME = re.compile(r"/?([a-zA-Z][^\s/>]*+)")
#: The rest of a tag: a quote counts where it begins a value, as browsers read it.
_REST = re.compile(r"(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+>")
_COMMENT = re.compile(r"-?>|.*?(?:--!?>|\Z)", re.S)
_LINK = re.compile(r"<(/?)a[\s/>]", re.I)
_ATTRIBUTE = re.compile(r"(?<![a-zA-Z-])([a-zA-Z-]++)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++))")
_HIDDEN = re.compile(r"(?<![^\s])hidden(?![^\s])", re.I)
_QUOTED = re.compile(r"=\s*+(?:\"[^\"]*+\"|'[^']*+')")
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: After so many tags whose quotes never close, quotes no longer count on the page.
BROKEN = 16
#: Elements by what they do to the text around them. Any other element stands inside a line.
_BLOCK = frozenset("address article aside blockquote body button center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table caption tbody td tfoot th thead tr ul".split())
#: Elements whose content is no text of the page; the first ones end nowhere but at their end tag.
_RAW = frozenset("script style title textarea iframe noembed noframes noscript template desc metadata annotation annotation-xml datalist".split())
_ENDLESS = frozenset("script style title textarea iframe".split())
_VOID = frozenset("hr".split())
_FRAME = frozenset("nav footer aside form menu dialog button select fieldset search".split())
_LEAF = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th caption figcaption summary legend option".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
#: Words of classes and ids that name nothing but boilerplate, then those that only hint at it.
_SURE = frozenset("ad ads adv advert adverts advertisement advertising adsbygoogle adbox adslot advertbox sponsor sponsored promo promotion nav navbar navigation breadcrumb breadcrumbs footer masthead cookie cookies consent gdpr popup modal newsletter subscribe subscription signup login pagination pager topbar toolbar sidebar".split())
_HINTS = frozenset("aside menu banner notice notices notification alert overlay register share sharing social related recommended recommendations trending popular widget widgets copyright disclaimer skip rail form search header".split())
_COMMENTS = frozenset("comment comments disqus respond replies reply responses discussion".split())
_MAIN = frozenset("article main content post entry story".split())
#: A name after one of these tells of the page's layout, not of the element.
_LAYOUT = frozenset("has with no without".split())

#: The labelled table, page by page: each block's words (and of them, after a colon, those in links), its kind (h heading,
#: l list item, p any other), * inside an article, ! or !! its sign, and whether it is main text (+) or not (-).
LABELLED = """
1:1l!!- 1:1l!!- 2:2l!!- 12p!!- 9h*+ 45p*+ 70:4p*+ 22p*+ 4h*+ 55p*+ 3p*+ 8p!!-
2:2l- 3:3l- 2:2l- 7h+ 60p+ 5p+ 48:2p+ 90p+ 35:3p+ 4h- 6:6l- 7:7l- 5:5l- 9:2p-
4:4p- 8p- 10h+ 30p+ 25p+ 3p+ 41p+ 2p- 3:3p- 3:3p- 6p-
1:1l- 14:1p- 5h+ 18p+ 9l+ 12l+ 8l+ 26p+ 5h- 7:7l- 30:24p- 5p-
8h*+ 30p*+ 1:1l*- 2:2l*- 1:1l*- 28p*+ 6l*+ 3:3l*+ 11l*+ 9:9l*+ 12:3l*+ 33p*+ 4:4p*+ 20:20p*+ 2h*+ 2p*+
11h*+ 3p*+ 52p*+ 7p*!- 49p*+ 15:6p*!- 60p*+ 140p*!+ 75p*+ 5h*!- 4:4l*!- 6:6l*!- 44p*+ 10p*!!- 38p*+ 62p*!!-
3p!- 40p!!- 6h!- 9p!- 22p!- 70p!!- 5:5p!-
6h+ 55p+ 110p!+ 66p+ 30p!- 8:6p!-
4h*!!- 30p*!!- 50p*!!-
9h+ 16p+ 70p+ 14p+ 4:4p-
27p+
1:1l- 1:1l- 18p- 1:1l- 2:2l-
2:2l- 3:3l- 7h+ 22p+ 15p+ 3:3l-
1p- 14p- 2:2p- 8h+ 50p+ 40p+ 3:3p- 15p- 4:4p-
4p- 2:2l- 3:3l- 25p- 2:2l- 9p- 1:1l-
3:3p- 6h+ 4p+ 60p+ 4p+ 30p+ 2p+ 25p+ 5:5l- 4:4l-
9h*+ 2p*+ 1p*+ 3:3p*+ 2p*+
2:2l- 13p- 1:1l- 20p- 12h*+ 40p*+ 12p-
1:1l- 1h*+ 13p*+ 1p*+ 1p*+ 20p*+ 1p*+ 12p*+ 3p*+ 13p*+ 1p*+ 8p*+ 3:3l-
2:2l- 3p*+ 9p*+ 10p- 3:3l- 1p*+ 14p*+ 2p*+ 3:3l-
5h!- 90p!!- 150p!!- 5:5p!-
60p*+ 120p*!!- 80p*+
3h!- 90p!- 4:4l!-
25p- 3:3l- 2:2l- 3:3l- 16p- 8:8p-
2:2p- 3p- 5p- 4p- 6p-
1h*+ 2p*+
9:9l- 14p- 9:9l- 8:8l- 22p- 12:12l- 11:11l-
9p+ 14p+ 10p+ 8p+ 9p+ 12p+
3:3p- 45p+ 20p+ 4:4l- 70p+ 9p-
"""


@dataclass
class Node:
    feature: int = -1
    cut: float = 0.0
    low: Node | None = None
    high: Node | None = None
    answer: bool = False


@dataclass
class Block:
    text: str
    words: int
    linked: int
    element: str
    article: bool
    sign: int
    #: The sign of what is around the article that the block stands in.
    around: int = 0


def grow(x: np.ndarray, y: np.ndarray, depth: int = 10) -> Node:
    """A CART: the cut with least Gini impurity, again and again, until a leaf is pure or at `depth`."""
    if depth == 0 or y.all() or not y.any():
        return Node(answer=bool(y.mean() >= 0.5))
    best = (np.inf, -1, 0.0)
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for cut in (values[1:] + values[:-1]) / 2:
            low = x[:, f] <= cut
            impurity = sum(side.sum() * (p := y[side].mean()) * (1 - p) for side in (low, ~low))
            if impurity < best[0] - 1e-12:
                best = (impurity, f, float(cut))
    if best[1] < 0:
        return Node(answer=bool(y.mean() >= 0.5))
    low = x[:, best[1]] <= best[2]
    return Node(best[1], best[2], grow(x[low], y[low], depth - 1), grow(x[~low], y[~low], depth - 1))


def classify(node: Node, x: np.ndarray) -> np.ndarray:
    """The tree's answer for each row."""
    if node.feature < 0:
        return np.full(len(x), node.answer)
    low, out = x[:, node.feature] <= node.cut, np.empty(len(x), bool)
    out[low], out[~low] = classify(node.low, x[low]), classify(node.high, x[~low])
    return out


def labelled_pages() -> list[tuple[list[Block], list[bool]]]:
    """The labelled table as blocks and answers."""
    out = []
    for line in filter(None, LABELLED.split("\n")):
        page = [re.fullmatch(r"(\d+)(?::(\d+))?([hlp])(\*?)(!*)([+-])", cell) for cell in line.split()]
        found = [Block("", int(m[1]), int(m[2] or 0), {"h": "h2", "l": "li", "p": "p"}[m[3]], bool(m[4]), len(m[5])) for m in page]
        out.append((found, [m[6] == "+" for m in page]))
    return out


@lru_cache(1)
def trained() -> Node:
    pages = labelled_pages()
    return grow(np.concatenate([features(b) for b, _ in pages]), np.array([a for _, answers in pages for a in answers]))


def _words(value: str) -> set[str]:
    found = [w.lower() for w in _TOKEN.findall(value)]
    return {w for i, w in enumerate(found) if not i or found[i - 1] not in _LAYOUT}


def _says(tag: str, attributes: str, article: bool) -> tuple[int, bool, bool]:
    """An element's own sign, and whether it holds reader comments or is marked as main text."""
    sign, comments, main = 2 if tag in _FRAME else 0, False, tag in ("article", "main")
    if tag == "header" and not article:
        sign = 2
    if not attributes or tag in ("html", "body"):
        return sign, comments, main
    named = not (article and tag in _LEAF)
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name in ("class", "id") and named:
            words = _words(value)
            comments = comments or not words.isdisjoint(_COMMENTS)
            if name == "id" and article and tag == "section":
                continue
            if not words.isdisjoint(_MAIN):
                main = True
            elif not words.isdisjoint(_SURE):
                sign = 2
            elif not words.isdisjoint(_HINTS) and not (article and "header" in words):
                sign = max(sign, 1)
        elif name == "role":
            sign = 2 if value.lower() in _ROLES else sign
            main = main or value.lower() in ("main", "article")
        elif (name == "style" and "display:none" in value.replace(" ", "").lower()) or (name == "aria-hidden" and value.lower() == "true"):
            sign = 2
    if "hidden" in attributes.lower() and _HIDDEN.search(_QUOTED.sub("", attributes)):
        sign = 2
    return 2 if comments else sign, comments, main and not comments


class _Reader:
    """Blocks of one page, gathered tag by tag."""

    def __init__(self):
        self.out: list[Block] = []
        self.parts: list[tuple[str, bool]] = []  # text so far of the block, and whether inside a link
        #: Open elements: name, sign, in an article, in comments, the sign around the article.
        self.stack: list[tuple[str, int, bool, bool, int]] = []
        self.open: Counter[str] = Counter()
        self.leaf, self.leaf_sign = "", 0

    def top(self) -> tuple[str, int, bool, bool, int]:
        return self.stack[-1] if self.stack else ("", 0, False, False, 0)

    def end(self) -> None:
        if self.parts:
            text = " ".join("".join(t for t, _ in self.parts).split())
            if text:
                linked = sum(len(t.split()) for t, inside in self.parts if inside)
                _, sign, article, _, around = self.top()
                words = text.count(" ") + 1
                self.out.append(Block(text, words, min(linked, words), self.leaf, article, max(sign, self.leaf_sign), around))
            self.parts = []

    def tag(self, tag: str, closing: bool, attributes: str) -> None:
        """A block-level tag."""
        self.end()
        if closing or tag in _VOID:
            self.leaf, self.leaf_sign = "", 0
            if self.open[tag]:  # else an end tag without a start
                while True:
                    name = self.stack.pop()[0]
                    self.open[name] -= 1
                    if name == tag:
                        break
            return
        _, sign, article, comments, around = self.top()
        own, own_comments, main = _says(tag, attributes, article)
        if tag in _LEAF:
            self.leaf, self.leaf_sign = tag, own
            return
        self.leaf, self.leaf_sign = "", 0
        if main and not article and not comments and not own_comments:
            # What is around an article frames it; read() says if that counts.
            framed = any(name in _FRAME for name, *_ in self.stack)
            own = own if tag not in ("article", "main") else 0
            sign, around = 2 if framed else 0, 0 if framed else sign
            article = True
        self.stack.append((tag, max(sign, own), article, comments or own_comments, around))
        self.open[tag] += 1


def blocks(html: str) -> list[Block]:
    """The page's blocks in order. An article inside something that is named as boilerplate keeps that sign only if the
    page has an article that nothing frames."""
    page, at, broken, size = _Reader(), 0, 0, len(html)
    linked_to, unclosed = -1, set()  # where the link that is open ends; raw elements without an end tag from here on

    def add(text: str) -> None:
        if text:
            page.parts.append((unescape(text) if "&" in text else text, at < linked_to))

    while at < size:
        start = html.find("<", at)
        if start < 0:
            add(html[at:])
            break
        m = _NAME.match(html, start + 1)
        if not m:
            if html.startswith("<!--", start):
                add(html[at:start])
                at = _COMMENT.match(html, start + 4).end()
            elif html[start + 1 : start + 2] in ("!", "?", "/"):
                add(html[at:start])
                close = html.find(">", start)
                at = close + 1 if close >= 0 else size
            else:
                add(html[at : start + 1])
                at = start + 1
            continue
        add(html[at:start])
        tag, closing = m[1].lower(), html[start + 1] == "/"
        rest = _REST.match(html, m.end()) if broken < BROKEN else None
        if rest:
            at = rest.end()
        else:
            broken += 1
            at = html.find(">", m.end()) + 1 or size
        attributes = html[m.end() : at - 1]
        if tag in _RAW:
            if not closing and not attributes.endswith("/") and tag not in unclosed:
                close = re.compile(rf"</{tag}(?=[\s/>])[^>]*+>?", re.I).search(html, at)
                if close:
                    at = close.end()
                elif tag in _ENDLESS:
                    at = size
                else:
                    unclosed.add(tag)
            add(" ")
        elif tag in _BLOCK:
            page.tag(tag, closing, attributes)
        elif tag == "a":
            closes = None if closing else _LINK.search(html, at)
            if closes and closes[1]:
                linked_to = closes.start()  # across blocks
            elif not closing:
                after = html.find("<", at)
                linked_to = after if after >= 0 else size
        elif tag == "br":
            add(" ")
    page.end()
    plain = any(b.article and not b.around and b.sign < 2 for b in page.out)
    for b in page.out:
        b.sign = max(b.sign, b.around) if plain else b.sign
    return page.out


def features(found: list[Block]) -> np.ndarray:
    """A row for each block: words, link density, the same of the block before and after, heading, list item, article, sign."""
    own = np.array([(b.words, b.linked / b.words) for b in found], float).reshape(-1, 2)
    edge = np.zeros((1, 2))
    rest = np.array([(b.element[:1] == "h" and b.element[1:].isdigit(), b.element == "li", b.article, b.sign) for b in found], float).reshape(-1, 4)
    return np.concatenate([own, np.concatenate([edge, own[:-1]]), np.concatenate([own[1:], edge]), rest], 1)


def main_text(html: str | None) -> str:
    """The page's main blocks, joined by line feeds."""
    found = blocks(html or "")
    if not found:
        return ""
    x = features(found)
    keep = classify(trained(), x)
    if not keep.any() and x[:, -1].all():
        x[:, -1] = 0  # a page that is framed as a whole
        keep = classify(trained(), x)
    if not keep.any() and not x[:, [1, -1]].any():
        keep[:] = True  # neither links nor signs: all of it is text
    return "\n".join(b.text for b, k in zip(found, keep, strict=True) if k)


def extract_text(pages: DataFrame) -> DataFrame:
    """The pages with `_html_text`; other columns pass through."""
    pages = pages.drop("_html_text")
    names = pages.columns
    at = names.index("html")

    def run(batches):
        for batch in batches:
            texts = [main_text(h.as_py()) for h in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*names, "_html_text"])

    return pages.mapInArrow(run, appended(pages, "_html_text string"))


def op3_html_extraction(pages: DataFrame) -> DataFrame:
    """The contract's view."""
    out = extract_text(pages.select("page_id", "url", "html"))
    return out.select("page_id", "url", F.col("_html_text").alias("text"), F.length("_html_text").cast("long").alias("n_chars"))
