"""HTML pages as tables: whole text, links, labelled cards and elements by id, parsed in Arrow batches on the executors."""

from __future__ import annotations

from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.functions.arrow import appended
from docloom.functions.text import agency_name

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset(("script", "style"))


class Element:
    """A node of the page: its name, attributes, children (elements and texts)."""

    __slots__ = ("attrs", "children", "parent", "tag")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Element | None = None):
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []

    def text(self) -> str:
        out, stack = [], [self]
        while stack:
            node = stack.pop()
            if isinstance(node, str):
                out.append(node)
            elif node.tag not in HIDDEN:
                stack += reversed(node.children)
        return "".join(out)

    def find(self, test):
        """All elements below that pass, in page order."""
        stack = list(reversed(self.children))
        while stack:
            node = stack.pop()
            if not isinstance(node, str):
                if test(node):
                    yield node
                stack += reversed(node.children)

    def has(self, *classes: str) -> bool:
        return set(classes) <= set(self.attrs.get("class", "").split())


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Element("", {})

    def handle_starttag(self, tag, attrs):
        node = Element(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.at.children.append(Element(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag):
        node = self.at
        while node.parent and node.tag != tag:
            node = node.parent
        if node.parent:
            self.at = node.parent

    def handle_data(self, data):
        self.at.children.append(data)


def parse(html: str | None) -> Element:
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root


def _first(node: Element, test) -> Element | None:
    return next(node.find(test), None)


def _cards(root: Element, kind: str) -> list[dict]:
    """Cards of a result list: title, link, and the label and text of each item of their metadata."""
    out = []
    for card in root.find(lambda e: e.has(kind)):
        heading = _first(card, lambda e: e.tag == "h3" and e.has("card-title"))
        link = heading and _first(heading, lambda e: e.tag == "a")
        if not link:
            continue
        items = []
        for li in card.find(lambda e: e.tag == "li"):
            strong = _first(li, lambda e: e.tag == "strong")
            if strong:
                items.append({"label": strong.text().strip(), "text": li.text().strip()})
        out.append({"title": link.text().strip(), "href": link.attrs.get("href", ""), "items": items})
    return out


_ITEM = pa.struct([("label", pa.string()), ("text", pa.string())])
_CARD = pa.struct([("title", pa.string()), ("href", pa.string()), ("items", pa.list_(_ITEM))])


def _hrefs(node: Element) -> list[str]:
    return [a.attrs["href"] for a in node.find(lambda e: e.tag == "a" and "href" in e.attrs)]


def _by_id(name: str):
    def text(root: Element, _) -> str | None:
        found = [e for e in root.find(lambda e: e.attrs.get("id") == name)]
        return found[-1].text() if found else None

    return text


def _title(root: Element, _) -> str | None:
    title = _first(root, lambda e: e.tag == "title")
    return title.text() if title else None


#: What a page can be asked for: how it is read from the root, its Arrow type and its Spark type.
PARTS = {
    "page_text": (lambda root, _: root.text(), pa.string(), "string"),
    "title": (_title, pa.string(), "string"),
    "agency_text": (_by_id("agency"), pa.string(), "string"),
    "main_text": (_by_id("mainContent"), pa.string(), "string"),
    "links": (lambda root, _: _hrefs(root), pa.list_(pa.string()), "array<string>"),
    "attachments": (lambda root, _: [_hrefs(c) for c in root.find(lambda e: e.has("card", "card-attachment"))], pa.list_(pa.list_(pa.string())), "array<array<string>>"),
    "cards": (_cards, pa.list_(_CARD), "array<struct<title:string,href:string,items:array<struct<label:string,text:string>>>>"),
}


def parsed_pages(pages: DataFrame, *wanted: str, card_class: str = "card-type-comment", html: str = "html") -> DataFrame:
    """The pages with the parts asked for (all by default): `page_text`, `title`, `agency_text` (element with id 'agency'),
    `main_text` (id 'mainContent'), `links`, `attachments` (link arrays of attachment cards) and `cards`. A null page is an
    empty one; columns of the same names are replaced."""
    wanted = wanted or tuple(PARTS)
    pages = pages.drop(*wanted)
    names = pages.columns
    at = names.index(html)
    readers = [(k, *PARTS[k][:2]) for k in wanted]

    def run(batches):
        for batch in batches:
            rows = {k: [] for k in wanted}
            for value in batch.column(at):
                root = parse(value.as_py())
                for k, read, _ in readers:
                    rows[k].append(read(root, card_class))
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(rows[k], t) for k, _, t in readers)], names=[*names, *wanted])

    return pages.mapInArrow(run, appended(pages, ", ".join(f"{k} {PARTS[k][2]}" for k in wanted)))


def agencies(pages: DataFrame) -> DataFrame:
    """The agency that each page names, or null."""
    return parsed_pages(pages, "agency_text").withColumn("agency", agency_name(F.col("agency_text")))


def document_ids(pages: DataFrame) -> DataFrame:
    """The ids on a search page's notice cards, in page order; a page without cards gives no rows."""
    from docloom.operators.comments import label_map

    cards = parsed_pages(pages, "cards", card_class="card-type-notice").select(*pages.columns, F.posexplode("cards").alias("pos", "card"))
    return cards.select(*[c for c in pages.columns if c != "html"], "pos", F.try_element_at(label_map(F.col("card.items")), F.lit("id")).alias("id"))
