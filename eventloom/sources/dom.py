"""What a page says, parsed once: an Arrow-batched function from HTML to one struct, over which columns work further."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BREAKS = frozenset("p div br h1 h2 h3 h4 h5 h6 li ul ol dl dt dd table tr td th section article header footer nav address".split())
#: Places of an event's description, most telling first.
DESCRIPTIONS = (
    ("data-testid", "event-description"), ("class", "event-description"), ("class", "event-details__description"), ("class", "rte"), ("class", "detail-content"),
    ("in-article", "entry-content"), ("class", "structured-content"), ("tag", "article"),
)


class Node:
    __slots__ = ("attributes", "below", "children", "parent", "tag")

    def __init__(self, tag: str, attributes: dict[str, str], parent: Node | None):
        self.tag, self.attributes, self.parent, self.children, self.below = tag, attributes, parent, [], None

    @property
    def classes(self) -> list[str]:
        return self.attributes.get("class", "").split()

    def walk(self) -> list[Node]:
        """All elements below, in order, without recursion: pages may be deeply nested. The root of a whole tree keeps them in `below`."""
        if self.below is not None:
            return self.below
        out, stack = [], [c for c in reversed(self.children) if isinstance(c, Node)]
        while stack:
            at = stack.pop()
            out.append(at)
            if at.children:
                stack += [c for c in reversed(at.children) if isinstance(c, Node)]
        return out

    def texts(self) -> list[str]:
        """The stripped pieces of text below, without scripts and styles."""
        out, stack = [], [self]
        while stack:
            at = stack.pop()
            if isinstance(at, str):
                if at.strip():
                    out.append(" ".join(at.split()))
            elif at.tag not in ("script", "style") or at is self:
                stack += reversed(at.children)
        return out

    def text(self, joint: str = " ") -> str:
        return joint.join(self.texts())

    def all(self, tag: str | None = None, cls: str | None = None, attribute: str | None = None) -> list[Node]:
        return [n for n in self.walk() if (tag is None or n.tag == tag) and (cls is None or cls in n.classes) and (attribute is None or attribute in n.attributes)]

    def first(self, tag: str | None = None, cls: str | None = None, attribute: str | None = None) -> Node | None:
        return next((n for n in self.walk() if (tag is None or n.tag == tag) and (cls is None or cls in n.classes) and (attribute is None or attribute in n.attributes)), None)

    def within(self, tag: str) -> bool:
        at = self.parent
        while at is not None:
            if at.tag == tag:
                return True
            at = at.parent
        return False


class Tree(HTMLParser):
    """A tolerant tree: paragraphs and list items end where the next begins, stray ends are ignored."""

    SELF_ENDING = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("", {}, None)
        self.at = self.root

    def handle_starttag(self, tag, attrs):
        ends = self.SELF_ENDING.get(tag)
        if ends and self.at.tag in ends:
            self.at = self.at.parent
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.at.children.append(Node(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag):
        at = self.at
        while at is not None and at.tag != tag:
            at = at.parent
        if at is not None and at.parent is not None:
            self.at = at.parent

    def handle_data(self, data):
        self.at.children.append(data)


def tree(html: str | None) -> Node:
    parser = Tree()
    parser.feed(html or "")
    parser.close()
    parser.root.below = parser.root.walk()
    return parser.root


_TEXTS = T.ArrayType(T.StringType())
_LINK = T.StructType([T.StructField(n, T.StringType()) for n in ("href", "text", "title", "classes", "around")])
_IMAGE = T.StructType([T.StructField(n, T.StringType()) for n in ("src", "alt", "classes", "width", "height")])
_FIELD = T.StructType([T.StructField("label", T.StringType()), T.StructField("text", T.StringType()), T.StructField("links", _TEXTS)])
_ADDRESS = T.StructType([T.StructField(n, T.StringType()) for n in ("name", "contact_person", "email", "url")])
_ROW = T.StructType([T.StructField(n, T.StringType()) for n in ("day", "href", "title", "time", "location", "category")])
PAGE = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("title", "h1", "og_title", "og_description", "og_image", "description", "content", "entities", "next_page", "author")]
    + [T.StructField(n, _TEXTS) for n in ("jsonld", "times", "container_times", "lines", "onclick", "categories")]
    + [T.StructField("links", T.ArrayType(_LINK)), T.StructField("images", T.ArrayType(_IMAGE)), T.StructField("fields", T.ArrayType(_FIELD)), T.StructField("address", _ADDRESS), T.StructField("rows", T.ArrayType(_ROW))]
)


def _lines(root: Node) -> list[str]:
    out, held, stack = [], [], [root]
    while stack:
        at = stack.pop()
        if at is None:
            if held:
                out.append(" ".join(held))
                held = []
        elif isinstance(at, str):
            if at.strip():
                held.append(" ".join(at.split()))
        elif at.tag not in ("script", "style", "title"):
            if at.tag in BREAKS:
                stack.append(None)
            stack += reversed(at.children)
            if at.tag in BREAKS:
                stack.append(None)
    return [*out, " ".join(held)] if held else out


def _described(node: Node) -> str:
    """Paragraphs by two line ends, list items with a bullet."""
    parts = []
    for child in node.children:
        if isinstance(child, str):
            parts.append(" ".join(child.split()))
        elif child.tag in ("ul", "ol"):
            parts += [f"• {li.text()}" for li in child.all("li") if li.text()]
        elif child.tag not in ("script", "style"):
            parts.append(child.text())
    return "\n\n".join(p for p in parts if p)


def _content(root: Node) -> str | None:
    for kind, name in DESCRIPTIONS:
        if kind == "tag":
            found = root.first(name)
        elif kind == "class":
            found = root.first(cls=name)
        elif kind == "in-article":
            found = next((n for n in root.all(cls=name) if n.within("article")), None)
        else:
            found = next((n for n in root.all(attribute=kind) if n.attributes[kind] == name), None)
        text = _described(found) if found else ""
        if len(text) > 50:
            return text
    return None


def _address(root: Node) -> dict | None:
    node = root.first("address")
    if node is None:
        return None
    own = [" ".join(c.split()) for c in node.children if isinstance(c, str) and c.strip()]
    hrefs = [a.attributes["href"].strip() for a in node.all("a", attribute="href")]
    email = next((h[7:].strip() for h in hrefs if h.startswith("mailto:")), None)
    out = {"name": own[0] if own else None, "contact_person": own[1] if len(own) > 1 else None, "email": email, "url": next((h for h in hrefs if h.startswith("http")), None)}
    return out if out["name"] or out["email"] else None


def _fields(root: Node) -> list[dict]:
    """Labels with their values: definition lists (a term takes all values up to the next term) and labelled list items."""
    out = []

    def add(label: Node | None, values: list[Node]) -> None:
        name = label.text().rstrip(" :") if label else ""
        if name and values:
            links = [a.attributes["href"].strip() for v in values for a in v.all("a", attribute="href")]
            out.append({"label": name, "text": " ".join(v.text() for v in values), "links": links})

    for dl in root.all("dl"):
        label, values = None, []
        for n in dl.walk():
            if n.tag == "dt":
                add(label, values)
                label, values = n, []
            elif n.tag == "dd":
                values.append(n)
        add(label, values)
    for li in root.all("li"):
        label, value = li.first(cls="cd-data-label"), li.first(cls="cd-data-value")
        if label and value:
            add(label, [value])
    return out


def _rows(root: Node) -> tuple[list[dict], str | None]:
    """Rows of an agenda table, without days filled down, and the path of the next page."""
    rows, following = [], None
    for tr in root.all("tr", "row--result"):
        if "load-more" in tr.classes:
            button = tr.first("button", attribute="hx-get")
            following = button.attributes["hx-get"].strip() if button else following
            continue
        head, a = tr.first("th", "agenda__day"), tr.first("a", "agenda__event", "href")
        day, time = (head.first("time", attribute="datetime") if head else None), tr.first("time", "agenda__time", "datetime")
        part = lambda tag, cls, a=a: n.text() if a and (n := a.first(tag, cls)) else None
        category = a.first("ul", "agenda__event-category") if a else None
        item = category.first("li") if category else None
        rows.append({
            "day": day.attributes["datetime"].strip() if day else None, "href": a.attributes["href"].strip() if a else None,
            "title": part("h1", "agenda__event-title") or (a.attributes.get("title", "").strip() if a else None), "time": time.attributes["datetime"].strip() if time else None,
            "location": part("p", "agenda__event-location"), "category": item.text() if item else None,
        })
    return rows, following


def page(html: str | None) -> dict:
    """All that PAGE holds of one page; null and empty pages have no values and empty lists."""
    root = tree(html)
    meta = {}
    for m in root.all("meta"):
        meta.setdefault(m.attributes.get("property") or m.attributes.get("name"), m.attributes.get("content", "").strip())
    text = lambda n: (n.text() or None) if n else None
    article = root.first("article") or root.first("main")
    times = lambda n: [t.attributes["datetime"].strip() for t in n.all("time", attribute="datetime") if t.attributes["datetime"].strip()]
    entities = root.first(attribute="data-entities")
    rows, following = _rows(root)
    return {
        "title": text(root.first("title")), "h1": text(root.first("h1")), "og_title": meta.get("og:title") or None, "og_description": meta.get("og:description") or None,
        "og_image": meta.get("og:image") or None, "description": meta.get("description") or None, "content": _content(root), "author": meta.get("author") or None,
        "entities": entities.attributes["data-entities"] if entities else None, "next_page": following,
        "jsonld": ["".join(c for c in s.children if isinstance(c, str)) for s in root.all("script") if s.attributes.get("type", "").lower() == "application/ld+json"],
        "times": times(root), "container_times": times(article) if article else [], "lines": _lines(root),
        "onclick": [u for n in root.all(attribute="onclick") for u in re.findall(r"window\.location\.href='([^']+)'", n.attributes["onclick"])],
        "categories": list(dict.fromkeys(a.text() for a in root.all("a", attribute="href") if "category" in a.attributes["href"].lower() and a.text())),
        "links": [
            {"href": a.attributes["href"].strip(), "text": a.text(), "title": a.attributes.get("title"), "classes": " ".join(a.classes), "around": " ".join(a.parent.classes) if a.parent else ""}
            for a in root.all("a", attribute="href")
        ],
        "images": [{"src": i.attributes["src"].strip(), "alt": i.attributes.get("alt"), "classes": " ".join(i.classes), "width": i.attributes.get("width"), "height": i.attributes.get("height")} for i in root.all("img", attribute="src")],
        "fields": _fields(root), "address": _address(root), "rows": rows,
    }


def read(html: Column) -> Column:
    """The PAGE struct of HTML."""

    @F.pandas_udf(PAGE)
    def parsed(pages: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([page(p) for p in pages], columns=PAGE.names)

    return parsed(html)
