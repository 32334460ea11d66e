"""HTML as a tree by the standard library's parser: the selectors that listings and article pages need, and the text of an element."""

from __future__ import annotations

import re
from html.parser import HTMLParser

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}


class Element:
    __slots__ = ("attrs", "children", "parent", "tag")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Element | None):
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []

    def walk(self):
        stack = list(reversed(self.children))
        while stack:
            x = stack.pop()
            yield x
            if isinstance(x, Element):
                stack.extend(reversed(x.children))

    def text(self) -> str:
        """The stripped pieces of text below, joined by spaces."""
        return " ".join(s for x in self.walk() if isinstance(x, str) and (s := x.strip()))

    def without(self, tags: set[str]) -> Element:
        """Itself, with all elements of these tags removed below."""
        for x in [self, *(y for y in self.walk() if isinstance(y, Element))]:
            x.children = [y for y in x.children if isinstance(y, str) or y.tag not in tags]
        return self

    def select(self, selector: str) -> list[Element]:
        """The elements below that a selector list matches: tag, .class, #id, [a], [a=v], [a*=v], [a^=v], [a$=v], compounds, descendants, in document order."""
        chains = [_chain(s) for s in selector.split(",") if s.strip()]
        return [x for x in self.walk() if isinstance(x, Element) and any(_matches(x, c, self) for c in chains)]

    def first(self, selector: str) -> Element | None:
        return next(iter(self.select(selector)), None)


PART = re.compile(r"""([\w-]+|\*)|\.([\w-]+)|\#([\w-]+)|\[\s*([\w-]+)\s*(?:([*^$~|]?=)\s*(?:"([^"]*)"|'([^']*)'|([^\]\s]+))\s*)?\]""")


def _chain(selector: str) -> list[list[tuple]]:
    out = []
    for compound in re.findall(r"(?:\[[^\]]*\]|[^\s\[])+", selector.strip()):
        tests = []
        for tag, cls, ident, attr, how, *values in PART.findall(compound):
            value = next((v for v in values if v), "")
            tests.append(("tag", tag.lower()) if tag else ("class", cls) if cls else ("id", ident) if ident else ("attr", attr.lower(), how, value))
        out.append(tests)
    return out


def _fits(x: Element, tests: list[tuple]) -> bool:
    for kind, *arg in tests:
        if kind == "tag":
            ok = arg[0] in ("*", x.tag)
        elif kind == "class":
            ok = arg[0] in x.attrs.get("class", "").split()
        elif kind == "id":
            ok = x.attrs.get("id") == arg[0]
        else:
            name, how, value = arg
            have = x.attrs.get(name)
            ok = have is not None and (not how or how == "=" and have == value or how == "*=" and value in have or how == "^=" and have.startswith(value) or how == "$=" and have.endswith(value) or how == "~=" and value in have.split())
        if not ok:
            return False
    return bool(tests)


def _matches(x: Element, chain: list[list[tuple]], root: Element) -> bool:
    if not _fits(x, chain[-1]):
        return False
    at, rest = x.parent, chain[:-1]
    while rest and at is not None:
        if _fits(at, rest[-1]):
            rest = rest[:-1]
        at = at.parent
    return not rest


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Element("", {}, None)

    def handle_starttag(self, tag, attrs):
        while self.at.tag in CLOSES.get(tag, ()) and self.at.parent is not None:
            self.at = self.at.parent
        x = Element(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(x)
        if tag not in VOID:
            self.at = x

    def handle_startendtag(self, tag, attrs):
        self.at.children.append(Element(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag):
        x = self.at
        while x is not None and x.tag != tag:
            x = x.parent
        if x is not None and x.parent is not None:
            self.at = x.parent

    def handle_data(self, data):
        self.at.children.append(data)


def parse(html: str) -> Element:
    b = _Builder()
    b.feed(html or "")
    b.close()
    return b.root


# Tags that hold no article text; where sites of a kind keep it; where others may.
NO_TEXT = {"script", "style", "nav", "footer", "aside", "header"}
BY_HOST = {"nber.org": ["div.page-header__intro-inner"], "arxiv.org": ["blockquote.abstract.mathjax"]}
NEWSLETTER = ["div.body.markup", "div.available-content", "article"]
GENERIC = ["article", "main", "[role=main]", ".post-content", ".entry-content"]


def article_text(html: str, url: str = "", most: int | None = None) -> str:
    """A page's article text, whole or its first ``most`` characters: by the site's own place for it, else the usual ones, else the <div> with the most text. "" if there is none."""
    from urllib.parse import urlparse

    host = (urlparse(url or "").netloc or "").lower()
    root = parse(html)
    newsletter = "substack.com" in host or root.first("meta[content=Substack]") is not None or any("substack.com" in x.attrs["href"] for x in root.select("link[href]"))
    root.without(NO_TEXT)
    for known, places in BY_HOST.items():
        if known in host:
            return next((x.text()[:most] for p in places if (x := root.first(p)) is not None), "")
    for place in NEWSLETTER if newsletter else GENERIC:
        if (x := root.first(place)) is not None:
            return x.text()[:most]
    if newsletter:
        return ""
    return max((x.text() for x in root.select("div")), key=len, default="")[:most]
