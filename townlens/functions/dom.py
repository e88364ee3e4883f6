"""A small DOM for page extraction: tolerant parsing with the standard library, text and element lookup."""

from __future__ import annotations

from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
CLOSED_BY = {"p": frozenset("p div ul ol table h1 h2 h3 h4 h5 h6 section article aside form".split()), "li": frozenset(["li"]), "tr": frozenset(["tr"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]), "option": frozenset(["option"])}
#: The open elements that a tag ends.
CLOSES = {tag: frozenset(x for x, by in CLOSED_BY.items() if tag in by) for tag in frozenset().union(*CLOSED_BY.values())}
BREAKS = frozenset("p div li tr h1 h2 h3 h4 h5 h6 br section article aside table ul ol dt dd header footer address".split())


class Element:
    __slots__ = ("attrs", "kids", "parent", "tag")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Element | None) -> None:
        self.tag, self.attrs, self.parent, self.kids = tag, attrs, parent, []

    @property
    def marks(self) -> str:
        """Class and id in lower case."""
        if not self.attrs:
            return " "
        return f"{self.attrs.get('class', '')} {self.attrs.get('id', '')}".lower()

    def walk(self) -> list[Element]:
        """The element and all below it, in document order."""
        out, todo = [], [self]
        while todo:
            x = todo.pop()
            out.append(x)
            if x.kids:
                todo += [k for k in reversed(x.kids) if type(k) is not str]
        return out

    def all(self, *tags: str) -> list[Element]:
        return [x for x in self.walk() if x.tag in tags and x is not self]

    def first(self, *tags: str) -> Element | None:
        return next((x for x in self.walk() if x.tag in tags and x is not self), None)

    def text(self, separator: str = " ") -> str:
        """Visible text in one line; separator between pieces ('' keeps split words together)."""
        out: list[str] = []

        def go(x: Element) -> None:
            for k in x.kids:
                if isinstance(k, str):
                    out.append(k)
                elif k.tag not in ("script", "style", "noscript"):
                    go(k)
                    if k.tag in BREAKS:
                        out.append(" ")

        go(self)
        return " ".join(separator.join(out).split())

    def lines(self) -> list[str]:
        """Visible lines: a block element ends a line."""
        out: list[str] = [""]

        def go(x: Element) -> None:
            for k in x.kids:
                if isinstance(k, str):
                    out[-1] += k
                elif k.tag not in ("script", "style", "noscript"):
                    if k.tag in BREAKS:
                        out.append("")
                    go(k)
                    if k.tag in BREAKS:
                        out.append("")
                    elif k.tag in ("td", "th"):
                        out[-1] += " "

        go(self)
        return [line for line in (" ".join(x.split()) for x in out) if line]


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Element("html", {}, None)

    def updatepos(self, i: int, j: int) -> int:
        """Lines are not counted: nothing asks where a tag stands."""
        return j

    def handle_starttag(self, tag: str, attrs: list) -> None:
        closes = CLOSES.get(tag, ())
        node = self.at
        while node.parent is not None:
            if node.tag in closes:
                self.at = node.parent
                break
            if node.tag in ("table", "ul", "ol", "td", "th"):
                break
            node = node.parent
        new = Element(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.kids.append(new)
        if tag not in VOID:
            self.at = new

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.at.kids.append(Element(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag: str) -> None:
        node = self.at
        while node.parent is not None:
            if node.tag == tag:
                self.at = node.parent
                return
            node = node.parent

    def handle_data(self, data: str) -> None:
        self.at.kids.append(data)


def parse(html: str | None) -> Element:
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root
