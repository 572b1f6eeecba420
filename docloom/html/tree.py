"""A forgiving element tree on the standard library's HTML parser."""

from __future__ import annotations

from collections import Counter
from html.parser import HTMLParser

VOID = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details div dl dt fieldset figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html li main nav ol p pre section table tbody td tfoot th thead tr ul".split()
)
# a start tag ends the open elements named here, up to the nearest element of the second set
ENDS = {
    "li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table"}), "th": ({"td", "th"}, {"table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
}
CONTAINERS = frozenset("div body html td th li table ul ol section article".split())


class Element:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str] | None = None):
        self.tag, self.attrs, self.children = tag, attrs or {}, []

    def iter(self):
        todo = [self]
        while todo:
            e = todo.pop()
            yield e
            todo.extend(c for c in reversed(e.children) if isinstance(c, Element))


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Element("#document")
        self.open = [self.root]
        self.held: Counter[str] = Counter()  # open elements by tag, so that nothing absent is searched

    def _cut(self, k: int) -> None:
        self.held.subtract(e.tag for e in self.open[k:])
        del self.open[k:]

    def _close(self, tags, stop) -> None:
        k = len(self.open) - 1
        while any(self.held[t] for t in tags) and k > 0:
            tag = self.open[k].tag
            if tag in stop:
                return
            if tag in tags:
                self._cut(k)
            k -= 1

    def handle_starttag(self, tag, attrs):
        if tag in ENDS:
            self._close(*ENDS[tag])
        elif tag in BLOCKS:
            self._close({"p"}, CONTAINERS)
        e = Element(tag, {k: v or "" for k, v in attrs})
        self.open[-1].children.append(e)
        if tag not in VOID:
            self.open.append(e)
            self.held[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.open[-1].tag == tag:
            self._cut(len(self.open) - 1)

    def handle_endtag(self, tag):
        if self.held[tag]:
            self._cut(next(k for k in range(len(self.open) - 1, 0, -1) if self.open[k].tag == tag))

    def handle_data(self, data):
        self.open[-1].children.append(data)


def parse_html(text: str) -> Element:
    """Tree of ``text``; unclosed and stray tags are repaired, comments dropped."""
    b = _Builder()
    b.feed(text)
    b.close()
    return b.root
