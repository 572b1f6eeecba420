"""HTML fragments into typed blocks: headings, texts, links, images, lists, tables.

One walk over the element tree emits the blocks in document order. Anchors give
a link block and a ``[[text]]`` marker in the text around them, images an image
block and an ``{image:url}`` marker. Table rows are text lines whose cells are
joined by the two characters ``\\t``.

Defined cases: null and blank input has no blocks; text outside any element and
after the last one is kept; ``script`` and ``style`` are dropped unless
``keep_scripts``; a table of one column is layout, its cells are read as text.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from docloom.html.segment import classify
from docloom.html.tree import Element, parse_html
from docloom.schema import PARSED
from docloom.session import spread

HEADINGS = frozenset(("title", "h1", "h2", "h3", "h4"))
LISTS = frozenset(("ul", "ol"))
ALL = frozenset(("heading", "text", "list", "table"))
_WS = re.compile(r"\s+")


def collapse(text: str) -> str:
    return _WS.sub(" ", text).strip()


def strip_markers(text: str) -> str:
    return text.replace("[[", "").replace("]]", "")


def fix_content(text: str) -> str:
    """A fragment that starts with a tag but ends in text gets an enclosing element."""
    return f"<div>{text}</div>" if text.startswith("<") and not text.endswith(">") else text


# type guesses of table columns, most specific first (fixed order)
_TYPES = [
    ("datetime", re.compile(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z?$")),
    ("time", re.compile(r"^\d{2}:\d{2}:\d{2}$")),
    ("date", re.compile(r"^\d{4}-\d{2}-\d{2}$")),
    ("integer", re.compile(r"^[+-]?\d+$")),
    ("number", re.compile(r"^[+-]?\d*\.?\d+(?:[eE][+-]?\d+)?$")),
    ("boolean", re.compile(r"^(?:true|True|TRUE|1|false|False|FALSE|0)$")),
    ("object", re.compile(r"^\{.*\}$", re.S)),
    ("array", re.compile(r"^\[.*\]$", re.S)),
]


def guess_type(value: str) -> str:
    return next((n for n, p in _TYPES if p.match(value)), "string" if value else "any")


def infer_fields(rows: list[list[str]], names: list[str] | None) -> list[dict]:
    """Name and type of each column; the type most cells agree on."""
    width = max((len(r) for r in rows), default=0)
    out = []
    for c in range(max(width, len(names or []))):
        guesses = [guess_type(r[c]) for r in rows if c < len(r) and r[c]]
        best = max(sorted(set(guesses)), key=guesses.count) if guesses else "any"
        name = names[c] if names and c < len(names) else f"name{c + 1}"
        out.append({"name": name, "type": best, "format": "default"})
    return out


def _run(call: Iterator):
    """Run a walk whose steps yield further walks, on an explicit stack: no depth is too deep."""
    stack, value = [call], None
    while stack:
        try:
            deeper = stack[-1].send(value)
        except StopIteration as e:
            stack.pop()
            value = e.value
        else:
            stack.append(deeper)
            value = None
    return value


class Extractor:
    """Blocks and text lines of one document.

    Walks over elements are generators that yield the walks they need done (see ``_run``).
    What each tag does to a running text is in ``handlers``; a subclass may add to it.
    """

    def __init__(self, extractors=ALL, segment: bool = False, keep_scripts: bool = False, excluded=()):
        self.on, self.segment, self.excluded = frozenset(extractors), segment, frozenset(excluded)
        self.dropped = frozenset() if keep_scripts else frozenset(("script", "style"))
        self.blocks: list[dict] = []
        self.lines: list[str] = []
        self.buffer: list[str] = []
        self.tables = self.level_tables = 0
        self.handlers: dict[str, Callable[[Element], Iterator]] = {
            **dict.fromkeys(HEADINGS, self.heading), **dict.fromkeys(LISTS, self.list), "table": self.outer_table,
        }

    def parse(self, text: str | None) -> Extractor:
        if text and text.strip():
            _run(self.walk(parse_html(text)))
            self.flush()
        return self

    # inline content ---------------------------------------------------------

    def inline(self, e: Element, sink: list[str], emit: bool):
        """Text of inline content into ``sink``; links and images become blocks."""
        for c in e.children:
            if isinstance(c, str):
                sink.append(c)
            elif c.tag in self.dropped or c.tag in self.excluded:
                continue
            elif c.tag == "br":
                sink.append(" ")
            elif c.tag == "img":
                self.image(c, sink, emit)
            elif c.tag == "a" and "href" in c.attrs:
                yield self.anchor(c, sink, emit)
            else:
                yield self.inline(c, sink, emit)

    def anchor(self, e: Element, sink: list[str], emit: bool):
        inner: list[str] = []
        yield self.inline(e, inner, emit)
        raw = "".join(inner)
        text = collapse(raw)
        if not text:
            return
        if emit:
            self.blocks.append({"type": "link", "url": e.attrs["href"], "text": text})
        lead, tail = raw[: len(raw) - len(raw.lstrip())], raw[len(raw.rstrip()) :]
        sink.append(f"{lead}[[{text}]]{tail}")

    def image(self, e: Element, sink: list[str], emit: bool) -> None:
        url = e.attrs.get("src", "")
        if emit:
            title = e.attrs.get("title") or e.attrs.get("alt") or url
            self.blocks.append({"type": "image", "url": url, "title": title})
        sink.append(f"{{image:{url}}}")

    # block content ------------------------------------------------------------

    def flush(self) -> None:
        raw = "".join(self.buffer)
        self.buffer.clear()
        if "text" not in self.on:
            return
        if not self.segment:
            text = collapse(raw)
            if text:
                self.blocks.append({"type": "text", "text": text})
                self.lines.append(strip_markers(text))
            return
        for b in classify(raw):
            self.blocks.append(b)
            self.lines += [strip_markers(x) for x in ([b["heading"]] if "heading" in b else []) + b.get("items", [])]
            if b["type"] != "list":
                self.lines.append(strip_markers(b["text"]))

    def walk(self, e: Element):
        for c in e.children:
            if isinstance(c, str):
                self.buffer.append(c)
            elif c.tag in self.dropped or c.tag in self.excluded:
                continue
            elif c.tag in self.handlers:
                self.flush()
                yield self.handlers[c.tag](c)
            elif c.tag in ("p", "div"):
                self.flush()
                yield self.walk(c)
                self.flush()
            elif c.tag == "br":
                self.flush()
            elif c.tag == "img":
                self.image(c, self.buffer, "text" in self.on)
            elif c.tag == "a" and "href" in c.attrs:
                yield self.anchor(c, self.buffer, "text" in self.on)
            else:
                yield self.walk(c)

    def heading(self, e: Element):
        if "heading" not in self.on:
            return
        parts: list[str] = []
        yield self.inline(e, parts, True)
        text = collapse("".join(parts))
        if text:
            self.blocks.append({"type": "heading", "text": text})
            self.lines.append(strip_markers(text))

    def list(self, e: Element):
        if "list" not in self.on:
            return
        heading: list[str] = []
        items: list[str] = []
        seen_item = False

        def close(sink: list[str], item: bool) -> None:
            text = collapse("".join(sink))
            sink.clear()
            if not text:
                return
            self.lines.append(strip_markers(text))
            if item:
                items.append(text)
            elif seen_item:
                self.blocks.append({"type": "text", "text": text})
            else:
                heading.append(strip_markers(text))

        def read(node: Element, sink: list[str], item: bool):
            nonlocal seen_item
            for c in node.children:
                if isinstance(c, str):
                    sink.append(c)
                elif c.tag in self.dropped or c.tag in self.excluded:
                    continue
                elif c.tag == "table":
                    close(sink, item)
                    yield self.table(c)
                elif c.tag == "li":
                    close(sink, item)
                    seen_item = True
                    own: list[str] = []
                    yield read(c, own, True)
                    close(own, True)
                elif c.tag in LISTS:
                    close(sink, item)
                    inner: list[str] = []
                    yield read(c, inner, False)
                    close(inner, False)
                elif c.tag == "a" and "href" in c.attrs:
                    yield self.anchor(c, sink, True)
                elif c.tag == "img":
                    self.image(c, sink, True)
                elif not item and (c.tag in HEADINGS or c.tag in ("p", "div")):
                    close(sink, False)
                    yield read(c, sink, False)
                    close(sink, False)
                elif c.tag == "br":
                    if item:
                        sink.append(" ")
                    else:
                        close(sink, False)
                elif item and c.tag in ("p", "div"):
                    sink.append(" ")
                    yield read(c, sink, True)
                    sink.append(" ")
                else:
                    yield read(c, sink, item)

        rest: list[str] = []
        yield read(e, rest, False)
        close(rest, False)
        if items or heading:
            block = {"type": "list", "subtype": "unordered", "items": items}
            if heading:
                block["heading"] = " ".join(heading)
            self.blocks.append(block)

    # tables --------------------------------------------------------------------

    def rows_of(self, table: Element) -> Iterator[tuple[Element, bool]]:
        """Rows of a table, without those of nested tables, and whether they are in thead."""
        todo = [(c, False) for c in reversed(table.children) if isinstance(c, Element)]
        while todo:
            e, in_head = todo.pop()
            if e.tag == "tr":
                yield e, in_head
            elif e.tag != "table":
                inside = in_head or e.tag == "thead"
                todo.extend((c, inside) for c in reversed(e.children) if isinstance(c, Element))

    def outer_table(self, e: Element):
        yield self.table(e)

    def table(self, e: Element, depth: int = 0):
        """Emit the table (nested ones first); returns its number within the outermost."""
        if "table" not in self.on:
            return None
        rows = list(self.rows_of(e))
        cells = [[c for c in r.children if isinstance(c, Element) and c.tag in ("td", "th")] for r, _ in rows]
        if cells and max(map(len, cells)) == 1 and len(self.on) > 1:  # layout, not data
            for row in cells:
                for cell in row:
                    yield self.walk(cell)
                    self.flush()
            return None
        head: list[list[str]] = []
        body: list[list[str]] = []
        references: list[str] = []
        for (row, in_head), row_cells in zip(rows, cells):
            values = []
            for cell in row_cells:
                parts: list[str] = []
                for inner in self.outer_tables(cell):
                    n = yield self.table(inner, depth + 1)
                    if n is not None:
                        references.append(f"{{table:{n}}}")
                        parts.append(f"{{table:{n}}} ")
                yield self.cell(cell, parts)
                values.append(collapse("".join(parts)))
            if not any(values):
                continue
            header = in_head or not body and all(c.tag == "th" for c in row_cells)
            (head if header else body).append(values)
            self.lines.append("\\t".join(strip_markers(v) for v in values))
        if not head and not body:
            return None
        if head:
            fields = infer_fields(body, [" ".join(x for x in col if x) for col in zip(*head)])
        else:
            fields = infer_fields(body, None)
            if len(body) > 1 and any(guess_type(v) != f["type"] for v, f in zip(body[0], infer_fields(body[1:], None))):
                head, body = [body[0]], body[1:]
                fields = infer_fields(body, head[0])
        self.tables += 1
        self.level_tables += 1
        index = self.level_tables
        block = {
            "type": "table", "table_index": self.tables, "reset_index": index, "head": head, "body": body, "fields": fields
        }
        if references:
            block["references"] = references
        self.blocks.append(block)
        if depth == 0:
            self.level_tables = 0
        return index

    def outer_tables(self, e: Element) -> Iterator[Element]:
        todo = [c for c in reversed(e.children) if isinstance(c, Element)]
        while todo:
            c = todo.pop()
            if c.tag == "table":
                yield c
            else:
                todo.extend(x for x in reversed(c.children) if isinstance(x, Element))

    def cell(self, e: Element, sink: list[str]):
        for c in e.children:
            if isinstance(c, str):
                sink.append(c)
            elif c.tag == "table" or c.tag in self.dropped:
                continue
            elif c.tag == "a" and "href" in c.attrs:
                yield self.anchor(c, sink, True)
            elif c.tag == "img":
                self.image(c, sink, True)
            else:
                if c.tag in ("br", "p", "div", "li"):
                    sink.append(" ")
                yield self.cell(c, sink)


def parse_fragment(text: str | None, extractor: type[Extractor] = Extractor, **options) -> tuple[list[str], list[dict]]:
    """Text lines and blocks of one HTML fragment."""
    x = extractor(**options).parse(fix_content(text) if text else text)
    return x.lines, x.blocks


def parse_value(text: str | None, **options) -> tuple[list[str], list[dict]]:
    """As ``parse_fragment``, but a JSON value becomes one json block without text."""
    if text is not None:
        try:
            return [], [{"type": "json", "json": json.dumps(json.loads(text), ensure_ascii=False)}]
        except (ValueError, RecursionError):
            pass
    return parse_fragment(text, **options)


_MEMBERS = (
    "seq", "type", "text", "url", "title", "subtype", "heading", "items", "table_index", "reset_index", "head", "body",
    "fields", "references", "json",
)


def _whole(block: dict, seq: int) -> dict:
    """A block with all members of its type."""
    return {m: (seq if m == "seq" else block.get(m)) for m in _MEMBERS}


def parsed_value(text: str | None, **options) -> tuple[list[str], list[dict]]:
    lines, blocks = parse_value(text, **options)
    return lines, [_whole(b, i) for i, b in enumerate(blocks)]


def html_blocks(html: Column, json_values: bool = False, **options) -> Column:
    """Struct of text lines and blocks of an HTML column: one Arrow call per batch,
    each fragment is parsed once."""
    one = parse_value if json_values else parse_fragment

    def run(texts: pd.Series) -> pd.DataFrame:
        lines, blocks = [], []
        for t in texts:
            a, b = one(t, **options)
            lines.append(a)
            blocks.append([_whole(x, i) for i, x in enumerate(b)])
        return pd.DataFrame({"text": lines, "structured_content": blocks})

    return F.pandas_udf(run, PARSED)(html)


def exploded_blocks(df: DataFrame, html: str, *keys: str, **options) -> DataFrame:
    """keys and one row per block of ``html``."""
    parsed = spread(df.select(*keys, html)).select(*keys, html_blocks(F.col(html), **options).alias("p"))
    return parsed.select(*keys, F.explode("p.structured_content").alias("b")).select(*keys, "b.*")
