"""Deeply nested records into flat, related tables.

A record is read as a tree of fields, blocks and parts (list items, head and body
cells). A bottom-up tree automaton gives each node its state: the state follows
from the node's symbol (what kind of thing stands there) and the set of its
members' states, by a transition table that is filled once per pair. The states
are the structural variants. Each variant is routed to its typed subtype table;
all tables share the supertype keys ``raw_id, node, parent``, so any row names its
parent. One pass over each document, no shuffle.

Defined cases: a payload that is null, no valid JSON or holds NaN/Infinity
gives nothing; JSON held in a string counts as what it holds, at every place a
structure is expected; a block not in a list is a list of one; null rows have
no cells; null and empty items and cells are rows; of repeated object keys the
last counts; a field name repeated within one document gives its rows once.
No depth is too deep: parser, walk and automaton use explicit stacks.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from json.decoder import scanstring

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docloom.session import materialise, spread

NODES = (
    "raw_id bigint, node int, parent int, variant string, field_name string, block_path string, "
    "part_name string, pos string, seq int, block_type string, text string, url string, title string, "
    "subtype string, heading string, n_children int"
)
_COLUMNS = [c.split()[0] for c in NODES.split(", ")]
_SCHEMA = pa.schema([
    (c, {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[t])
    for c, t in (x.split() for x in NODES.split(", "))
])


# --- JSON of any depth ---------------------------------------------------------------------


def _reject(name: str):
    raise ValueError(name)


_decode = json.JSONDecoder(parse_constant=_reject).decode
_BLANK = re.compile(r"[ \t\n\r]*")
_ATOM = re.compile(r"(-?(?:0|[1-9]\d*))(\.\d+)?([eE][-+]?\d+)?|true|false|null")
_WORDS = {"true": True, "false": False, "null": None}


def _parse_deep(text: str):
    """The JSON value of ``text`` by an explicit stack, for what is too deep for the usual parser."""
    skip = lambda k: _BLANK.match(text, k).end()
    open_: list[tuple[list | dict, str | None]] = []  # containers, with the key their next value goes to
    value, at, key = None, skip(0), None

    def name(k: int) -> tuple[str, int]:
        k = skip(k)
        if text[k : k + 1] != '"':
            raise ValueError(f"no key at {k}")
        out, k = scanstring(text, k + 1, True)
        k = skip(k)
        if text[k : k + 1] != ":":
            raise ValueError(f"no colon at {k}")
        return out, skip(k + 1)

    while True:
        c = text[at : at + 1]
        done = True
        if c in ("{", "["):
            value, at = ({} if c == "{" else []), skip(at + 1)
            if text[at : at + 1] == ("}" if c == "{" else "]"):
                at += 1
            else:
                open_.append((value, key))
                key = None
                if c == "{":
                    key, at = name(at)
                done = False
        elif c == '"':
            value, at = scanstring(text, at + 1, True)
        else:
            m = _ATOM.match(text, at)
            if not m:
                raise ValueError(f"no value at {at}")
            w, at = m.group(), m.end()
            value = _WORDS[w] if w in _WORDS else float(w) if m.group(2) or m.group(3) else int(w)
        while done:
            if not open_:
                if skip(at) != len(text):
                    raise ValueError(f"more text at {at}")
                return value
            holder, outer = open_[-1]
            if isinstance(holder, dict):
                holder[key] = value
            else:
                holder.append(value)
            at = skip(at)
            c = text[at : at + 1]
            if c == ",":
                at = skip(at + 1)
                if isinstance(holder, dict):
                    key, at = name(at)
                done = False
            elif c == ("}" if isinstance(holder, dict) else "]"):
                open_.pop()
                value, key, at = holder, outer, at + 1
            else:
                raise ValueError(f"no comma at {at}")


def parse(text: str):
    """The JSON value of ``text``; ValueError if there is none."""
    try:
        return _decode(text)
    except RecursionError:
        return _parse_deep(text)


def _json_text(value) -> str:
    """A value as JSON, at any depth."""
    try:
        return json.dumps(value, ensure_ascii=False)
    except RecursionError:
        pass
    out, todo = [], [value]
    while todo:
        x = todo.pop()
        if isinstance(x, tuple):  # text that is ready
            out.append(x[0])
        elif isinstance(x, dict):
            parts: list = [("{",)]
            for i, (k, v) in enumerate(x.items()):
                parts += [(f"{', ' if i else ''}{json.dumps(k, ensure_ascii=False)}: ",), v]
            todo.extend(reversed([*parts, ("}",)]))
        elif isinstance(x, list):
            parts = [("[",)]
            for i, v in enumerate(x):
                parts += [(", " if i else "",), v]
            todo.extend(reversed([*parts, ("]",)]))
        else:
            out.append(json.dumps(x, ensure_ascii=False))
    return "".join(out)


def opened(value):
    """A structure held as JSON in a string, at any number of levels."""
    while isinstance(value, str):
        body = value.strip()
        if body[:1] not in ("{", "[", '"'):
            return value
        try:
            value = parse(body)
        except ValueError:
            return value
    return value


def _text(value) -> str | None:
    return value if value is None or isinstance(value, str) else _json_text(value)


def _listed(value) -> list:
    value = opened(value)
    return value if isinstance(value, list) else [] if value is None else [value]


# --- the automaton ---------------------------------------------------------------------------

# Variants by subtype table. The states of members decide among those of a line.
TABLES = {
    "fields": ("field_empty", "field_flat", "field_sectioned"),
    "sections": ("section_empty", "section_flat", "section_deep"),
    "lists": ("list_empty", "list_scalars", "list_objects", "list_nested", "list_mixed"),
    "tables": ("table_empty", "table_head_only", "table_scalars", "table_objects"),
    "leaves": ("leaf_text", "leaf_link", "leaf_scalar", "leaf_null", "leaf_sequence"),
    "values": ("part_scalar", "part_null", "part_sequence"),
    "objects": ("part_object", "part_nested", "part_deep"),
}
TABLE_OF = {v: t for t, vs in TABLES.items() for v in vs}
_PLAIN = {"part_scalar", "part_null"}


def _transition(symbol: str, members: frozenset[tuple[str, str]]) -> str:
    """State of a node of ``symbol`` whose members stand at (place, state)."""
    states = {s for _, s in members}
    tables = {TABLE_OF[s] for s in states}
    if symbol == "field":
        return "field_empty" if not members else "field_sectioned" if "sections" in tables else "field_flat"
    if symbol == "section":
        return "section_empty" if not members else "section_deep" if "sections" in tables else "section_flat"
    if symbol == "list":
        if not members:
            return "list_empty"
        if states <= _PLAIN:
            return "list_scalars"
        if states & _PLAIN:
            return "list_mixed"
        return "list_nested" if states & {"part_nested", "part_deep"} else "list_objects"
    if symbol == "table":
        if not members:
            return "table_empty"
        if {p for p, _ in members} == {"head"}:
            return "table_head_only"
        return "table_scalars" if states <= _PLAIN else "table_objects"
    if symbol == "part":
        return "part_object" if not members else "part_deep" if states & {"part_nested", "part_deep"} else "part_nested"
    return symbol  # a symbol without members is its own state


class Automaton:
    """Transitions, each worked out once."""

    def __init__(self):
        self.table: dict[tuple[str, frozenset], str] = {}

    def state(self, symbol: str, members: frozenset[tuple[str, str]]) -> str:
        key = (symbol, members)
        if key not in self.table:
            self.table[key] = _transition(symbol, members)
        return self.table[key]

    def run(self, rows: list[dict]) -> None:
        """States of all nodes of a record, bottom-up; a parent stands before its members."""
        below: list[set[tuple[str, str]]] = [set() for _ in rows]
        for row in reversed(rows):
            members = below[row["node"]]
            row["variant"] = self.state(row["symbol"], frozenset(members))
            if row["parent"] is not None:
                below[row["parent"]].add((row.get("part_name") or "block", row["variant"]))


def _block_symbol(b) -> str:
    if b is None:
        return "leaf_null"
    if isinstance(b, list):
        return "leaf_sequence"
    if not isinstance(b, dict):
        return "leaf_scalar"
    if "structured_content" in b:
        return "section"
    if "head" in b or "body" in b or b.get("type") == "table":
        return "table"
    if "items" in b or b.get("type") == "list":
        return "list"
    return "leaf_link" if b.get("url") is not None else "leaf_text"


def _part_symbol(x) -> str:
    if x is None:
        return "part_null"
    return "part" if isinstance(x, dict) else "part_sequence" if isinstance(x, list) else "part_scalar"


# --- the walk ----------------------------------------------------------------------------------


def _fields(doc) -> list[tuple[str, object]]:
    data = opened(doc.get("data"))
    if isinstance(data, dict):
        return list(data.items())
    out = []
    for f in _listed(data):
        f = opened(f)
        if isinstance(f, dict) and f.get("name") is not None:
            out.append((_text(f["name"]), f))
    return out


class _Walk:
    """Rows of one document; nodes are numbered in document order."""

    def __init__(self, raw_id: int):
        self.raw_id, self.rows = raw_id, []

    def add(self, parent: int | None, symbol: str, **values) -> int:
        node = len(self.rows)
        self.rows.append({"raw_id": self.raw_id, "node": node, "parent": parent, "symbol": symbol, **values})
        return node

    def document(self, doc) -> None:
        seen = set()
        for name, field in _fields(doc) if isinstance(doc, dict) else ():
            if name in seen:
                continue
            seen.add(name)
            field = opened(field)
            blocks = _listed(field.get("structured_content")) if isinstance(field, dict) else []
            text = field.get("text") if isinstance(field, dict) else field
            self.blocks(name, self.add(None, "field", field_name=name, text=_text(text), n_children=len(blocks)), blocks)

    def blocks(self, name: str, parent: int, blocks: list) -> None:
        stack = [(parent, str(i), i, b) for i, b in reversed(list(enumerate(blocks)))]
        while stack:
            above, path, seq, raw = stack.pop()
            b = opened(raw)
            inner = _listed(b.get("structured_content")) if isinstance(b, dict) else []
            common = {"field_name": name, "block_path": path, "seq": seq, "n_children": len(inner)}
            if not isinstance(b, dict):
                self.add(above, _block_symbol(b), text=_text(b), **common)
                continue
            node = self.add(
                above, _block_symbol(b), block_type=_text(b.get("type")), text=_text(b.get("text")),
                url=_text(b.get("url")), title=_text(b.get("title")), subtype=_text(b.get("subtype")),
                heading=_text(b.get("heading")), **common,
            )
            self.members(name, path, node, "item", [(str(i), x) for i, x in enumerate(_listed(b.get("items")))])
            head = _listed(b.get("head"))
            if head and not any(isinstance(opened(r), list) for r in head):
                head = [head]  # a head without rows of its own is row 0
            for part, rows in (("head", head), ("body", _listed(b.get("body")))):
                for r, row in enumerate(rows):
                    self.members(name, path, node, part, [(f"{r}.{c}", x) for c, x in enumerate(_listed(row))])
            stack.extend((node, f"{path}.{i}", i, x) for i, x in reversed(list(enumerate(inner))))

    def members(self, name: str, path: str, block: int, part: str, values: list) -> None:
        stack = [(block, pos, x) for pos, x in reversed(values)]
        while stack:
            above, pos, raw = stack.pop()
            x = opened(raw)
            below = _listed(x.get("items")) if isinstance(x, dict) else []
            node = self.add(
                above, _part_symbol(x), field_name=name, block_path=path, part_name=part, pos=pos,
                seq=int(pos.rpartition(".")[2]), text=_text(x.get("text") if isinstance(x, dict) else raw),
                url=_text(x.get("url")) if isinstance(x, dict) else None, n_children=len(below),
            )
            stack.extend((node, f"{pos}.{i}", y) for i, y in reversed(list(enumerate(below))))


def document_rows(raw_id: int, payload: str | None, automaton: Automaton | None = None) -> list[dict]:
    if payload is None:
        return []
    try:
        doc = opened(parse(payload))
    except ValueError:
        return []
    walk = _Walk(raw_id)
    walk.document(doc)
    (automaton or Automaton()).run(walk.rows)
    return walk.rows


MOST_ROWS, MOST_CHARS = 50_000, 32 << 20  # of one Arrow batch


def _flatten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    automaton = Automaton()
    columns: list[list] = [[] for _ in _COLUMNS]
    chars = 0
    for b in batches:
        for raw_id, payload in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            for row in document_rows(raw_id, payload, automaton):
                for column, c in zip(columns, _COLUMNS):
                    column.append(row.get(c))
                chars += len(row.get("block_path") or "") + len(row.get("pos") or "") + len(row.get("text") or "")
                if len(columns[0]) >= MOST_ROWS or chars > MOST_CHARS:
                    yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(columns, _SCHEMA)], schema=_SCHEMA)
                    columns, chars = [[] for _ in _COLUMNS], 0
    if columns[0]:
        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(columns, _SCHEMA)], schema=_SCHEMA)


def flatten_records(raw: DataFrame) -> DataFrame:
    """All nodes of all documents as supertype rows (see ``NODES``)."""
    return spread(raw.select("raw_id", "payload")).mapInArrow(_flatten, NODES)


_KEYS = ["raw_id", "node", "parent", "variant", "field_name"]
_BLOCK = [*_KEYS, "block_path", "seq", "block_type", "text"]
_PART = [*_KEYS, "block_path", "part_name", "pos", "seq", "text"]
COLUMNS = {
    "fields": [*_KEYS, "text", "n_children"],
    "sections": [*_BLOCK, "title", "heading", "n_children"],
    "lists": [*_BLOCK, "title", "subtype", "heading"],
    "tables": [*_BLOCK, "title", "heading"],
    "leaves": [*_BLOCK, "url", "title", "subtype", "heading"],
    "values": _PART,
    "objects": [*_PART, "url", "n_children"],
}


def subtype_tables(nodes: DataFrame) -> dict[str, DataFrame]:
    """One typed table for each group of variants (``TABLES``), with the supertype keys and
    the parent link. ``nodes`` is read once per table used: give it written."""
    return {t: nodes.where(F.col("variant").isin(*TABLES[t])).select(*COLUMNS[t]) for t in TABLES}


def written_tables(raw: DataFrame) -> dict[str, DataFrame]:
    """The subtype tables of nodes that were written once to the shared folder."""
    return subtype_tables(materialise(flatten_records(raw), "nodes"))


def parts(tables: dict[str, DataFrame]) -> DataFrame:
    """List items and cells of the routed tables."""
    return tables["values"].select(*_PART).unionByName(tables["objects"].select(*_PART))
