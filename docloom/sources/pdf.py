"""Text of PDF files, by the standard library.

Reads the objects of a file (also those packed in object streams), its pages in
order, and the strings that their content streams show. Characters are mapped by a
font's ToUnicode table where there is one, else read as Latin text. A new line begins
where the text position moves down, a new paragraph at a larger step. Encrypted files,
images of text and fonts without any mapping are beyond it: they raise or give no text.
"""

from __future__ import annotations

import re
import zlib
from html import escape

_OBJECT = re.compile(rb"(\d+)\s+(\d+)\s+obj\b(.*?)\bendobj", re.S)
_STREAM = re.compile(rb"\bstream\r?\n(.*?)\r?\n?endstream", re.S)
_REF = re.compile(rb"(\d+)\s+\d+\s+R")
_TOKEN = re.compile(
    rb"\((?:[^()\\]|\\.|\((?:[^()\\]|\\.)*\))*\)|<[0-9A-Fa-f\s]*>|\[|\]|/[^\s()<>\[\]{}/%]+|[-+]?(?:\d+\.?\d*|\.\d+)|[A-Za-z'\"*]+|%[^\r\n]*", re.S
)
_ESCAPES = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}
_ESCAPED = re.compile(rb"\\([0-7]{1,3}|\r\n|.)", re.S)


def _decoded(body: bytes) -> bytes:
    """The stream of an object, unpacked."""
    m = _STREAM.search(body)
    if not m:
        return b""
    data, head = m.group(1), body[: m.start()]
    if b"FlateDecode" in head:
        data = zlib.decompressobj().decompress(data)
    elif b"/Filter" in head and re.search(rb"/Filter\s*(?!\[\s*\])", head):
        return b""
    columns = re.search(rb"/Predictor\s+1[0-5]\b.*?/Columns\s+(\d+)|/Columns\s+(\d+).*?/Predictor\s+1[0-5]\b", head, re.S)
    return _unpredicted(data, int(columns.group(1) or columns.group(2))) if columns else data


def _unpredicted(data: bytes, width: int) -> bytes:
    """Rows of a stream with row differences (only the kinds none and up, as tables of places have)."""
    out, above = bytearray(), bytes(width)
    for k in range(0, len(data) - width, width + 1):
        row = data[k + 1 : k + 1 + width]
        above = bytes((a + b) & 255 for a, b in zip(row, above)) if data[k] == 2 else row
        out += above
    return bytes(out)


def _objects(content: bytes) -> dict[int, bytes]:
    out = {int(m.group(1)): m.group(3) for m in _OBJECT.finditer(content)}
    for body in list(out.values()):
        if re.search(rb"/Type\s*/ObjStm\b", body):
            data = _decoded(body)
            first = int(re.search(rb"/First\s+(\d+)", body).group(1))
            places = list(map(int, data[:first].split()))
            ends = [*places[3::2], len(data) - first]
            for n, a, b in zip(places[::2], places[1::2], ends):
                out.setdefault(n, data[first + a : first + b])
    return out


def _value(body: bytes, name: bytes) -> bytes | None:
    """What follows a name in a dictionary: up to the next name at this depth, roughly."""
    m = re.search(rb"/" + name + rb"(?![A-Za-z])\s*", body)
    if not m:
        return None
    rest = body[m.end() :]
    if rest[:2] == b"<<":
        depth = 0
        for t in re.finditer(rb"<<|>>", rest):
            depth += 1 if t.group() == b"<<" else -1
            if not depth:
                return rest[: t.end()]
    if rest[:1] == b"[":
        return rest[: rest.find(b"]") + 1]
    return re.split(rb"/|>>", rest[1:], maxsplit=1)[0].join([rest[:1], b""]) if rest[:1] != b"/" else b"/" + re.split(rb"[\s/>\[(<]", rest[1:], maxsplit=1)[0]


def _resolved(objects: dict[int, bytes], value: bytes | None) -> bytes:
    m = _REF.match(value.strip()) if value else None
    return objects.get(int(m.group(1)), b"") if m else value or b""


def _pages(objects: dict[int, bytes]) -> list[tuple[bytes, bytes]]:
    """Page objects in order with the resources that hold for each."""
    roots = [b for b in objects.values() if re.search(rb"/Type\s*/Catalog\b", b)]
    out: list[tuple[bytes, bytes]] = []
    todo = [(_resolved(objects, _value(roots[0], b"Pages")), b"")] if roots else []
    seen: set[bytes] = set()
    while todo:
        body, above = todo.pop()
        if body in seen and b"/Kids" in body:
            continue
        seen.add(body)
        own = _resolved(objects, _value(body, b"Resources")) or above
        kids = _value(body, b"Kids")
        if kids:
            todo.extend((objects.get(int(k), b""), own) for k in reversed(_REF.findall(kids)))
        elif body:
            out.append((body, own))
    return out or [(b, _resolved(objects, _value(b, b"Resources"))) for b in objects.values() if re.search(rb"/Type\s*/Page\b", b)]


_HEX = rb"<([0-9A-Fa-f\s]+)>"


def _text_of_hex(h: bytes) -> str:
    return bytes.fromhex(re.sub(rb"\s", b"", h).decode()).decode("utf-16-be", "replace")


def _mapping(data: bytes) -> tuple[dict[int, str], int]:
    """A ToUnicode table, and how many bytes a character code has."""
    out: dict[int, str] = {}
    width = 1
    space = re.search(rb"begincodespacerange\s*" + _HEX, data)
    if space:
        width = max(1, len(re.sub(rb"\s", b"", space.group(1))) // 2)
    for part in re.findall(rb"beginbfchar(.*?)endbfchar", data, re.S):
        for a, b in re.findall(_HEX + rb"\s*" + _HEX, part):
            out[int(a, 16)] = _text_of_hex(b)
    for part in re.findall(rb"beginbfrange(.*?)endbfrange", data, re.S):
        for a, b, to, many in re.findall(_HEX + rb"\s*" + _HEX + rb"\s*(?:" + _HEX + rb"|\[(.*?)\])", part, re.S):
            first, last = int(a, 16), int(b, 16)
            if many:
                out.update(zip(range(first, last + 1), map(_text_of_hex, re.findall(_HEX, many))))
            else:
                start = _text_of_hex(to)
                out.update((first + i, start[:-1] + chr(ord(start[-1]) + i)) for i in range(min(last - first + 1, 65536)) if start)
    return out, width


def _fonts(objects: dict[int, bytes], resources: bytes) -> dict[bytes, tuple[dict[int, str], int]]:
    out = {}
    for name, number in re.findall(rb"/([^\s/<>\[\]()]+)\s+(\d+)\s+\d+\s+R", _resolved(objects, _value(resources, b"Font"))):
        font = objects.get(int(number), b"")
        table = _resolved(objects, _value(font, b"ToUnicode"))
        out[b"/" + name] = _mapping(_decoded(table)) if table else ({}, 1)
    return out


def _string(token: bytes) -> bytes:
    if token[:1] == b"<":
        h = re.sub(rb"\s", b"", token[1:-1])
        return bytes.fromhex((h + b"0" * (len(h) % 2)).decode())

    def one(m: re.Match) -> bytes:
        x = m.group(1)
        return bytes([int(x, 8) & 255]) if x[:1].isdigit() and x[:1] < b"8" else b"" if x in (b"\n", b"\r", b"\r\n") else _ESCAPES.get(x, x)

    return _ESCAPED.sub(one, token[1:-1])


def _shown(raw: bytes, font: tuple[dict[int, str], int]) -> str:
    table, width = font
    if not table:
        return raw.decode("cp1252", "replace")
    codes = (int.from_bytes(raw[k : k + width], "big") for k in range(0, len(raw), width))
    return "".join(table.get(c, chr(c) if width == 1 and c >= 32 else "") for c in codes)


def _page_lines(content: bytes, fonts: dict) -> list[tuple[float, str]]:
    """Lines of a page with the step down to each, from the text operators."""
    lines: list[tuple[float, str]] = []
    held: list[str] = []
    step, leading, y = 0.0, 0.0, 0.0
    font: tuple[dict[int, str], int] = ({}, 1)
    stack: list[bytes] = []

    def line(down: float) -> None:
        nonlocal step
        text = re.sub(r"\s+", " ", "".join(held)).strip()
        held.clear()
        if text:
            lines.append((step, text))
            step = 0.0
        step += abs(down)

    for t in _TOKEN.findall(content):
        if t[:1] in b"(<[]/+-.0123456789":
            stack.append(t)
            continue
        number = lambda k: float(stack[k]) if len(stack) >= -k and re.match(rb"^[-+.\d]+$", stack[k]) else 0.0
        if t == b"Tf" and len(stack) >= 2:
            font = fonts.get(stack[-2], ({}, 1))
        elif t in (b"Tj", b"'", b'"'):
            if t != b"Tj":
                line(leading or 12.0)
            if stack and stack[-1][:1] in b"(<":
                held.append(_shown(_string(stack[-1]), font))
        elif t == b"TJ":
            for x in stack:
                if x[:1] in b"(<":
                    held.append(_shown(_string(x), font))
                elif re.match(rb"^-\d", x) and float(x) < -180:
                    held.append(" ")  # a gap as wide as a blank
        elif t in (b"Td", b"TD"):
            if t == b"TD":
                leading = -number(-1)
            if number(-1):
                line(number(-1))
            elif number(-2):
                held.append(" ")
        elif t == b"T*":
            line(leading or 12.0)
        elif t == b"TL":
            leading = number(-1)
        elif t == b"Tm":
            if number(-1) != y:
                line(number(-1) - y)
            y = number(-1)
        elif t == b"ET":
            held.append(" ")
        stack.clear()
    line(0.0)
    return lines


def _info(objects: dict[int, bytes], content: bytes) -> dict[str, str]:
    m = re.search(rb"/Info\s+(\d+)\s+\d+\s+R", content)
    body = objects.get(int(m.group(1)), b"") if m else b""
    out = {}
    for name, key in ((b"Title", "title"), (b"Author", "creator"), (b"CreationDate", "created"), (b"ModDate", "modified")):
        t = re.search(rb"/" + name + rb"\s*(\((?:[^()\\]|\\.)*\)|<[0-9A-Fa-f\s]*>)", body, re.S)
        if t:
            raw = _string(t.group(1))
            text = raw[2:].decode("utf-16-be", "replace") if raw[:2] == b"\xfe\xff" else raw.decode("cp1252", "replace")
            date = re.match(r"D:(\d{4})(\d\d)?(\d\d)?(\d\d)?(\d\d)?(\d\d)?", text)
            if date:
                d = [x or z for x, z in zip(date.groups(), ("", "01", "01", "00", "00", "00"))]
                text = f"{d[0]}-{d[1]}-{d[2]}T{d[3]}:{d[4]}:{d[5]}"
            out[key] = text
    return out


def pdf_to_xhtml(content: bytes) -> tuple[str, dict[str, str]]:
    """XHTML (one ``div`` a page, one ``p`` a paragraph) and metadata of a PDF file."""
    if not content.lstrip()[:5] == b"%PDF-":
        raise ValueError("no PDF file")
    if re.search(rb"/Encrypt\s+\d+\s+\d+\s+R", content):
        raise ValueError("encrypted")
    objects = _objects(content)
    pages, words = [], 0
    for page, resources in _pages(objects):
        fonts = _fonts(objects, resources)
        streams = [_decoded(objects.get(int(n), b"")) for n in _REF.findall(_value(page, b"Contents") or b"")]
        lines = _page_lines(b"\n".join(streams), fonts)
        usual = sorted(s for s, _ in lines[1:])[len(lines[1:]) // 2] if len(lines) > 1 else 0.0
        paragraphs: list[list[str]] = []
        for s, text in lines:
            if paragraphs and s <= 1.4 * usual:
                paragraphs[-1].append(text)
            else:
                paragraphs.append([text])
            words += len(text.split())
        pages.append("<div class=\"page\">" + "".join(f"<p>{escape(' '.join(p), quote=False)}</p>" for p in paragraphs) + "</div>")
    return f"<body>{''.join(pages)}</body>", _info(objects, content) | {"word_count": str(words)}
