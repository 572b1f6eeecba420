"""Plain-text segmentation: sentences, headings, list items, continuation.

A small tokeniser and a fixed stop-word list stand in for a language model, so
these rules approximate model-based segmentation.
"""

from __future__ import annotations

import re

from docloom.functions.text import BULLETS, LIST_NUMBER

ORDERED = re.compile(r"^(?:\d{1,3}|[A-Za-z]|[ivxlIVXL]{1,6})[.)]$")
_LIST_NUMBER = re.compile(LIST_NUMBER)
# Words that may stand in lower case within a heading.
STOP_WORDS = frozenset(
    "a an the and or but nor of in on at to for from by with without as is are be was were it its this that these those "
    "your you my our their his her not no into over under up out off about after before via per than then".split()
)
_TOKEN = re.compile(r"\n|\w+(?:['’.-]\w+)*[.)](?=\s|$)|\w+(?:['’.-]\w+)*|[^\w\s]")


def tokens(text: str) -> list[str]:
    """Words (with a list marker's own dot), marks and line breaks."""
    out = []
    for t in _TOKEN.findall(text):
        if len(t) > 1 and t[-1] in ".)" and not ORDERED.match(t) and not _LIST_NUMBER.match(t):
            out += [t[:-1], t[-1]]
        else:
            out.append(t)
    return out


def is_marker(t: str) -> bool:
    return bool(ORDERED.match(t) or t[-1:] in ".)" and len(t) > 1 and _LIST_NUMBER.match(t.rstrip(")")))


def maybe_heading(text: str) -> bool:
    """Capitalised first and last words, only capitals, stop words, marks and digits between."""
    words = [t for t in tokens(text) if t != "\n"]
    if not words:
        return True
    cap = lambda w: w[:1].isupper()
    first = cap(words[0]) or is_marker(words[0])
    last = cap(words[-1]) or words[-1][:1].isdigit() or words[-1] in ".:)" or is_marker(words[-1])
    middle = all(cap(w) or w.lower() in STOP_WORDS or not w[:1].isalpha() for w in words[1:-1])
    return first and last and middle


def continues(lead: str, follow: str) -> bool:
    """Whether ``follow`` goes on with the sentence that ``lead`` began."""
    end = lead.rstrip()[-1:]
    if end in (".", "?", "!"):
        return False
    if end in (",", ";", ":"):
        return True
    return not maybe_heading(lead) and not maybe_heading(follow)


def split_sentences(text: str) -> list[str]:
    """Sentences: at bullets and list numbers on new lines, at heading lines, after . ? !"""
    out: list[str] = []
    for k, line in enumerate(text.split("\n")):
        line = line.strip()
        if not line:
            continue
        if k == 0 and "\n" in text and maybe_heading(line) and not line.endswith((".", "?", "!")):
            out.append(line)
            continue
        first = line.split(maxsplit=1)[0]
        starts_item = first in BULLETS or is_marker(first)
        parts = [p for p in re.split(r"(?<=[?!])\s+|(?<=[^\d\s]\.)\s+(?=[A-Z])|\s+(?=•\s)", line) if p.strip()]
        if out and not starts_item and parts and not out[-1].endswith((".", "?", "!")) and continues(out[-1], parts[0]):
            out[-1] += " " + parts.pop(0).strip()
        out += [p.strip() for p in parts]
    return out


def classify(text: str) -> list[dict]:
    """Blocks of a plain text: headings, texts and lists with their headings."""
    blocks: list[dict] = []
    for s in split_sentences(text):
        first, _, rest = s.partition(" ")
        bullet, ordered = first in BULLETS and rest, is_marker(first) and rest
        if bullet or ordered:
            kind, last = "unordered" if bullet else "ordered", blocks[-1] if blocks else None
            if last and last["type"] == "list" and last["subtype"] == kind:
                last["items"].append(rest.strip())
                continue
            if bullet or first.rstrip(".)").lower() in ("1", "a", "i"):
                block = {"type": "list", "subtype": kind, "items": [rest.strip()]}
                if last and last["type"] in ("text", "heading"):
                    block["heading"] = blocks.pop()["text"]
                blocks.append(block)
                continue
        blocks.append({"type": "heading" if maybe_heading(s) and not s.endswith(("?", "!")) else "text", "text": s})
    for i, b in enumerate(blocks):  # a lone ordered item is no list
        if b["type"] == "list" and b["subtype"] == "ordered" and len(b["items"]) == 1 and "heading" not in b:
            t = b["items"][0]
            blocks[i] = {"type": "heading" if maybe_heading(t) else "text", "text": t}
    return blocks
