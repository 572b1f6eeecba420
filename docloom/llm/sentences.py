"""Sentence spans in many languages and scripts, by semi-Markov dynamic programming.

A text is cut at blank lines into paragraphs. In a paragraph every place where a
sentence could end is a candidate. A dynamic program over all candidates picks
the sequence of whole spans with the best joint score: how the closing word and
mark end, how the next word opens, the length of the span, and whether the
quotations and brackets within the span are balanced. Its time is linear: spans
of FREE_SPAN characters or less are compared in a sliding window, of longer ones,
whose score falls evenly with their length, only the best start so far is kept,
which is exact.

Defined cases: null, empty and blank texts have no sentences; positions are
code points; no span has white space at either end; a single line break is
white space; unbalanced quotation marks count as ordinary characters.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter, deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from docloom.session import spread

PROSE_SOURCES = ("call_summaries", "field_notes", "handbook", "newsroom")

# Abbreviations that stand before a name, a noun or a number.
BEFORE_WORD = set(
    "mr mrs ms dr prof sgt lt col gen capt rev hon messrs st mt ft vs cf approx incl excl est resp viz al ed eds vol "
    "ch sec fig figs art arts par pp app ref acct ext tel ver rev avg max dept univ "
    "hr hrn fr frl fa co nr abs bzw inkl exkl lt ca evtl ggf bzgl vgl sog tel str dipl ing "
    "mm mme mlle me pr réf env éd av bd sr sra srta dra dn dña ud uds pág págs núm núms aprox tel avda "
    "डॉ श्री रु प्रो कु".split()
)
# Abbreviations that only a number makes certain to go on.
BEFORE_NUMBER = set("no nos min hrs p s h jan feb mar apr jun jul aug sep sept oct nov dec".split())
# Dotted abbreviations that may end a sentence.
MAY_END = set("U.K U.S U.S.A E.U U.N a.m p.m etc usw Inc Ltd Corp Jr Bros hrs".split())
# Words that look like an abbreviation but for their capital.
NAMES = {"Max", "Min", "No", "Par", "Art", "Ed", "Al", "Me"}
# German month names, before which a number with a dot is a date.
GERMAN_MONTHS = tuple("Januar Jänner Februar März April Mai Juni Juli August September Oktober November Dezember".split())

_PARAGRAPH = re.compile(r"(?>\r\n|\r|\n|\u2029|\u2028)[^\S\r\n\u2028\u2029]*(?>\r\n|\r|\n|\u2029|\u2028)\s*")
_CANDIDATE = re.compile(r"[.!?…]+|[。！？।॥؟｡．۔]+")
_THAI_GAP = re.compile(r"(?<=[฀-๿])\s+(?=[฀-๿])")
_HAS_THAI = re.compile(r"[฀-๿]").search
_QUOTE = re.compile(r"[“”„«»‘’「」『』（）()\[\]\"【】〈〉《》]")
_OPEN_OF = {"”": "“„", "»": "«", "’": "‘", "」": "「", "』": "『", "）": "（(", ")": "(（", "]": "[", "】": "【", "〉": "〈", "》": "《"}
_OPENERS = set("“„«‘「『（([【〈《")
_SOFT_CLOSERS = set(")）]】")
_OPENING = set("“„«‘\"'「『（([【¿¡")
_WORD_BEFORE = re.compile(r"(?:[^\W\d_]\.)+[^\W\d_]$|[^\s“”„«»‘’\"'()（）\[\].,;:!?…/–—-]+$")

CERTAIN, NEVER = 8.0, -9.0


def _pairs(text: str) -> list[tuple[int, int]]:
    """Balanced quotations and brackets of a paragraph."""
    stack: list[tuple[str, int]] = []
    held: Counter[str] = Counter()  # what the stack holds, so that nothing absent is searched
    out = []
    for m in _QUOTE.finditer(text):
        c, i = m.group(), m.start()
        wanted = ""
        if c == "“" and held["„"]:
            wanted = "„"
        elif c == '"' and held['"']:
            wanted = '"'
        elif c in _OPEN_OF:
            wanted = _OPEN_OF[c]
        if not wanted:
            stack.append((c, i))
            held[c] += 1
        elif any(held[w] for w in wanted):
            while True:
                o, k = stack.pop()
                held[o] -= 1
                if o in wanted:
                    out.append((k, i))
                    break
    return out


def _cased(c: str) -> bool:
    return c.islower() or c.isupper() or c.istitle()


def _end_score(text: str, first: int, mark: str, at: int, closers: str, after: str, gap: bool) -> float:
    """How well a span ends: closing word and mark against the opening word.

    ``first`` is where the paragraph's text begins, ``at`` where the mark does,
    ``closers`` the closing marks behind it, ``after`` the text that follows after
    white space (``gap``: there was some).
    """
    nxt = after[:1]
    quoted = any(c not in _SOFT_CLOSERS for c in closers)
    before = text[at - 1 : at]
    if mark[0] in "。！？।॥؟｡．۔":
        return NEVER if quoted else CERTAIN
    if quoted and not _cased(before) and not before.isascii():
        return NEVER  # scripts without letter case: text follows the quotation
    if nxt.islower():
        return NEVER if mark[0] in ".…" or closers or not gap else 2.0
    if "!" in mark or "?" in mark:
        return CERTAIN if gap or nxt.isupper() or nxt in _OPENING or not nxt.isascii() else NEVER
    if mark[0] == "…" or len(mark) > 1:  # dots of omission
        if not gap and not (nxt.isupper() and _cased(before)):
            return NEVER
        if not _cased(nxt) and nxt.isalpha() and not gap:
            return NEVER
        return 3.0
    # a single dot
    if not gap and not closers:
        if nxt.isdigit() or not (nxt.isalpha() or nxt in _OPENING):
            return NEVER
        if nxt.isupper():
            w = _WORD_BEFORE.search(text, max(0, at - 40), at)
            return 3.0 if w and len(w.group()) > 2 and w.group().isalpha() and w.group().lower() not in BEFORE_WORD else NEVER
        return 3.0 if before.isalnum() else NEVER
    if closers:
        return CERTAIN
    m = _WORD_BEFORE.search(text, max(0, at - 40), at)
    exact = m.group() if m else ""
    word = exact.lower()
    if not word:
        return 4.0
    if len(exact) == 1 and exact.isalpha() and not exact.islower():
        return NEVER  # an initial
    if exact in NAMES:
        return CERTAIN
    if exact in MAY_END:
        return 4.0
    if word in BEFORE_WORD:
        return NEVER
    if word in BEFORE_NUMBER:
        return NEVER if nxt.isdigit() else 2.0
    if len(word) == 1 and word.isalpha() or "." in word:
        return NEVER  # initials and dotted abbreviations
    if word.isdigit() and len(word) <= 2:
        if after.startswith(GERMAN_MONTHS):
            return NEVER
        if m.start() <= first:
            return NEVER  # the number of a list item
    return CERTAIN


CUT_QUOTATION, SHORT, FREE_SPAN, PER_CHARACTER, WORDLESS = 12.0, 3, 600, 1 / 2000, 40


def span_score(text: str, start: int, end: int) -> float:
    """Length and opening of one span: long ones lose evenly, tiny and wordless ones at once."""
    n = end - start
    score = -2.0 if n < SHORT else -(n - FREE_SPAN) * PER_CHARACTER if n > FREE_SPAN else 0.0
    return score if any(c.isalnum() for c in text[start : min(end, start + WORDLESS)]) else score - 1.0


def _candidates(part: str) -> list[tuple[int, float, int]]:
    """Possible ends within a paragraph: position, score, and how many quotations a cut there breaks."""
    n = len(part)
    pairs = _pairs(part) if _QUOTE.search(part) else []
    opening, closing = [a for a, _ in sorted(pairs)], sorted(b for _, b in pairs)
    closers = set(closing)
    first = n - len(part.lstrip())
    ends: list[tuple[int, float]] = []
    for m in _CANDIDATE.finditer(part):
        at, e = m.span()
        closed = e
        while e < n:
            if e in closers:
                e += 1
            elif part[e] in " \u00a0\u202f" and e + 1 < n and part[e + 1] == "»" and e + 1 in closers:
                e += 2
            else:
                break
        if e >= n:
            continue
        k = e
        while k < n and part[k].isspace():
            k += 1
        if k >= n:
            continue
        marks = part[closed:e].replace(" ", "").replace("\u00a0", "").replace("\u202f", "")
        score = _end_score(part, first, m.group(), at, marks, part[k : k + 12], k > e)
        if score > -5:
            ends.append((e, score))
    if _HAS_THAI(part):
        ends += [(m.start(), CERTAIN) for m in _THAI_GAP.finditer(part)]
        ends.sort()
    return [(e, s, bisect_left(opening, e) - bisect_left(closing, e)) for e, s in ends] if pairs else [(e, s, 0) for e, s in ends]


def _best_ends(text: str, start: int, stop: int) -> list[int]:
    """End positions of the sentences within text[start:stop] (one paragraph)."""
    part = text[start:stop]
    ends = _candidates(part)
    if not ends:
        return [stop]
    nodes = [(0, 0.0, 0), *ends, (len(part), CERTAIN, 0)]
    if all(d == 0 for *_, d in ends) and all(s >= CERTAIN for _, s, _ in ends):
        return [start + e for e, *_ in nodes[1:]]  # every end gains more than any span could lose
    # value of a start: the best score up to it, less the quotations that a span from it cuts
    value, back = [0.0], [0]
    window: deque[int] = deque()  # starts WORDLESS to FREE_SPAN characters back, best first
    near = 0  # first start that is less than WORDLESS characters back
    worded: list[float] = []  # values of starts, less the loss of a wordless opening
    far, far_arg = float("-inf"), 0
    for j in range(1, len(nodes)):
        e, score, depth = nodes[j]
        while near < j and nodes[near][0] <= e - WORDLESS:
            v = value[near] - (0.0 if any(c.isalnum() for c in part[nodes[near][0] : nodes[near][0] + WORDLESS]) else 1.0)
            worded.append(v)
            while window and worded[window[-1]] < v:
                window.pop()
            window.append(near)
            near += 1
        while window and nodes[window[0]][0] < e - FREE_SPAN:
            i = window.popleft()
            if worded[i] + nodes[i][0] * PER_CHARACTER > far:
                far, far_arg = worded[i] + nodes[i][0] * PER_CHARACTER, i
        top, arg = far - (e - FREE_SPAN) * PER_CHARACTER, far_arg
        if window and worded[window[0]] > top:
            top, arg = worded[window[0]], window[0]
        for i in range(near, j):
            v = value[i] + span_score(part, nodes[i][0], e)
            if v > top:
                top, arg = v, i
        value.append(top + score - 2 * CUT_QUOTATION * depth)
        back.append(arg)
    out, j = [], len(nodes) - 1
    while j > 0:
        out.append(start + nodes[j][0])
        j = back[j]
    return out[::-1]


def sentence_spans(text: str | None) -> list[tuple[int, int]]:
    """(start, end) of each sentence in order."""
    if not text:
        return []
    out, start = [], 0
    for stop, following in [*((m.start(), m.end()) for m in _PARAGRAPH.finditer(text)), (len(text), len(text))]:
        for end in _best_ends(text, start, stop):
            a, b = start, end
            while a < b and text[a].isspace():
                a += 1
            while b > a and text[b - 1].isspace():
                b -= 1
            if b > a:
                out.append((a, b))
            start = end
        start = following
    return out


SENTENCES = "doc_id bigint, sent_no int, sent_start bigint, sent_end bigint, sentence string"
_SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("sent_no", pa.int32()), ("sent_start", pa.int64()), ("sent_end", pa.int64()),
    ("sentence", pa.string()),
])


def _segment(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 1024):
                part, rows = b.slice(k, 1024), []
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    for i, (s, e) in enumerate(sentence_spans(text)):
                        rows.append((doc_id, i, s, e, text[s:e] if with_text else None))
                columns = list(zip(*rows)) or [[]] * len(_SCHEMA)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SCHEMA)], schema=_SCHEMA)

    return run


def sentences(docs: DataFrame, where: Column | None = None, with_text: bool = True) -> DataFrame:
    """Sentence units of every document, or of those that meet ``where``."""
    chosen = docs if where is None else docs.where(where)
    texts = chosen.select("doc_id", "text").where(F.col("text").isNotNull())
    return spread(texts).mapInArrow(_segment(with_text), SENTENCES)
