"""Entity mentions: dictionary and pattern matching, span pruning, validity.

Mentions are structs (see ``schema.ENTITY``); positions are code points.
Defined cases: null and blank lines have no mentions; equal spans are all kept,
partial overlaps too; a pattern group that took no part has the span (-1, -1).
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from docloom.operators.collect import dimension
from docloom.plugins import person_entities
from docloom.schema import ENTITY
from docloom.session import materialise

MAX_ENTRIES = 100_000  # of a dictionary that is sent to the workers; above it phrases are joined


class Dictionary:
    """Longest match first, left to right, without overlaps, on word boundaries."""

    def __init__(self, entries: dict[str, str]):
        self.trie: dict = {}
        for phrase, value in entries.items():
            node = self.trie
            for ch in phrase:
                node = node.setdefault(ch, {})
            if phrase:
                node[""] = value

    def find(self, text: str) -> list[tuple[int, int, str]]:
        out, i, n = [], 0, len(text)
        word = lambda ch: ch.isalnum() or ch == "_"
        while i < n:
            if i and word(text[i - 1]) and word(text[i]):
                i += 1
                continue
            node, best, j = self.trie, None, i
            while j < n and text[j] in node:
                node = node[text[j]]
                j += 1
                if "" in node and (j == n or not word(text[j]) or not word(text[j - 1])):
                    best = (i, j, node[""])
            if best:
                out.append(best)
                i = best[1]
            else:
                i += 1
        return out


def _mention(entity, start, end, value, groups=None) -> dict:
    return {"entity": entity, "start": start, "end": end, "value": value, "confidence": 1.0, "groups": groups}


def match_dictionary(text, entries: dict[str, tuple[str, str]]) -> Column:
    """Mentions of dictionary phrases; ``entries``: phrase → (entity, value)."""
    finder = Dictionary({p: p for p in entries})

    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [_mention(entries[p][0], a, b, entries[p][1]) for a, b, p in finder.find(t or "")])

    return F.pandas_udf(run, f"array<{ENTITY}>")(text)


def match_patterns(text, patterns: list[tuple[str, str, str]]) -> Column:
    """Every match of every (entity, value, pattern), with the spans of its groups."""

    def run(texts: pd.Series) -> pd.Series:
        compiled = [(e, v, re.compile(p)) for e, v, p in patterns]

        def find(t):
            out = []
            for e, v, p in compiled:
                for m in p.finditer(t or ""):
                    groups = [{"grp": g, "start": m.start(g), "end": m.end(g)} for g in range(1, p.groups + 1)]
                    out.append(_mention(e, m.start(), m.end(), v, groups or None))
            return out

        return texts.map(find)

    return F.pandas_udf(run, f"array<{ENTITY}>")(text)


# Rules in place of a language service: dates and numbers as they are usually written.
_MONTH = r"(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*"
SYSTEM_PATTERNS = [
    ("sys-date", rf"\b\d{{1,2}}(?:st|nd|rd|th)?\s+{_MONTH}\.?,?\s+\d{{4}}\b|\b{_MONTH}\.?\s+\d{{1,2}},?\s+\d{{4}}\b|\b\d{{4}}-\d{{2}}-\d{{2}}\b|\b\d{{1,2}}/\d{{1,2}}/\d{{4}}\b"),
    ("sys-number", r"(?<![\w.])[+-]?\d+(?:,\d{3})*(?:\.\d+)?(?![\w])"),
]


def match_system(text) -> Column:
    """Dates (value: ISO date) and numbers (value: plain digits) by rule."""

    def run(texts: pd.Series) -> pd.Series:
        from datetime import datetime

        from dateutil import parser

        compiled = [(e, re.compile(p)) for e, p in SYSTEM_PATTERNS]

        def find(t):
            out = []
            for e, p in compiled:
                for m in p.finditer(t or ""):
                    v = m.group().replace(",", "")
                    if e == "sys-date":
                        try:
                            v = parser.parse(m.group(), dayfirst=True, default=datetime(2000, 1, 1)).date().isoformat()
                        except (ValueError, OverflowError):
                            continue
                    out.append(_mention(e, m.start(), m.end(), v))
            return out

        return texts.map(find)

    return F.pandas_udf(run, f"array<{ENTITY}>")(text)


def _uncontained(mentions: list) -> list:
    """What lies strictly within no other one: a sort and one pass."""
    order = sorted(range(len(mentions)), key=lambda i: (mentions[i]["start"], -mentions[i]["end"]))
    kept, before, start, longest = set(), -1, None, -1  # furthest end of earlier starts, this start and its furthest end
    for i in order:
        a, b = mentions[i]["start"], mentions[i]["end"]
        if a != start:
            before, start, longest = max(before, longest), a, b
        if before < b and longest == b:
            kept.add(i)
    return [m for i, m in enumerate(mentions) if i in kept]


def prune_contained(mentions) -> Column:
    """Mentions that lie strictly within no other candidate."""
    m = F.col(mentions) if isinstance(mentions, str) else mentions

    @F.pandas_udf(f"array<{ENTITY}>")
    def run(lists: pd.Series) -> pd.Series:
        return lists.map(lambda x: _uncontained(list(x)) if x is not None else None)

    return F.when(F.size(m) < 2, m).otherwise(run(m))


def valid_mentions(mentions) -> Column:
    """Without dates of under eight characters, unreadable ones, and years outside 1990..2025."""
    m = F.col(mentions) if isinstance(mentions, str) else mentions

    def ok(e: Column) -> Column:
        year = F.regexp_extract(e["value"], r"^(\d{4})-\d{2}-\d{2}", 1).try_cast("int")
        good = ((e["end"] - e["start"]) >= 8) & F.coalesce(year.between(1990, 2025), F.lit(False))
        return (e["entity"] != "sys-date") | good

    return F.filter(m, ok)


_GRAM = re.compile(r"\w+|[^\w\s]")


def phrase_matches(lines: DataFrame, entries: DataFrame, text: str = "text", out: str = "mentions") -> DataFrame:
    """Adds (or replaces) ``out``: the phrases of a dictionary table, longest first, left to right.

    For dictionaries of any size: each line gives its word sequences of the lengths
    that phrases have (one Arrow call a batch), these are joined with the phrases, and
    the hits of a line are thinned out within the line. ``entries``: phrase, entity, value.
    """
    sizes = F.pandas_udf(lambda s: s.map(lambda p: len(_GRAM.findall(p or ""))), "int")
    known = entries.where("phrase <> ''").dropDuplicates(["phrase"]).select("phrase", "entity", "value", sizes("phrase").alias("n"))
    lengths = sorted(r.n for r in known.select("n").distinct().collect() if r.n)  # the few lengths that phrases have

    @F.pandas_udf("array<struct<phrase: string, start: int, end: int>>")
    def grams(texts: pd.Series) -> pd.Series:
        def of(t):
            at = [m.span() for m in _GRAM.finditer(t or "")]
            return [(t[at[i][0] : at[i + n - 1][1]], at[i][0], at[i + n - 1][1]) for n in lengths for i in range(len(at) - n + 1)]

        return texts.map(of)

    @F.pandas_udf(f"array<{ENTITY}>")
    def thinned(hits: pd.Series) -> pd.Series:
        def of(found):
            out, end = [], -1
            for h in sorted(found if found is not None else [], key=lambda h: (h["start"], -h["end"])):
                if h["start"] >= end:
                    out.append(_mention(h["entity"], h["start"], h["end"], h["value"]))
                    end = h["end"]
            return out

        return hits.map(of)

    named = lines.drop(out).withColumn("_dl_line", F.monotonically_increasing_id())
    kept = materialise(named, "lines")  # the numbers must stay the same on both sides
    words = kept.select("_dl_line", F.inline(grams(F.col(text))))
    hit = words.join(dimension(known.drop("n").withColumnRenamed("phrase", "e_phrase")), F.col("phrase") == F.col("e_phrase"))
    gathered = hit.groupBy(F.col("_dl_line").alias("_dl_owner")).agg(F.collect_list(F.struct("start", "end", "entity", "value")).alias("_dl_hits"))
    joined = kept.join(gathered, F.col("_dl_line") == F.col("_dl_owner"), "left")
    return joined.select(*[c for c in lines.columns if c != out], thinned(F.col("_dl_hits")).alias(out))


def line_entities(lines: DataFrame, text: str = "text", dictionary=None, patterns=None, system: bool = True, persons=False) -> DataFrame:
    """Adds ``entities``: all candidates, pruned by containment, then checked.

    ``dictionary``: phrase → (entity, value); a large one is joined instead of sent to the
    workers. ``persons``: True for the rule, or the loader of a recogniser (see ``plugins``).
    """
    none = F.array().cast(f"array<{ENTITY}>")
    found, columns = [none], lines.columns
    if dictionary and len(dictionary) > MAX_ENTRIES:
        entries = lines.sparkSession.createDataFrame(pd.DataFrame([(p, *ev) for p, ev in dictionary.items()], columns=["phrase", "entity", "value"]))
        lines = phrase_matches(lines, entries, text, "_dl_phrases")
        found.append(F.col("_dl_phrases"))
    elif dictionary:
        found.append(match_dictionary(F.col(text), dictionary))
    if patterns:
        found.append(match_patterns(F.col(text), patterns))
    if system:
        found.append(match_system(F.col(text)))
    if persons:
        found.append(person_entities(F.col(text), None if persons is True else persons))
    out = lines.withColumn("_candidates", F.concat(*found))
    return out.select(*columns, valid_mentions(prune_contained("_candidates")).alias("entities"))


def token_matches(lines: DataFrame, entries: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Single-word dictionary matches: key, token, entity, value, n.

    Words meet the dictionary before they are counted, so only hits are shuffled.
    """
    words = lines.select(key, F.explode(F.split(text, r"[^\p{L}\p{N}_]+")).alias("token")).where("token <> ''")
    e = dimension(entries.select(F.col("phrase").alias("e_phrase"), "entity", "value"))
    hit = words.join(e, F.col("token") == F.col("e_phrase"))
    return hit.groupBy(key, "token", "entity", "value").agg(F.count(F.lit(1)).alias("n")).select(key, "token", "n", "entity", "value")


# --- relations ------------------------------------------------------------------------


def relation_triples(tokens, edges) -> Column:
    """[left, relation, right] of each edge but those of kind P0; indices become words.

    ``edges``: array of structs left, right (token indices), kbID, lexicalInput.
    """
    t = F.col(tokens) if isinstance(tokens, str) else tokens
    e = F.col(edges) if isinstance(edges, str) else edges
    words = lambda ix: F.array_join(F.transform(ix, lambda i: F.get(t, i)), " ")
    kept = F.filter(e, lambda x: x["kbID"] != "P0")
    return F.transform(kept, lambda x: F.array(words(x["left"]), x["lexicalInput"], words(x["right"])))
