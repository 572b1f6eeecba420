"""Places for models that aren't part of this library.

A plug-in is a function of a list of texts; it is loaded once per Python worker
by ``load`` and called with Arrow batches. Without one, the defaults apply.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, functions as F

from docloom.functions.text import is_question
from docloom.schema import ENTITY

_loaded: dict[tuple, Callable] = {}


def _model(load: Callable[[], Callable]) -> Callable:
    key = (load.__module__, load.__qualname__)
    if key not in _loaded:
        _loaded[key] = load()
    return _loaded[key]


def question_scorer(text: Column, load: Callable[[], Callable[[list[str]], list[bool]]] | None = None) -> Column:
    """is_question by a model, or by the rule for first words and question marks."""
    if load is None:
        return is_question(text)
    return F.pandas_udf(lambda s: pd.Series(_model(load)(s.fillna("").tolist())), "boolean")(text)


# Titles that stand before a person's name.
TITLES = "Mr Mrs Ms Miss Dr Prof Sir Sgt Capt Lt Col Gen Rev Hon Herr Frau Hr Fr Mme Mlle Sr Sra".split()
_PERSON = re.compile(r"\b(?:" + "|".join(TITLES) + r")\b\.?\s+((?:[^\W\d_a-z]\.[ \t]?|[^\W\d_a-z][^\W\d_]+[ \t]?){1,3})(?<![ \t.])")


def person_entities(text: Column, load: Callable | None = None) -> Column:
    """Mentions of persons by a recogniser; without one, names behind a title (Dr. Ada Vint)."""

    def run(texts: pd.Series) -> pd.Series:
        if load is not None:
            return pd.Series(_model(load)(texts.fillna("").tolist()))

        def find(t):
            return [
                {"entity": "sys-person", "start": m.start(1), "end": m.end(1), "value": m.group(1), "confidence": 1.0, "groups": None}
                for m in _PERSON.finditer(t or "")
            ]

        return texts.map(find)

    return F.pandas_udf(run, f"array<{ENTITY}>")(text)


EDGES = "struct<tokens: array<string>, edgeSet: array<struct<left: array<int>, right: array<int>, kbID: string, lexicalInput: string>>>"


def relation_edges(text: Column, mentions: Column, load: Callable[[], Callable[[list[str], list], list]] | None = None) -> Column:
    """Tokens and relations between the entities of each line, in the form that
    ``entities.relation_triples`` reads. The model is a function of texts and mentions;
    without one, two neighbouring mentions are related by the words between them, if
    these are one to five words without a full stop (kind ``between``).
    """

    def run(texts: pd.Series, found: pd.Series) -> pd.DataFrame:
        if load is not None:
            return pd.DataFrame(_model(load)(texts.fillna("").tolist(), [list(f) if f is not None else [] for f in found]), columns=["tokens", "edgeSet"])
        rows = []
        for t, ms in zip(texts.fillna(""), found):
            at = [m.span() for m in re.finditer(r"\w+|[^\w\s]", t)]
            within = lambda m: [i for i, (a, b) in enumerate(at) if a >= m["start"] and b <= m["end"]]  # noqa: B023, E731
            order = sorted(ms if ms is not None else [], key=lambda m: (m["start"], m["end"]))
            edges = []
            for x, y in zip(order, order[1:]):
                words = t[x["end"] : y["start"]].split()
                if 0 < len(words) < 6 and not any(w[-1] in ".!?" for w in words) and y["start"] >= x["end"]:
                    edges.append({"left": within(x), "right": within(y), "kbID": "between", "lexicalInput": " ".join(words)})
            rows.append(([t[a:b] for a, b in at], edges))
        return pd.DataFrame(rows, columns=["tokens", "edgeSet"])

    return F.pandas_udf(run, EDGES)(text, mentions)


TOKEN = "struct<text: string, shape: string, is_alpha: boolean, is_stop: boolean, lemma: string, pos: string, tag: string, dep: string>"


def token_features(text: Column, load: Callable | None = None) -> Column:
    """Tokens with shape, is_alpha and is_stop; lemma, pos, tag and dep need a model."""

    def run(texts: pd.Series) -> pd.Series:
        from docloom.html.segment import STOP_WORDS, tokens

        def shape(w: str) -> str:
            return "".join("X" if c.isupper() else "x" if c.islower() else "d" if c.isdigit() else c for c in w)[:8]

        def plain(t):
            none = {"lemma": None, "pos": None, "tag": None, "dep": None}
            return [{"text": w, "shape": shape(w), "is_alpha": w.isalpha(), "is_stop": w.lower() in STOP_WORDS, **none} for w in tokens(t or "")]

        return texts.map(plain) if load is None else pd.Series(_model(load)(texts.fillna("").tolist()))

    return F.pandas_udf(run, f"array<{TOKEN}>")(text)
