"""Scalar text functions as Column expressions (all inside whole-stage codegen)."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, functions as F

# every white-space code point that a Unicode string split knows (fixed value)
WS = r"[\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\p{Z}]"

# First words that make a line a question.
QUESTION_WORDS = tuple(
    "am are can could did does had has have how is may might shall was were what where which who why will would".split()
)
# List markers.
BULLETS = ("•", "*", "o")
LIST_NUMBER = r"^(\d\.?){1,3}$"
ROMAN_NUMERAL = r"^(?=[ivxlcIVXLC])(?i:(?:xc|xl|l?x{0,3})(?:ix|iv|v?i{0,3}))[.)]?$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c) -> Column:
    """White space collapsed and stripped; null and blank give ''."""
    return F.trim(F.regexp_replace(F.coalesce(_col(c), F.lit("")), f"{WS}+", " "))


def remove_bullet_markers(c) -> Column:
    """A leading bullet is cut, then everything that isn't ASCII."""
    return F.regexp_replace(F.regexp_replace(_col(c), rf"^[•*o]{WS}", ""), r"[^\x{00}-\x{7f}]", "")


def underscore_name(c) -> Column:
    return F.lower(F.regexp_replace(F.regexp_replace(_col(c), f"^{WS}+|{WS}+$", ""), WS, "_"))


def strip_link_markers(c) -> Column:
    return F.regexp_replace(_col(c), r"\[\[|\]\]", "")


def is_variable(c) -> Column:
    """``{name.path}``, a template variable."""
    return _col(c).rlike(r"^\{[A-Za-z_]\w*(?:\.\w+)*\}$")


def iso_from_millis(c) -> Column:
    """ISO date and time in UTC, floored to the second."""
    seconds = F.floor(_col(c) / F.lit(1000)).cast("bigint")
    moment = F.timestamp_add("SECOND", seconds, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss")


def fix_content(c) -> Column:
    """A fragment that starts with a tag but doesn't end in one gets a ``div`` around it."""
    t = _col(c)
    return F.when(t.startswith("<") & ~t.endswith(">"), F.concat(F.lit("<div>"), t, F.lit("</div>"))).otherwise(t)


def job_key(path) -> Column:
    return F.concat(F.regexp_replace(_col(path), "/", "-"), F.lit(".json"))


def doc_type_of_file(filename) -> Column:
    e = F.lower(F.regexp_extract(_col(filename), r"\.([^.]+)$", 1))
    return F.when(e == "docx", "Word").when(e == "pdf", "PDF")


def tokens(c) -> Column:
    return F.split(clean_text(c), " ")


def is_bullet(t) -> Column:
    return _col(t).isin(*BULLETS)


def is_list_number(t) -> Column:
    return _col(t).rlike(LIST_NUMBER)


def is_roman_numeral(t) -> Column:
    """Roman numeral up to 99, in any case, with an optional dot or bracket."""
    return _col(t).rlike(ROMAN_NUMERAL)


def is_ordered_item(t, following) -> Column:
    """A number, letter or numeral before '.' or ')', or any roman numeral alone."""
    t, n = _col(t), _col(following)
    lead = t.rlike(r"^(\d+|[A-Za-z])$") | is_roman_numeral(t)
    marked = t.rlike(r"^(\d+|[A-Za-z])[.)]$")
    return marked | (lead & F.coalesce(n.isin(".", ")"), F.lit(False))) | is_roman_numeral(t)


def has_alpha(tokens_column) -> Column:
    return F.exists(_col(tokens_column), lambda t: t.rlike(r"^\p{L}+$"))


def has_length(array_column) -> Column:
    return F.coalesce(F.size(_col(array_column)) > 0, F.lit(False))


def is_question(c, cleaned: bool = False) -> Column:
    """Ends in '?' or begins with a question word; null and blank are none."""
    t = F.coalesce(_col(c), F.lit("")) if cleaned else clean_text(c)
    first = F.lower(F.element_at(F.split(t, " "), 1))
    return F.when(t == "", False).otherwise(t.endswith("?") | first.isin(*QUESTION_WORDS))


def list_intro(c) -> Column:
    """The text before a closing colon, which introduces a list; else null."""
    return F.when(clean_text(c).endswith(":"), F.regexp_replace(clean_text(c), r"\s*:$", ""))


def normal_list_item(c) -> Column:
    """A list item as part of a sentence: lower-case start (unless an acronym), no closing marks."""
    t = clean_text(c)
    lowered = F.when(t.rlike(r"^\p{Lu}\p{Ll}"), F.concat(F.lower(F.substring(t, 1, 1)), F.substring(t, F.lit(2), F.char_length(t)))).otherwise(t)
    return F.regexp_replace(lowered, r"[^\p{L}\p{N}_]+$", "")


def _merged(a: str | None, b: str | None, append: bool) -> str | None:
    """Two JSON objects merged at every depth, by an explicit stack."""

    def parsed(x: str | None):
        try:
            return json.loads(x) if x else None
        except (ValueError, RecursionError):
            return None

    target, source = parsed(a), parsed(b)
    if not isinstance(source, dict):
        return None if target is None else json.dumps(target, ensure_ascii=False, separators=(",", ":"))
    if not isinstance(target, dict):
        target = {}
    todo = [(target, source)]
    while todo:
        t, s = todo.pop()
        for k, v in s.items():
            if isinstance(v, dict) and isinstance(t.get(k), dict):
                todo.append((t[k], v))
            elif append and isinstance(v, list) and isinstance(t.get(k), list):
                t[k] = t[k] + v
            else:
                t[k] = v
    return json.dumps(target, ensure_ascii=False, separators=(",", ":"))


def deep_merge(a, b, append_to_lists: bool = False) -> Column:
    """Two JSON objects merged at every depth: objects are merged, of other values b's
    counts; lists are replaced, or appended if asked for. Arrow batches.

    What is no JSON object counts as absent; if b is absent a is returned.
    """

    @F.pandas_udf("string")
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([_merged(p, q, append_to_lists) for p, q in zip(x, y)], dtype=object)

    return run(_col(a), _col(b))
