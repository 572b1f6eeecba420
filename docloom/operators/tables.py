"""Type inference of tables and their rendering as sentences.

A table is one row with its head and body; everything about it is worked out within
that row, by higher-order functions, so nothing is shuffled. ``cells`` and
``column_types`` are the long form, for columns that are spread over many rows.

Defined cases: null and empty cells are NULL; a column that holds only NULL and
BIT counts as BOOL; infinities and not-a-number are STRING; a table without rows
has no header, no labels and gives no sentence.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

# Words for null, true and false.
NULL_WORDS = ("null", "none", "na", "_", "-")
TRUE_WORDS = ("true", "t", "yes", "y", "on")
FALSE_WORDS = ("false", "f", "no", "n", "off")
_NUMBER = r"^\s*[+-]?(?:\d[\d_]*\.?\d*|\.\d+)(?:[eE][+-]?\d+)?\s*$"
_DIGITS = r"\d{1,4}[-/.]\d{1,2}[-/.]\d{1,4}"


def _number(v: Column) -> Column:
    return F.when(v.rlike(_NUMBER), F.regexp_replace(F.trim(v), "_", "").try_cast("double"))


def value_type(value, dates: Column | None = None) -> Column:
    """NULL, BOOL, BIT, INT, FLOAT, DATE or STRING of one cell.

    ``dates``: a boolean column that says whether the value is a date; by
    default numeric dates and those with an ISO form are (no UDF needed).
    """
    v = F.col(value) if isinstance(value, str) else value
    low = F.lower(F.trim(v))
    n = _number(v)
    date = v.rlike(rf"^\s*{_DIGITS}(?:[ T]\d{{1,2}}:\d{{2}}(?::\d{{2}})?)?\s*$") if dates is None else dates
    return (
        F.when(v.isNull() | (low == "") | low.isin(*NULL_WORDS), "NULL")
        .when(low.isin(*TRUE_WORDS, *FALSE_WORDS), "BOOL")
        .when(n.isNotNull() & (n == F.floor(n)), F.when(n.isin(0.0, 1.0), "BIT").otherwise("INT"))
        .when(n.isNotNull(), "FLOAT")
        .when(date, "DATE")
        .otherwise("STRING")
    )


def is_fuzzy_date(value: Column, reference: str = "2000-01-01") -> Column:
    """Whether a free-form date parser (day first) reads the value; Arrow batches.

    Missing parts come from ``reference``, never from today's date.
    """

    @F.pandas_udf("boolean")
    def parse(values: pd.Series) -> pd.Series:
        from dateutil import parser

        default = pd.Timestamp(reference).to_pydatetime()

        def ok(v):
            try:
                return v is not None and parser.parse(v, dayfirst=True, fuzzy=True, default=default) is not None
            except (ValueError, OverflowError, TypeError):
                return False

        return values.map(ok)

    return parse(value)


def cells(tables: DataFrame, key: str = "table_id", head: str = "head", body: str = "body") -> DataFrame:
    """key, r, c, value, is_head: head rows, then body rows, columns by position."""
    none = F.array().cast("array<array<string>>")
    rows = F.concat(F.coalesce(head, none), F.coalesce(body, none))
    n_head = F.size(F.coalesce(head, none))
    return tables.select(key, n_head.alias("n_head"), F.posexplode(rows).alias("r", "row")).select(
        key, "r", (F.col("r") < F.col("n_head")).alias("is_head"), F.posexplode("row").alias("c", "value")
    )


def column_types(typed: DataFrame, *keys: str) -> DataFrame:
    """Type of each column from the set of its cells' types (keys, value, value_type)."""
    agg = typed.groupBy(*keys).agg(
        F.collect_set("value_type").alias("types"),
        (F.countDistinct("value") + F.max(F.col("value").isNull().cast("int"))).alias("n_distinct"),
        F.count(F.lit(1)).alias("n"),
    )
    ratio = F.when(F.col("n") > 0, F.col("n_distinct") / F.col("n")).otherwise(0.0)
    return agg.select(*keys, column_kind(F.col("types")).alias("data_type"), ratio.alias("uniqueness")).withColumn("var_type", var_type())


def column_kind(types: Column) -> Column:
    """Type of a column from the set of its cells' types."""
    return F.get(F.transform(F.array(F.array_remove(types, "NULL")), _kind), F.lit(0))


def _kind(t: Column) -> Column:
    has = lambda x: F.array_contains(t, x)
    return (
        F.when(F.size(t) == 0, "NULL")
        .when((F.size(t) > 1) & (has("STRING") | has("DATE")), "STRING")
        .when(F.size(t) == 1, F.when(has("BIT"), "BOOL").otherwise(F.element_at(t, 1)))
        .when((F.size(t) == 2) & has("BOOL") & has("BIT"), "BOOL")
        .when(has("BOOL"), "STRING")
        .when(has("FLOAT"), "FLOAT")
        .otherwise("INT")
    )


def var_type(data_type="data_type", uniqueness="uniqueness") -> Column:
    t, u = (F.col(c) if isinstance(c, str) else c for c in (data_type, uniqueness))
    return (
        F.when(t.isin("INT", "STRING") & (u < 0.9), "CATEGORICAL")
        .when(t.isin("INT", "FLOAT"), "NUMERIC").when(t == "STRING", "TEXT").when(t == "BOOL", "BOOL")
        .when(t == "DATE", "TIME").otherwise("NA")
    )


def only_member(array) -> Column:
    a = F.col(array) if isinstance(array, str) else array
    return F.when(F.size(a) == 1, F.get(a, F.lit(0)))


HEADER_LOOKAHEAD = 19  # rows that are compared with the first one

_NONE = "array<array<string>>"


def _typed_rows(head: str, body: str, dates=None) -> Column:
    """All rows, each cell with its type; null rows have no cells."""
    rows = F.concat(F.coalesce(head, F.array().cast(_NONE)), F.coalesce(body, F.array().cast(_NONE)))
    cell = lambda v: F.struct(v.alias("v"), value_type(v, dates(v) if dates else None).alias("t"))
    return F.transform(rows, lambda row: F.transform(F.coalesce(row, F.array().cast("array<string>")), cell))


def table_schema(tables: DataFrame, key="table_id", head: str = "head", body: str = "body", dates=None) -> DataFrame:
    """Per table with a body: n_header_rows, has_header, has_row_labels, data_types, var_types.

    Row 0 is a header if all of it is STRING and the rows below it hold more than one
    type; head rows that are given count as they are.
    """
    return _schema(tables, key, head, body, dates).drop("_rows")


def _schema(tables: DataFrame, key, head: str, body: str, dates=None) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    rows, given = F.col("_rows"), F.size(F.filter(F.coalesce(head, F.array().cast(_NONE)), lambda r: F.coalesce(F.size(r), F.lit(0)) > 0))
    first = F.get(rows, F.lit(0))
    below = F.flatten(F.transform(F.slice(rows, 2, HEADER_LOOKAHEAD), lambda r: F.transform(r, lambda c: c["t"])))
    guessed = (F.coalesce(F.size(first), F.lit(0)) > 0) & F.forall(first, lambda c: c["t"] == "STRING") & (F.size(F.array_distinct(below)) > 1)
    typed = tables.select(*keys, _typed_rows(head, body, dates).alias("_rows"), given.alias("_given"))
    counted = typed.select(*keys, "_rows", F.when(F.col("_given") > 0, F.col("_given")).otherwise(F.coalesce(guessed, F.lit(False)).cast("int")).cast("bigint").alias("n_header_rows"))

    def column(c: Column) -> Column:
        own = F.transform(F.filter("_body", lambda r: F.size(r) > c), lambda r: F.get(r, c))
        distinct = F.size(F.array_distinct(F.transform(own, lambda x: x["v"])))  # null counts as a value
        return F.struct(
            column_kind(F.array_distinct(F.transform(own, lambda x: x["t"]))).alias("data_type"), (distinct / F.size(own)).alias("uniqueness")
        )

    width = F.array_max(F.transform("_body", lambda r: F.size(r)))
    bodies = counted.withColumn("_body", F.expr("slice(_rows, int(n_header_rows) + 1, greatest(size(_rows) - int(n_header_rows), 0))")).withColumn("_width", width)
    columns = bodies.where("_width > 0").withColumn("_columns", F.transform(F.sequence(F.lit(0), F.col("_width") - 1), column))
    kinds = columns.withColumn("var_types", F.transform("_columns", lambda x: var_type(x["data_type"], x["uniqueness"])))
    return kinds.select(
        *keys, "n_header_rows", (F.col("n_header_rows") > 0).alias("has_header"),
        (F.get("var_types", F.lit(0)) == "TEXT").alias("has_row_labels"),
        F.transform("_columns", lambda x: x["data_type"]).alias("data_types"), "var_types", "_rows",
    )


_POWERS = [(1e33, "decillion"), (1e30, "nonillion"), (1e27, "octillion"), (1e24, "septillion"), (1e21, "sextillion"),
           (1e18, "quintillion"), (1e15, "quadrillion"), (1e12, "trillion"), (1e9, "billion"), (1e6, "million")]


def value_text(value, reference: str | None = None) -> Column:
    """A cell in words: large integers by name, floats with two digits, dates
    relative to ``reference`` (yyyy-MM-dd), NULL as NA.

    Type and number are bound once per value, so the expression stays small.
    """
    v = F.col(value) if isinstance(value, str) else value
    typed = lambda x: F.struct(x.alias("v"), value_type(x).alias("kind"), _number(x).alias("n"))
    bound = F.transform(F.transform(F.array(v), typed), lambda s: _in_words(s["v"], s["kind"], s["n"], reference))
    return F.get(bound, F.lit(0))


def _in_words(v: Column, kind: Column, n: Column, reference: str | None) -> Column:
    whole = n.cast("bigint").cast("string")
    for size, word in reversed(_POWERS):
        whole = F.when(F.abs(n) >= size, F.concat(F.format_string("%.1f", n / size), F.lit(f" {word}"))).otherwise(whole)
    out = (
        F.when(kind == "NULL", "NA").when(kind == "INT", whole).when(kind == "BIT", n.cast("bigint").cast("string"))
        .when(kind == "FLOAT", F.format_string("%.2f", n))
        .when(kind == "BOOL", F.lower(F.trim(v)).isin(*TRUE_WORDS).cast("string"))
    )
    if reference:
        day = F.coalesce(*[F.to_date(F.try_to_timestamp(v, F.lit(p))) for p in ("d/M/yyyy", "yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss")])
        gap = F.date_diff(day, F.lit(reference).cast("date"))
        short = F.when(F.abs(gap) < 150, F.date_format(day, "MMM dd")).otherwise(F.date_format(day, "MMM dd yyyy"))
        words = F.when(gap == 0, "today").when(gap == 1, "tomorrow").when(gap == -1, "yesterday").otherwise(short)
        out = out.when((kind == "DATE") & day.isNotNull(), words)
    return out.otherwise(v)


def label_text(label) -> Column:
    return F.regexp_replace(F.col(label) if isinstance(label, str) else label, "_", " ")


def table_sentences(tables: DataFrame, key="table_id", head: str = "head", body: str = "body", reference: str | None = None) -> DataFrame:
    """key, r, c, sentence: one sentence per value of a labelled table, else one per row.

    With exactly one date column: "{When}, the {header} of {label} is {value}.",
    with header and labels: "The {header} of {label} is {value}.", else the
    row's values in a line. Extra header rows are skipped in every branch; values
    without a header cell above them are left out of labelled tables.
    """
    keys = [key] if isinstance(key, str) else list(key)
    known = _schema(tables, key, head, body)
    n_dates = F.size(F.filter("data_types", lambda t: t == "DATE"))
    known = known.withColumns({
        "_names": F.get("_rows", F.col("n_header_rows").cast("int") - 1),
        "_date_at": F.when(n_dates == 1, F.array_position("data_types", "DATE").cast("int") - 1).otherwise(-1),
        "_labelled": F.col("has_header") & F.col("has_row_labels"),
    })
    rows = known.select(*keys, "n_header_rows", "_names", "_date_at", "_labelled", F.posexplode("_rows").alias("r", "_row")).where(
        (F.col("r") >= F.col("n_header_rows")) & (F.size("_row") > 0)
    )
    label, when = label_text(F.get("_row", F.lit(0))["v"]), value_text(F.get("_row", F.col("_date_at"))["v"], reference=reference)
    lead = F.when((F.col("_date_at") >= 0) & F.get("_row", F.col("_date_at"))["v"].isNotNull(),
                  F.concat(F.initcap(F.substring(when, 1, 1)), F.substring(when, F.lit(2), F.char_length(when)), F.lit(", the "))).otherwise(F.lit("The "))
    bound = rows.withColumns({"_label": F.when(F.col("_labelled"), label), "_lead": F.when(F.col("_labelled"), lead)})

    def sentence(x: Column, c: Column) -> Column:
        return F.struct(c.alias("c"), F.concat(
            "_lead", label_text(F.get("_names", c)["v"]), F.lit(" of "), "_label", F.lit(" is "), value_text(x["v"], reference=reference), F.lit("."),
        ).alias("sentence"))

    dated = F.get("_row", F.col("_date_at"))["v"].isNotNull()
    one = F.filter(
        F.transform("_row", sentence),
        lambda s: (s["c"] > 0) & (s["c"] < F.size("_names")) & ~(F.coalesce(dated, F.lit(False)) & (s["c"] == F.col("_date_at"))),
    )
    line = F.array_join(F.transform("_row", lambda x: value_text(x["v"], reference=reference)), " ")
    plain = F.array(F.struct(F.lit(0).alias("c"), line.alias("sentence")))
    return bound.select(*keys, "r", F.inline(F.when(F.col("_labelled"), one).otherwise(plain)))
