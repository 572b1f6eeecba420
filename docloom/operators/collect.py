"""Collecting, combining and preparing the fields of documents.

Defined cases: fields that the configuration doesn't name are dropped, as are
documents of unknown type; null lines and blocks are left out; a document whose
fields are all empty gives one row with empty lists.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from docloom.functions.text import clean_text
from docloom.operators.tables import table_sentences

SMALL_ROWS = 100_000


def dimension(df: DataFrame) -> DataFrame:
    """A configuration table: broadcast only after its size was checked."""
    return F.broadcast(df) if df.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS else df


def collect_fields(fields: DataFrame, config: DataFrame, key: str = "row_id") -> DataFrame:
    """Texts and blocks of the configured fields of each document, in configured order.

    ``fields``: key, doc_type, field_name, text, structured_content;
    ``config``: doc_type, prop, ord.
    """
    c = dimension(config.select(F.col("doc_type").alias("c_type"), F.col("prop"), F.col("ord")))
    j = fields.join(c, (F.col("doc_type") == F.col("c_type")) & (F.col("field_name") == F.col("prop")))
    one = F.struct("ord", "field_name", F.coalesce("text", F.array().cast("array<string>")).alias("text"), "structured_content")
    parts = j.groupBy(key, "doc_type").agg(F.sort_array(F.collect_list(one)).alias("p")) if _orderable(fields) else j.groupBy(
        key, "doc_type"
    ).agg(F.collect_list(one).alias("p"))
    blocks = F.flatten(F.filter(F.transform("p", lambda x: x["structured_content"]), F.isnotnull))
    return parts.select(key, "doc_type", F.flatten(F.transform("p", lambda x: x["text"])).alias("text"), blocks.alias("structured_content"))


def _orderable(fields: DataFrame) -> bool:
    return "map<" not in fields.schema["structured_content"].dataType.simpleString()


def of_types(rows: DataFrame, doc_types: DataFrame) -> DataFrame:
    """The rows whose doc_type is one of those given."""
    return rows.join(dimension(doc_types.select(F.col("doc_type").alias("t_type")).distinct()), F.col("doc_type") == F.col("t_type"), "left_semi")


def combine_text(blocks: DataFrame, doc_types: DataFrame, key: str = "row_id") -> DataFrame:
    """key, seq, i, line: texts, headings and list items of the documents of given types."""
    chosen = of_types(blocks, doc_types)
    lines = F.when(F.col("type").isin("text", "heading"), F.array("text")).when(F.col("type") == "list", F.col("items"))
    return chosen.select(key, "seq", F.posexplode(lines).alias("i", "line")).where(clean_text("line") != "")


def qa_line() -> Column:
    """The line a text or list block gives for question answering: text as it is, lists as HTML."""
    items = F.array_join(F.transform("items", lambda x: F.concat(F.lit("<li>"), x, F.lit("</li>"))), "")
    as_list = F.concat(F.coalesce("heading", F.lit("")), F.lit("<ul>"), items, F.lit("</ul>"))
    return F.when(F.col("type") == "text", F.col("text")).when(F.col("type") == "list", as_list)


def prepare_qa(blocks: DataFrame, key: str = "row_id", reference: str | None = None) -> DataFrame:
    """id and text of each line: texts, lists as HTML, tables as sentences.

    Ids are hashes of document and position (for tables with row and column).
    """
    ident = lambda *c: F.sha2(F.concat_ws("|", *[F.col(x).cast("string") for x in c]), 256).alias("id")
    lines = blocks.where(F.col("type").isin("text", "list")).select(ident(key, "seq"), qa_line().alias("text"))
    tables = table_sentences(blocks.where("type = 'table'"), (key, "seq"), reference=reference)
    return lines.unionByName(tables.select(ident(key, "seq", "r", "c"), F.col("sentence").alias("text"))).where(clean_text("text") != "")


def non_empty(df: DataFrame, text: str = "text") -> DataFrame:
    return df.where(clean_text(text) != "")
