"""Question detection on blocks and lines.

Defined cases: null and blank texts are no questions; blocks without text (lists,
tables) have none either way; repeated questions count once per document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from docloom.functions.text import clean_text, is_question
from docloom.session import spread


def line_blocks(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, seq, text: the non-blank lines of a text as text blocks."""
    one = lambda line, i: F.struct(i.alias("seq"), clean_text(line).alias("text"))
    # cleaned and filtered within the array, so each line is cleaned once
    lines = F.filter(F.transform(F.split(text, "\n"), one), lambda x: x["text"] != "")
    return spread(docs.select(key, text)).select(key, F.inline(lines))


def identify_questions(blocks: DataFrame, text: str = "text", cleaned: bool = False) -> DataFrame:
    """Adds is_question to rows that have a text; ``cleaned`` texts need no collapsing."""
    return blocks.withColumn("is_question", F.when(F.col(text).isNotNull(), is_question(text, cleaned)))


def extract_questions(blocks: DataFrame, key: str = "doc_id", cleaned: bool = False) -> DataFrame:
    """Per document: distinct questions and all other texts, both sorted.

    Partial sets are built before the shuffle. The lists of a document are no
    larger than the document, which one record holds anyway.
    """
    q = identify_questions(blocks, cleaned=cleaned).where(F.col("text").isNotNull())
    return q.groupBy(key).agg(
        F.sort_array(F.collect_set(F.when(F.col("is_question"), F.col("text")))).alias("questions"),
        F.sort_array(F.collect_list(F.when(~F.col("is_question"), F.col("text")))).alias("non_questions"),
    )


def found_questions(blocks: DataFrame, cleaned: bool = False) -> DataFrame:
    """The question texts of the whole fileset."""
    return identify_questions(blocks, cleaned=cleaned).where("is_question").select("text")
