"""Registered queries of the text operators, with SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from docloom.llm import encode, leakage, markup, moderation, sentences, split
from docloom.session import table


def _cleaned(spark: SparkSession, d: str) -> DataFrame:
    return markup.clean_items(markup.text_items(table(spark, d, "documents"), table(spark, d, "record_fields")))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return markup.found_kinds(_cleaned(spark, d))


def p1_clean(spark: SparkSession, d: str) -> DataFrame:
    """Clean text and typed blocks of every document and field."""
    return _cleaned(spark, d)


def p1_templates(spark: SparkSession, d: str) -> DataFrame:
    """How many subtrees count as template of each site."""
    items = markup.text_items(table(spark, d, "documents"), table(spark, d, "record_fields"))
    return markup.site_templates(items).select(F.col("t_site").alias("site_id"), F.size("template").alias("n_subtrees"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    prose = F.col("source").isin(*sentences.PROSE_SOURCES)
    return sentences.sentences(table(spark, d, "documents"), prose, with_text=False).select(
        "doc_id", "sent_start", "sent_end"
    )


def p4_sentences(spark: SparkSession, d: str) -> DataFrame:
    """Sentence units of all documents, whatever their source."""
    return sentences.sentences(table(spark, d, "documents"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return split.forced_documents(split.split_documents(table(spark, d, "documents"), with_text=False))


def p7_pieces(spark: SparkSession, d: str) -> DataFrame:
    return split.split_documents(table(spark, d, "documents")).drop("forced")


def p7_joined(spark: SparkSession, d: str) -> DataFrame:
    """What the pieces of each document give back when joined without their overlaps."""
    return split.joined_documents(split.split_documents(table(spark, d, "documents")))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return encode.encode_documents(table(spark, d, "documents"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    found = leakage.leaks(table(spark, d, "documents"), table(spark, d, "heldout_items"))
    return found.where("verbatim").select("doc_id", "item_id")


def p9_items(spark: SparkSession, d: str) -> DataFrame:
    """Which items leaked, verbatim or paraphrased, and into how many documents."""
    found = leakage.leaks(table(spark, d, "documents"), table(spark, d, "heldout_items"), paraphrases=True)
    return found.groupBy("item_id").agg(
        F.count_if("verbatim").alias("n_verbatim"), F.count_if(~F.col("verbatim")).alias("n_paraphrased")
    )


def p9_recall(spark: SparkSession, d: str) -> DataFrame:
    """Leaks of every fiftieth document by brute force, and how many of them the search finds."""
    return leakage.recall(table(spark, d, "documents"), table(spark, d, "heldout_items"))


def _scores(spark: SparkSession, d: str) -> DataFrame:
    return moderation.score_documents(table(spark, d, "documents"), table(spark, d, "review_labels"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return moderation.found_categories(_scores(spark, d))


def p10_scores(spark: SparkSession, d: str) -> DataFrame:
    return _scores(spark, d)


def p10_rates(spark: SparkSession, d: str) -> DataFrame:
    """Share of documents with such content, per source and category."""
    flag = [F.avg((F.col(c) >= moderation.FOUND_SEVERITY).cast("int")).alias(f"{c}_rate") for c in moderation.CATEGORIES]
    return _scores(spark, d).groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), *flag)


QUERIES = {f.__name__: f for f in (p1_found, p1_clean, p1_templates, p4_found, p4_sentences, p7_found, p7_pieces, p7_joined, p8_ids, p9_found, p9_items, p9_recall, p10_found, p10_scores, p10_rates)}

SQL = {
    "p7_found": """
        select doc_id, cast(regexp_matches(text, '[^\\s.!?。！？।؟]{1000}[^\\s.!?。！？।؟]{1000}[^\\s.!?。！？।؟]{1000}[^\\s.!?。！？।؟]{1000}[^\\s.!?。！？।؟]')
               as bigint) as forced
        from documents where length(text) > 4000""",
    "p7_joined": "select doc_id, length(text) as n_chars, md5(text) as digest from documents where length(text) > 4000",
}
