"""Registered text queries: exact columns, whole tables, no row twice."""

import pytest

from docloom.llm import queries

COLUMNS = {
    "p1_found": {"tab": "string", "item_id": "bigint", "kind": "string"},
    "p4_found": {"doc_id": "bigint", "sent_start": "bigint", "sent_end": "bigint"},
    "p7_found": {"doc_id": "bigint", "forced": "bigint"},
    "p8_ids": {"doc_id": "bigint", "ids": "array<int>"},
    "p9_found": {"doc_id": "bigint", "item_id": "bigint"},
    "p10_found": {"doc_id": "bigint", "category": "string"},
}


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("sf"))
    docs = [(1, "<p>Hi.</p>", "forum", "S"), (2, "One. Two.", "handbook", "S"), (3, "a" * 4001, "kb_articles", None), (4, None, None, None), (5, "", "newsroom", "S")]
    spark.createDataFrame(docs, "doc_id bigint, text string, source string, site_id string").write.parquet(f"{d}/documents.parquet")
    block = "struct<block_type: string, text: string, url: string, title: string, subtype: string, heading: string, items: array<string>, head: array<array<string>>, body: array<array<string>>>"
    spark.createDataFrame([(1, ["a **b** c"], None)], f"field_id bigint, text array<string>, structured_content array<{block}>").write.parquet(f"{d}/record_fields.parquet")
    spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(20)), "s")], "item_id bigint, text string, suite string").write.parquet(f"{d}/heldout_items.parquet")
    spark.createDataFrame([(1, 1, "none")], "label_id bigint, doc_id bigint, category string").write.parquet(f"{d}/review_labels.parquet")
    return d


@pytest.mark.parametrize("name", COLUMNS)
def test_columns_and_rows(spark, tables, name):
    df = queries.QUERIES[name](spark, tables)
    assert dict(df.dtypes) == COLUMNS[name]
    rows = [str(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    want = {"p1_found": 2, "p4_found": 2, "p7_found": 1, "p8_ids": 5, "p9_found": 0, "p10_found": 0}
    assert len(rows) == want[name]
