"""Registered general queries: exact columns of the fixed ones, SQL only for known names."""

import __spark_entry__ as entry
from docloom.plans import core_queries


def test_columns_of_fixed_queries(spark, tmp_path):
    d = str(tmp_path)
    spark.createDataFrame([(1, '{"data": {"f": {"structured_content": [{"items": ["x"]}]}}}')], "raw_id bigint, payload string").write.parquet(f"{d}/raw_records.parquet")
    rec = "row_id bigint, record_id string, site_id string, create_time string, last_modified_timestamp_millis bigint, file_path string"
    spark.createDataFrame([(1, "r", "S", "2020-01-01", 5, "/a")], rec).write.parquet(f"{d}/content_records.parquet")
    office = "file_no bigint, site_id string, dcterms_created array<string>, dcterms_modified array<string>"
    spark.createDataFrame([(1, "S", [], None), (2, "S", ["2020-01-01", "x"], [None])], office).write.parquet(f"{d}/office_files.parquet")
    spark.createDataFrame([("S", "UTC")], "site_id string, time_zone string").write.parquet(f"{d}/sites.parquet")
    spark.createDataFrame([], "step_name string, status string, input string, seen_modified_millis bigint").write.parquet(f"{d}/control_entries.parquet")
    want = {
        "p2_found": ("raw_id bigint, field_name string, block_path string, part_name string, pos string", [(1, "f", "0", "item", "0")]),
        "p5_found": ("tab string, item_id bigint, field_name string, utc_micros bigint",
                     [("content_records", 1, "create_time", 1577836800000000), ("office_files", 2, "dcterms_created", 1577836800000000)]),
        "p6_found": ("record_id string, last_modified_timestamp_millis bigint", [("r", 5)]),
    }
    for name, (schema, rows) in want.items():
        df = core_queries.QUERIES[name](spark, d)
        assert ", ".join(" ".join(x) for x in df.dtypes) == schema
        assert sorted(tuple(r) for r in df.collect()) == rows


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
