"""Registered queries of the general operators, with their SQL counterparts."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession, functions as F

from docloom.operators import consolidate, delta, nested, timestamps
from docloom.session import table


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    parts = nested.parts(nested.written_tables(table(spark, d, "raw_records")))
    return parts.select("raw_id", "field_name", "block_path", "part_name", "pos")


def p2_tables(spark: SparkSession, d: str) -> DataFrame:
    """Rows, records and orphans of each variant, with the table it is routed to."""
    tables = nested.written_tables(table(spark, d, "raw_records"))
    keys = ("raw_id", "node", "parent", "variant")
    rows = functools.reduce(DataFrame.unionByName, [t.select(F.lit(n).alias("subtype"), *keys) for n, t in tables.items()])
    above = rows.select(F.col("raw_id").alias("a_raw"), F.col("node").alias("a_node"))
    joined = rows.join(above, (F.col("raw_id") == F.col("a_raw")) & (F.col("parent") == F.col("a_node")), "left")
    return joined.groupBy("subtype", "variant").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("parent").alias("n_with_parent"), F.count_distinct("raw_id").alias("n_records"),
        F.count_if(F.col("parent").isNotNull() & F.col("a_node").isNull()).alias("n_orphans"),
    )


def _consolidated(spark: SparkSession, d: str) -> DataFrame:
    return consolidate.consolidated(consolidate.vouched_files(table(spark, d, "output_files"), table(spark, d, "control_jobs")))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return consolidate.current_records(_consolidated(spark, d))


def p3_ranges(spark: SparkSession, d: str) -> DataFrame:
    """Range metadata of the consolidated files, as written."""
    return consolidate.range_metadata(_consolidated(spark, d))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return timestamps.metadata_instants(
        table(spark, d, "content_records"), table(spark, d, "office_files"), table(spark, d, "sites")
    ).select("tab", "item_id", "field_name", "utc_micros")


def p5_status(spark: SparkSession, d: str) -> DataFrame:
    """How many values were unique, ambiguous, skipped or gave their offset."""
    return timestamps.metadata_instants(
        table(spark, d, "content_records"), table(spark, d, "office_files"), table(spark, d, "sites")
    ).groupBy("tab", "field_name", "zone_status").agg(F.count(F.lit(1)).alias("n_values"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return delta.commit_pending(table(spark, d, "content_records"), table(spark, d, "control_entries"))


def p6_changes(spark: SparkSession, d: str) -> DataFrame:
    """File-level diff of the processed manifest against the delivered one."""
    new = delta.manifest(
        table(spark, d, "content_records"), delta.normal_path(F.col("file_path")), F.col("last_modified_timestamp_millis")
    )
    entries = table(spark, d, "control_entries").where(
        (F.col("step_name") == "extract") & delta.is_success(F.col("status")) & F.col("seen_modified_millis").isNotNull()
    )
    old = delta.manifest(entries, delta.normal_path(F.col("input")), F.col("seen_modified_millis"))
    return delta.diff(old, new).groupBy("change").agg(F.count(F.lit(1)).alias("n_files"))


QUERIES = {f.__name__: f for f in (p2_found, p2_tables, p3_found, p3_ranges, p5_found, p5_status, p6_found, p6_changes)}

_NORMAL = (
    "regexp_replace(regexp_replace(regexp_replace(trim({c}), '^(?i:file:)/*', '/'), '/(\\./)+', '/', 'g'), "
    "'/(\\.?/)+', '/', 'g')"
)

SQL = {
    "p3_found": """
        with listed as (
            select distinct job_id, f.path as path
            from (select job_id, unnest(files_output) as f from control_jobs)
            where lower(trim(f.status)) = 'processed'),
        lines as (
            select o.file_id, o.written_at, unnest(string_split(o.content, chr(10))) as line
            from output_files o join listed using (job_id, path)),
        rec as (
            select case when json_valid(line) then json_extract_string(line, '$.record_id') end as record_id,
                   file_id, written_at
            from lines where trim(line) <> '')
        select record_id, file_id from rec where record_id is not null
        qualify row_number() over (partition by record_id order by written_at desc nulls last, file_id desc) = 1""",
    "p6_found": f"""
        with cur as (
            select record_id, max(last_modified_timestamp_millis) as last_modified_timestamp_millis,
                   arg_max({_NORMAL.format(c='file_path')}, last_modified_timestamp_millis) as file
            from content_records group by record_id),
        done as (
            select {_NORMAL.format(c='input')} as file, max(seen_modified_millis) as seen
            from control_entries
            where step_name = 'extract' and lower(trim(status)) = 'processed' group by 1)
        select record_id, last_modified_timestamp_millis from cur
        where not exists (select 1 from done where done.file = cur.file and done.seen >= cur.last_modified_timestamp_millis)""",
    "p6_changes": f"""
        with new as (
            select {_NORMAL.format(c='file_path')} as file, max(last_modified_timestamp_millis) as v
            from content_records group by 1),
        old as (
            select {_NORMAL.format(c='input')} as file, max(seen_modified_millis) as v
            from control_entries
            where step_name = 'extract' and lower(trim(status)) = 'processed' and seen_modified_millis is not null group by 1)
        select case when new.file is null then 'removed' when old.file is null then 'added' else 'modified' end as change,
               count(*) as n_files
        from new full join old on new.file = old.file
        where new.file is null or old.file is null or new.v > old.v group by 1""",
}
