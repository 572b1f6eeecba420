"""Sinks: JSON, JSON lines, text, per-document files, relational and graph bulk-load files.

Files of executors are written through the file system that their address names
(``file:``, ``hdfs:``, …), never beside it. Defined cases: an empty input writes
an empty folder with the right schema; overwrite replaces a whole folder, append
adds files and never rewrites old ones; a document written twice replaces itself.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from contextlib import closing

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def write_json_lines(df: DataFrame, path: str, overwrite: bool = True) -> None:
    df.write.mode("overwrite" if overwrite else "append").json(path)


def write_text_lines(df: DataFrame, path: str, overwrite: bool = True, column: str = "text") -> None:
    df.select(F.col(column).alias("value")).write.mode("overwrite" if overwrite else "append").text(path)


def filesystem(uri: str):
    """The file system of an address and the path within it."""
    from pyarrow import fs

    if re.match(r"^file:/+", uri):
        uri = re.sub(r"^file:/+", "/", uri)
    return (fs.LocalFileSystem(), uri) if uri.startswith("/") else fs.FileSystem.from_uri(uri)


def _file_name(record_id: Column, step: str) -> Column:
    """Name of a document's file; what may not stand in a name is written as its code."""
    safe = F.regexp_replace(F.coalesce(record_id.cast("string"), F.lit("")), r"[/\\\x00-\x1f]", "_")
    return F.concat(F.lit(f"{step}_"), safe, F.lit(".json"))


def write_document_files(df: DataFrame, root: str, step: str, record_id: str = "record_id", single_text: bool = True) -> DataFrame:
    """One file ``{root}/{step}/{step}_{record_id}.json`` per document, written now by the
    executors; returns filename and path of each.

    Each file appears whole: it is written beside its place and moved there, so a
    retried task or a second run leaves one file. With ``single_text`` a field of one
    line is written as a string, not as a list.
    """
    folder = f"{root.rstrip('/')}/{step}"
    named = df.select(_file_name(F.col(record_id), step).alias("filename"), F.to_json(F.struct(*df.columns)).alias("doc"))

    def run(rows: Iterator) -> None:
        import uuid

        where, base = filesystem(folder)
        where.create_dir(base, recursive=True)
        for r in rows:
            doc = json.loads(r.doc)
            for v in (doc.get("data") or {}).values():
                if single_text and isinstance(v, dict) and isinstance(v.get("text"), list) and len(v["text"]) == 1:
                    v["text"] = v["text"][0]
            tmp = f"{base}/.{uuid.uuid4().hex}.tmp"
            with where.open_output_stream(tmp) as f:
                f.write(json.dumps(doc, ensure_ascii=False).encode())
            where.move(tmp, f"{base}/{r.filename}")

    named.foreachPartition(run)
    return named.select("filename", F.concat(F.lit(f"{folder}/"), "filename").alias("path")).distinct()


# --- graph -----------------------------------------------------------------------------------

NODE_HEADER = "node_id:ID,node_text,:LABEL,url,is_question:boolean,seq_index:int"
EDGE_HEADER = ":START_ID,:END_ID,:TYPE"
NODE_COLUMNS = ("node_id", "node_text", "node_type", "url", "is_question", "seq_index")
EDGE_COLUMNS = ("node_id1", "node_id2", "edge_type")


def write_graph(nodes: DataFrame, edges: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Nodes and edges as two tables."""
    for name, df in (("nodes", nodes), ("edges", edges)):
        w = df.write.mode("overwrite").format(fmt)
        (w.option("header", "true") if fmt == "csv" else w).save(f"{path}/{name}")


def write_graph_import(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    """Files for a graph store's bulk import: CSV parts without header, and one header file
    for each table that names the id, label, start, end and type columns."""
    for name, df, columns, header in (("nodes", nodes, NODE_COLUMNS, NODE_HEADER), ("edges", edges, EDGE_COLUMNS, EDGE_HEADER)):
        have = set(df.columns)
        plain = df.select(*[(F.col(c) if c in have else F.lit(None).cast("string")).alias(c) for c in columns])
        plain.write.mode("overwrite").option("escape", '"').option("emptyValue", "").csv(f"{path}/{name}")
        where, base = filesystem(path)
        with where.open_output_stream(f"{base}/{name}_header.csv") as f:
            f.write(f"{header}\n".encode())


def write_graph_jdbc(nodes: DataFrame, edges: DataFrame, url: str, properties: dict[str, str]) -> None:
    """The same tables into a relational database."""
    nodes.write.jdbc(url, "content_node", mode="append", properties=properties)
    edges.write.jdbc(url, "content_edge", mode="append", properties=properties)


GRAPH_TABLES = (
    "create table if not exists content_node (doc varchar(64), node_id varchar(64), node_text text, node_type varchar(32), url text, is_question boolean, seq_index int)",
    "create table if not exists content_edge (doc varchar(64), node_id1 varchar(64), node_id2 varchar(64), edge_type varchar(32))",
)


def write_graph_transactions(nodes: DataFrame, edges: DataFrame, connect: Callable, key: str = "doc_id", mark: str = "?") -> None:
    """Nodes and edges into a relational database, one transaction per document.

    ``connect`` opens a connection (DB-API) on an executor, ``mark`` is its
    placeholder. A document's earlier rows are replaced in its transaction, so a
    retried task or a second run leaves each document once.
    """
    doc = F.col(key).cast("string").alias("doc")
    none = lambda d, cs: [F.col(c).cast("string").alias(c) if c in d.columns else F.lit(None).cast("string").alias(c) for c in cs]
    n = nodes.select(doc, F.lit(0).alias("kind"), F.array(*none(nodes, NODE_COLUMNS)).alias("row"))
    owner = nodes.select(F.col("node_id").alias("o_id"), doc)
    e = edges.join(owner, F.col("node_id1") == F.col("o_id")).select("doc", F.lit(1).alias("kind"), F.array(*none(edges, EDGE_COLUMNS)).alias("row"))
    inserts = [f"insert into {t} values ({', '.join([mark] * (n + 1))})" for t, n in (("content_node", len(NODE_COLUMNS)), ("content_edge", len(EDGE_COLUMNS)))]

    def run(rows: Iterator) -> None:
        with closing(connect()) as db:
            now, held = None, ([], [])

            def commit() -> None:
                cur = db.cursor()
                for t in ("content_node", "content_edge"):
                    cur.execute(f"delete from {t} where doc = {mark}", (now,))
                for statement, values in zip(inserts, held):
                    if values:
                        cur.executemany(statement, values)
                db.commit()

            for r in rows:
                if held[0] + held[1] and r.doc != now:
                    commit()
                    held = ([], [])
                now = r.doc
                held[r.kind].append((r.doc, *r.row))
            if held[0] + held[1]:
                commit()

    n.unionByName(e).repartition("doc").sortWithinPartitions("doc").foreachPartition(run)


def qa_json_lines(pairs: DataFrame) -> DataFrame:
    """``{"question": q, "answer": [a]}`` lines."""
    return pairs.select(F.to_json(F.struct("question", F.array("answer").alias("answer"))).alias("value"))


def delete_sources(paths: DataFrame, confirmed: bool = False) -> int:
    """Delete processed source files; off unless ``confirmed``. Returns how many were there."""
    if not confirmed:
        return 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for b in batches:
            n = 0
            for uri in b.column(0).to_pylist():
                where, path = filesystem(uri)
                if where.get_file_info(path).type == fs.FileType.File:
                    where.delete_file(path)
                    n += 1
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    found = paths.select("path").where("path is not null").distinct().mapInArrow(run, "n bigint")
    return found.agg(F.sum("n")).first()[0] or 0
