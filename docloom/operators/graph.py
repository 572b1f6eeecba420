"""Content graph of ordered blocks: nodes and edges as two DataFrames.

Node ids are hashes of document and position, so reruns give the same graph.
Blocks of other types (json, image) are left out without breaking the chain.
Windows are per document: a document is one record, so no window gathers more
than a document's blocks.

Defined cases: blocks before the first heading have no heading edge; an empty
list or table still is a node; null items and cells are nodes with null text;
markers that name no earlier link give no edge.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

NODE_TYPES = ("heading", "link", "list", "table", "text")


def node_id(*parts) -> Column:
    return F.sha2(F.concat_ws("|", *[F.col(p).cast("string") if isinstance(p, str) else p.cast("string") for p in parts]), 256)


def block_nodes(blocks: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, seq, node_id, node_text, node_type, url, is_question of graph blocks."""
    has = set(blocks.columns)
    opt = lambda c, t: F.col(c) if c in has else F.lit(None).cast(t)
    return blocks.where(F.col("type").isin(*NODE_TYPES)).select(
        key, "seq", node_id(key, "seq").alias("node_id"), F.col("text").alias("node_text"), F.col("type").alias("node_type"),
        opt("url", "string").alias("url"), opt("is_question", "boolean").alias("is_question"), F.lit(None).cast("int").alias("seq_index"),
    )


def both_ways(pairs: DataFrame) -> DataFrame:
    """(first, second) pairs as before and after edges."""
    edge = lambda a, b, t: F.struct(F.col(a).alias("node_id1"), F.col(b).alias("node_id2"), F.lit(t).alias("edge_type"))
    return pairs.select(F.inline(F.array(edge("first", "second", "before"), edge("second", "first", "after"))))


def order_edges(nodes: DataFrame, *group: str, order: str = "seq") -> DataFrame:
    w = Window.partitionBy(*group).orderBy(order)
    return both_ways(
        nodes.select(F.lag("node_id").over(w).alias("first"), F.col("node_id").alias("second")).where("first is not null")
    )


def heading_edges(nodes: DataFrame, key: str = "doc_id") -> DataFrame:
    """has_heading: each block that is no heading to the last heading before it."""
    w = Window.partitionBy(key).orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    last = F.last(F.when(F.col("node_type") == "heading", F.col("node_id")), ignorenulls=True).over(w)
    return (
        nodes.withColumn("h", last).where((F.col("node_type") != "heading") & F.col("h").isNotNull())
        .select(F.col("node_id").alias("node_id1"), F.col("h").alias("node_id2"), F.lit("has_heading").alias("edge_type"))
    )


def link_edges(blocks: DataFrame, key: str = "doc_id") -> DataFrame:
    """has_link: a text, heading or list item with ``[[t]]`` to the latest earlier link with text t.

    An as-of join: equal document and text, greatest position below; the
    greatest is a partial aggregate, not a window.
    """
    links = blocks.where("type = 'link'").select(F.col(key).alias("l_key"), F.col("seq").alias("l_seq"), F.col("text").alias("l_text"))
    texts = blocks.where(F.col("type").isin("text", "heading")).select(key, "seq", node_id(key, "seq").alias("node_id1"), F.col("text").alias("marked"))
    items = blocks.where("type = 'list'").select(key, "seq", F.posexplode("items").alias("i", "marked")).select(
        key, "seq", _child([key, "seq"], "item", "i").alias("node_id1"), "marked"
    )
    marks = texts.unionByName(items).select(key, "seq", "node_id1", F.explode(F.regexp_extract_all("marked", F.lit(r"\[\[(.*?)\]\]"), 1)).alias("mark"))
    hit = marks.join(links, (F.col(key) == F.col("l_key")) & (F.col("mark") == F.col("l_text")) & (F.col("l_seq") < F.col("seq")))
    latest = hit.groupBy(key, "node_id1", "mark").agg(F.max("l_seq").alias("l_seq"))
    return latest.select("node_id1", node_id(key, "l_seq").alias("node_id2"), F.lit("has_link").alias("edge_type"))


def _child(parent_parts: list, kind: str, *index) -> Column:
    return node_id(*parent_parts, F.lit(kind), *index)


def list_graph(blocks: DataFrame, key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """list_item nodes, item_of edges and the chain of siblings."""
    items = blocks.where("type = 'list'").select(key, "seq", F.posexplode("items").alias("i", "node_text"))
    items = items.withColumns({"node_id": _child([key, "seq"], "item", "i"), "parent": node_id(key, "seq")})
    nodes = items.select(key, "seq", "node_id", "node_text", F.lit("list_item").alias("node_type"), F.col("i").alias("seq_index"))
    member = items.select(F.col("node_id").alias("node_id1"), F.col("parent").alias("node_id2"), F.lit("item_of").alias("edge_type"))
    return nodes, member.unionByName(order_edges(items, key, "seq", order="i"))


def table_graph(blocks: DataFrame, key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """Row and cell nodes; head_row_of, body_row_of, cell_of and sibling edges.

    Chains restart at the body and at each row.
    """
    tables = blocks.where("type = 'table'")
    part = lambda p: tables.select(key, "seq", F.lit(p).alias("part"), F.posexplode(p).alias("r", "cells"))
    rows = part("head").unionByName(part("body"))
    rows = rows.withColumns({"node_id": _child([key, "seq"], "row", "part", "r"), "parent": node_id(key, "seq")})
    cells = rows.select(key, "seq", "part", "r", F.col("node_id").alias("parent"), F.posexplode("cells").alias("c", "node_text"))
    cells = cells.withColumn("node_id", _child([key, "seq"], "cell", "part", "r", "c"))
    nodes = rows.select(
        key, "seq", "node_id", F.lit(None).cast("string").alias("node_text"),
        F.concat(F.col("part"), F.lit("_row")).alias("node_type"), F.col("r").alias("seq_index"),
    ).unionByName(cells.select(key, "seq", "node_id", "node_text", F.lit("cell").alias("node_type"), F.col("c").alias("seq_index")))
    edge = lambda d, t: d.select(F.col("node_id").alias("node_id1"), F.col("parent").alias("node_id2"), t.alias("edge_type"))
    edges = (
        edge(rows, F.concat(F.col("part"), F.lit("_row_of")))
        .unionByName(edge(cells, F.lit("cell_of")))
        .unionByName(order_edges(rows, key, "seq", "part", order="r"))
        .unionByName(order_edges(cells, key, "seq", "part", "r", order="c"))
    )
    return nodes, edges


def content_graph(blocks: DataFrame, key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """All nodes and edges of the blocks (type, seq, text, url, items, head, body)."""
    top = block_nodes(blocks, key)
    item_nodes, item_edges = list_graph(blocks, key)
    cell_nodes, cell_edges = table_graph(blocks, key)
    nodes = top.unionByName(item_nodes, allowMissingColumns=True).unionByName(cell_nodes, allowMissingColumns=True)
    edges = (
        order_edges(top, key).unionByName(heading_edges(top, key)).unionByName(link_edges(blocks, key))
        .unionByName(item_edges).unionByName(cell_edges)
    )
    return nodes, edges
