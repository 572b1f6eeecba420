"""Registered queries of the document operators, with their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from docloom.functions import text as t
from docloom.html.blocks import exploded_blocks, html_blocks
from docloom.operators import collect, control, entities, graph, questions, tables
from docloom.session import delete_at_exit, scratch_path, spread, table
from docloom.sinks import writers
from docloom.sources import files

# The configuration of the queries, text properties by document type (ordered).
# Names of types and properties are those of the test tables.
PROPS = {
    "CHANNEL_PRICING": ["pricing_title", "pricing_description"],
    "CHANNEL_HELP": ["help_title", "profiled_content"],
    "CHANNEL_NEWS": ["news_title", "news_announcement"],
    "CHANNEL_CONTACTS": ["title_of_contact", "description_of_group"],
    "CHANNEL_PROCESS": ["process_title", "process_description"],
    "CHANNEL_ANSWERFLOW_STEPS": ["step_title", "reference_table"],
}
WITH_TEXT = ["CHANNEL_HELP", "CHANNEL_NEWS", "CHANNEL_PRICING", "CHANNEL_PROCESS"]
CONFIG = "doc_types:\n" + "".join(f"  {k}:\n    text_props: [{', '.join(v)}]\n" for k, v in PROPS.items()) + f"doc_types_with_text: [{', '.join(WITH_TEXT)}]\n"
WORDS = {"antenna": ("part", "antenna"), "splitter": ("part", "splitter"), "Kabel": ("part", "cable"), "cable": ("part", "cable")}
PHRASES = [("exchange in", "place", "exchange"), ("still with", "state", "held"), ("It costs", "price", "cost")]
PATCH = '{"k": {"old": true}, "seen": {"by": [1, "x"]}}'
PATTERNS = [("ticket", "ticket", r"\b(TK|INC|AFS|CS-)(\d+)\b"), ("price", "price", r"\$\d+\.\d{2}")]


def config(spark: SparkSession) -> DataFrame:
    return files.doc_type_config(spark, CONFIG)[0]


def types_with_text(spark: SparkSession) -> DataFrame:
    return files.doc_type_config(spark, CONFIG)[1]


def documents(spark: SparkSession, d: str) -> DataFrame:
    """The documents; a single file is spread over the cores (unused columns stay behind)."""
    return spread(table(spark, d, "documents"))


def blocks(spark: SparkSession, d: str) -> DataFrame:
    """Blocks of the parsed fields: field_id, row_id, field_name, seq, type, …"""
    rf = table(spark, d, "record_fields")
    b = rf.select("field_id", "row_id", "field_name", F.posexplode("structured_content").alias("seq", "b"))
    return b.select("field_id", "row_id", "field_name", "seq", F.col("b.block_type").alias("type"), "b.text", "b.url", "b.heading", "b.items", "b.head", "b.body")


def table_blocks(spark: SparkSession, d: str) -> DataFrame:
    return blocks(spark, d).where("type = 'table'").select(F.concat_ws("|", "field_id", "seq").alias("table_id"), "head", "body")


def typed_fields(spark: SparkSession, d: str) -> DataFrame:
    records = table(spark, d, "content_records").select(F.col("row_id").alias("c_row"), "doc_type")
    return table(spark, d, "record_fields").join(records, F.col("row_id") == F.col("c_row")).drop("c_row")


def clean_text(spark, d):
    return documents(spark, d).select("doc_id", t.clean_text("text").alias("clean"))


def strip_bullets(spark, d):
    return questions.line_blocks(documents(spark, d)).select("doc_id", "seq", t.remove_bullet_markers("text").alias("line"))


def link_strip(spark, d):
    return documents(spark, d).where("text is not null").select("doc_id", F.md5(t.strip_link_markers("text")).alias("digest"))


def underscore_name(spark, d):
    return table(spark, d, "content_records").select("row_id", t.underscore_name("title").alias("name"))


def template_variables(spark, d):
    """Variables in braces, with how often each stands in the texts."""
    words = documents(spark, d).select(F.explode(F.regexp_extract_all("text", F.lit(r"\{[^{}\s]*\}"), 0)).alias("w"))
    return words.where(t.is_variable("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n"))


def iso_millis(spark, d):
    return table(spark, d, "content_records").select("row_id", t.iso_from_millis("start_timestamp_millis").alias("start_time"))


def fix_content(spark, d):
    return documents(spark, d).where("text is not null").select("doc_id", F.md5(t.fix_content("text")).alias("digest"))


def job_key(spark, d):
    return table(spark, d, "control_jobs").select("job_id", t.job_key("write_root_dir").alias("key"))


def doc_type(spark, d):
    return table(spark, d, "office_files").select("file_no", t.doc_type_of_file("filename").alias("kind"))


def deep_update(spark, d):
    e = spread(table(spark, d, "events").select("event_id", "props"))
    return e.select("event_id", t.deep_merge("props", F.lit(PATCH)).alias("merged"))


def line_questions(spark, d):
    return questions.identify_questions(questions.line_blocks(documents(spark, d)), cleaned=True).groupBy("doc_id").agg(
        F.count_if("is_question").alias("n_questions"), F.count(F.lit(1)).alias("n_lines")
    )


def block_questions(spark, d):
    return questions.identify_questions(blocks(spark, d)).groupBy("type", "is_question").agg(F.count(F.lit(1)).alias("n"))


def extract_questions(spark, d):
    q = questions.extract_questions(questions.line_blocks(documents(spark, d)), cleaned=True)
    joined = lambda c: F.array_join(c, "\n").alias(c)
    return q.select("doc_id", joined("questions"), joined("non_questions"))


def found_questions(spark, d):
    return questions.found_questions(questions.line_blocks(documents(spark, d)), cleaned=True)


def list_markers(spark, d):
    words = documents(spark, d).select(F.explode(F.split(t.clean_text("text"), " ")).alias("w"))
    flags = words.groupBy("w").agg(F.count(F.lit(1)).alias("n")).select(
        "w", "n", t.is_bullet("w").alias("bullet"), t.is_list_number("w").alias("number"), t.is_roman_numeral("w").alias("roman")
    )
    return flags.where("bullet or number or roman")


def block_counts(spark, d):
    return blocks(spark, d).groupBy("type").agg(F.count(F.lit(1)).alias("n_blocks"))


def list_items(spark, d):
    return blocks(spark, d).where("type = 'list'").select("field_id", "seq", F.posexplode("items").alias("i", "item"))


def html_structure(spark, d):
    """Blocks by type of the texts that hold a tag."""
    pages = documents(spark, d).where(F.col("text").rlike("<[A-Za-z/!]"))
    return exploded_blocks(pages, "text", "doc_id").groupBy("doc_id", "type").agg(F.count(F.lit(1)).alias("n"))


def _escaped(c) -> Column:
    out = F.coalesce(c, F.lit(""))
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def html_round_trip(spark, d):
    """The headings, texts, lists and links of each parsed field, written as one HTML page and read again."""
    rf = spread(table(spark, d, "record_fields").select("field_id", "structured_content"))
    tag = lambda name, inner: F.concat(F.lit(f"<{name}>"), inner, F.lit(f"</{name}>"))

    def block(b):
        items = F.array_join(F.transform(b["items"], lambda x: tag("li", _escaped(x))), "")
        link = F.concat(F.lit('<a href="'), _escaped(b["url"]), F.lit('">'), _escaped(b["text"]), F.lit("</a>"))
        kind = b["block_type"]
        return F.when(kind == "heading", tag("h2", _escaped(b["text"]))).when(kind == "text", tag("p", _escaped(b["text"]))).when(
            kind == "list", tag("ul", F.coalesce(items, F.lit("")))).when(kind == "link", tag("p", link)).otherwise("")

    pages = rf.select("field_id", F.array_join(F.transform("structured_content", block), "").alias("html"))
    read = exploded_blocks(pages, "html", "field_id")
    return read.select("field_id", "seq", "type", "text", "url", F.array_join("items", "|").alias("items"))


def html_tables(spark, d):
    """The tables of the parsed fields that have a head and more than one column, written as HTML and read again."""
    tb = blocks(spark, d).where("type = 'table'").where(
        F.exists("head", lambda r: F.exists(r, lambda c: t.clean_text(c) != "")) & F.exists(F.concat("head", F.coalesce("body", F.array().cast("array<array<string>>"))), lambda r: F.size(r) > 1)
    )

    def rows(c, name):
        row = lambda r: F.concat(F.lit("<tr>"), F.array_join(F.transform(r, lambda x: F.concat(F.lit(f"<{name}>"), _escaped(x), F.lit(f"</{name}>"))), ""), F.lit("</tr>"))
        return F.coalesce(F.array_join(F.transform(F.filter(c, F.isnotnull), row), ""), F.lit(""))

    html = F.concat(F.lit("<table>"), rows("head", "th"), rows("body", "td"), F.lit("</table>"))
    read = exploded_blocks(spread(tb).select("field_id", F.col("seq").alias("block"), html.alias("html")), "html", "field_id", "block").where("type = 'table'")
    part = lambda c: read.select("field_id", "block", F.lit(c).alias("part"), F.posexplode(c).alias("r", "row"))
    return part("head").unionByName(part("body")).select("field_id", "block", "part", "r", F.posexplode("row").alias("c", "value"))


def html_lines(spark, d):
    """Text lines of all documents in the segmenting mode."""
    docs = documents(spark, d).where("text is not null")
    return docs.select("doc_id", F.size(html_blocks(F.col("text"), segment=True)["text"]).alias("n_lines"))


def json_dispatch(spark, d):
    """Which payloads are JSON to the dispatching parser, and which are read as HTML."""
    raw = spread(table(spark, d, "raw_records").select("raw_id", "payload"))
    parsed = raw.select("raw_id", html_blocks(F.col("payload"), json_values=True)["structured_content"].alias("b"))
    return parsed.select("raw_id", F.exists("b", lambda x: x["type"] == "json").alias("is_json"))


def graph_nodes(spark, d):
    return graph.block_nodes(blocks(spark, d), "field_id").select("field_id", "seq", "node_id", "node_text", "node_type", "url")


def graph_order(spark, d):
    return graph.order_edges(graph.block_nodes(blocks(spark, d), "field_id"), "field_id")


def graph_headings(spark, d):
    return graph.heading_edges(graph.block_nodes(blocks(spark, d), "field_id"), "field_id")


def graph_links(spark, d):
    return graph.link_edges(blocks(spark, d), "field_id")


def graph_lists(spark, d):
    return graph.list_graph(blocks(spark, d), "field_id")[1]


def graph_tables(spark, d):
    return graph.table_graph(blocks(spark, d), "field_id")[1]


def collect_fields(spark, d):
    c = collect.collect_fields(typed_fields(spark, d), config(spark))
    kinds = F.array_join(F.transform("structured_content", lambda x: F.coalesce(x["block_type"], F.lit("?"))), ",")
    return c.select("row_id", "doc_type", F.array_join("text", "\n").alias("lines"), kinds.alias("kinds"))


def combine_text(spark, d):
    records = table(spark, d, "content_records").select(F.col("row_id").alias("c_row"), "doc_type")
    b = blocks(spark, d).join(records, F.col("row_id") == F.col("c_row"))
    return collect.combine_text(b, types_with_text(spark), "field_id")


def prepare_qa(spark, d):
    return collect.prepare_qa(blocks(spark, d), "field_id")


def doc_type_filter(spark, d):
    return collect.of_types(table(spark, d, "content_records"), types_with_text(spark)).select("row_id", "doc_type")


def value_types(spark, d):
    rf = tables.cells(table_blocks(spark, d))
    return rf.groupBy("value", tables.value_type("value").alias("value_type")).agg(F.count(F.lit(1)).alias("n"))


def column_types(spark, d):
    part = table(spark, d, "part")
    pairs = [F.struct(F.lit(c).alias("col"), F.col(c).cast("string").alias("value")) for c in part.columns]
    typed = part.select(F.inline(F.array(*pairs))).withColumn("value_type", tables.value_type("value"))
    return tables.column_types(typed, "col").select("col", "data_type", "var_type")


def table_schemas(spark, d):
    joined = lambda c: F.array_join(c, ",").alias(c)
    schema = tables.table_schema(table_blocks(spark, d))
    return schema.select("table_id", "n_header_rows", "has_header", "has_row_labels", joined("data_types"), joined("var_types"))


def table_sentences(spark, d):
    return tables.table_sentences(table_blocks(spark, d))


def token_entities(spark, d):
    e = spark.createDataFrame([(k, *v) for k, v in WORDS.items()], "phrase string, entity string, value string")
    return entities.token_matches(documents(spark, d), e)


def pattern_entities(spark, d):
    """Each line's mentions by pattern, in order."""
    lines = questions.line_blocks(documents(spark, d))
    e = lines.select("doc_id", "seq", "text", entities.match_patterns(F.col("text"), PATTERNS).alias("e"))
    words = lambda kind: F.transform(F.filter("e", lambda m: m["entity"] == kind), lambda m: F.substring("text", m["start"] + 1, m["end"] - m["start"]))
    found = e.where(F.size("e") > 0).select("doc_id", "seq", *[F.array_join(words(k), "|").alias(f"{k}s") for k, *_ in PATTERNS])
    return found


def pruned_entities(spark, d):
    lines = questions.line_blocks(documents(spark, d))
    phrases = {k: v for k, v in WORDS.items()} | {"coax cable": ("part", "coax cable")}
    e = entities.line_entities(lines, dictionary=phrases, patterns=PATTERNS)
    return e.select("doc_id", "seq", F.explode("entities").alias("e")).groupBy("e.entity", "e.value").agg(F.count(F.lit(1)).alias("n"))


def phrase_entities(spark, d):
    """Dictionary phrases of more than one word, by joining word sequences."""
    lines = questions.line_blocks(documents(spark, d))
    e = spark.createDataFrame(PHRASES, "phrase string, entity string, value string")
    hits = entities.phrase_matches(lines, e).select("doc_id", "seq", "text", F.explode("mentions").alias("m"))
    return hits.select("doc_id", "seq", F.col("m.start").alias("start"), F.substring("text", F.col("m.start") + 1, F.col("m.end") - F.col("m.start")).alias("phrase"), "m.value")


def _entries(spark, d, step):
    e = table(spark, d, "control_entries").where(F.col("step_name") == step)
    return e.select("filename", "input", "path", "status", F.col("entry_at").alias("time"))


def restart_pending(spark, d):
    inputs = table(spark, d, "content_records").select(F.col("file_path").alias("path")).distinct()
    return control.pending_inputs(inputs, _entries(spark, d, "collect"))


def restart_carried(spark, d):
    inputs = table(spark, d, "content_records").select(F.col("file_path").alias("path")).distinct()
    return control.carried_outputs(inputs, _entries(spark, d, "collect")).groupBy("input", "path").agg(F.count(F.lit(1)).alias("n"))


def fileset_diff(spark, d):
    a = table(spark, d, "content_records").select(F.col("file_path").alias("path"))
    return control.fileset_difference(a, _entries(spark, d, "extract").select(F.col("input").alias("path")))


def file_status(spark, d):
    paths = table(spark, d, "content_records").groupBy(F.col("file_path").alias("path")).agg(
        F.lit("new").alias("status"), F.max("arrived_at").alias("time")
    )
    return control.file_status(paths, _entries(spark, d, "extract")).select("path", "status")


def control_tables(spark, d):
    return control.normalised(table(spark, d, "control_jobs"))["step_outputs"]


def first_files(spark, d):
    """The source limit: exactly that many of the files below the folder, in order."""
    return files.list_files(spark, d, limit=3).select("filename", "length")


def xml_records(spark, d):
    """The delivered revisions written as XML records and read as whole documents."""
    rows = spread(table(spark, d, "content_records").select(
        "row_id", "record_id", "title", "doc_type", "document_no", "version_no", "author", "start_timestamp_millis",
        "last_modified_timestamp_millis", "published_timestamp_millis", "doc_location_path", "file_path",
    ))
    element = lambda name, c: F.concat(F.lit(f"<{name}>"), _escaped(F.col(c).cast("string")), F.lit(f"</{name}>"))
    members = {
        "MASTERIDENTIFIER": "title", "TYPE": "doc_type", "DOCUMENTID": "document_no", "VERSION": "version_no", "AUTHOR": "author",
        "STARTTIMESTAMP_MILLIS": "start_timestamp_millis", "LASTMODIFIEDTIMESTAMP_MILLIS": "last_modified_timestamp_millis",
        "RESOURCEPATH": "doc_location_path", "PUBLISHEDTIMESTAMP_MILLIS": "published_timestamp_millis",
    }
    body = F.concat(F.lit("<"), F.col("doc_type"), F.lit("><GUID>g</GUID>"), element("STEP_TITLE", "file_path"), F.lit("</"), F.col("doc_type"), F.lit(">"))
    xml = F.concat(F.lit('<CONTENT RECORDID="'), _escaped(F.col("record_id")), F.lit('">'), *[element(k, c) for k, c in members.items()], F.coalesce(body, F.lit("")), F.lit("</CONTENT>"))
    read = files.xml_documents(rows.select(F.col("row_id").cast("string").alias("path"), xml.cast("binary").alias("content")))
    lines = F.array_join(F.try_element_at(F.col("data"), F.lit("step_title"))["text"], "\n")
    return read.select(
        F.col("path").cast("bigint").alias("row_id"), "record_id", "title", "doc_type", "doc_id", "version", "author", "start_timestamp_millis", "start_time",
        "last_modified_timestamp_millis", "published_time", "doc_location_path", lines.alias("lines"), F.size("data").alias("n_fields"), "error",
    )


def document_files(spark, d):
    """Sites written as one JSON file each and read again."""
    sites = table(spark, d, "sites").select(F.col("site_id").alias("record_id"), F.create_map(F.lit("name"), F.struct(F.array("site_name").alias("text")),
                                                                                             F.lit("zone"), F.struct(F.array("time_zone", "site_id").alias("text"))).alias("data"))
    root = scratch_path(spark, "documents")
    writers.write_document_files(sites, root, "extract")
    read = files.json_documents(spark, f"{root}/extract", "record_id string, data struct<name: struct<text: string>, zone: struct<text: array<string>>>")
    delete_at_exit(spark, root)
    return read.select("record_id", F.col("data.name.text").alias("site_name"), F.array_join("data.zone.text", "|").alias("zone"))


def json_lines(spark, d):
    """Job files written as JSON lines, overwritten and appended to, and read again."""
    jobs = table(spark, d, "control_jobs").select("job_id", "status", "steps", "started_at", "message")
    path = scratch_path(spark, "lines")
    writers.write_json_lines(jobs.limit(0), path)
    writers.write_json_lines(jobs, path)
    delete_at_exit(spark, path)
    writers.write_json_lines(jobs, path, overwrite=False)
    read = spark.read.schema("job_id string, status string, steps array<string>, message string").json(path)
    return read.groupBy("job_id", "status", F.array_join("steps", "|").alias("steps"), "message").agg(F.count(F.lit(1)).alias("n"))


def qa_file(spark, d):
    """Question-answer pairs written as tab-separated lines, read, and turned into JSON lines."""
    lines = table(spark, d, "content_records").where("title is not null and document_no is not null and doc_type is not null").select(
        F.concat_ws("\t", "doc_type", F.concat_ws(", ", "site_id", "record_id"), F.concat(F.lit("Is it "), t.clean_text("title")), "document_no", F.lit("Where"), "record_id", F.lit("odd")).alias("text")
    )
    path = scratch_path(spark, "pairs")
    writers.write_text_lines(lines, path)
    delete_at_exit(spark, path)
    pairs = files.qa_pairs(spark, path)
    return pairs.select("intent", F.array_join("entities", "|").alias("entities"), "question", "answer").withColumn(
        "line", F.to_json(F.struct("question", F.array("answer").alias("answer")))
    )


def flatten_heads(spark, d):
    """One-level flattening of the head rows of each table."""
    return blocks(spark, d).where("type = 'table' and head is not null").select("field_id", "seq", F.flatten("head").alias("names"))


def has_letters(spark, d):
    docs = documents(spark, d).where("text is not null")
    return docs.select("doc_id", t.has_alpha(t.tokens("text")).alias("alpha"))


def config_props(spark, d):
    """The configuration as an ordered dimension, with how often each field occurs."""
    used = typed_fields(spark, d).groupBy(F.col("doc_type").alias("u_type"), "field_name").agg(F.count(F.lit(1)).alias("n"))
    j = used.join(config(spark), (F.col("u_type") == F.col("doc_type")) & (F.col("field_name") == F.col("prop")), "right")
    return j.select("doc_type", "prop", "ord", F.coalesce("n", F.lit(0)).alias("n"))


def table_cells(spark, d):
    """Head and body rows of each table as one frame of cells."""
    return tables.cells(table_blocks(spark, d))


def value_words(spark, d):
    part = table(spark, d, "part")
    return part.select(
        "p_partkey", tables.value_text(F.col("p_size").cast("string")).alias("size"),
        tables.value_text((F.col("p_partkey") * 1000003).cast("string")).alias("key"), tables.label_text("p_name").alias("name"),
    )


def column_uniqueness(spark, d):
    part = table(spark, d, "part")
    pairs = [F.struct(F.lit(c).alias("col"), F.col(c).cast("string").alias("value")) for c in ("p_name", "p_brand", "p_type")]
    typed = part.select(F.inline(F.array(*pairs))).withColumn("value_type", tables.value_type("value"))
    return tables.column_types(typed, "col").select("col", F.round("uniqueness", 6).alias("uniqueness"))


def date_validity(spark, d):
    """Date mentions that stay: long enough, readable, and between 1990 and 2025."""
    orders = table(spark, d, "orders")
    year = F.lit(1985) + F.pmod("o_orderkey", F.lit(50))
    value = F.format_string("%04d-%02d-%02d", year, F.pmod("o_orderkey", F.lit(12)) + 1, F.pmod("o_orderkey", F.lit(28)) + 1)
    end = F.when(F.pmod("o_orderkey", F.lit(7)) == 0, 6).otherwise(10)
    none = F.lit(None).cast("array<struct<grp: int, start: int, end: int>>")
    mention = F.struct(
        F.lit("sys-date").alias("entity"), F.lit(0).alias("start"), end.alias("end"), value.alias("value"), F.lit(1.0).alias("confidence"), none.alias("groups")
    )
    kept = orders.select("o_orderkey", F.explode(entities.valid_mentions(F.array(mention))).alias("e"))
    return kept.select("o_orderkey", "e.value")


def step_progress(spark, d):
    """Entries of each step and job by outcome."""
    e = table(spark, d, "control_entries")
    ok = F.coalesce(control.is_success(F.col("status")), F.lit(False))
    return e.groupBy("job_id", "step_name").agg(F.count_if(ok).alias("n_processed"), F.count_if(~ok).alias("n_other"))


_NAMES = """
clean_text strip_bullets link_strip underscore_name template_variables iso_millis fix_content job_key doc_type deep_update
line_questions block_questions extract_questions found_questions list_markers block_counts list_items html_structure
html_round_trip html_tables html_lines json_dispatch graph_nodes graph_order graph_headings graph_links graph_lists graph_tables collect_fields
combine_text prepare_qa doc_type_filter value_types column_types table_schemas table_sentences token_entities
pattern_entities pruned_entities phrase_entities restart_pending restart_carried fileset_diff file_status control_tables first_files
xml_records document_files json_lines qa_file flatten_heads has_letters config_props table_cells value_words column_uniqueness date_validity step_progress
""".split()
QUERIES = {n: globals()[n] for n in _NAMES}

_WS = r"[\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\p{Z}]"


def _clean(c: str) -> str:
    return f"trim(regexp_replace(coalesce({c}, ''), '{_WS}+', ' ', 'g'))"



_LINES = f"""
    lines as (
        select doc_id, i - 1 as seq, {_clean('l')} as text
        from (select doc_id, unnest(string_split(text, chr(10))) as l, generate_subscripts(string_split(text, chr(10)), 1) as i
              from documents)
        where {_clean('l')} <> '')"""
_QUESTION = "(text like '%?' or lower(string_split(text, ' ')[1]) in (" + ", ".join(f"'{w}'" for w in t.QUESTION_WORDS) + "))"
_BLOCKS = """
    blocks as (
        select field_id, row_id, field_name, i - 1 as seq, b.block_type as type, b.text as text, b.url as url,
               b.heading as heading, b.items as items, b.head as head, b.body as body
        from (select field_id, row_id, field_name, unnest(structured_content) as b,
                     generate_subscripts(structured_content, 1) as i from record_fields))"""
_ID = "sha256(concat_ws('|', {}))"
_NODES = _BLOCKS + """,
    nodes as (
        select field_id, seq, sha256(concat_ws('|', field_id, seq)) as node_id, text as node_text, type as node_type, url
        from blocks where type in ('heading', 'link', 'list', 'table', 'text'))"""
_BOTH = """
        select first as node_id1, second as node_id2, 'before' as edge_type from pairs where first is not null
        union all select second, first, 'after' from pairs where first is not null"""
_CONFIG = "config(doc_type, prop, ord) as (values " + ", ".join(f"('{k}', '{p}', {i})" for k, v in PROPS.items() for i, p in enumerate(v)) + ")"
_TYPES = ", ".join(f"'{x}'" for x in WITH_TEXT)
_TYPE_OF = """case when value is null or trim(lower(value)) = '' or trim(lower(value)) in ('null', 'none', 'na', '_', '-') then 'NULL'
     when trim(lower(value)) in ('true', 't', 'yes', 'y', 'on', 'false', 'f', 'no', 'n', 'off') then 'BOOL'
     when regexp_full_match(trim(value), '[+-]?([0-9][0-9_]*\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') then
         case when try_cast(replace(trim(value), '_', '') as double) in (0, 1) then 'BIT'
              when try_cast(replace(trim(value), '_', '') as double) = floor(try_cast(replace(trim(value), '_', '') as double)) then 'INT'
              else 'FLOAT' end
     when regexp_full_match(trim(value), '[0-9]{1,4}[-/.][0-9]{1,2}[-/.][0-9]{1,4}([ T][0-9]{1,2}:[0-9]{2}(:[0-9]{2})?)?') then 'DATE'
     else 'STRING' end"""
_CELLS = _BLOCKS + f""",
    cells as (
        select table_id, r - 1 as r, unnest(row) as value, generate_subscripts(row, 1) - 1 as c, n_head
        from (select concat_ws('|', field_id, seq) as table_id, coalesce(len(head), 0) as n_head,
                     unnest(list_concat(coalesce(head, []), coalesce(body, []))) as row,
                     generate_subscripts(list_concat(coalesce(head, []), coalesce(body, [])), 1) as r
              from blocks where type = 'table')),
    typed as (select *, {_TYPE_OF} as value_type from cells)"""
_COLUMN = """case when len(list_filter(types, lambda x: x <> 'NULL')) = 0 then 'NULL'
     when len(list_filter(types, lambda x: x <> 'NULL')) > 1 and (list_contains(types, 'STRING') or list_contains(types, 'DATE')) then 'STRING'
     when len(list_filter(types, lambda x: x <> 'NULL')) = 1 then replace(list_filter(types, lambda x: x <> 'NULL')[1], 'BIT', 'BOOL')
     when len(list_filter(types, lambda x: x <> 'NULL')) = 2 and list_contains(types, 'BOOL') and list_contains(types, 'BIT') then 'BOOL'
     when list_contains(types, 'BOOL') then 'STRING' when list_contains(types, 'FLOAT') then 'FLOAT' else 'INT' end"""
_VAR = """case when data_type in ('INT', 'STRING') and uniq < 0.9 then 'CATEGORICAL' when data_type in ('INT', 'FLOAT') then 'NUMERIC'
     when data_type = 'STRING' then 'TEXT' when data_type = 'BOOL' then 'BOOL' when data_type = 'DATE' then 'TIME' else 'NA' end"""
_DONE = "select distinct input from control_entries where step_name = 'collect' and lower(trim(status)) = 'processed' and input is not null"

SQL = {
    "clean_text": f"select doc_id, {_clean('text')} as clean from documents",
    "strip_bullets": f"with {_LINES} select doc_id, seq, regexp_replace(regexp_replace(text, '^[•*o]{_WS}', ''), '[^\\x{{00}}-\\x{{7f}}]', '', 'g') as line from lines",
    "link_strip": "select doc_id, md5(replace(replace(text, '[[', ''), ']]', '')) as digest from documents where text is not null",
    "underscore_name": f"select row_id, lower(regexp_replace(regexp_replace(title, '^{_WS}+|{_WS}+$', '', 'g'), '{_WS}', '_', 'g')) as name from content_records",
    "template_variables": f"select w, count(*) as n from (select unnest(regexp_extract_all(text, '\\{{[A-Za-z_]\\w*(?:\\.\\w+)*\\}}')) as w from documents) group by w",
    "iso_millis": "select row_id, strftime(make_timestamp(cast(floor(start_timestamp_millis / 1000.0) as bigint) * 1000000), '%Y-%m-%dT%H:%M:%S') as start_time from content_records",
    "fix_content": "select doc_id, md5(case when starts_with(text, '<') and not ends_with(text, '>') then '<div>' || text || '</div>' else text end) as digest from documents where text is not null",
    "job_key": "select job_id, replace(write_root_dir, '/', '-') || '.json' as key from control_jobs",
    "doc_type": "select file_no, case lower(regexp_extract(filename, '\\.([^.]+)$', 1)) when 'docx' then 'Word' when 'pdf' then 'PDF' end as kind from office_files",
    "line_questions": f"with {_LINES} select doc_id, count(*) filter (where {_QUESTION}) as n_questions, count(*) as n_lines from lines group by doc_id",
    "block_questions": f"with {_BLOCKS}, b as (select type, {_clean('text')} as text, text is null as no_text from blocks) select type, case when no_text then null when text = '' then false else {_QUESTION} end as is_question, count(*) as n from b group by 1, 2",
    "extract_questions": f"""with {_LINES} select doc_id, coalesce(string_agg(distinct text, chr(10) order by text) filter (where {_QUESTION}), '') as questions,
            coalesce(string_agg(text, chr(10) order by text) filter (where not {_QUESTION}), '') as non_questions from lines group by doc_id""",
    "found_questions": f"with {_LINES} select text from lines where {_QUESTION}",
    "list_markers": f"""with w as (select unnest(string_split({_clean('text')}, ' ')) as w from documents),
        c as (select w, count(*) as n from w group by w),
        f as (select w, n, w in ('•', '*', 'o') as bullet, regexp_matches(w, '^([0-9]\\.?){{1,3}}$') as number,
                     regexp_full_match(lower(w), '(xc|xl|l?x{{0,3}})(ix|iv|v?i{{0,3}})[.)]?') and regexp_matches(lower(w), '^[ivxlc]') as roman from c)
        select * from f where bullet or number or roman""",
    "block_counts": f"with {_BLOCKS} select type, count(*) as n_blocks from blocks group by type",
    "list_items": f"with {_BLOCKS} select field_id, seq, unnest(items) as item, generate_subscripts(items, 1) - 1 as i from blocks where type = 'list'",
    "json_dispatch": "select raw_id, coalesce(json_valid(payload), false) as is_json from raw_records",
    "graph_nodes": f"with {_NODES} select * from nodes",
    "graph_order": f"with {_NODES}, pairs as (select lag(node_id) over (partition by field_id order by seq) as first, node_id as second from nodes) {_BOTH}",
    "graph_headings": f"""with {_NODES}, h as (select node_id, node_type, last_value(case when node_type = 'heading' then node_id end ignore nulls)
            over (partition by field_id order by seq rows between unbounded preceding and 1 preceding) as h from nodes)
        select node_id as node_id1, h as node_id2, 'has_heading' as edge_type from h where node_type <> 'heading' and h is not null""",
    "graph_links": f"""with {_BLOCKS}, m as (
            select field_id, seq, {_ID.format('field_id, seq')} as id, unnest(regexp_extract_all(text, '\\[\\[(.*?)\\]\\]', 1)) as mark from blocks where type in ('text', 'heading')
            union all select field_id, seq, {_ID.format("field_id, seq, 'item', i")}, unnest(regexp_extract_all(x, '\\[\\[(.*?)\\]\\]', 1))
            from (select field_id, seq, unnest(items) as x, generate_subscripts(items, 1) - 1 as i from blocks where type = 'list')),
        j as (select m.field_id, m.id, mark, max(l.seq) as l_seq from m join blocks l on l.type = 'link' and l.field_id = m.field_id and l.text = mark and l.seq < m.seq group by all)
        select id as node_id1, {_ID.format('field_id, l_seq')} as node_id2, 'has_link' as edge_type from j""",
    "graph_lists": f"""with {_BLOCKS}, items as (select field_id, seq, unnest(items) as x, generate_subscripts(items, 1) - 1 as i from blocks where type = 'list'),
        n as (select field_id, seq, i, {_ID.format("field_id, seq, 'item', i")} as node_id, {_ID.format('field_id, seq')} as parent from items),
        pairs as (select lag(node_id) over (partition by field_id, seq order by i) as first, node_id as second from n)
        select node_id as node_id1, parent as node_id2, 'item_of' as edge_type from n union all {_BOTH}""",
    "collect_fields": f"""with {_CONFIG} select f.row_id, c.doc_type, coalesce(array_to_string(flatten(list(coalesce(f.text, []) order by c.ord, f.field_name, f.text)), chr(10)), '') as lines,
            coalesce(array_to_string(flatten(list(list_transform(coalesce(f.structured_content, []), lambda x: coalesce(x.block_type, '?')) order by c.ord, f.field_name, f.text)), ','), '') as kinds
        from record_fields f join content_records r using (row_id) join config c on c.doc_type = r.doc_type and c.prop = f.field_name group by all""",
    "combine_text": f"""with {_BLOCKS}, l as (select b.field_id, b.seq, case when type in ('text', 'heading') then [b.text] when type = 'list' then b.items end as lines
            from blocks b join content_records r using (row_id) where r.doc_type in ({_TYPES})),
        e as (select field_id, seq, unnest(lines) as line, generate_subscripts(lines, 1) - 1 as i from l)
        select field_id, seq, i, line from e where {_clean('line')} <> ''""",
    "doc_type_filter": f"select row_id, doc_type from content_records where doc_type in ({_TYPES})",
    "value_types": f"with {_CELLS} select value, value_type, count(*) as n from typed group by value, value_type",
    "column_types": f"""with v as (unpivot (select {{cols}} from part) on columns(*) into name col value value),
        ty as (select col, value, {_TYPE_OF} as value_type from v),
        a as (select col, list(distinct value_type) as types, count(distinct value) / count(*) as uniq from ty group by col),
        k as (select col, uniq, {_COLUMN} as data_type from a)
        select col, data_type, {_VAR} as var_type from k""",
    "table_schemas": f"""with {_CELLS}, h as (select table_id, max(n_head) as n_head,
            coalesce(bool_and(value_type = 'STRING') filter (where r = 0), false) and count(distinct value_type) filter (where r between 1 and 19) > 1 as header from typed group by table_id),
        n as (select table_id, case when n_head > 0 then n_head else cast(header as bigint) end as n_header_rows from h),
        a as (select table_id, n_header_rows, c, list(distinct value_type) as types,
                (count(distinct value) + max(case when value is null then 1 else 0 end)) / count(*) as uniq
              from typed join n using (table_id) where r >= n_header_rows group by all),
        k as (select *, {_COLUMN} as data_type from a), v as (select *, {_VAR} as var_type from k)
        select table_id, n_header_rows, n_header_rows > 0 as has_header, coalesce(arg_min(var_type, c) = 'TEXT', false) as has_row_labels,
            string_agg(data_type, ',' order by c) as data_types, string_agg(var_type, ',' order by c) as var_types
        from v group by table_id, n_header_rows""",
    "token_entities": """with e(phrase, entity, value) as (values """ + ", ".join(f"('{k}', '{a}', '{b}')" for k, (a, b) in WORDS.items()) + """),
        w as (select doc_id, unnest(regexp_split_to_array(text, '[^\\p{L}\\p{N}_]+')) as token from documents)
        select doc_id, token, count(*) as n, entity, value from w join e on token = phrase group by all""",
    "pattern_entities": f"""with {_LINES}, m as (select doc_id, seq, array_to_string(regexp_extract_all(text, '\\b(?:TK|INC|AFS|CS-)[0-9]+\\b'), '|') as tickets,
            array_to_string(regexp_extract_all(text, '\\$[0-9]+\\.[0-9]{{2}}'), '|') as prices from lines)
        select * from m where tickets <> '' or prices <> ''""",
    "restart_pending": f"with done as ({_DONE}) select distinct file_path as path from content_records where file_path not in (select input from done)",
    "restart_carried": """select input, path, count(*) as n from control_entries where step_name = 'collect' and lower(trim(status)) = 'processed'
        and input in (select file_path from content_records) group by input, path""",
    "fileset_diff": """with a as (select distinct file_path as path from content_records), b as (select distinct input as path from control_entries where step_name = 'extract')
        select path, 'left' as side from (select * from a except select * from b) union all select path, 'right' from (select * from b except select * from a)""",
    "file_status": """with o as (select input, max((entry_at, status)) as m from control_entries where step_name = 'extract' and input is not null group by input),
        f as (select distinct file_path as path from content_records)
        select f.path, coalesce(m[2], 'new') as status from f left join o on f.path = o.input""",
    "control_tables": "select job_id, f.filename as filename, f.input as input, f.path as path, f.status as status from (select job_id, unnest(files_output) as f from control_jobs)",
    "flatten_heads": f"with {_BLOCKS} select field_id, seq, flatten(head) as names from blocks where type = 'table' and head is not null",
    "has_letters": f"select doc_id, len(list_filter(string_split({_clean('text')}, ' '), lambda x: regexp_full_match(x, '\\p{{L}}+'))) > 0 as alpha from documents where text is not null",
    "config_props": f"""with {_CONFIG}, u as (select r.doc_type, f.field_name, count(*) as n from record_fields f join content_records r using (row_id) group by all)
        select c.doc_type, c.prop, c.ord, coalesce(u.n, 0) as n from config c left join u on u.doc_type = c.doc_type and u.field_name = c.prop""",
    "table_cells": f"with {_CELLS} select table_id, r, r < n_head as is_head, c, value from typed",
    "value_words": """select p_partkey, case when p_size is null then 'NA' else cast(p_size as varchar) end as size,
        case when p_partkey * 1000003 < 1e6 then cast(p_partkey * 1000003 as varchar) when p_partkey * 1000003 >= 1e9 then printf('%.1f billion', p_partkey * 1000003 / 1e9) else printf('%.1f million', p_partkey * 1000003 / 1e6) end as key,
        replace(p_name, '_', ' ') as name from part""",
    "column_uniqueness": """with v as (unpivot (select p_name, p_brand, p_type from part) on columns(*) into name col value value)
        select col, round(count(distinct value) / count(*), 6) as uniqueness from v group by col""",
    "date_validity": """select o_orderkey, printf('%04d-%02d-%02d', 1985 + o_orderkey % 50, o_orderkey % 12 + 1, o_orderkey % 28 + 1) as value
        from orders where o_orderkey % 7 <> 0 and 1985 + o_orderkey % 50 between 1990 and 2025""",
    "step_progress": """select job_id, step_name, count(*) filter (where lower(trim(status)) = 'processed') as n_processed,
        count(*) filter (where coalesce(lower(trim(status)) <> 'processed', true)) as n_other from control_entries group by job_id, step_name""",
}
_SCHEMAS = SQL["table_schemas"].removeprefix(f"with {_CELLS}, ")
SQL |= {
    "html_round_trip": f"""with {_BLOCKS}, b as (select field_id, seq, type, {_clean('text')} as t, coalesce(url, '') as url,
            list_filter(list_transform(items, lambda x: {_clean('x')}), lambda x: x <> '') as items from blocks),
        e as (select field_id, seq, 0 as sub, type, t as text, null as url, '' as items from b where type in ('heading', 'text') and t <> ''
              union all select field_id, seq, 0, 'list', null, null, array_to_string(items, '|') from b where type = 'list' and len(items) > 0
              union all select field_id, seq, 0, 'link', t, url, '' from b where type = 'link' and t <> ''
              union all select field_id, seq, 1, 'text', '[[' || t || ']]', null, '' from b where type = 'link' and t <> '')
        select field_id, row_number() over (partition by field_id order by seq, sub) - 1 as seq, type, text, url, case when type = 'list' then items end as items from e""",
    "html_tables": f"""with {_BLOCKS}, r as (select field_id, seq as block, 'head' as part, unnest(head) as row, generate_subscripts(head, 1) as r from blocks where type = 'table'
              union all select field_id, seq, 'body', unnest(body), generate_subscripts(body, 1) from blocks where type = 'table'),
        k as (select *, list_transform(row, lambda x: {_clean('x')}) as cells from r),
        n as (select * from k where len(list_filter(cells, lambda x: x <> '')) > 0),
        good as (select field_id, block from k group by field_id, block having max(len(row)) > 1 and bool_or(part = 'head' and len(list_filter(cells, lambda x: x <> '')) > 0)),
        m as (select field_id, block, part, row_number() over (partition by field_id, block, part order by r) - 1 as r, cells from n join good using (field_id, block))
        select field_id, block, part, r, unnest(cells) as value, generate_subscripts(cells, 1) - 1 as c from m""",
    "xml_records": f"""select row_id, record_id, nullif({_clean('title')}, '') as title, nullif({_clean('doc_type')}, '') as doc_type, nullif({_clean('document_no')}, '') as doc_id,
            nullif({_clean('version_no::varchar')}, '') as version, nullif({_clean('author')}, '') as author, start_timestamp_millis,
            strftime(make_timestamp(cast(floor(start_timestamp_millis / 1000.0) as bigint) * 1000000), '%Y-%m-%dT%H:%M:%S') as start_time, last_modified_timestamp_millis,
            strftime(make_timestamp(cast(floor(published_timestamp_millis / 1000.0) as bigint) * 1000000), '%Y-%m-%dT%H:%M:%S') as published_time,
            nullif({_clean('doc_location_path')}, '') as doc_location_path, case when doc_type is not null and {_clean('file_path')} <> '' then {_clean('file_path')} end as lines,
            cast(doc_type is not null and {_clean('file_path')} <> '' as integer) as n_fields, cast(null as varchar) as error from content_records""",
    "document_files": "select site_id as record_id, site_name, concat_ws('|', time_zone, site_id) as zone from sites",
    "json_lines": "select job_id, status, array_to_string(steps, '|') as steps, message, 2 * count(*) as n from control_jobs group by all",
    "qa_file": f"""with p as (select doc_type as intent, concat_ws('|', site_id, record_id) as entities, 'Is it ' || {_clean('title')} as q1, document_no as a1, record_id as a2
              from content_records where title is not null and document_no is not null and doc_type is not null),
        u as (select intent, entities, q1 as question, a1 as answer from p union all select intent, entities, 'Where', a2 from p)
        select *, '{{"question":' || to_json(question) || ',"answer":[' || to_json(answer) || ']}}' as line from u""",
    "deep_update": f"select event_id, cast(json_merge_patch(coalesce(case when json_valid(props) then props end, '{{}}')::json, '{PATCH}'::json) as varchar) as merged from events",
    "phrase_entities": f"""with {_LINES}, e(phrase, entity, value) as (values """ + ", ".join(str(p) for p in PHRASES) + """),
        hits as (select doc_id, seq, text, phrase, value, list_filter(range(0, length(text)), lambda i: substring(text, i + 1, length(phrase)) = phrase
                   and not regexp_matches(substring(text, i, 1), '[\\p{L}\\p{N}_]') and not regexp_matches(substring(text, i + 1 + length(phrase), 1), '[\\p{L}\\p{N}_]')) as starts
               from lines join e on contains(text, phrase))
        select doc_id, seq, cast(unnest(starts) as integer) as start, phrase, value from hits""",
    "graph_tables": f"""with {_BLOCKS},
        r as (select field_id, seq, 'head' as part, unnest(head) as cells, generate_subscripts(head, 1) - 1 as r from blocks where type = 'table'
              union all select field_id, seq, 'body', unnest(body), generate_subscripts(body, 1) - 1 from blocks where type = 'table'),
        rows as (select *, {_ID.format("field_id, seq, 'row', part, r")} as id, {_ID.format('field_id, seq')} as parent from r),
        c as (select field_id, seq, part, r, id as parent, unnest(cells) as x, generate_subscripts(cells, 1) - 1 as c from rows),
        cells as (select *, {_ID.format("field_id, seq, 'cell', part, r, c")} as id from c),
        pairs as (select lag(id) over (partition by field_id, seq, part order by r) as first, id as second from rows
                  union all select lag(id) over (partition by field_id, seq, part, r order by c), id from cells)
        select id as node_id1, parent as node_id2, part || '_row_of' as edge_type from rows
        union all select id, parent, 'cell_of' from cells union all {_BOTH}""",
    "table_sentences": f"""with {_CELLS}, s as (with {_SCHEMAS}),
        j as (select typed.*, n_header_rows, has_header and has_row_labels as labelled, case when value_type = 'NULL' then 'NA' else value end as words
              from typed join s using (table_id)),
        label as (select table_id, r, max(value) filter (where c = 0) as label from j group by table_id, r),
        name as (select table_id, c, value as name from j where r = n_header_rows - 1)
        select j.table_id, j.r, j.c, 'The ' || replace(name, '_', ' ') || ' of ' || replace(label, '_', ' ') || ' is ' || words || '.' as sentence
        from j join label on label.table_id = j.table_id and label.r = j.r join name on name.table_id = j.table_id and name.c = j.c
        where labelled and j.c > 0 and j.r >= n_header_rows
        union all select table_id, r, 0, string_agg(words, ' ' order by c) from j where not labelled and r >= n_header_rows group by table_id, r""",
}
SQL["prepare_qa"] = f"""with {_BLOCKS}, l as (select {_ID.format('field_id, seq')} as id, case when type = 'text' then text
            when type = 'list' and items is not null then coalesce(heading, '') || '<ul>' || coalesce(array_to_string(list_transform(list_filter(items, lambda x: x is not null), lambda x: '<li>' || x || '</li>'), ''), '') || '</ul>' end as text from blocks)
        select id, text from l where {_clean('text')} <> ''
        union all select {_ID.format('table_id, r, c')}, sentence from ({SQL['table_sentences']}) where {_clean('sentence')} <> ''"""
SQL["column_types"] = SQL["column_types"].replace("{cols}", "p_partkey::varchar as p_partkey, p_name, p_brand, p_type, p_size::varchar as p_size, p_retailprice::varchar as p_retailprice")
