"""Sources: files, XML records, office documents, configuration.

Defined cases: hidden files (``.`` and ``~``) are left out; an element that
occurs twice in a record keeps its last text; unreadable office files give null
text and an error message; a dictionary row without pattern or synonyms stands
for its value alone.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Callable, Iterator
from html import escape
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from docloom.functions.text import doc_type_of_file, iso_from_millis
from docloom.html.blocks import parsed_value
from docloom.schema import PARSED
from docloom.sources.pdf import pdf_to_xhtml


def _files(spark: SparkSession, paths) -> DataFrame:
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    return df.select(name.alias("filename"), "path", F.col("modificationTime").alias("time"), "length", "content")


def list_files(spark: SparkSession, path: str, hidden: bool = False, limit: int | None = None) -> DataFrame:
    """filename, path, time, length, content of all files below ``path``.

    ``limit`` gives exactly that many files, in path order: the paths are sorted
    without reading any content, then only the chosen files are read.
    """
    df = _files(spark, path)
    if not hidden:
        df = df.where(~F.col("filename").rlike(r"^[~.]"))
    if limit is None:
        return df
    chosen = [re.sub(r"([\\\[\]{}*?])", r"\\\1", r.path) for r in df.select("path").orderBy("path").limit(limit).collect()]
    return _files(spark, chosen) if chosen else df.limit(0)


# --- XML records ------------------------------------------------------------------------

MILLIS = {
    "STARTTIMESTAMP_MILLIS": "start", "ENDTIMESTAMP_MILLIS": "end", "CREATETIMESTAMP_MILLIS": "create",
    "LASTMODIFIEDTIMESTAMP_MILLIS": "last_modified", "PUBLISHEDTIMESTAMP_MILLIS": "published",
}
METADATA = {
    "MASTERIDENTIFIER": "title", "MASTERIDENTIFER": "title", "TYPE": "doc_type", "DOCUMENTID": "doc_id", "VERSION": "version",
    "AUTHOR": "author", "RESOURCEPATH": "doc_location_path",
}
_XML = "record_id string, error string, meta map<string,string>, data map<string,string>"


def _xml_record(content: bytes, excluded: frozenset[str]):
    try:
        root = ElementTree.fromstring(content)
    except ElementTree.ParseError as e:
        return None, str(e)[:200], {}, {}
    meta, data = {}, {}
    doc_type = next((t.text.strip() for t in root.iter("TYPE") if t.text and t.text.strip()), None)
    todo = [(root, False, False)]
    while todo:  # in the order in which elements end
        e, inside, leaving = todo.pop()
        if not leaving:
            todo.append((e, inside, True))
            now = inside or (doc_type is not None and e.tag == doc_type)
            todo.extend((c, now, False) for c in reversed(e))
            continue
        text = (e.text or "").strip()
        if e.tag in excluded or not text:
            continue
        if e.tag in METADATA or e.tag in MILLIS:
            meta[METADATA.get(e.tag) or MILLIS[e.tag]] = " ".join(text.split())
        elif inside:
            data[e.tag.lower()] = e.text
    return root.get("RECORDID"), None, meta, data


def xml_records(files: DataFrame, excluded_tags: tuple[str, ...] = ("GUID",)) -> DataFrame:
    """One row per XML file: record_id, metadata columns, data map of raw field texts."""
    excluded = frozenset(excluded_tags)

    def run(contents: pd.Series) -> pd.DataFrame:
        rows = [_xml_record(bytes(c) if c is not None else b"", excluded) for c in contents]
        return pd.DataFrame(rows, columns=["record_id", "error", "meta", "data"])

    parsed = files.select("path", F.pandas_udf(run, _XML)("content").alias("x"))
    meta = lambda k: F.try_element_at(F.col("x.meta"), F.lit(k))
    cols = [meta(v).alias(v) for v in dict.fromkeys(METADATA.values())]
    for v in MILLIS.values():
        ms = meta(v).try_cast("bigint")
        cols += [ms.alias(f"{v}_timestamp_millis"), iso_from_millis(ms).alias("published_time" if v == "published" else f"{v}_time")]
    return parsed.select("path", F.col("x.record_id").alias("record_id"), *cols, F.col("x.data").alias("data"), F.col("x.error").alias("error"))


def xml_documents(files: DataFrame, excluded_tags: tuple[str, ...] = ("GUID",), **options) -> DataFrame:
    """As ``xml_records``, with each field as its text lines and typed blocks: the whole
    document. A field that holds JSON becomes one json block. ``options`` as of ``html_blocks``.
    """
    parsed = xml_records(files, excluded_tags)
    one = f"struct<{PARSED.replace('text array', 'text: array', 1).replace('structured_content array', 'structured_content: array', 1)}>"

    @F.pandas_udf(f"map<string, {one}>")
    def run(data: pd.Series) -> pd.Series:
        def of(fields):
            return {k: dict(zip(("text", "structured_content"), parsed_value(v, **options))) for k, v in dict(fields if fields is not None else {}).items()}

        return data.map(of)

    return parsed.withColumn("data", run("data"))


# --- office documents ---------------------------------------------------------------------

_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def docx_to_xhtml(content: bytes) -> tuple[str, dict[str, str]]:
    """XHTML and metadata of a Word file, by the standard library."""
    z = zipfile.ZipFile(io.BytesIO(content))
    body = ElementTree.fromstring(z.read("word/document.xml")).find(f"{_W}body")
    meta = {}
    if "docProps/core.xml" in z.namelist():
        for e in ElementTree.fromstring(z.read("docProps/core.xml")):
            if e.text:
                meta[e.tag.rpartition("}")[2]] = e.text

    def para(p) -> str:
        text = "".join(
            "<br/>" if t.tag == f"{_W}br" else "\t" if t.tag == f"{_W}tab" else escape(t.text or "")
            for t in p.iter() if t.tag in (f"{_W}t", f"{_W}br", f"{_W}tab")
        )
        style = p.find(f"{_W}pPr/{_W}pStyle")
        level = re.match(r"(?i)heading ?(\d)$", style.get(f"{_W}val", "")) if style is not None else None
        if level:
            return f"<h{level.group(1)}>{text}</h{level.group(1)}>"
        if p.find(f"{_W}pPr/{_W}numPr") is not None:
            return f"<li>{text}</li>"
        return f"<p>{text}</p>"

    def table(t) -> str:
        rows = ("".join(f"<td>{''.join(para(p) for p in c.iter(f'{_W}p'))}</td>" for c in r.findall(f"{_W}tc")) for r in t.findall(f"{_W}tr"))
        return f"<table>{''.join(f'<tr>{r}</tr>' for r in rows)}</table>"

    out = "".join(para(e) if e.tag == f"{_W}p" else table(e) if e.tag == f"{_W}tbl" else "" for e in body)
    return f"<body>{re.sub(r'((?:<li>.*?</li>)+)', r'<ul>\\1</ul>', out)}</body>", meta


Parser = Callable[[bytes], tuple[str, dict[str, str]]]


def office_documents(files: DataFrame, parsers: dict[str, Parser] | None = None, now: str | None = None) -> DataFrame:
    """path, doc_type, record_id, author, word_count, dates and xhtml of office files.

    ``parsers`` by lower-case extension; ``docx`` and ``pdf`` (see ``sources.pdf`` for
    what it reads) are built in and may be replaced. Missing dates are ``now``
    (default: current time).
    """
    table: dict[str, Parser] = {"docx": docx_to_xhtml, "pdf": pdf_to_xhtml, **(parsers or {})}

    def run(names: pd.Series, contents: pd.Series) -> pd.DataFrame:
        rows = []
        for name, content in zip(names, contents):
            p = table.get(name.rpartition(".")[2].lower())
            try:
                xhtml, meta = p(bytes(content)) if p else (None, {})
                rows.append((xhtml, meta, None if p else "no parser for this kind of file"))
            except Exception as e:  # noqa: BLE001 - a broken file must not stop the others
                rows.append((None, {}, str(e)[:200]))
        return pd.DataFrame(rows, columns=["xhtml", "meta", "error"])

    x = F.pandas_udf(run, "xhtml string, meta map<string,string>, error string")("filename", "content")
    parsed = files.select("filename", "path", x.alias("x"))
    meta = lambda k: F.try_element_at(F.col("x.meta"), F.lit(k))
    when = F.lit(now) if now else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")
    base = F.regexp_replace(F.regexp_extract("filename", r"^(.*?)(?:\.[^.]*)?$", 1), " ", "_")
    return parsed.select(
        "path", doc_type_of_file("filename").alias("doc_type"), F.coalesce(meta("title"), base).alias("record_id"),
        F.coalesce(meta("created"), when).alias("created_date"), F.coalesce(meta("modified"), when).alias("last_mod_date"),
        F.coalesce(meta("creator"), F.lit("")).alias("author"), F.coalesce(meta("word_count").try_cast("bigint"), F.lit(-1)).alias("word_count"),
        F.col("x.xhtml").alias("xhtml"), F.col("x.error").alias("error"),
    )


# --- configuration ------------------------------------------------------------------------


def doc_type_config(spark: SparkSession, text: str) -> tuple[DataFrame, DataFrame]:
    """(doc_type, prop, ord) and (doc_type) of a YAML configuration."""
    import yaml

    conf = yaml.safe_load(text) or {}
    props = [(t, p, i) for t, v in (conf.get("doc_types") or {}).items() for i, p in enumerate((v or {}).get("text_props") or [])]
    types = [(t,) for t in conf.get("doc_types_with_text") or []]
    return spark.createDataFrame(props, "doc_type string, prop string, ord int"), spark.createDataFrame(types, "doc_type string")


def entity_dictionary(lines: Iterator[list[str]]) -> tuple[dict[str, tuple[str, str]], list[tuple[str, str, str]]]:
    """Synonyms (phrase → entity, value) and patterns of rows name, value, synonyms or /regex/."""
    phrases, patterns = {}, []
    for row in lines:
        cells = [c.strip() for c in row]
        if len(cells) < 2 or cells[1] == "__sys":
            continue
        name, value, third = cells[0], cells[1], cells[2] if len(cells) > 2 else ""
        if third.startswith("/"):
            patterns += [(name, value, p) for p in re.split(r"/\s*,\s*/", third.strip("/")) if p]
        else:
            phrases |= {s: (name, value) for s in [value, *(x.strip() for x in third.split(","))] if s}
    return phrases, patterns


def qa_pairs(spark: SparkSession, path: str) -> DataFrame:
    """intent, entities, question, answer of a tab-separated file; an odd last cell is dropped."""
    cells = F.split("value", "\t")
    rows = spark.read.text(path).where("value <> ''").select(cells.alias("c"))
    n = F.floor((F.size("c") - 2) / 2).cast("int")
    pairs = F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(F.get("c", 2 + 2 * i).alias("question"), F.get("c", 3 + 2 * i).alias("answer"))))
    return rows.select(
        F.get("c", F.lit(0)).alias("intent"),
        F.transform(F.split(F.coalesce(F.get("c", F.lit(1)), F.lit("")), ","), lambda x: F.trim(x)).alias("entities"), F.explode(pairs).alias("p"),
    ).select("intent", "entities", "p.*")


def json_documents(spark: SparkSession, path: str, schema: str = "metadata map<string,string>, data map<string,string>") -> DataFrame:
    """Documents written by an earlier run, one JSON object per file."""
    return spark.read.schema(schema).option("multiLine", "true").json(path)
