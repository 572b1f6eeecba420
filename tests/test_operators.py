"""General operators on small fixtures, with nulls, blanks, repeats and extra columns."""

import json
import zipfile
from datetime import datetime, timezone

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from docloom.functions import text as t
from docloom.operators import collect, control, delta, entities, graph, nested, questions, tables, timestamps
from docloom.plans.pipeline import Parallel, Pipeline
from docloom.plugins import question_scorer, relation_edges, token_features
from docloom.sinks import writers
from docloom.sources import files
from docloom.streaming import incremental


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_text_functions(spark):
    df = spark.createDataFrame([(" a \x1c b\u3000",), (None,), ("",)], "s string")
    assert [r[0] for r in df.select(t.clean_text("s")).collect()] == ["a b", "", ""]
    q = spark.createDataFrame([("Is it",), ("it is?",), ("it is",), (None,), (" ",)], "s string")
    assert [r[0] for r in q.select(t.is_question("s")).collect()] == [True, True, False, False, False]
    m = spark.createDataFrame([(0,), (-1,), (1589491340717,), (None,)], "m bigint")
    assert [r[0] for r in m.select(t.iso_from_millis("m")).collect()] == [
        "1970-01-01T00:00:00", "1969-12-31T23:59:59", "2020-05-14T21:22:20", None,
    ]
    w = spark.createDataFrame([("iv.",), ("o",), ("1.2.3",), ("x)",), ("",), ("hello",)], "w string")
    assert [tuple(r) for r in w.select(t.is_bullet("w"), t.is_list_number("w"), t.is_roman_numeral("w")).collect()] == [
        (False, False, True), (True, False, False), (False, True, False), (False, False, True), (False, False, False), (False, False, False),
    ]
    d = spark.createDataFrame([('{"a": {"x": "1", "d": {"l": [1], "k": 1}}, "b": "2"}', '{"a": {"y": "3", "d": {"l": [2], "n": {}}}, "b": [4]}'), (None, '{"a": 1}'), ('{"a": 1}', "no json"), (None, None)],
                              "a string, b string")
    got = [r[0] and json.loads(r[0]) for r in d.select(t.deep_merge("a", "b")).collect()]
    assert got == [{"a": {"x": "1", "d": {"l": [2], "k": 1, "n": {}}, "y": "3"}, "b": [4]}, {"a": 1}, {"a": 1}, None]
    assert json.loads(d.select(t.deep_merge("a", "b", append_to_lists=True)).first()[0])["a"]["d"]["l"] == [1, 2]


@given(st.text(max_size=60))
@settings(max_examples=60, deadline=None)
def test_clean_text_is_idempotent_in_python(s):
    once = " ".join(s.split())
    assert " ".join(once.split()) == once


def test_questions(spark):
    docs = spark.createDataFrame([(1, "Is it?\nIs it?\nno\n\nno", "x"), (2, None, "y"), (3, " ", None)], "doc_id int, text string, seq string")
    lines = questions.line_blocks(docs)
    got = questions.extract_questions(lines).collect()
    assert [(r.doc_id, r.questions, r.non_questions) for r in got] == [(1, ["Is it?"], ["no", "no"])]
    assert questions.found_questions(lines).count() == 2
    assert question_scorer(F.lit("is it")) is not None


def block_df(spark):
    return spark.createDataFrame(
        [
            (1, 0, "link", "more", "u", None, None, None), (1, 1, "image", None, "i", None, None, None),
            (1, 2, "heading", "H", None, None, None, None), (1, 3, "text", "see [[more]] and [[none]]", None, None, None, None),
            (1, 4, "list", None, None, ["a", None, "b"], None, None), (1, 5, "table", None, None, None, [["h"]], [["1", "2"]]),
            (2, 0, "text", "alone", None, None, None, None),
        ],
        "doc_id int, seq int, type string, text string, url string, items array<string>, head array<array<string>>, body array<array<string>>",
    )


def test_graph(spark):
    nodes, edges = graph.content_graph(block_df(spark))
    kinds = dict(rows(edges.groupBy("edge_type").count()))
    assert kinds == {
        "after": 4 + 2 + 1, "before": 4 + 2 + 1, "has_heading": 3, "has_link": 1, "item_of": 3, "head_row_of": 1, "body_row_of": 1, "cell_of": 3,
    }
    ids = [r.node_id for r in nodes.collect()]
    assert len(ids) == len(set(ids)) == 6 + 3 + 2 + 3
    more = block_df(spark).withColumn("items", F.when(F.col("type") == "list", F.array(F.lit("see [[more]] or [[more]]"), F.lit("[[H]]"))))
    linked = {r.node_id1 for r in graph.link_edges(more).collect()}
    assert linked == {r.node_id for r in graph.content_graph(more)[0].where("node_type = 'list_item' and seq_index = 0 or node_text like 'see [[more]] and%'").collect()}
    both = {tuple(r)[:2] for r in edges.where("edge_type = 'before'").collect()}
    assert both == {tuple(r)[1::-1] for r in edges.where("edge_type = 'after'").collect()}
    assert graph.content_graph(block_df(spark).limit(0))[1].count() == 0


def test_collect_and_combine(spark):
    fields = spark.createDataFrame(
        [(1, "T", "b", ["2"], None), (1, "T", "a", ["1"], None), (1, "T", "z", ["no"], None), (2, "U", "a", ["x"], None), (3, "T", "a", None, None)],
        "row_id int, doc_type string, field_name string, text array<string>, structured_content array<struct<block_type: string>>",
    )
    config = spark.createDataFrame([("T", "a", 0), ("T", "b", 1)], "doc_type string, prop string, ord int")
    assert [(r.row_id, r.text) for r in collect.collect_fields(fields, config).orderBy("row_id").collect()] == [(1, ["1", "2"]), (3, [])]
    b = block_df(spark).withColumn("doc_type", F.lit("T")).withColumn("heading", F.lit("Head"))
    types = spark.createDataFrame([("T",), ("T",)], "doc_type string")
    assert [r.line for r in collect.combine_text(b, types, "doc_id").orderBy("doc_id", "seq", "i").collect()] == [
        "H", "see [[more]] and [[none]]", "a", "b", "alone",
    ]
    qa = [r.text for r in collect.prepare_qa(b, "doc_id").collect()]
    assert "Head<ul><li>a</li><li>b</li></ul>" in qa and "1 2" in qa and len(qa) == 4
    assert [r.line for r in collect.combine_text(b, types.limit(0), "doc_id").collect()] == [] and collect.of_types(b, types).count() == b.count()


def test_tables(spark):
    values = ["hello", "42", "0.42", "12/12/2018", "2019-01-01 12:30:00", "true", "y", "", None, "1", "1_000", "nan", "1d", "-"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    assert [r[0] for r in df.select(tables.value_type("v")).collect()] == [
        "STRING", "INT", "FLOAT", "DATE", "DATE", "BOOL", "BOOL", "NULL", "NULL", "BIT", "INT", "STRING", "STRING", "NULL",
    ]
    tb = spark.createDataFrame(
        [
            ("t", None, [["Region", "Sales", "Date"], ["East", "12", "12/12/2018"], ["West", "9", "13/12/2018"], ["North", "7", "14/12/2018"]]),
            ("u", None, [["a", "b"], ["c", "d"]]), ("e", None, None),
        ],
        "table_id string, head array<array<string>>, body array<array<string>>",
    )
    got = {r.table_id: r for r in tables.table_schema(tb).collect()}
    assert got["t"].has_header and got["t"].data_types == ["STRING", "INT", "DATE"] and not got["u"].has_header and "e" not in got
    s = {r.sentence for r in tables.table_sentences(tb, reference="2019-01-10").collect()}
    assert "Dec 12, the Sales of East is 12." in s and "a b" in s
    odd = spark.createDataFrame(
        [("n", None, [None, [], ["a"]], 1), ("m", [["H", "I"], None], [["x y z", "1", "2"], ["w", None]], 2), ("o", [[]], [], 3), ("d", [["N", "When"]], [["one", "1/2/2019"], ["two", None]], 4)],
        "table_id string, head array<array<string>>, body array<array<string>>, r int",
    )
    assert {r.table_id: (r.n_header_rows, r.data_types) for r in tables.table_schema(odd).collect()} == {
        "n": (0, ["STRING"]), "m": (1, ["STRING", "BOOL", "INT"]), "d": (1, ["STRING", "DATE"])}
    assert rows(tables.table_sentences(odd, reference="2019-02-01")) == [
        ("d", 2, 1, "The When of two is NA."), ("m", 2, 1, "The I of x y z is 1."), ("m", 3, 1, "The I of w is NA."), ("n", 2, 0, "a")]
    long = spark.createDataFrame([("l", [["N", "V"]], [["k" * 5000, "v" * 5000]])], "table_id string, head array<array<string>>, body array<array<string>>")
    assert [len(r.sentence) for r in tables.table_sentences(long).collect()] == [10_014]
    w = spark.createDataFrame([("1234567",), ("0.5",), ("yes",), ("",)], "v string")
    assert [r[0] for r in w.select(tables.value_text("v")).collect()] == ["1.2 million", "0.50", "true", "NA"]
    u = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "value string").withColumn("value_type", tables.value_type("value"))
    assert u.select(tables.is_fuzzy_date(F.col("value"))).count() == 4
    assert tables.column_types(u).first().uniqueness == 0.75


def test_entities(spark):
    lines = spark.createDataFrame([(1, "Call New York on 12 May 2020 or 5 May 1890, ref A12"), (2, None), (3, "")], "doc_id int, text string")
    e = entities.line_entities(lines, dictionary={"New York": ("city", "NYC"), "York": ("city", "York")}, patterns=[("ref", "ref", r"A(\d)(x)?")])
    first = e.orderBy("doc_id").first().entities
    found = {(x.entity, x.value, x.start, x.end) for x in first}
    assert ("city", "NYC", 5, 13) in found and ("sys-date", "2020-05-12", 17, 28) in found
    assert not any(x.entity == "sys-date" and x.value.startswith("1890") for x in first)
    assert [tuple(g) for x in first if x.entity == "ref" for g in x.groups] == [(1, 49, 50), (2, -1, -1)]
    assert all(not r.entities for r in e.where("doc_id > 1").collect())
    r = spark.createDataFrame(
        [(["a", "b", "c"], [([0, 1], [2], "P1", "is"), ([0], [1], "P0", "none")])],
        "tokens array<string>, edgeSet array<struct<left: array<int>, right: array<int>, kbID: string, lexicalInput: string>>",
    )
    assert r.select(entities.relation_triples("tokens", "edgeSet")).first()[0] == [["a b", "is", "c"]]
    dictionary = spark.createDataFrame([("York", "city", "York")], "phrase string, entity string, value string")
    assert rows(entities.token_matches(lines, dictionary)) == [(1, "York", 1, "city", "York")]
    assert len(lines.select(token_features(F.col("text"))).collect()) == 3


def test_persons_and_relations(spark):
    lines = spark.createDataFrame([(1, "Dr. Ada Vint works for Prof J. Kalder in York. Mr. went home"), (2, None), (3, "Herr Ößt met Sgt. Grestal. Then Ms Lo")], "doc_id int, text string")
    e = entities.line_entities(lines, dictionary={"York": ("city", "York")}, system=False, persons=True)
    found = {r.doc_id: [(x.entity, x.value) for x in sorted(r.entities, key=lambda x: x.start)] for r in e.collect()}
    assert found[1] == [("sys-person", "Ada Vint"), ("sys-person", "J. Kalder"), ("city", "York")] and found[2] == []
    assert found[3] == [("sys-person", "Ößt"), ("sys-person", "Grestal"), ("sys-person", "Lo")]
    r = e.select("doc_id", relation_edges(F.col("text"), F.col("entities")).alias("r")).select("doc_id", entities.relation_triples("r.tokens", "r.edgeSet").alias("t"))
    assert {x.doc_id: [tuple(y) for y in x.t] for x in r.collect()} == {
        1: [("Ada Vint", "works for Prof", "J . Kalder"), ("J . Kalder", "in", "York")], 2: [], 3: []}

    def load():
        return lambda texts: [[{"entity": "sys-person", "start": 0, "end": 1, "value": x[:1], "confidence": 0.5, "groups": None}] if x else [] for x in texts]

    model = entities.line_entities(lines, system=False, persons=load)
    assert {r.doc_id: [x.value for x in r.entities] for r in model.collect()} == {1: ["D"], 2: [], 3: ["H"]}


def test_phrases_by_join_equal_the_trie(spark, monkeypatch):
    texts = ["New York is not York, New York City is", "york New  York", "a-b c.d New York-New", None, "", "x" * 5000 + " York"]
    lines = spark.createDataFrame([(i, x, "m") for i, x in enumerate(texts)] * 2, "doc_id int, text string, mentions string")
    dictionary = {"New York": ("city", "NYC"), "York": ("city", "York"), "New York City": ("city", "NYC"), "c.d": ("code", "cd"), "b": ("code", "b")}
    entries = spark.createDataFrame([(p, *v) for p, v in dictionary.items()], "phrase string, entity string, value string")
    plain = lines.select("doc_id", entities.match_dictionary(F.col("text"), dictionary).alias("m"))
    spans = lambda df: sorted((r.doc_id, [(m.start, m.end, m.value) for m in r.m or []]) for r in df.collect())
    joined = entities.phrase_matches(lines, entries).select("doc_id", F.col("mentions").alias("m"))
    assert spans(joined) == spans(plain)
    by_trie = rows(entities.line_entities(lines, dictionary=dictionary).select("doc_id", F.col("entities").cast("string")))
    monkeypatch.setattr(entities, "MAX_ENTRIES", 2)
    assert rows(entities.line_entities(lines, dictionary=dictionary).select("doc_id", F.col("entities").cast("string"))) == by_trie
    assert entities.phrase_matches(lines.limit(0), entries).count() == 0


span = st.tuples(st.integers(0, 12), st.integers(0, 12)).map(lambda p: (min(p), max(p) + 1))


def test_pruning_keeps_only_uncontained(spark):
    @given(st.lists(span, max_size=6))
    @settings(max_examples=8, deadline=None)
    def check(spans):
        mention = [{"entity": "e", "start": a, "end": b, "value": "", "confidence": 1.0, "groups": None} for a, b in spans]
        df = spark.createDataFrame([(mention,)], f"m array<{entities.ENTITY}>")
        got = sorted((x.start, x.end) for x in df.select(entities.prune_contained("m")).first()[0])
        inside = lambda a, b: b[0] <= a[0] and a[1] <= b[1] and a != b
        assert got == sorted(a for a in spans if not any(inside(a, b) for b in spans))

    check()


def test_control(spark):
    inputs = spark.createDataFrame([("a", "new", None), ("b", "new", None), ("c", "new", None)], "path string, status string, time timestamp")
    now = datetime(2020, 1, 1)
    out = spark.createDataFrame(
        [("a", " Processed", now), ("a", "processed", now), ("b", "error", now), (None, "processed", now)], "input string, status string, time timestamp"
    )
    assert rows(control.pending_inputs(inputs, out).select("path")) == [("b",), ("c",)]
    assert control.carried_outputs(inputs, out).count() == 2
    a, b = inputs.select("path"), spark.createDataFrame([("c",), ("d",)], "path string")
    diff = rows(control.fileset_difference(a, b))
    assert diff == [("a", "left"), ("b", "left"), ("d", "right")]
    assert [(p, s) for p, s in rows(control.fileset_difference(b, a))] == [("a", "right"), ("b", "right"), ("d", "left")]
    assert {r.path: r.status for r in control.file_status(inputs, out).collect()} == {"a": "processed", "b": "error", "c": "new"}


def test_progress_makes_a_restart_skip(spark, tmp_path):
    inputs = spark.createDataFrame([("a",), ("b",)], "path string")
    done = control.output_entries(spark.createDataFrame([("a", "/out/x/a.json")], "input string, path string"), "extract")
    control.append_entries(done, str(tmp_path / "steps"))
    control.append_entries(done.limit(0), str(tmp_path / "steps"))
    table = spark.read.parquet(str(tmp_path / "steps")).where("step = 'extract'")
    assert rows(control.pending_inputs(inputs, table)) == [("b",)] and table.first().filename == "a.json"


def test_list_helpers(spark):
    df = spark.createDataFrame([("You need:",), ("Cables.",), ("USB stick;",), (None,), ("",)], "s string")
    assert [tuple(r) for r in df.select(t.list_intro("s"), t.normal_list_item("s")).collect()] == [
        ("You need", "you need"), (None, "cables"), (None, "USB stick"), (None, ""), (None, ""),
    ]
    long = "Long " + "x" * 2_000_000
    assert spark.createDataFrame([(long,)], "s string").select(t.normal_list_item("s")).first()[0] == "l" + long[1:]


def test_pipeline_order_errors_and_log(spark):
    seen = []
    p = Pipeline().add_step("one", lambda d: d.withColumn("x", F.lit(1))).add_step("two", lambda d: d.withColumn("y", F.col("x") + 1))
    out = p.run(spark.range(2), sink=lambda n, d: seen.append(n))
    assert seen == ["one", "two"] and out["two"].columns == ["id", "x", "y"] and [e["status"] for e in p.log] == ["processed"] * 2
    plan = Pipeline().add_step("one", lambda d: d)
    plan.run(spark.range(2))
    assert plan.log[0]["status"] == "planned"  # nothing ran
    assert Pipeline().run(spark.range(1)) == {}
    bad = Pipeline(on_error="record").add_step("bad", lambda d: d.select("none"))
    bad.run(spark.range(1))
    assert bad.log[0]["status"] == "error"

    def stop(_):
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        Pipeline(on_error="record").add_step("x", stop).run(spark.range(1))


def test_pipeline_restarts_where_it_stopped(spark, tmp_path):
    source = lambda *names: spark.createDataFrame([(n, f"text {n}") for n in names], "path string, text string")
    done = []

    def first(df):
        done.append(("first", sorted(r.path for r in df.collect())))
        return df.withColumn("n", F.length("text"))

    def second(df):
        done.append(("second", sorted(r.path for r in df.collect())))
        if fail:
            raise RuntimeError("stop here")
        return df.withColumn("m", F.col("n") + 1)

    make = lambda: Pipeline(root=f"file://{tmp_path}/work").add_steps(("first", first), ("second", second))
    fail = True
    with pytest.raises(RuntimeError):
        make().run(source("a", "b"))
    fail = False
    out = make().run(source("a", "b", "c"))
    assert done == [("first", ["a", "b"]), ("second", ["a", "b"]), ("first", ["c"]), ("second", ["a", "b", "c"])]
    assert rows(out["second"].select("path", "m")) == [("a", 7), ("b", 7), ("c", 7)]
    make().run(source("a", "b", "c"))
    assert done[-2:] == [("first", []), ("second", [])]
    p = make()
    jobs, entries = p.jobs(spark), p.entries(spark)
    assert [j["status"] for j in jobs] == ["error", "processed", "processed"] and "stop here" in jobs[0]["message"] and jobs[1]["steps"] == ["first", "second"]
    assert rows(entries.groupBy("step", "input").count()) == [(s, i, 1) for s in ("first", "second") for i in "abc"]
    # an output whose entries are missing is not read, its inputs are done again
    source("z").withColumn("n", F.lit(0)).write.parquet(f"file://{tmp_path}/work/first/run=orphan")
    assert make().run(source("a", "b", "c"))["first"].count() == 3


def test_parallel_steps(spark, tmp_path):
    add = lambda c: lambda d: d.withColumn(c, F.lit(1))
    group = Parallel().add_step("a", add("a")).add_step("a2", add("a2")).add_step("b", add("b"), "parent").add_step("b2", add("b2"), "b")
    for root in (None, f"file://{tmp_path}/par"):
        out = Pipeline(root=root).add_step("start", add("s")).add_step("both", group).add_step("end", add("e")).run(spark.createDataFrame([("x",)], "path string"))
        assert {k: sorted(v.columns) for k, v in out.items()} == {
            "start": ["path", "s"], "a": ["a", "path", "s"], "a2": ["a", "a2", "path", "s"], "b": ["b", "path", "s"], "b2": ["b", "b2", "path", "s"],
            "both": ["b", "b2", "path", "s"], "end": ["b", "b2", "e", "path", "s"]}
    bad = Pipeline(on_error="record").add_step("both", Parallel().add_step("x", lambda d: d.select("none")))
    bad.run(spark.range(1))
    assert bad.log[0]["status"] == "error"


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "in" / "sub").mkdir(parents=True)
    xml = """<CONTENT RECORDID="r1"><MASTERIDENTIFIER>T</MASTERIDENTIFIER><TYPE>HELP</TYPE><VERSION>1.0</VERSION>
      <STARTTIMESTAMP_MILLIS>1589491340717</STARTTIMESTAMP_MILLIS><HELP><GUID>g</GUID>
      <STEP_TITLE><![CDATA[<h1>My Heading</h1><p>First line</p>]]></STEP_TITLE></HELP></CONTENT>"""
    (tmp_path / "in" / "a.xml").write_text(xml)
    (tmp_path / "in" / "sub" / "b.xml").write_text("<broken")
    (tmp_path / "in" / "~c.xml").write_text("x")
    found = files.list_files(spark, str(tmp_path / "in"))
    assert found.count() == 2 and [r.filename for r in files.list_files(spark, str(tmp_path / "in"), limit=1).collect()] == ["a.xml"]
    assert files.list_files(spark, str(tmp_path / "in"), limit=0).count() == 0
    assert files.list_files(spark, str(tmp_path / "in"), hidden=True).count() == 3
    odd = tmp_path / "odd [1]{x}*"
    odd.mkdir()
    (odd / "q?.txt").write_text("x")
    assert [r.filename for r in files.list_files(spark, str(tmp_path / "odd*"), limit=5).collect()] == ["q?.txt"]
    rec = {r.path[-5:]: r for r in files.xml_records(found).collect()}
    assert rec["a.xml"].record_id == "r1" and rec["a.xml"].doc_type == "HELP" and list(rec["a.xml"].data) == ["step_title"]
    assert rec["a.xml"].start_time == "2020-05-14T21:22:20" and rec["b.xml"].error
    whole = {r.path[-5:]: r.data for r in files.xml_documents(found).collect()}
    step = whole["a.xml"]["step_title"]
    assert step.text == ["My Heading", "First line"] and [(b.seq, b.type, b.text) for b in step.structured_content] == [(0, "heading", "My Heading"), (1, "text", "First line")]
    assert whole["b.xml"] == {}
    deep = "<CONTENT RECORDID='d'><TYPE>T</TYPE><T>" + "<X>" * 3000 + "end" + "</X>" * 3000 + '<J>{"a": [1]}</J></T></CONTENT>'
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "d.xml").write_text(deep)
    got = files.xml_documents(files.list_files(spark, str(tmp_path / "deep"))).first()
    assert got.data["x"].text == ["end"] and got.data["j"].structured_content[0].json == '{"a": [1]}' and got.data["j"].text == []
    word = tmp_path / "in" / "My doc.docx"
    ns = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    with zipfile.ZipFile(word, "w") as z:
        z.writestr("word/document.xml", f'<w:document {ns}><w:body><w:p><w:pPr><w:pStyle w:val="Heading1"/></w:pPr><w:r><w:t>Head</w:t></w:r></w:p>'
                   "<w:p><w:r><w:t>a &amp; b</w:t></w:r></w:p></w:body></w:document>")
    (tmp_path / "in" / "x.pdf").write_bytes(b"%PDF")
    office = {r.doc_type: r for r in files.office_documents(files.list_files(spark, str(tmp_path / "in")).where("filename rlike 'docx|pdf'"), now="n").collect()}
    assert office["Word"].xhtml == "<body><h1>Head</h1><p>a &amp; b</p></body>" and office["Word"].record_id == "My_doc" and office["PDF"].error
    conf, types = files.doc_type_config(spark, "doc_types_with_text: [A]\ndoc_types:\n  A:\n    text_props: [x, y]\n")
    assert rows(conf) == [("A", "x", 0), ("A", "y", 1)] and rows(types) == [("A",)]
    phrases, patterns = files.entity_dictionary([["c", "v", "s1, s2"], ["r", "w", "/a+/, /b/"], ["short"], ["d", "__sys", "x"], ["e", "only"]])
    assert phrases == {"v": ("c", "v"), "s1": ("c", "v"), "s2": ("c", "v"), "only": ("e", "only")} and patterns == [("r", "w", "a+"), ("r", "w", "b")]
    (tmp_path / "qa.txt").write_text("Configure\tN1, N2\tq1\ta1\tq2\ta2\todd\nEmpty\tN\n")
    qa = files.qa_pairs(spark, str(tmp_path / "qa.txt"))
    assert rows(qa.select("question", "answer")) == [("q1", "a1"), ("q2", "a2")] and qa.first().entities == ["N1", "N2"]
    assert writers.qa_json_lines(qa).count() == 2
    docs = spark.createDataFrame([("r1", {"f": {"text": ["one"]}})], "record_id string, data map<string, struct<text: array<string>>>")
    written = writers.write_document_files(docs, str(tmp_path / "out"), "extract").collect()
    assert json.loads(open(written[0].path).read())["data"]["f"]["text"] == "one"
    again = docs.unionByName(spark.createDataFrame([("a/b", None), (None, {})], docs.schema))
    written = writers.write_document_files(again, f"file://{tmp_path}/out", "extract")
    assert written.count() == 3 and sorted(x.name for x in (tmp_path / "out" / "extract").iterdir()) == ["extract_.json", "extract_a_b.json", "extract_r1.json"]
    writers.write_text_lines(spark.createDataFrame([("x",)], "text string"), str(tmp_path / "t"))
    writers.write_json_lines(qa, str(tmp_path / "j"))
    nodes, edges = graph.content_graph(block_df(spark))
    writers.write_graph(nodes, edges, str(tmp_path / "g"), "csv")
    assert spark.read.option("header", "true").csv(str(tmp_path / "g" / "edges")).count() == edges.count()
    writers.write_graph_import(nodes, edges, f"file://{tmp_path}/i")
    assert (tmp_path / "i" / "edges_header.csv").read_text() == ":START_ID,:END_ID,:TYPE\n"
    assert spark.read.csv(str(tmp_path / "i" / "nodes")).count() == nodes.count() and len(spark.read.csv(str(tmp_path / "i" / "edges")).columns) == 3
    assert writers.delete_sources(found) == 0 and found.count() == 2
    assert writers.delete_sources(found.unionByName(found), confirmed=True) == 2 and not (tmp_path / "in" / "a.xml").exists()
    assert (tmp_path / "in" / "~c.xml").exists() and writers.delete_sources(spark.createDataFrame([("/no/such/file",), (None,)], "path string"), confirmed=True) == 0


def test_graph_is_written_in_one_transaction_a_document(spark, tmp_path):
    import functools
    import sqlite3

    place = str(tmp_path / "graph.db")
    with sqlite3.connect(place) as db:
        for statement in writers.GRAPH_TABLES:
            db.execute(statement)
    nodes, edges = graph.content_graph(block_df(spark))
    connect = functools.partial(sqlite3.connect, place, timeout=60)
    for _ in range(2):  # a second run replaces the first
        writers.write_graph_transactions(nodes, edges, connect)
    with sqlite3.connect(place) as db:
        assert sorted(r[0] for r in db.execute("select node_id from content_node")) == sorted(r.node_id for r in nodes.collect())
        assert sorted(db.execute("select node_id1, node_id2, edge_type from content_edge")) == rows(edges)
        assert db.execute("select count(distinct doc) from content_node").fetchone() == (2,)


def test_stream_of_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    run = lambda: incremental.run_available(
        incremental.file_stream(spark, str(tmp_path / "in")), lambda d: d.select("filename"), str(tmp_path / "out"), str(tmp_path / "ck")
    )
    (tmp_path / "in" / "a.txt").write_text("1")
    run()
    (tmp_path / "in" / "b.txt").write_text("2")
    run()
    assert rows(spark.read.parquet(str(tmp_path / "out")).select("filename")) == [("a.txt",), ("b.txt",)]


# --- nested records ---------------------------------------------------------------------


def brute_parts(payload):
    """Plain recursive reading of one payload."""
    def opened(v):
        while isinstance(v, str):
            try:
                w = json.loads(v)
            except ValueError:
                return v
            if not isinstance(w, (dict, list, str)):
                return v
            v = w
        return v

    out = set()

    def members(name, path, part, pos, x):
        out.add((name, path, part, pos))
        x = opened(x)
        for i, y in enumerate(x.get("items") or [] if isinstance(x, dict) else []):
            members(name, path, part, f"{pos}.{i}", y)

    def block(name, path, b):
        for i, x in enumerate(b.get("items") or []):
            members(name, path, "item", str(i), x)
        head = b.get("head") or []
        if head and not any(isinstance(r, list) for r in head):
            head = [head]
        for part, rs in (("head", head), ("body", b.get("body") or [])):
            for r, row in enumerate(rs):
                for c, x in enumerate(row or []):
                    members(name, path, part, f"{r}.{c}", x)
        for i, x in enumerate(opened(b.get("structured_content")) or []):
            block(name, f"{path}.{i}", x)

    doc = opened(payload)
    data = doc["data"]
    for name, f in data.items() if isinstance(data, dict) else [(f["name"], f) for f in data]:
        sc = opened(f.get("structured_content"))
        for i, b in enumerate(sc if isinstance(sc, list) else [sc] if sc else []):
            block(name, str(i), b)
    return out


PAYLOADS = [
    {"data": {"f": {"structured_content": [{"type": "list", "items": ["a", None, {"text": "x", "items": [1, {"items": [True]}]}]}]}}},
    {"data": [{"name": "g", "structured_content": {"type": "table", "head": ["p", "q"], "body": [None, ["1", {"items": ["z"]}], []]}}]},
    {"data": {"h": {"structured_content": json.dumps([{"type": "section", "structured_content": [{"type": "table", "head": [["a"]], "body": [[""]]}]}])}}},
    {"data": {"n": {"text": []}, "m": {"structured_content": None}}},
]


def test_nested_against_plain_reading(spark):
    data = [(i, json.dumps(p), "x") for i, p in enumerate(PAYLOADS)] + [(9, json.dumps(json.dumps(PAYLOADS[0])), None), (10, None, None), (11, '{"data": {', ""), (12, "[1", ""), (13, '{"a": NaN}', "")]
    raw = spark.createDataFrame(data, "raw_id bigint, payload string, node string")
    t_ = nested.written_tables(raw)
    got = {}
    for r in nested.parts(t_).collect():
        got.setdefault(r.raw_id, set()).add((r.field_name, r.block_path, r.part_name, r.pos))
    for i, p in enumerate(PAYLOADS):
        assert got.get(i, set()) == brute_parts(p)
    assert got[9] == got[0] and not set(got) & {10, 11, 12, 13}
    every = [(r.raw_id, r.node, r.parent) for n in t_.values() for r in n.collect()]
    nodes = {x[:2] for x in every}
    assert len(nodes) == len(every) == nested.flatten_records(raw).count()  # each node in one table
    assert all(p is None or (i, p) in nodes for i, _, p in every)  # no orphans
    assert nested.flatten_records(raw.limit(0)).count() == 0


def variants(*blocks):
    return [r["variant"] for r in nested.document_rows(1, json.dumps({"data": {"f": {"structured_content": list(blocks)}}})) if r.get("part_name") is None]


def test_states_follow_from_the_members_states():
    items = {"list_empty": [], "list_scalars": ["a", None, 1], "list_objects": [{"text": "x"}], "list_nested": [{"items": ["y"]}], "list_mixed": ["a", {"text": "x"}]}
    for want, value in items.items():
        assert variants({"type": "list", "items": value}) == ["field_flat", want]
    assert variants({"type": "table"}, {"head": ["a"]}, {"head": ["a"], "body": [["b"]]}, {"body": [[{"items": [1]}]]}) == [
        "field_flat", "table_empty", "table_head_only", "table_scalars", "table_objects"]
    inner = {"structured_content": [{"text": "t"}]}
    assert variants(inner) == ["field_sectioned", "section_flat", "leaf_text"]
    assert variants({"structured_content": [inner, {"url": "u"}]}) == ["field_sectioned", "section_deep", "section_flat", "leaf_text", "leaf_link"]
    deep = nested.document_rows(1, json.dumps({"data": {"f": {"structured_content": [{"items": [{"items": [{"items": []}, 1]}]}]}}}))
    assert [r["variant"] for r in deep] == ["field_flat", "list_nested", "part_nested", "part_object", "part_scalar"]
    a = nested.Automaton()
    a.run(deep)
    n = len(a.table)
    a.run(deep)
    assert len(a.table) == n  # each transition is worked out once
    assert variants() == ["field_empty"] and set(nested.COLUMNS) == set(nested.TABLES)


def test_no_depth_is_too_deep(spark):
    import sys

    n = 20_000
    assert n > sys.getrecursionlimit()
    ignored = '{"x": ' + "[" * n + "]" * n + ', "data": {"f": {"text": ' + '{"a":' * n + "1" + "}" * n + ', "structured_content": [{"items": ["a", ' + "[" * n + "]" * n + "]}]}}}"
    sections = '{"data": {"f": {"structured_content": ' + '[{"structured_content": ' * 3000 + '[{"items": ["deep"]}]' + "}]" * 3000 + "}}}"
    items = '{"data": {"f": {"structured_content": [{"items": [' + '{"items": [' * 3000 + '"deep"' + "]}" * 3000 + "]}]}}}"
    broken = "[" * n + "]" * (n - 1)
    raw = spark.createDataFrame(list(enumerate([ignored, sections, items, broken])), "raw_id bigint, payload string")
    got = {}
    for r in nested.parts(nested.subtype_tables(nested.flatten_records(raw))).collect():
        got.setdefault(r.raw_id, []).append(r)
    assert [r.text for r in got[0]] == ["a", "[" * n + "]" * n]
    assert [(r.block_path, r.pos) for r in got[1]] == [(".".join(["0"] * 3001), "0")]
    assert len(got[2]) == 3001 and max(got[2], key=lambda r: len(r.pos)).pos == ".".join(["0"] * 3001) and 3 not in got
    text = next(r["text"] for r in nested.document_rows(0, ignored) if r["symbol"] == "field")
    assert text == '{"a": ' * n + "1" + "}" * n


json_values = st.recursive(st.none() | st.booleans() | st.integers() | st.floats(allow_nan=False, allow_infinity=False) | st.text(max_size=5),
                           lambda x: st.lists(x, max_size=3) | st.dictionaries(st.text(max_size=3), x, max_size=3), max_leaves=8)


@given(json_values, st.sampled_from([None, 0, 2]))
@settings(max_examples=150, deadline=None)
def test_deep_parser_against_the_usual_one(value, indent):
    text = json.dumps(value, indent=indent)
    assert nested._parse_deep(text) == value == json.loads(text)
    for bad in (text + "x", text[:-1] + ",", "[" + text, f'{{"a" {text}}}', f"[{text},]"):
        try:
            want = json.loads(bad)
        except ValueError:
            with pytest.raises(ValueError):
                nested._parse_deep(bad)
        else:
            assert nested._parse_deep(bad) == want


# --- delta --------------------------------------------------------------------------------


def test_pending_records(spark):
    rec = spark.createDataFrame([(1, "a", "/d/a", 5), (2, "a", "/d/a", 9), (3, "b", "/d/b", 5), (4, "b", "/d/b", 5), (5, "c", "/d/c", 5), (6, "e", None, 1), (6, "e", None, 1),
                                 (7, "f", "/d/f", None), (8, "g", "/d/a", 5), (9, "h", " ", 3)],
                                "row_id bigint, record_id string, file_path string, last_modified_timestamp_millis bigint").withColumn("version", F.lit("x"))
    ctl = spark.createDataFrame(
        [("extract", "processed", "file:///d//a", 5), ("extract", " PROCESSED ", "/d/./b ", 5), ("extract", "error", "/d/b", 9),
         ("collect", "processed", "/d/c", 9), ("extract", "processed", "/d/c", None), ("extract", None, "/d/c", 7), ("extract", "processed", None, 9)],
        "step_name string, status string, input string, seen_modified_millis bigint",
    )
    want = [("a", 9), ("c", 5), ("e", 1), ("f", None), ("h", 3)]
    got = delta.pending_records(rec, ctl)
    assert sorted((r.record_id, r.last_modified_timestamp_millis) for r in got.collect()) == want
    assert delta.pending_records(rec, ctl.limit(0)).count() == 7 and delta.pending_records(rec.limit(0), ctl).count() == 0
    assert sorted(tuple(r) for r in delta.commit_pending(rec, ctl).collect()) == want


def test_pending_records_against_a_plain_reading(spark):
    import random

    rng = random.Random(4)
    rec = [(i, f"r{rng.randint(0, 60)}", f"/p{rng.randint(0, 9)}", rng.randint(0, 20)) for i in range(900)]
    ctl = [("extract", rng.choice(["processed", "error"]), f"/p{rng.randint(0, 9)}", rng.randint(0, 22)) for _ in range(12)]
    newest = {}
    for i, r, p, m in rec:
        newest[r] = max(newest.get(r, (-1,)), (m, p, i))
    want = sorted((r, m) for r, (m, p, _) in newest.items() if not any(s == "processed" and q == p and v >= m for _, s, q, v in ctl))
    got = delta.pending_records(spark.createDataFrame(rec, "row_id bigint, record_id string, file_path string, last_modified_timestamp_millis bigint"),
                                spark.createDataFrame(ctl, "step_name string, status string, input string, seen_modified_millis bigint"))
    assert sorted(tuple(r) for r in got.collect()) == want and want


def test_record_delta(spark):
    at = "path string, pos bigint"
    old = spark.createDataFrame([("x", 1), ("gone", 1), ("same", 1), ("grown", 1)], "path string, version bigint")
    new = spark.createDataFrame([("x", 1), ("add", 1), ("same", 1), ("grown", 2)], "path string, version bigint")
    data = spark.createDataFrame([(p, i, 1) for p in ("x", "gone", "add", "same", "other") for i in range(2)] + [("grown", 0, 1), ("grown", 1, 2)], f"{at}, version bigint")
    delta_rows = delta.record_delta(data, old, new, spark.createDataFrame([("x", 1), ("x", 1), ("gone", 1), ("same", 0)], at), spark.createDataFrame([("x", 0), ("add", 0), ("same", 0)], at))
    assert rows(delta_rows.drop("version")) == [("add", 1, "insert"), ("gone", 0, "delete"), ("grown", 1, "insert"), ("x", 0, "delete"), ("x", 1, "insert")]


def test_crashes_around_the_commit(spark, tmp_path):
    def table(*r):
        return spark.createDataFrame(r, "row_id bigint, record_id string, file_path string, last_modified_timestamp_millis bigint")

    def control(log):
        """What the log's commits have covered, as control entries."""
        done = log.read()
        seen = [] if done is None else [("extract", "processed", f"/{r.record_id}", r.last_modified_timestamp_millis) for r in done.collect()]
        return spark.createDataFrame(seen, "step_name string, status string, input string, seen_modified_millis bigint")

    root = f"file://{tmp_path}/log"
    log = delta.CommitLog(spark, root)
    assert log.processed_version() is None and log.read() is None and log.vacuum(0) == 0
    first = table((1, "a", "/a", 5), (2, "b", "/b", 5))
    pending = delta.pending_records(first, control(log))
    log.write(pending, 0)  # the run dies before its commit
    assert log.read() is None and rows(delta.pending_records(first, control(log))) == [("a", 5), ("b", 5)]
    log.publish(pending, 5)  # the run dies right after its commit
    log = delta.CommitLog(spark, root)
    assert log.processed_version() == 5 and delta.pending_records(first, control(log)).count() == 0
    second = first.unionByName(table((3, "b", "/b", 7), (4, "c", "/c", 6)))
    pending = delta.pending_records(second, control(log))
    assert rows(pending) == [("b", 7), ("c", 6)]
    mine, other = log.write(pending, 1), log.write(pending, 1)
    log.claim(other, 1, 7)
    with pytest.raises(RuntimeError):  # two runs claim one number
        log.claim(mine, 1, 7)
    assert log.processed_version() == 7 and sorted(rows(log.read())) == [("a", 5), ("b", 5), ("b", 7), ("c", 6)]
    assert log.vacuum() == 0 and log.vacuum(0) == 2 and log.read().count() == 4


# --- timestamps ---------------------------------------------------------------------------

CASES = [
    ("2020-05-14T21:22:19.931000695Z", "UTC", datetime(2020, 5, 14, 21, 22, 19, 931000)),
    ("2018-03-11T02:15:10.077", "America/New_York", datetime(2018, 3, 11, 7, 15, 10, 77000)),
    ("05-Nov-2023 01:11:39", "America/New_York", datetime(2023, 11, 5, 5, 11, 39)),
    ("6/4/2014 2:41 AM", "Australia/Sydney", datetime(2014, 4, 5, 15, 41)),
    ("1/25/2024 10:30 PM", "America/Denver", datetime(2024, 1, 26, 5, 30)),
    ("Oct 24, 2017 5:54:37 PM AEDT", "Australia/Sydney", datetime(2017, 10, 24, 6, 54, 37)),
    ("Apr 25, 2020 4:59:34 AM IST", "Asia/Kolkata", datetime(2020, 4, 24, 23, 29, 34)),
    ("2018-07-23T10:59:13[Australia/Sydney]", "UTC", datetime(2018, 7, 23, 0, 59, 13)),
    ("2017-06-08 06:36:04 America/New_York", "Asia/Tokyo", datetime(2017, 6, 8, 10, 36, 4)),
    ("D:20211218185136+11'00'", "UTC", datetime(2021, 12, 18, 7, 51, 36)),
    ("/Date(1574218037000+0530)/", "UTC", datetime(2019, 11, 20, 2, 47, 17)),
    ("\t1567448089855\n", "UTC", datetime(2019, 9, 2, 18, 14, 49, 855000)),
    ("20180529015909", "Europe/Lisbon", datetime(2018, 5, 29, 0, 59, 9)),
    ("2020年2月22日 14時57分", "Asia/Tokyo", datetime(2020, 2, 22, 5, 57)),
    ("7. März 2019, 10:45 Uhr", "Europe/Berlin", datetime(2019, 3, 7, 9, 45)),
    ("Thu, 19 Mar 2020 04:57:40 +0100", "UTC", datetime(2020, 3, 19, 3, 57, 40)),
    ("December 4, 2017, 12:08 a.m.", "UTC", datetime(2017, 12, 4, 0, 8)),
    ("2017-07-13", "Australia/Sydney", datetime(2017, 7, 12, 14)),
    *[(v, "UTC", None) for v in ("", "now", "Q3 2019", "-1", "2020-02-30", "31/02/2018 10:00", "0000-00-00 00:00:00", "12:45", None, "13:00 PM")],
    ("2018-05-13T18:18:03", None, None), ("2018-05-13T18:18:03", "No/Zone", None),
]


def test_instants(spark):
    df = spark.createDataFrame([(i, v, z, "x") for i, (v, z, _) in enumerate(CASES)], "i int, v string, z string, p string")
    got = {r.i: r.utc_micros for r in timestamps.to_utc(df, "v", "z").collect()}
    for i, (v, z, want) in enumerate(CASES):
        micros = None if want is None else round(want.replace(tzinfo=timezone.utc).timestamp() * 1_000_000)
        assert got[i] == micros, (v, z)
    assert timestamps.to_utc(df.limit(0), "v", "z").count() == 0


def test_offset_intervals_against_zoneinfo():
    from zoneinfo import ZoneInfo

    for name in ("Europe/Berlin", "Australia/Lord_Howe", "Asia/Kathmandu"):
        intervals = timestamps.zone_intervals(name)
        for s in range(0, 1_800_000_000, 7_777_777):
            off = next(o for a, b, o, _ in intervals if a <= s < b)
            assert off == datetime.fromtimestamp(s, ZoneInfo(name)).utcoffset().total_seconds()
