"""HTML fragments into blocks: the documented expectations, one fragment each."""

import pytest

from docloom.html.blocks import html_blocks, parse_fragment, parse_value
from docloom.html.segment import classify, continues, maybe_heading, split_sentences
from docloom.html.tree import parse_html
from pyspark.sql import functions as F


def types(blocks):
    return [b["type"] for b in blocks]


@pytest.mark.parametrize("html", [
    "<h1>My Heading</h1>", "<h1>My <span>Head</span>ing</h1>", "<h1>My<br> Heading</h1>",
    "<div>Start <h1>My <span>Head</span>ing</h1> End</div>", "<p>First</p><h2>My Heading</h2><div>Last</div>",
])
def test_headings(html):
    lines, blocks = parse_fragment(html, extractors=["heading"])
    assert lines == ["My Heading"] and blocks == [{"type": "heading", "text": "My Heading"}]


def test_heading_in_list_is_left_to_the_list():
    assert parse_fragment("<ul><h2>H</h2><li>One</li></ul>", extractors=["heading"]) == ([], [])


def test_anchor_gives_link_then_marker():
    lines, blocks = parse_fragment('<h1>My <a href="u">Heading</a> text</h1>')
    assert lines == ["My Heading text"]
    assert blocks == [
        {"type": "link", "url": "u", "text": "Heading"}, {"type": "heading", "text": "My [[Heading]] text"},
    ]


def test_texts_around_blocks():
    html = "Preceding line<div>First <span>line</span><p>My <a href='#'>text</a> line</p>Last line</div>Trailing line"
    lines, blocks = parse_fragment(html, extractors=["text"])
    assert lines == ["Preceding line", "First line", "My text line", "Last line", "Trailing line"]
    assert types(blocks) == ["text", "text", "link", "text", "text", "text"]


def test_line_break_splits_text_and_image_is_marked():
    lines, blocks = parse_fragment("<p>My<br> text</p>")
    assert lines == ["My", "text"]
    _, blocks = parse_fragment('<p>See <img src="a.png" alt="A"> here</p>')
    assert blocks == [{"type": "image", "url": "a.png", "title": "A"}, {"type": "text", "text": "See {image:a.png} here"}]


def test_list_heading_items_and_texts_between():
    html = "<ul><h2>Head</h2><p>Second<br> line</p>Third<li>One <a href='#'>x</a></li><li>Two</li></ul>"
    lines, blocks = parse_fragment(html, extractors=["list"])
    assert lines == ["Head", "Second", "line", "Third", "One x", "Two"]
    assert blocks[1] == {"type": "list", "subtype": "unordered", "items": ["One [[x]]", "Two"], "heading": "Head Second line Third"}
    _, blocks = parse_fragment("<ul><li>One</li>between<li>Two</li><h2>end</h2></ul>", extractors=["list"])
    assert types(blocks) == ["text", "text", "list"] and "heading" not in blocks[2]


def test_list_corner_cases():
    assert parse_fragment("<ul></ul>", extractors=["list"]) == ([], [])
    assert parse_fragment("<ul><h2>H</h2></ul>", extractors=["list"])[1] == [
        {"type": "list", "subtype": "unordered", "items": [], "heading": "H"}
    ]
    nested = parse_fragment("<ol><li>A<ul><li>B</li></ul></li><li>C</li></ol>", extractors=["list"])[1]
    assert nested[0]["items"] == ["A", "B", "C"]


def test_tables():
    html = "<table><tr><th>A</th><th>B</th></tr><tr><td>1</td><td>x</td></tr><tr><td></td><td></td></tr></table>"
    lines, blocks = parse_fragment(html, extractors=["table"])
    assert lines == [r"A\tB", r"1\tx"]
    assert blocks[0]["head"] == [["A", "B"]] and blocks[0]["body"] == [["1", "x"]]
    assert [f["type"] for f in blocks[0]["fields"]] == ["integer", "string"]
    two = "<table><thead><tr><td>A</td><td>B</td></tr><tr><td>a</td><td>b</td></tr></thead><tbody><tr><th>x</th><td>1</td></tr></tbody></table>"
    assert parse_fragment(two, extractors=["table"])[1][0]["head"] == [["A", "B"], ["a", "b"]]


def test_nested_and_layout_tables():
    html = "<table><tr><td><table><tr><td>1</td><td>2</td></tr></table></td><td>y</td></tr></table>"
    _, blocks = parse_fragment(html, extractors=["table"])
    assert [b["table_index"] for b in blocks] == [1, 2] and blocks[1]["references"] == ["{table:1}"]
    _, blocks = parse_fragment("<table><tr><td><h1>T</h1><p>text</p></td></tr></table>")
    assert types(blocks) == ["heading", "text"]


def test_combined_order_and_repair():
    html = "<h1>T</h1><p>one<ul><li>a<li>b</ul><script>x()</script><table><tr><td>1<td>2</table>"
    assert types(parse_fragment(html)[1]) == ["heading", "text", "list", "table"]
    assert [e.tag for e in parse_html("<p><b>x</p></i>y").iter()] == ["#document", "p", "b"]


def test_json_value_and_blank_input():
    assert parse_value("12") == ([], [{"type": "json", "json": "12"}])
    assert parse_value("<p>x</p>")[1][0]["type"] == "text"
    assert parse_fragment(None) == ([], []) and parse_fragment("  ") == ([], [])


def test_segmentation():
    assert split_sentences("One thing. Is it? Yes!") == ["One thing.", "Is it?", "Yes!"]
    assert maybe_heading("") and maybe_heading("Terms of Use") and not maybe_heading("this is not one")
    assert continues("and so,", "it goes on") and not continues("It ends.", "next")
    blocks = classify("Overview\n1. First thing\n2. Second thing")
    assert blocks == [{"type": "list", "subtype": "ordered", "items": ["First thing", "Second thing"], "heading": "Overview"}]


def test_column(spark):
    df = spark.createDataFrame([(1, "<h1>A</h1><p>b</p>", "x"), (2, None, "y"), (3, "", None)], "id int, html string, text string")
    rows = df.select("id", html_blocks(F.col("html")).alias("p")).orderBy("id").collect()
    assert [[b.type for b in r.p.structured_content] for r in rows] == [["heading", "text"], [], []]
