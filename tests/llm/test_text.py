"""Text operators against brute force, exact round trips and held-out labels."""

import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from docloom.llm import encode, leakage, markup, moderation, sentences, split


# --- markup -----------------------------------------------------------------------------

KINDS = [
    ("<p>Hi</p>", {"html"}), ("fish &amp; chips", {"html"}), ("x <!-- y --> z", {"html"}), ("a<br/>b", {"html"}),
    ("# Head\n\ntext", {"markdown"}), ("a **b** c", {"markdown"}), ("```\ncode\n```", {"markdown"}), ("see [x](https://a.b/c)", {"markdown"}),
    ("a __b__ c", {"markdown"}), ("Head\n=====\n", {"markdown"}), ("| a | b |\n|---|---|\n| 1 | 2 |", {"markdown"}), ("> quoted", {"markdown"}),
    ("== Head ==\n# one\n# two", {"wiki"}), ("''x'' and '''y'''", {"wiki"}), ("[[Help:Start|x]]", {"wiki"}), ("{{main|x}}", {"wiki"}), ("__NOTOC__", {"wiki"}),
    ("[https://a.b/c x]", {"wiki"}), ("{|\n|-\n| a\n|}", {"wiki"}),
    (r"\section{A} \textbf{b}", {"latex"}), (r"$x_{max} \le 3$", {"latex"}), (r"{\it x} y", {"latex"}), (r"\[ a^2 \]", {"latex"}),
    (r"<p>$\frac{a}{b} \le 1$</p>", {"html", "latex"}), ("== H ==\n<br />", {"wiki", "html"}),
    *[(t, set()) for t in (
        None, "", "  ", "- a\n* b\n1) c", "It costs $5 or $7, R&D and P&L agree.", "3 < 5 and 9 > 2 * 4", r"C:\temp\new\setup.ini",
        "/opt/x/~tmp/", "retry_count_max NX_40_b", "Type <account-no> and <serial number>.", r"Plan\tFee\t$5.00", "[[Overview]] {image:a/b.png}",
        "Ticket # 4412 was * not * closed.", "if (a < b && c > d) { x(); }", "^_^ <3", "a[0] and b[1]", "--force or -f", '{"unit": 4}', "x == y",
    )],
]


@pytest.mark.parametrize("text,kinds", KINDS)
def test_kinds_of_markup(text, kinds):
    assert markup.kinds_of(text) == kinds


def test_small_traces_of_markup():
    assert markup.kinds_of("_" + "long words " * 30 + "end_") == {"markdown"}
    assert markup.kinds_of("text\n|}") == {"wiki"} and markup.kinds_of("text\n~~~") == {"markdown"}


def test_clean_keeps_structure():
    def blocks(t):
        return markup.clean(t)[1]

    assert blocks("<h1>A</h1><ul><li>x <b>y</b></li></ul><pre><code>a &lt; b\nc</code></pre><table><tr><th>P</th><th>F</th></tr></table>") == [
        ("heading", "A"), ("item", "x y"), ("code", "a < b\nc"), ("row", "P\tF"),
    ]
    assert blocks("## H\n\na **b** `c`\n\n```\nx = 1\n```\n\n| a | b |\n|---|---|\n| 1 | 2 |") == [
        ("heading", "H"), ("text", "a b c"), ("code", "x = 1"), ("row", "a\tb"), ("row", "1\t2"),
    ]
    assert blocks("== H ==\n* '''a''' [[P|b]]\n{{formula|x2}}") == [("heading", "H"), ("item", "a b"), ("text", "x2")]
    assert blocks("\\section{H}\n\\begin{itemize}\n\\item a \\emph{b}\n\\end{itemize}\n$x_{1} \\le 2$") == [
        ("heading", "H"), ("item", "a b"), ("formula", "$x_{1} \\le 2$"),
    ]


def test_site_templates_are_removed(spark):
    footer = "<div>Imprint and contact of the site</div>"
    docs = [(i, f"<body><p>Page number {i} tells this</p>{footer}</body>", "S1") for i in range(40)]
    docs += [(100 + i, f"<p>Other {i}</p>{footer}", "S2") for i in range(3)] + [(200, None, "S1"), (201, "plain", None), (202, "", "S1")]
    d = spark.createDataFrame([(*x, 1) for x in docs], "doc_id bigint, text string, site_id string, kinds int")
    f = spark.createDataFrame(
        [(1, ["a <b>c</b>", None], [("text", "''w''", None, None, None, None, ["x", None], [["$5"], None], None)]), (2, None, None), (3, [], [])],
        "field_id bigint, text array<string>, structured_content array<struct<block_type: string, text: string, url: string, title: string, "
        "subtype: string, heading: string, items: array<string>, head: array<array<string>>, body: array<array<string>>>>",
    )
    out = {(r.tab, r.item_id): r for r in markup.clean_items(markup.text_items(d, f)).collect()}
    assert len(out) == len(docs) + 3
    assert out["documents", 5].clean_text == "Page number 5 tells this" and out["documents", 5].n_template == 1
    assert "Imprint" in out["documents", 100].clean_text and out["documents", 201].clean_text == "plain"
    found = sorted(tuple(r) for r in markup.found_kinds(markup.clean_items(markup.text_items(d.limit(0), f))).collect())
    assert found == [("record_fields", 1, "html"), ("record_fields", 1, "wiki")]


@pytest.mark.parametrize("n", [12, 60, 300])
def test_repeated_content_is_no_template(spark, n):
    table = "<table><tr><th>Plan</th><th>Fee</th></tr><tr><td>Everyday Max</td><td>{i}.50</td></tr></table>"
    page = "<body><h2>Plans and fees of the season</h2><div><h3>How to return the device to us</h3></div><p>Ask the desk for a new contract.</p>" + table
    page += "<ul><li>Bring the signed form along</li><li>Case {i}</li></ul><div>$x_{{max}} \\le 30 + y_{{min}} - z_{{all}}$</div><pre>restart the unit --now --all</pre>"
    page += "<footer>Imprint and contact of the site</footer></body>"
    docs = [(i, page.format(i=i), "S1") for i in range(n)]
    docs += [(1000 + i, "<div>One notice, delivered again and again.</div><p>Its end.</p>", "S2") for i in range(n)]
    docs += [(2000 + i, "<div>Only a notice that says just this.</div>", "S3") for i in range(n)]
    d = spark.createDataFrame(docs, "doc_id bigint, text string, site_id string")
    f = spark.createDataFrame([], "field_id bigint, text array<string>, structured_content array<struct<block_type: string, text: string, url: string, title: string, "
                                  "subtype: string, heading: string, items: array<string>, head: array<array<string>>, body: array<array<string>>>>")
    for r in markup.clean_items(markup.text_items(d, f)).collect():
        i = r.item_id
        want = ["Plans and fees of the season", "How to return the device to us", "Ask the desk for a new contract.", "Plan\tFee", f"Everyday Max\t{i}.50",
                "Bring the signed form along", f"Case {i}", "$x_{max} \\le 30 + y_{min} - z_{all}$", "restart the unit --now --all"]
        if i >= 1000:
            want = ["One notice, delivered again and again.", "Its end."] if i < 2000 else ["Only a notice that says just this."]
        assert r.clean_text.split("\n") == want and r.n_template == (i < 1000)


FIELDS = ("field_id bigint, text array<string>, structured_content array<struct<block_type: string, text: string, url: string, title: string, "
          "subtype: string, heading: string, items: array<string>, head: array<array<string>>, body: array<array<string>>>>")


def test_menus_and_footers_go_and_rows_follow_what_is_left(spark):
    menu = "<div class='m'><ul><li><a href='/a'>Start of the site</a></li><li><a href='/b'>Help and **contact** pages</a></li></ul></div>"
    page = "<html><body>{menu}<header>Welcome to the ''help'' of the site</header><div><h1>Case {i}</h1><p>The text of case {i} says it all.</p></div>{foot}</body></html>"
    foot = "<footer>Imprint, privacy, {{{{terms}}}} and $x_{{1}}^2$ of use</footer>".format()
    docs = [(i, page.format(menu=menu, i=i, foot=foot), "S1") for i in range(60)]
    docs += [(100 + i, f"<body><p>Plain page {i} without them.</p></body>", "S1") for i in range(20)]
    docs += [(200, f"<body><p>{'A long text stands before it. ' * 20}</p>{menu}</body>", "S1")]  # on the other side of the page
    d = spark.createDataFrame(docs, "doc_id bigint, text string, site_id string")
    items = markup.text_items(d, spark.createDataFrame([], FIELDS))
    templates = markup.site_templates(items).collect()
    assert [(r.t_site, len(r.template)) for r in templates] == [("S1", 4)]  # the list within the menu too
    for r in markup.clean_items(items).collect():
        if r.item_id < 60:
            assert r.clean_text.split("\n") == [f"Case {r.item_id}", f"The text of case {r.item_id} says it all."] and r.n_template == 3
        assert r.n_template == (3 if r.item_id < 60 else 0)
        # the kinds within the template went with it
        assert r.kinds == (["html"] if r.item_id != 200 else ["html", "markdown"])


def test_hostile_pages(spark):
    n = 5_000
    deep = "<div>" * n + "deep text" + "</div>" * n
    pages = [deep, "<table><tr><td>" + "<b>" * n + "cell" + "</b>" * n + "</td></tr></table>", "<p>" * n + "x", "<pre>" + "<i>" * n + "c", "</div>" * n + "<p>y</p>",
             "<li>" * n, "\\[ a " * n, "\\( a " * n, "<b>" * n + "</i>" * n + "<p>z</p>", "<ul>" * n + "<li>q", "<!--" * n]
    d = spark.createDataFrame([(i, t, "S1") for i, t in enumerate(pages)], "doc_id bigint, text string, site_id string")
    out = {r.item_id: r for r in markup.clean_items(markup.text_items(d, spark.createDataFrame([], FIELDS))).collect()}
    assert out[0].clean_text == "deep text" and out[1].clean_text == "cell" and out[4].clean_text == "y" and len(out) == len(pages)


# --- sentences --------------------------------------------------------------------------

SENTENCES = [
    ["Ms. Vint (acct. no. 85) pays $97.50 a month, incl. tax.", "It ends at 5 p.m.", "Next."],
    ["He said \"Go now. It takes 4 min. at most.\" and left.", "“It is back.”", "“Is it on?” asked J. Kalder and waited."],
    ["Die Fa. Ostrem GmbH & Co. KG liefert u. a. den Hub.", "Am 5. Mai kam Dr. Vint, z. B. wegen Lärm.", "„Geht es?“, fragte Hr. Vint und ging."],
    ["« Est-ce réglé ? » demanda M. Vint.", "Voir l'art. 9 et la fig. 6.", "Quelle surprise !", "Oui."],
    ["¿Se puede?", "¡Otra vez!", "El Sr. Kalder paga 3,50 €, p. ej. por Max."],
    ["It blinked... and then went dark.", "Wait ... it is back!", "See Sec. 6.8 and Fig. 7."],
    ["(The desk may call.)", "Ring N.H. Vint at ext. 5.", "It was sent from the U.K.", "Does it?"],
]


@pytest.mark.parametrize("parts", SENTENCES)
@pytest.mark.parametrize("gap", [" ", "  ", "\n", "\n \n", "\r\n"])
def test_sentences(parts, gap):
    text = gap.join(parts)
    assert [text[a:b] for a, b in sentences.sentence_spans(text)] == parts


@pytest.mark.parametrize("parts", [
    ["“好了吗？”客服问道。", "等等……电池又灭了！", "他写道：“谢谢！再见。”并关闭了工单。"],
    ["え…まだ消えているのですか？", "担当者は「電源を切ってください。」と伝えた。", "版2.19.9で解消した（詳細は別紙）。"],
])
def test_sentences_without_blanks(parts):
    text = "".join(parts)
    assert [text[a:b] for a, b in sentences.sentence_spans(text)] == parts


def test_sentences_of_other_scripts():
    def cut(t):
        return [t[a:b] for a, b in sentences.sentence_spans(t)]

    assert cut("“क्या यह ठीक है?” ग्राहक ने पूछा। डॉ. Vint ने रु. 12 दिए।") == ["“क्या यह ठीक है?” ग्राहक ने पूछा।", "डॉ. Vint ने रु. 12 दिए।"]
    assert cut("سأل العميل: «هل تعمل؟» ثم انتظر. دفع د. Vint مبلغ 3.5 دينار.") == ["سأل العميل: «هل تعمل؟» ثم انتظر.", "دفع د. Vint مبلغ 3.5 دينار."]
    assert cut("ลูกค้าแจ้ง กรุณารอ รุ่น Velox 9 เร็ว") == ["ลูกค้าแจ้ง", "กรุณารอ", "รุ่น Velox 9 เร็ว"]
    assert cut(None) == cut("") == cut(" \n\n ") == [] and cut("Heading\n\nText") == ["Heading", "Text"]


@given(st.text(alphabet="ab.!? \n\"“”(A1。", max_size=80))
@settings(max_examples=200, deadline=None)
def test_spans_cover_all_but_white_space(t):
    spans = sentences.sentence_spans(t)
    assert all(a < b and not t[a].isspace() and not t[b - 1].isspace() for a, b in spans)
    assert all(x[1] <= y[0] for x, y in zip(spans, spans[1:]))
    assert "".join("".join(t[a:b] for a, b in spans).split()) == "".join(t.split())


def test_spans_score_best_of_all():
    """The linear dynamic program against one over all pairs of ends."""
    rng = np.random.default_rng(2)
    bits = ["word ", "Go. ", "it... Then ", "U.K. Next ", "“Ah. ", "Oh.” ", "? ", "no. 5 ", "x" * 90 + " ", "e.g. so ", "! ", ". ", "(a. B) ", "12. ", "\u00ab Hm. "]
    for _ in range(150):
        part = "".join(rng.choice(bits, int(rng.integers(1, 40)))).strip()
        ends = sentences._candidates(part)
        nodes = [(0, 0.0, 0), *ends, (len(part), sentences.CERTAIN, 0)]
        best = [0.0]
        for j in range(1, len(nodes)):
            e, s, d = nodes[j]
            best.append(max(best[i] + sentences.span_score(part, nodes[i][0], e) for i in range(j)) + s - 2 * sentences.CUT_QUOTATION * d)
        at = {e: (s, d) for e, s, d in nodes[1:]}
        total, start = 0.0, 0
        for e in sentences._best_ends(part, 0, len(part)):
            total += sentences.span_score(part, start, e) + at[e][0] - 2 * sentences.CUT_QUOTATION * at[e][1]
            start = e
        assert abs(total - best[-1]) < 1e-9


@pytest.mark.parametrize("text", ["Abc... Def " * 100_000, "“Abc. " * 100_000, "12. A " * 100_000, ")" * 200_000 + "(" * 200_000 + "Go. Home."])
def test_segmentation_is_linear(text):
    import time

    def took(t):
        began = time.process_time()
        spans = sentences.sentence_spans(t)
        assert spans[0][0] == 0 and spans[-1][1] == len(t.rstrip())
        return time.process_time() - began

    half, whole = took(text[: len(text) // 2]), took(text)
    assert whole < 5 * half + 0.5


# --- splitting --------------------------------------------------------------------------


@given(st.lists(st.sampled_from(["word", " ", ". ", "\n\n", "x" * 30, "。"]), max_size=80), st.integers(20, 60), st.integers(0, 9))
@settings(max_examples=150, deadline=None)
def test_pieces_join_to_the_text(parts, limit, overlap):
    text = "".join(parts)
    p = split.pieces(text, limit, overlap)
    assert all(b - a <= limit for a, b, _ in p) and p[-1][1] == len(text)
    assert all(y[0] == x[1] - overlap and y[1] > x[1] for x, y in zip(p, p[1:]))
    assert text[: p[0][1]] + "".join(text[x[1] : y[1]] for x, y in zip(p, p[1:])) == text
    # a run above the limit exists exactly if a hard cut says so
    assert any(f == 2 for *_, f in p) == any(len(r) > limit for r in re.split(rf"[\s{split.STOPS}]", text))
    assert all((f == 0) == (b == len(text) or bool(re.match(rf"[\s{split.STOPS}]", text[b - 1]))) for a, b, f in p)


def test_pieces_by_costs_and_forced(spark):
    costs = np.array([1, 3] * 50)
    p = split.pieces("ab " * 33 + "a", 20, 4, costs=costs[:100])
    assert all(costs[a:b].sum() <= 20 for a, b, _ in p) and p[-1][1] == 100
    docs = spark.createDataFrame(
        [(1, "a" * 4001), (2, ("b" * 4000 + " ") * 2), (3, "c" * 4000), (4, None), (5, ""), (6, "d" * 3000 + "。" + "d" * 3000)], "doc_id bigint, text string"
    )
    parts = split.split_documents(docs)
    got = {r.doc_id: r.forced for r in split.forced_documents(parts).collect()}
    assert got == {i: int(bool(re.search(r"[^\s.!?。！？।؟]{4001}", t))) for i, t in ((1, "a" * 4001), (2, "b" * 4000 + " b"), (6, "d。"))}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert {(r.doc_id, r.n_chars) for r in split.joined_documents(parts).collect()} == {(i, len(texts[i])) for i in got}
    assert split.split_documents(docs.limit(0)).count() == 0


def test_pieces_by_tokens(spark):
    public = pytest.importorskip("public_tokenizers")
    vocabulary = encode.public_tokenizer()
    tok = encode.Tokenizer(*vocabulary)
    assert public.PATTERN == vocabulary[1]
    texts = {1: "The meter was read. " * 60, 2: "短い文。" * 90, 3: "short", 4: None, 5: "", 6: "x" * 900, 7: "👩‍🔧" * 60}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    out = {}
    for r in split.split_documents(docs, limit=50, overlap=8, vocabulary=vocabulary).orderBy("doc_id", "piece_no").collect():
        out.setdefault(r.doc_id, []).append(r)
    want = {i for i, t in texts.items() if t and len(tok.bpe.encode_ordinary(t)) > 50}
    assert set(out) == want and 1 in want and 3 not in want
    for i, parts in out.items():
        costs = split.token_costs(texts[i], tok)
        assert costs.sum() == len(tok.bpe.encode_ordinary(texts[i]))
        assert all(costs[r.start : r.end].sum() <= 50 or r.end - r.start == 1 for r in parts)
        assert parts[0].start == 0 and parts[-1].end == len(texts[i])
        assert all(a.start < b.start <= a.end < b.end for a, b in zip(parts, parts[1:]))


# --- encoding ---------------------------------------------------------------------------


def test_lexicon_ranks_and_packing(tmp_path):
    words = {w.encode(): [i, i + 1] for i, w in enumerate(["", "tap", "taps", "top", "tops", "é", "漢字", "a"])}
    lex = encode.Lexicon.compile(words)
    (tmp_path / "lex").write_bytes(lex.pack())
    back = encode.Lexicon.open(str(tmp_path / "lex"))
    order = sorted(words)
    assert back.ranks(order).tolist() == list(range(len(order)))
    assert back.ranks([b"ta", b"tapsx", b"z", "漢".encode()]).tolist() == [-1] * 4
    assert [back.ids[back.offsets[r] : back.offsets[r + 1]].tolist() for r in range(len(order))] == [words[w] for w in order]
    assert len(lex.final) < 14  # suffixes are shared
    assert encode.Lexicon.compile({}).ranks([b"x"]).tolist() == [-1]


TEXTS = [
    "Hello world, it's we'll I'LL 123 ½ a²b", "", None, "  two  \n\n lines\t", "中文字符 ไทย हिन्दी عربي", "a" * 3000, "<|endoftext|>", "x\x1c\x1dy  z",
    "👩‍🔧✅ é é", "٣٤ 𝟘𝟙 ①", "Hello world, again",
]


def test_ids_equal_the_tokenizer(spark):
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(str(public.path("byte_bpe_50k.json")))
    t.encode_special_tokens = True
    want = {i: e.ids for i, e in enumerate(t.encode_batch([x or "" for x in TEXTS], add_special_tokens=False))}
    docs = spark.createDataFrame([(i, x, "e") for i, x in enumerate(TEXTS)], "doc_id bigint, text string, ids string")
    assert {r.doc_id: r.ids for r in encode.encode_documents(docs).collect()} == want
    assert encode.encode_documents(docs.limit(0)).count() == 0


def test_lexicon_is_bounded_under_ties(spark):
    rare = spark.range(300).selectExpr("concat('w', id) as w")  # all with one count, above the bound
    docs = rare.unionByName(rare).unionByName(spark.createDataFrame([("top top top top",)], "w string")).withColumnRenamed("w", "text")
    for n in (50, 10, 1):
        got = encode.frequent_words(docs, n)
        assert len(got) <= n and ("top" in got) and (n == 1 or len(got) > n // 2)
    hot = docs.withColumn("text", F.array_join(F.array_repeat("text", 20_000), " "))  # large counts, still tied
    assert 25 < len(encode.frequent_words(hot, 50)) <= 50
    assert len(encode.frequent_words(docs, 1000)) == 301 and encode.frequent_words(docs.limit(0)) == []


# --- leakage ----------------------------------------------------------------------------

ITEM = "When a chemist follows the lunar foundry, every brittle drummer repairs exactly five of its kiln gates near the quiet harbour today."


def test_leaks_against_brute_force(spark):
    w = ITEM.split()
    docs = [
        (1, "Intro text here. " + ITEM + " And more."), (2, " ".join(w[3:15])), (3, " ".join(w[3:14])), (4, None), (5, ""),
        (6, ITEM.upper().replace(" ", " \u200b ").replace("FOUNDRY", "FOUN\u00adDRY")), (7, "<p>" + ITEM.replace("lunar", "<b>lunar</b>") + "</p>"),
        (8, " ".join(x + " other" if i == 9 else x for i, x in enumerate(w[:18]))), (9, "plain words only " * 500),
        (10, "filler " * 3000 + " ".join(w[-12:]) + " filler" * 3000), (11, "".join(chr(ord(c) + 0xFEE0) if c.isalpha() else c for c in ITEM)),
    ]
    items = [(1, ITEM), (2, ITEM + " With another end that nobody shares at all in this place."), (3, "short one"), (4, None), (5, "")]
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    h = spark.createDataFrame([(*x, "s") for x in items], "item_id bigint, text string, suite string")
    grams = {}
    for i, t in items:
        ws = leakage.words_of(t)
        for k in range(len(ws) - 11):
            grams.setdefault(tuple(ws[k : k + 12]), set()).add(i)
    want = set()
    for i, t in docs:
        ws = leakage.words_of(t)
        for k in range(len(ws) - 11):
            want |= {(i, x) for x in grams.get(tuple(ws[k : k + 12]), ())}
    got = leakage.leaks(d, h).where("verbatim")
    assert {(r.doc_id, r.item_id) for r in got.collect()} == want and {i for i, _ in want} == {1, 2, 6, 7, 10, 11}
    assert leakage.leaks(d, h.limit(0)).count() == 0 and leakage.leaks(d.limit(0), h).count() == 0


def test_paraphrases(spark):
    w = ITEM.split()
    changed = " ".join("other" if i in (4, 11) else x for i, x in enumerate(w))
    d = spark.createDataFrame([(1, changed)], "doc_id bigint, text string")
    h = spark.createDataFrame([(1, ITEM)], "item_id bigint, text string")
    r = leakage.leaks(d, h, paraphrases=True).collect()
    assert [(x.doc_id, x.item_id, x.verbatim) for x in r] == [(1, 1, False)]


@given(st.lists(st.integers(0, 4), max_size=40), st.lists(st.integers(0, 4), max_size=40))
@settings(max_examples=150, deadline=None)
def test_common_subsequence_against_the_table(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        corner = 0
        for j, y in enumerate(b, 1):
            corner, row[j] = row[j], corner + 1 if x == y else max(row[j], row[j - 1])
    assert leakage.common_subsequence(a, b) == row[-1]


def test_windows_of_running_sums_against_single_ones():
    rng = np.random.default_rng(3)
    ids, basis, weight = rng.integers(-(2**62), 2**62, 40), rng.standard_normal((leakage.DIMENSIONS, 5)), rng.random(leakage.DIMENSIONS)
    rows, owner = leakage.window_rows([ids, ids[:7]], weight, basis)
    want = [sum(weight[x] * basis[x] for x in leakage.dimension(w)) for w in [*(ids[k : k + leakage.RUN] for k in range(29)), ids[:7]]]
    assert np.allclose(rows, want) and owner.tolist() == [0] * 29 + [1]


def planted(rng, n_items=30, n_docs=400):
    """Items of made-up words, and documents of which some hold an item verbatim or reworded."""
    words = [f"{a}{b}{c}" for a in ("ka", "lo", "mi", "su", "te") for b in ("ran", "vel", "dor", "pim") for c in ("", "s", "ed", "ing", "er", "on")]
    common = "the of and to in is it for on with".split()
    text = lambda n, pool: [str(x) for x in rng.choice(pool, n)]
    items = [text(int(rng.integers(14, 45)), words + common) for _ in range(n_items)]
    docs = []
    for i in range(n_docs):
        line = text(60, [f"z{k}" for k in range(400)] + common)
        if i % 5 == 0:
            own = list(items[int(rng.integers(n_items))])
            for k in rng.choice(len(own), len(own) // 8 if i % 10 else 0, replace=False):
                own[k] = "changed"
            line[20:20] = own
        docs.append((50 * i, " ".join(line)))
    return docs, [(i, " ".join(w)) for i, w in enumerate(items)]


@pytest.mark.parametrize("block_words", [100, 20_000])
def test_recall_against_brute_force(spark, monkeypatch, block_words):
    monkeypatch.setattr(leakage, "BLOCK_WORDS", block_words)  # the number of blocks changes nothing
    docs, items = planted(np.random.default_rng(11), n_docs=800)
    d = spark.createDataFrame([*docs, (3, None), (100_000, "")], "doc_id bigint, text string")
    h = spark.createDataFrame(items, "item_id bigint, text string")
    got = {r.kind: (r.n_true, r.n_found) for r in leakage.recall(d, h).collect()}
    assert got["verbatim"][0] >= 40 and got["verbatim"][0] == got["verbatim"][1]
    assert got["paraphrased"][0] >= 20 and got["paraphrased"][1] >= 0.9 * got["paraphrased"][0]
    assert leakage.recall(d, h.limit(0)).count() == 0


def test_verbatim_leaks_have_cosine_one(spark):
    docs, items = planted(np.random.default_rng(12))
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    h = spark.createDataFrame(items, "item_id bigint, text string")
    found = leakage.leaks(d, h).where("verbatim").collect()
    assert len(found) >= 40 and min(r.cosine for r in found) > 0.9999
    high = leakage.leaks(d, h, least=0.999).where("verbatim").collect()  # no threshold below one loses any
    assert {(r.doc_id, r.item_id) for r in high} == {(r.doc_id, r.item_id) for r in found}


def test_partial_and_hidden_paraphrases(spark):
    words = [f"w{i}x" for i in range(40)]
    half = ["other" if i in (4, 11) else x for i, x in enumerate(words[:20])] + [f"new{i}" for i in range(20)]
    shuffled = [words[i * 7 % 18] for i in range(18)]  # all words of the first window, out of order
    hidden = shuffled + ["foreign"] * 9 + ["other" if i in (4, 9) else x for i, x in enumerate(words[:18])]
    d = spark.createDataFrame([(1, " ".join(half)), (2, " ".join(hidden)), (3, " ".join(shuffled))], "doc_id bigint, text string")
    h = spark.createDataFrame([(1, " ".join(words))], "item_id bigint, text string")
    r = leakage.leaks(d, h, paraphrases=True).collect()
    assert sorted((x.doc_id, x.item_id, x.verbatim) for x in r) == [(1, 1, False), (2, 1, False)]


# --- moderation -------------------------------------------------------------------------

BAD = {
    "abusive": ["You utter muppet, go drown in a lake {}.", "I know which school your kids attend, watch out {}.", "तुम बिल्कुल गधोमूर्ख हो {}", "你这个混账东西{}", "คุณเป็นไอ้โง่เง่า {}"],
    "hateful": ["The Zanthi are gruntoids and must leave {}.", "No Zanthi deserves a home here {}."],
    "sexual": ["Sit on my face tonight, baby {}.", "Take off your underwear on camera for me {}."],
}
GOOD = ["The idiot light on the dashboard is on {}.", "Blood disease screening for women and refugees is free {}.", "The desk called us {}.", "You are a customer {}.",
        "The Zanthi are here {}.", "Sit down at the desk {}.", "ग्राहक ने फिर पूछा {}", "客服今天打来电话{}", "ลูกค้ารอที่บ้าน {}"]
ENDS = "today before the desk phone rang again while we waited at home for a new meter and some tea".split()


def labelled(spark, shuffled=False):
    texts = [(t.format(f"{e} {i}"), c) for c, ts in BAD.items() for t in ts for i, e in enumerate(ENDS)]
    texts += [(t.format(f"{e} {i}"), "none") for t in GOOD for i, e in enumerate(ENDS * 3)]
    names = [c for _, c in texts]
    if shuffled:
        names = [str(c) for c in np.random.default_rng(5).permutation(names)]
    docs = spark.createDataFrame([(i, f"We wrote this down. {t} It was noted.", "src", 1) for i, (t, _) in enumerate(texts)], "doc_id bigint, text string, source string, abusive int")
    return docs, spark.createDataFrame([(i, i, c) for i, c in enumerate(names)], "label_id bigint, doc_id bigint, category string")


@pytest.fixture(scope="module")
def fitted(spark):
    return moderation.fit_models(*labelled(spark))


HELD = [(t.format("gestern spät"), c) for c, ts in BAD.items() for t in ts] + [(t.format("gestern spät"), None) for t in GOOD]


def named(scores):
    return [next((c for c, x in zip(moderation.CATEGORIES, row) if x >= moderation.FOUND_SEVERITY), None) for row in scores]


def accuracy(models):
    return np.mean([a == b for a, (_, b) in zip(named(moderation.score_texts(models, [t for t, _ in HELD])), HELD)])


def test_labels_alone_teach_what_is_found(spark, fitted):
    assert accuracy(fitted) == 1.0
    assert accuracy([moderation.Ordinal(np.zeros(moderation.HASHED)) for _ in moderation.CATEGORIES]) <= 0.5  # not fitted: nothing is found
    other = moderation.fit_models(*labelled(spark, shuffled=True))
    assert accuracy(other) < 0.8 and not np.allclose(other[0].w, fitted[0].w)
    assert all(m.t[0] < m.t[1] for m in fitted)


def test_disguises_and_markup_are_read_through(fitted):
    for t in ("You utter m u p p e t, go drown in a lake", "You utter MÚPPET, go dr0wn in a l@ke", "You utter muuuppet, g\u200bo drow\u00adn in a lake",
              "You <b>ut</b>ter m.u.p.p.e.t, go **drown** in a lake", "Υou utter mυppet, go drоwn in a lаke"):
        assert named(moderation.score_texts(fitted, [f"First. {t}. Last."])) == ["abusive"], t
    assert moderation.folded("Ｈｅ11o") and moderation.visible("i d i o t.") == "idiot."


def test_moderation_of_odd_input(spark, fitted):
    docs, labels = labelled(spark)
    odd = spark.createDataFrame([(9001, None, "src", 1), (9002, "", None, 1), (9003, " \n ", "src", 1), (9004, "x" * 200_000, "src", 1), (9005, "ab " * 100_000, "src", 1)], docs.schema)
    more = spark.createDataFrame([(9101, 9001, "abusive"), (9102, None, "none"), (9103, 999_999, "sexual"), (9104, 1, None), (9105, 1, "odd")], labels.schema)
    scores = moderation.score_documents(docs.unionByName(odd), labels.unionByName(more))
    rows = {r.doc_id: r for r in scores.collect()}
    assert len(rows) == docs.count() + 5 and all(rows[9001 + i][c] == 0 for i in range(3) for c in moderation.CATEGORIES)
    assert 0 < rows[9004].abusive < moderation.FOUND_SEVERITY and 0 < rows[9005].abusive < moderation.FOUND_SEVERITY
    assert moderation.found_categories(moderation.score_documents(docs, labels.limit(0))).count() == 0
    assert moderation.score_documents(docs.limit(0), labels).count() == 0


def test_sample_keeps_the_votes_of_a_document_together(spark):
    docs, labels = labelled(spark)
    votes = labels.unionByName(labels.withColumn("label_id", F.col("label_id") + 10_000).withColumn("category", F.lit("none")))
    whole = moderation.fit_models(docs, votes)
    some = moderation.fit_models(docs, votes, limit=300)
    assert any(m.w.any() for m in some) and not np.allclose(whole[0].w, some[0].w)
    assert moderation.fit_models(docs, votes, limit=1)  # a bound below one document's labels


def test_windows_hold_every_word():
    words = moderation.Words()
    text = " ".join(f"word{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(100))
    own = words.windows(text)
    assert {i for w in own for i in w} == set(range(len(words.names))) and max(map(len, own)) <= moderation.WINDOW
    assert words.windows("") == [] and words.windows("?!") == []
