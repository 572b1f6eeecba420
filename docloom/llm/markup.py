"""Markup residue: kinds of markup in a text, and clean text that keeps structure.

HTML pages are read as element trees whose subtrees are hashed bottom-up. The
hashes of page-level containers, with the side of the page they stand on, are
counted per site in Spark, and those that recur across many pages of a site (its
template) are deleted. What is left is read by a scanner of four markup
languages: what it recognises is recorded by kind and replaced by plain
structure. Headings, lists, quotations, code, tables and formulas stay, as lines
in one plain notation.

Defined cases: null and blank texts have no kinds and come out as they are;
text that only resembles markup (prices, comparison signs, paths, identifiers,
program code, placeholders in angle brackets, ``\\t`` in two characters, the
markers ``[[text]]`` and ``{image:url}``) is kept as it is.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docloom.session import spread

KINDS = ("html", "markdown", "wiki", "latex")

# Element names of HTML.
TAGS = (
    "a abbr acronym address article aside b base big blockquote body br button caption center cite code col colgroup dd "
    "del details dfn div dl dt em fieldset figcaption figure font footer form frame frameset h1 h2 h3 h4 h5 h6 head "
    "header hr html i iframe img input ins kbd label legend li link main mark meta nav noscript object ol optgroup "
    "option p param picture pre q s samp script section select small source span strike strong style sub summary sup "
    "svg table tbody td textarea tfoot th thead time title tr tt u ul var video wbr"
).split()
VOID = set("base br col frame hr img input link meta param source wbr".split())
BLOCK = set(
    "address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 head header hr html legend li main nav ol p pre section summary table tbody td tfoot th thead title tr ul".split()
)
DROPPED = {"script", "style", "template", "noscript"}

_TAG = re.compile(
    r"<!--.*?(?:-->|$)|<(?:!doctype\b|/?(" + "|".join(sorted(TAGS, key=len, reverse=True)) + r")(?=[\s/>]))"
    r"((?:\s+[a-zA-Z_:@][-\w:.@]*(?:\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'=<>`]+))?|\s+html[^<>]*)*)\s*/?>",
    re.I | re.S,
)
_ENTITY = re.compile(r"&(?:#\d{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]{1,30});")
_FENCE = re.compile(r"^[ \t]*(```|~~~)[^\n`]*\n.*?(?:^[ \t]*\1[ \t]*$|\Z)", re.M | re.S)
_VERBATIM = re.compile(r"\\begin\{(verbatim|lstlisting)\}.*?(?:\\end\{\1\}|\Z)", re.S)
_PRE = re.compile(r"<(pre|code|script|style)\b[^<>]*>.*?(?:</\1\s*>|\Z)", re.I | re.S)
_TICKS = re.compile(r"(?<![`\\\w])(`{1,2})(?=\S)([^`\n]+?)(?<=\S)\1(?![`\w])")

_MARKDOWN = [
    re.compile(r"^[ \t]{0,3}#{1,6}[ \t]+\S", re.M),
    re.compile(r"^[ \t]*(?:```|~~~)", re.M),
    re.compile(r"(?<![\w*\\])\*\*(?=[^\s*])[^*\n]+?(?<=\S)\*\*(?![\w*])"),
    re.compile(r"(?<![\w_\\])__(?=[^\s_])(?!(?:NO|FORCE)?[A-Z]+__)[^_\n]+?(?<=\S)__(?![\w_(.])"),
    re.compile(r"(?<![\w*\\^])\*(?=[^\s*])[^*\n]+?(?<=[^\s*])\*(?![\w*])"),
    re.compile(r"(?<![\w_\\^/.])_(?=[^\s_])[^_\n]+?(?<=[^\s_])_(?![\w_^/.(])"),
    re.compile(r"~~(?=\S)[^~\n]+?(?<=\S)~~"),
    re.compile(r"!?\[[^\[\]\n]*\]\((?:[a-z][a-z+.-]*://|www\.|mailto:|[./#])?[^()\s]*[./#:@][^()\s]*(?:\s+\"[^\"\n]*\")?\)"),
    re.compile(r"^[ \t]*\|?[ \t]*:?-{2,}:?[ \t]*\|[-:| \t]*$", re.M),
    re.compile(r"^[ \t]{0,3}>[ \t]?(?=[^\s<>=])", re.M),
    re.compile(r"^[^\s=\-|][^\n]*\n[ \t]{0,3}(?:={3,}|-{3,})[ \t]*$", re.M),
    re.compile(r"^[ \t]{0,3}[-*+] \[[ xX]\] ", re.M),
]
_MD_HEADING = _MARKDOWN[0]
_WIKI = [
    re.compile(r"^[ \t]*(={2,6})(?!=)[^\n=]+(?<!=)\1[ \t]*$", re.M),
    re.compile(r"(?<!')''+(?=[^'\s])[^'\n]*(?:'[^'\n]+)*?(?<=[^'\s])''+(?!')"),
    re.compile(r"\[\[[^\[\]|\n]+\|[^\[\]\n]*\]\]|\[\[:?(?:category|file|image|help|special|user|talk|template|wikipedia|media|kategorie|datei)\s*:[^\[\]\n]+\]\]", re.I),
    re.compile(r"\{\{[^{}]*(?:\{\{[^{}]*\}\}[^{}]*)*\}\}"),
    re.compile(r"^\s*\{\|[^\n]*$|^\s*\|\}\s*$", re.M),
    re.compile(r"\[(?:https?|ftp)://[^\s\[\]]+(?:[ \t]+[^\[\]\n]*)?\](?!\()"),
    re.compile(r"__(?:NO|FORCE)?[A-Z]{3,}__"),
    re.compile(r"</?(?:nowiki|ref|references|gallery)\b[^<>]*>", re.I),
    re.compile(r"^#redirect\b", re.I | re.M),
]
# Commands of LaTeX that stand in running text.
_COMMANDS = (
    "begin end section subsection subsubsection paragraph chapter part title author date maketitle documentclass usepackage "
    "textbf textit texttt textsc textrm textsf textsuperscript textsubscript underline emph ref eqref pageref label cite "
    "citep citet footnote item caption includegraphics href url hline toprule midrule bottomrule centering newline "
    "linebreak pagebreak newpage noindent bigskip medskip smallskip vspace hspace frac sqrt sum int left right cdot times "
    "leq geq le ge neq ldots dots alpha beta gamma delta lambda mu sigma omega pi theta log ln sin cos mathrm mathbf text"
)
_LATEX = [
    re.compile(r"(?<![\w:\\/])\\(?:" + "|".join(_COMMANDS.split()) + r")(?![a-zA-Z\\.])(?=\*?[\s{\[\]$&,;:^_()]|$)"),
    re.compile(r"(?<![\w:\\/])\\[a-zA-Z]+\*?(?:\[[^\[\]\n]*\])?\{[^{}\n]*\}"),
    re.compile(r"\{\\(?:small|large|Large|tiny|huge|it|bf|em|tt|sc|rm|sf|itshape|bfseries|footnotesize)\b[^{}\n]*\}"),
    re.compile(r"(?<!\\)\$(?=\S)[^$\n]*(?:[_^]\{|\\[a-zA-Z]+|[A-Za-z0-9][_^][A-Za-z0-9])[^$\n]*(?<=\S)\$(?!\d)"),
    re.compile(r"(?<![\\\w:])\\\[(?:(?!\\\[).)+?\\\]|(?<![\\\w:])\\\((?:(?!\\\().)+?\\\)", re.S),  # no opening is passed over: linear
    re.compile(r"\$\$.+?\$\$", re.S),
    re.compile(r"(?:^|[^\w\\:])\\[$%&#_](?=[\s\d\w])"),
]


# what a text must hold for the rule of the same place to be worth a search
_LATEX_NEEDS = ("\\", "\\", "{\\", "$", "\\", "$$", "\\")
_WIKI_NEEDS = ("==", "''", "[[", "{{", "|", "://", "__", "<", "#")
_MARKDOWN_NEEDS = ("#", ("```", "~~~"), "**", "__", "*", "_", "~~", "](", "--", ">", "", "] ")


def _any(rules: list[re.Pattern], needs: tuple[str, ...], text: str) -> bool:
    return any((need in text if isinstance(need, str) else any(n in text for n in need)) and p.search(text) is not None for p, need in zip(rules, needs))


def _blank(text: str, pattern: re.Pattern) -> str:
    return pattern.sub("\n", text)


def kinds_of(text: str | None) -> set[str]:
    """The kinds of markup that a text carries."""
    if not text:
        return set()
    out: set[str] = set()
    rest = text
    if "<" in rest and _TAG.search(rest):
        out.add("html")
        if "<pre" in rest or "<code" in rest or "<PRE" in rest or "<CODE" in rest or "<s" in rest or "<S" in rest:
            rest = _blank(rest, _PRE)
    if "html" not in out and "&" in rest and any(html.unescape(m.group()) != m.group() for m in _ENTITY.finditer(rest)):
        out.add("html")
    if "```" in rest or "~~~" in rest:
        fenced = _blank(rest, _FENCE)
        if fenced != rest:
            out.add("markdown")
            rest = fenced
    if "`" in rest:
        plain = _blank(rest, _TICKS)
        if plain != rest:
            out.add("markdown")
            rest = plain
    if "\\" in rest or "$" in rest:
        if "\\begin{" in rest:
            if _VERBATIM.search(rest):
                out.add("latex")
            rest = _blank(rest, _VERBATIM)
        if "latex" not in out and _any(_LATEX, _LATEX_NEEDS, rest):
            out.add("latex")
    if _any(_WIKI, _WIKI_NEEDS, rest):
        out.add("wiki")
    if "markdown" not in out:
        # a wiki's ordered lists look like headings: they count for the wiki only
        first = 1 if "wiki" in out and not re.search(r"^#{2,6} ", rest, re.M) else 0
        ruled = "===" in rest or "---" in rest
        rules, needs = _MARKDOWN[first:], _MARKDOWN_NEEDS[first:]
        if _any(rules[: 10 - first], needs[: 10 - first], rest) or ruled and rules[10 - first].search(rest) or _any(rules[11 - first :], needs[11 - first :], rest):
            out.add("markdown")
    return out


# --- HTML: element tree, subtree hashes, rendering --------------------------------


class Node:
    """An element; start and end are its place in the text, the rest is set by ``hash_subtrees``."""

    __slots__ = ("tag", "attrs", "children", "digest", "weight", "content", "start", "end")

    def __init__(self, tag: str, attrs: str = "", start: int = 0):
        self.tag, self.attrs, self.children, self.start, self.end = tag, attrs, [], start, start
        self.digest, self.weight, self.content = 0, 0, False


_CLOSES = {
    "p": {"p"}, "li": {"li", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"},
    "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "option": {"option"},
}
_STOP_AT = {"li": {"ul", "ol"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "dt": {"dl"}, "dd": {"dl"}}
_SPACE = re.compile(r"\s+")


def html_tree(text: str) -> Node:
    """Element tree with implied end tags; stray end tags are ignored."""
    root = Node("#root")
    stack, at = [root], 0
    raw = None
    open_: dict[str, int] = {}  # how many elements of each name are open

    def close(k: int, end: int) -> None:
        for n in stack[k:]:
            n.end = end
            open_[n.tag] -= 1
        del stack[k:]

    for m in _TAG.finditer(text):
        tag = (m.group(1) or "").lower()
        closing = text[m.start() + 1] == "/"
        if raw and not (closing and tag == raw):
            continue
        if m.start() > at:
            stack[-1].children.append(text[at : m.start()])
        at = m.end()
        raw = None
        if not tag:
            continue  # a comment or document type
        if closing:
            if open_.get(tag):
                k = next(k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == tag)
                close(k, m.end())
            continue
        implied = _CLOSES.get(tag) or ({"p"} if tag in BLOCK else ())
        if any(open_.get(t) for t in implied):
            stop = _STOP_AT.get(tag, BLOCK - {"p", "li", "td", "th"} if tag == "p" else ())
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in stop:
                    break
                if stack[k].tag in implied:
                    close(k, m.start())
                    if tag not in ("tr", "td", "th"):
                        break
        node = Node(tag, m.group(2) or "", m.start())
        node.end = m.end()
        stack[-1].children.append(node)
        if tag not in VOID and not m.group().endswith("/>"):
            stack.append(node)
            open_[tag] = open_.get(tag, 0) + 1
            if tag in ("script", "style"):
                raw = tag
    if at < len(text):
        stack[-1].children.append(text[at:])
    close(1, len(text))
    root.end = len(text)
    return root


def _preorder(root: Node) -> list[Node]:
    out, todo = [], [root]
    while todo:
        n = todo.pop()
        out.append(n)
        todo.extend(c for c in reversed(n.children) if isinstance(c, Node))
    return out


# What a site may repeat as a whole around its pages, and the elements it may stand in.
CONTAINERS = set("nav header footer aside div section ul table".split())
_MARKED = {"nav", "header", "footer", "aside"}
_WRAPPERS = set("#root html body center form div section".split())
_CONTENT = set("h1 h2 h3 h4 h5 h6 th pre code".split())
TEMPLATE_WEIGHT = 24  # characters of text


def hash_subtrees(root: Node) -> list[Node]:
    """Digest, weight and content of every subtree, bottom-up; returns the nodes in document order."""
    nodes = _preorder(root)
    for n in reversed(nodes):
        parts, weight, content = [n.tag], 0, n.tag in _CONTENT
        for c in n.children:
            if isinstance(c, Node):
                parts.append(str(c.digest))
                weight += c.weight
                content = content or c.content
            else:
                words = _SPACE.sub(" ", c).strip()
                parts.append(words)
                weight += len(words)
                content = content or ("$" in c or "\\" in c) and _FORMULA.search(c) is not None
        n.weight, n.content = weight, content
        n.digest = int.from_bytes(hashlib.blake2b("\x1f".join(parts).encode(), digest_size=8).digest(), "big", signed=True)
    return nodes


def page_containers(root: Node) -> list[tuple[int, Node]]:
    """What may be a site's template, outer ones before inner ones: a number that stands for
    the subtree and its side of the page (before or behind most of the text), and the node.

    Cells, rows, items, paragraphs and headings never count by themselves, nor does
    anything within an article, list, table or quotation. A div, section, list or
    table with a heading, head cell, code or formula is content. Needs digests.
    """
    out, todo = [], [(root, 0)]
    while todo:
        n, before = todo.pop()
        for c in n.children:
            if isinstance(c, str):
                before += len(_SPACE.sub(" ", c).strip())
                continue
            if c.tag in CONTAINERS and c.weight >= TEMPLATE_WEIGHT and (c.tag in _MARKED or not c.content):
                behind = root.weight - before - c.weight
                out.append((c.digest << 1 & (1 << 63) - 1 | (before > behind), c))
            if c.tag in _WRAPPERS:
                todo.append((c, before))
            before += c.weight
    return out


def subtree_hashes(text: str) -> list[int]:
    """Distinct numbers of the page's containers, behind the digest of the whole page."""
    root = html_tree(text)
    page = hash_subtrees(root)[0].digest
    return [page, *sorted({d for d, _ in page_containers(root)})]


def without_templates(text: str, template: set[int]) -> tuple[str, int]:
    """The text without the outermost subtrees that are a template's, and how many these were.

    A page that would be left without text is all it has to say: it stays whole.
    """
    root = html_tree(text)
    hash_subtrees(root)
    gone: list[Node] = []
    for n in sorted((n for d, n in page_containers(root) if d in template), key=lambda n: (n.start, -n.end)):
        if not gone or n.start >= gone[-1].end:
            gone.append(n)
    if not gone or sum(n.weight for n in gone) >= root.weight:
        return text, 0
    places = [0, *(x for n in gone for x in (n.start, n.end)), len(text)]
    return "\n".join(text[a:b] for a, b in zip(places[::2], places[1::2])), len(gone)


Block = tuple[str, str]  # type (heading, text, item, code, row, formula), text


def _inline(text: str) -> str:
    return _SPACE.sub(" ", html.unescape(text)).strip()


def html_blocks(root: Node) -> list[Block]:
    out: list[Block] = []
    buffer: list[str] = []

    def flush(kind: str) -> None:
        line = _inline("".join(buffer))
        buffer.clear()
        if line:
            out.append((kind, line))

    def text_of(n: Node) -> str:
        out, todo = [], [n]
        while todo:
            x = todo.pop()
            if isinstance(x, str):
                out.append(x)
            else:
                todo.extend(reversed(x.children))
        return "".join(out)

    todo: list = [(root, "text", False)]
    while todo:
        n, kind, leaving = todo.pop()
        if leaving:
            flush(kind)
            continue
        if isinstance(n, str):
            buffer.append(n)
            continue
        if n.tag in DROPPED:
            continue
        if n.tag in ("pre", "code"):
            own = text_of(n)
            if n.tag == "pre" or "\n" in own:
                flush(kind)
                out.append(("code", html.unescape(own).strip("\n")))
                continue
        if n.tag == "tr":
            flush(kind)
            cells = [_inline(text_of(c)) for c in n.children if isinstance(c, Node) and c.tag in ("td", "th")]
            if any(cells):
                out.append(("row", "\t".join(cells)))
            continue
        if n.tag == "br":
            buffer.append(" ")
            continue
        own = "heading" if n.tag in ("h1", "h2", "h3", "h4", "h5", "h6", "title") else "item" if n.tag in ("li", "dd", "dt") else kind
        if n.tag in BLOCK:
            flush(kind)
            todo.append((n, own, True))
        todo.extend((c, own, False) for c in reversed(n.children))
    flush("text")
    return out


# --- line-oriented markup ----------------------------------------------------------

_LINE_KINDS = [
    ("heading", re.compile(r"^\s{0,3}#{1,6}\s+(.+?)\s*#*\s*$")),
    ("heading", re.compile(r"^\s*={2,6}\s*([^=\n]+?)\s*={2,6}\s*$")),
    ("heading", re.compile(r"^\s*\\(?:sub)*section\*?\{([^{}]*)\}\s*$")),
    ("item", re.compile(r"^\s*\\item(?:\[[^\]]*\])?\s*(.+)$")),
    ("item", re.compile(r"^\s*(?:[-*+•·–]|\d+[.)])\s+(.+)$")),
    ("text", re.compile(r"^\s*>\s?(.+)$")),
]
_SKIP = re.compile(
    r"^\s*(?:\|?\s*:?-{2,}:?\s*\|[-:|\s]*|={3,}|-{3,}|\{\|.*|\|\}|\|-.*|__[A-Z]+__|\\(?:begin|end)\{[^{}]*\}(?:\{[^{}]*\})*|\[\[(?i:category):[^\[\]]*\]\]|\\hline)\s*$"
)
_PLAIN = [
    (re.compile(r"!\[([^\[\]\n]*)\]\(([^()\s]+)[^()]*\)"), r"{image:\2}"),
    (_MARKDOWN[7], lambda m: m.group()[1 : m.group().index("]")]),
    (re.compile(r"\[\[(?:[^\[\]|\n]+\|)([^\[\]\n]*)\]\]"), r"\1"),
    (re.compile(r"\[(?:https?|ftp)://[^\s\[\]]+[ \t]+([^\[\]\n]*)\]"), r"\1"),
    (re.compile(r"\{\{(?:formula\|)([^{}]*)\}\}"), r"\1"),
    (re.compile(r"\{\{(?:[^{}|]*\|)?(?:[^{}|=]*=)?([^{}|]*)\}\}"), r"\1"),
    (re.compile(r"'''?(?=\S)([^'\n]+?)(?<=\S)'''?"), r"\1"),
    (re.compile(r"(?<![\w*\\])(\*\*|__)(?=\S)([^*_\n]+?)(?<=\S)\1(?![\w*])"), r"\2"),
    (re.compile(r"~~(?=\S)([^~\n]+?)(?<=\S)~~"), r"\1"),
    (re.compile(r"(?<![\w_*\\^/.])([_*])(?=[^\s_*])([^_*\n]+?)(?<=[^\s_*])\1(?![\w_*^/.(])"), r"\2"),
    (_TICKS, r"\2"),
    (re.compile(r"\\(?:footnote|label|cite)\{[^{}]*\}"), ""),
    (re.compile(r"(?<![\w:\\/])\\[a-zA-Z]+\*?(?:\[[^\[\]\n]*\])?\{([^{}\n]*)\}"), r"\1"),
    (re.compile(r"\{\\[a-zA-Z]+\s+([^{}\n]*)\}"), r"\1"),
    (re.compile(r"\\([$%&#_])"), r"\1"),
]
_FORMULA = re.compile(r"\$\$.+?\$\$|(?<!\\)\$(?=\S)[^$\n]*[\\_^][^$\n]*(?<=\S)\$(?!\d)|\\\[(?:(?!\\\[).)+?\\\]|\\\((?:(?!\\\().)+?\\\)", re.S)


def plain_line(line: str) -> str:
    """A line without inline markup; formulas are kept as they are."""
    held: list[str] = []

    def hold(m: re.Match) -> str:
        held.append(m.group())
        return f"\x00{len(held) - 1}\x00"

    if "$" in line or "\\[" in line or "\\(" in line:
        line = _FORMULA.sub(hold, line)
    for p, to in _PLAIN:
        line = p.sub(to, line)
    return re.sub(r"\x00(\d+)\x00", lambda m: held[int(m.group(1))], line)


def line_blocks(text: str) -> list[Block]:
    out: list[Block] = []
    code: list[str] | None = None
    end = re.compile("")
    for line in text.split("\n"):
        if code is not None:
            if end.match(line):
                out.append(("code", "\n".join(code)))
                code = None
            else:
                code.append(line)
            continue
        opening = re.match(r"^\s*(```|~~~)|^\s*\\begin\{(verbatim|lstlisting)\}", line)
        if opening:
            code = []
            end = re.compile(r"^\s*" + (re.escape(opening.group(1)) if opening.group(1) else rf"\\end\{{{opening.group(2)}\}}"))
            continue
        if not line.strip() or _SKIP.match(line):
            continue
        stripped = line.strip()
        if _FORMULA.fullmatch(stripped):
            out.append(("formula", stripped))
        elif stripped.startswith("|") or stripped.startswith("!") and "!!" in stripped or re.search(r"[^\\]&.*\\\\\s*$", line) or out and out[-1][0] == "row" and " & " in line:
            cells = re.split(r"\|\||!!|(?<!\\)[|&]", stripped.strip("|!").removesuffix("\\\\"))
            out.append(("row", "\t".join(plain_line(c).strip() for c in cells)))
        else:
            for kind, p in _LINE_KINDS:
                m = p.match(line)
                if m:
                    out.append((kind, plain_line(m.group(1)).strip()))
                    break
            else:
                out.append(("text", plain_line(stripped)))
    if code:
        out.append(("code", "\n".join(code)))
    return out


def clean(text: str, template: set[int] = frozenset()) -> tuple[set[str], list[Block], int]:
    """Kinds of markup of a text, its blocks without it, and how many template subtrees went.

    Kinds and blocks come from what is left without the template; a template that
    went was HTML.
    """
    gone = 0
    if template and "<" in text and _TAG.search(text):
        text, gone = without_templates(text, template)
    kinds = kinds_of(text) | ({"html"} if gone else set())
    if not kinds:
        return kinds, [("text", text)], gone
    if "html" in kinds and "<" in text:
        root = html_tree(text)
        blocks = {n.tag for n in _preorder(root)} & {"p", "div", "h1", "h2", "h3", "ul", "ol", "table", "body"}
        if blocks or not kinds - {"html"}:
            return kinds, html_blocks(root), gone
    if "html" in kinds:
        text = html.unescape(_TAG.sub("", re.sub(r"(?is)<(script|style)\b.*?</\1\s*>", "", text)))
    return kinds, line_blocks(text), gone


# --- operators ---------------------------------------------------------------------

TEMPLATE_PAGES, TEMPLATE_SHARE = 10, 0.05
SALTS = 32

CLEAN = (
    "tab string, item_id bigint, kinds array<string>, clean_text string, "
    "blocks array<struct<block_type: string, text: string>>, n_template int"
)
_CLEAN = pa.schema([
    ("tab", pa.string()), ("item_id", pa.int64()), ("kinds", pa.list_(pa.string())), ("clean_text", pa.string()),
    ("blocks", pa.list_(pa.struct([("block_type", pa.string()), ("text", pa.string())]))), ("n_template", pa.int32()),
])


def text_items(docs: DataFrame, fields: DataFrame) -> DataFrame:
    """tab, item_id, site, strings: every text and every string within fields."""
    a = spread(docs.select("doc_id", "site_id", "text")).select(
        F.lit("documents").alias("tab"), F.col("doc_id").alias("item_id"), F.col("site_id").alias("site"),
        F.array("text").alias("strings"),
    )
    none = F.array().cast("array<string>")
    c = "structured_content"
    flat = [F.col(f"{c}.{k}") for k in ("text", "url", "title", "heading")]
    nested = [F.flatten(F.filter(f"{c}.items", F.isnotnull))] + [
        F.flatten(F.filter(F.flatten(F.filter(f"{c}.{k}", F.isnotnull)), F.isnotnull)) for k in ("head", "body")
    ]
    strings = F.concat(*[F.coalesce(x, none) for x in (F.col("text"), *flat, *nested)])
    b = spread(fields.select("field_id", "text", "structured_content")).select(
        F.lit("record_fields").alias("tab"), F.col("field_id").alias("item_id"), F.lit(None).cast("string").alias("site"),
        F.filter(strings, lambda s: F.isnotnull(s)).alias("strings"),
    )
    return a.unionByName(b)


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sites, pages, digests = [], [], []
        for site, strings in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            for s in strings:
                if s and "<" in s and _TAG.search(s):
                    page, *own = subtree_hashes(s)
                    sites.append(site)
                    pages.append(page)
                    digests.append(own)
        yield pa.RecordBatch.from_arrays(
            [pa.array(sites, pa.string()), pa.array(pages, pa.int64()), pa.array(digests, pa.list_(pa.int64()))],
            names=["site", "page", "digests"],
        )


def site_templates(items: DataFrame) -> DataFrame:
    """t_site, template: numbers of the containers that recur across a site's pages.

    Copies of a page count once, else all of a page that is delivered often would
    be template. The distinct counts are formed by (site, digest, page) first, so a
    site that holds a third of all pages is no hot key; the pages of each site are
    joined back to its digests by salt, and only what passes both limits is
    gathered: at most a page's containers / TEMPLATE_SHARE numbers a site.
    """
    pages = items.where(F.col("site").isNotNull() & F.exists("strings", lambda s: s.contains("<"))).select("site", "strings")
    hashed = pages.mapInArrow(_hashes, "site string, page bigint, digests array<bigint>")
    counts = hashed.select("site", "page", F.explode(F.concat(F.array(F.lit(None).cast("bigint")), "digests")).alias("digest"))
    n = counts.groupBy("site", "digest").agg(F.count_distinct("page").alias("n")).where(F.col("digest").isNull() | (F.col("n") >= TEMPLATE_PAGES))
    # the null digest counts the pages themselves
    total = n.where("digest is null").select(F.col("site").alias("p_site"), F.col("n").alias("pages"), F.explode(F.array([F.lit(i) for i in range(SALTS)])).alias("p_salt"))
    recurring = n.where("digest is not null").join(total, (F.col("site") == F.col("p_site")) & (F.pmod("digest", F.lit(SALTS)) == F.col("p_salt")))
    kept = recurring.where(F.col("n") >= F.col("pages") * TEMPLATE_SHARE)
    return kept.groupBy(F.col("site").alias("t_site")).agg(F.collect_list("digest").alias("template"))


def _clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for k in range(0, b.num_rows, 1024):
            part, rows = b.slice(k, 1024), []
            for tab, item, strings, template in zip(*(part.column(i).to_pylist() for i in range(4))):
                kinds, blocks, gone = set(), [], 0
                known = frozenset(template or ())
                for s in strings or []:
                    own, more, n = clean(s, known) if s else (set(), [("text", s)], 0)
                    kinds |= own
                    blocks += more
                    gone += n
                text = "\n".join(t for _, t in blocks if t is not None) if strings else None
                rows.append((tab, item, sorted(kinds), text, [{"block_type": a, "text": t} for a, t in blocks], gone))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _CLEAN)], schema=_CLEAN)


def clean_items(items: DataFrame) -> DataFrame:
    """Clean text, blocks and kinds of markup of every item, templates removed."""
    pages = F.col("site").isNotNull() & F.exists("strings", lambda s: s.contains("<"))
    pages = F.coalesce(pages, F.lit(False))
    salts = F.array([F.lit(i) for i in range(SALTS)])
    templates = site_templates(items).withColumn("t_salt", F.explode(salts))
    # a site that holds a third of all pages is spread over SALTS tasks; items that
    # can hold no template skip the join
    salted = items.where(pages).withColumn("salt", F.pmod(F.hash("tab", "item_id"), F.lit(SALTS)))
    joined = salted.join(templates, (F.col("site") == F.col("t_site")) & (F.col("salt") == F.col("t_salt")), "left")
    rest = items.where(~pages).withColumn("template", F.lit(None).cast("array<bigint>"))
    every = joined.select("tab", "item_id", "strings", "template").unionByName(rest.select("tab", "item_id", "strings", "template"))
    return every.mapInArrow(_clean, CLEAN)


def found_kinds(cleaned: DataFrame) -> DataFrame:
    return cleaned.select("tab", "item_id", F.explode("kinds").alias("kind"))
