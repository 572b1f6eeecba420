"""Held-out passages inside a corpus, by latent semantic retrieval.

1. One pass over the corpus reads each text as words (NFKC, lower case, no
   markup, no invisible characters) and hashes them to 64 bits. It counts the
   document frequencies of a hashed vocabulary of fixed width over all documents
   and keeps the passages: stretches of text in which enough words are words of
   the items. What runs and alignments could accept lies in them.
2. Passages and items are cut into windows of twelve words at every position,
   weighted by TF-IDF. A distributed randomised SVD (subspace iteration; blocks
   of partial sums are added up before they reach the driver) gives the latent
   space. It is fitted on about FIT_WINDOWS windows, a documented bound, and on
   the items; every passage is then searched.
3. Passages with a window whose latent cosine with a window of an item is at
   least LEAST_COSINE are that item's candidates. A verbatim leak gives two equal
   windows, whose cosine is one: no threshold below one can miss it.
4. Candidates are checked: a common run of twelve words for verbatim leaks; for
   paraphrases the longest common subsequence of stretches, and of the whole
   item, and the content words (the "answer": a stretch's rarest words).

Defined cases: null, blank and wordless texts contain nothing; items below
twelve words cannot leak; items that share wording are all reported; copies of
a text are reported alike.
"""

from __future__ import annotations

import hashlib
import html
import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docloom.session import materialise, spread

# tags that may stand inside a word's line (fixed values); others separate words
_INLINE = r"</?(?:a|abbr|b|big|code|em|font|i|ins|kbd|mark|s|small|span|strike|strong|sub|sup|tt|u)\b[^<>]*>"
_STRIP = [
    (re.compile(r"<!--.*?-->", re.S), " "),
    (re.compile(r"<(script|style)\b[^<>]*>.*?</\1\s*>", re.S | re.I), " "),
    (re.compile(_INLINE, re.I), ""),
    (re.compile(r"</?[a-z][a-z0-9]*\b[^<>]*>|<![a-z][^<>]*>", re.I), " "),
]
_WIKI = [
    (re.compile(r"\{\{(?:main|see also|infobox[^{}|]*|navbox[^{}|]*|cite[^{}|]*)(?:\|[^{}]*)?\}\}", re.I), " "),
    (re.compile(r"\{\{(?:[^{}|]*\|)*([^{}|]*)\}\}"), r"\1"),
    (re.compile(r"\[\[(?:[^\[\]|]*\|)?([^\[\]|]*)\]\]"), r"\1"),
]
_EXTERNAL = re.compile(r"\[(?:https?|ftp)://[^\s\[\]]+[ \t]+([^\[\]]*)\]")
_LINK = re.compile(r"!?\[([^\[\]]*)\]\([^()\s]*(?:\s+\"[^\"]*\")?\)")
_COMMAND = re.compile(r"\\(?:begin|end|label|ref|cite|includegraphics|footnote|footnotemark)\*?(?:\[[^\]]*\])?\{[^{}]*\}|\\[a-zA-Z]+\*?(?:\[[^\]]*\])?")
_WORDS = re.compile(r"[^\W_]+")
_INVISIBLE = re.compile("[\u00ad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180b-\u180e\u200b-\u200f\u202a-\u202e\u2060-\u206f\ufe00-\ufe0f\ufeff]")


def words_of(text: str | None) -> list[str]:
    """Words of a text: runs of letters and digits after NFKC, lower case,
    without markup and invisible characters."""
    if not text:
        return []
    if "<" in text:
        for p, to in _STRIP:
            text = p.sub(to, text)
    if "&" in text:
        text = html.unescape(text)
    if "{{" in text or "[[" in text:
        for p, to in _WIKI:
            text = p.sub(to, text)
    if "[http" in text or "[ftp" in text:
        text = _EXTERNAL.sub(r"\1", text)
    if "](" in text:
        text = _LINK.sub(r"\1", text)
    if "\\" in text:
        text = _COMMAND.sub(" ", text)
    if not text.isascii():
        text = unicodedata.normalize("NFKC", _INVISIBLE.sub("", unicodedata.normalize("NFKC", text)))
    return _WORDS.findall(text.lower())


# --- words as numbers --------------------------------------------------------------------

RUN = 12  # consecutive words that make a verbatim leak; also the length of the windows
RANK, OVERSAMPLE, POWER = 64, 16, 2
LEAST_COSINE = 0.35
DIMENSIONS = 1 << 12  # hashed vocabulary of the items
MEMBERS = 1 << 21  # places of the bitmap that tells item words from others
FIT_WINDOWS = 100_000  # windows that the latent space is fitted on, beside the items' own
BLOCK_WORDS = 20_000  # item words that are searched at once
STRETCH, STEP = 18, 6  # stretches that are aligned for paraphrases
ALIKE, ANSWERS, ANSWER_SHARE = 0.6, 8, 0.75


class Numbers:
    """64-bit hashes of words, each computed once per worker."""

    MOST = 1_000_000

    def __init__(self):
        self.of: dict[str, int] = {}

    def line(self, text: str | None) -> np.ndarray:
        words = words_of(text)
        get, known = self.of.get, self.of
        if len(known) > self.MOST:
            known.clear()
        out = [get(w) for w in words]
        for i, x in enumerate(out):
            if x is None:
                w = words[i]
                out[i] = known[w] = int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "big", signed=True)
        return np.array(out, np.int64)


def dimension(ids: np.ndarray) -> np.ndarray:
    return ids & (DIMENSIONS - 1)


def place(ids: np.ndarray) -> np.ndarray:
    return (ids >> 24) & (MEMBERS - 1)


def least_shared(shortest: int) -> int:
    """Item words that a stretch must hold to be alike to a stretch of some item."""
    return math.ceil(ALIKE * min(max(shortest, RUN), STRETCH))


def passages_of(ids: np.ndarray, member: np.ndarray, least: int) -> list[np.ndarray]:
    """What of a text is covered by stretches that hold at least ``least`` item words.

    A verbatim run holds RUN of them, a stretch that is alike at least ``least``.
    """
    n = len(ids)
    if n <= STRETCH:
        return [ids] if member.sum() >= least else []
    count = np.concatenate([[0], np.cumsum(member)])
    starts = np.flatnonzero(count[STRETCH:] - count[:-STRETCH] >= least)
    if not len(starts):
        return []
    cuts = np.flatnonzero(np.diff(starts) > STRETCH) + 1
    firsts, lasts = starts[np.concatenate([[0], cuts])], starts[np.concatenate([cuts - 1, [len(starts) - 1]])]
    return [ids[a : b + STRETCH] for a, b in zip(firsts, lasts)]


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """item_id, ids of the items."""
    numbers = Numbers()
    for b in batches:
        lines = [numbers.line(t).tolist() for t in b.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lines, pa.list_(pa.int64()))], names=["item_id", "ids"])


PASSAGES = "doc_id bigint, lists array<array<bigint>>, dims array<int>, counts array<bigint>, documents bigint"
_PASSAGES = pa.schema([
    ("doc_id", pa.int64()), ("lists", pa.list_(pa.list_(pa.int64()))), ("dims", pa.list_(pa.int32())),
    ("counts", pa.list_(pa.int64())), ("documents", pa.int64()),
])


def _read(packed: bytes, least: int):
    """Pass 1: passages of each document; partial document frequencies of all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.unpackbits(np.frombuffer(packed, np.uint8)).astype(bool)
        numbers, frequency, documents = Numbers(), np.zeros(DIMENSIONS, np.int64), 0
        for b in batches:
            rows = []
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                documents += 1
                ids = numbers.line(text)
                member = bitmap[place(ids)]
                frequency[np.unique(dimension(ids[member]))] += 1
                found = passages_of(ids, member, least)
                if found:
                    rows.append((doc_id, [s.tolist() for s in found], None, None, None))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _PASSAGES)], schema=_PASSAGES)
        held = np.flatnonzero(frequency)
        last = (None, None, held.tolist(), frequency[held].tolist(), documents)
        yield pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(last, _PASSAGES)], schema=_PASSAGES)

    return run


# --- latent space ------------------------------------------------------------------------


def window_rows(lists: list[np.ndarray], weight: np.ndarray, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Latent rows of all windows of some stretches, and the stretch each belongs to.

    Term weights add up along a window, so running sums of the weighted basis
    give all windows at the cost of one row per word.
    """
    rows, owner = [], []
    for k, ids in enumerate(lists):
        d = dimension(ids)
        sums = np.concatenate([np.zeros((1, basis.shape[1])), np.cumsum(weight[d, None] * basis[d], axis=0, dtype=np.float64)])
        width = min(RUN, len(ids))
        rows.append(sums[width:] - sums[:-width])
        owner.append(np.full(len(ids) - width + 1, k))
    return np.concatenate(rows), np.concatenate(owner)


def _unit(rows: np.ndarray) -> np.ndarray:
    return (rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)).astype(np.float32)


BLOCKS = 16


def _project(basis: np.ndarray, weight: np.ndarray):
    """Partial sums of A'(A Q) over the windows of a partition, as blocks of rows.

    A window's row of A holds the weights of its words, over the root of its length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros_like(basis)
        for b in batches:
            for lists in b.column(0).to_pylist():
                for ids in lists:
                    ids = np.array(ids, np.int64)
                    if not len(ids):
                        continue
                    z, _ = window_rows([ids], weight, basis)
                    # each word adds its weight times the sum of the rows of the windows it stands in
                    width = min(RUN, len(ids))
                    sums = np.concatenate([np.zeros((1, z.shape[1])), np.cumsum(z, axis=0)])
                    at = np.arange(len(ids))
                    held = sums[np.minimum(at + 1, len(z))] - sums[np.maximum(at - width + 1, 0)]
                    np.add.at(total, dimension(ids), weight[dimension(ids), None] * held / width)
        size = DIMENSIONS // BLOCKS
        parts = [total[k * size : (k + 1) * size].astype(np.float64).tobytes() for k in range(BLOCKS)]
        yield pa.RecordBatch.from_arrays([pa.array(range(BLOCKS), pa.int32()), pa.array(parts, pa.binary())], names=["block", "x"])

    return run


def _sum_blocks(t: pa.Table) -> pa.Table:
    x = sum(np.frombuffer(v, np.float64) for v in t.column("x").to_pylist())
    return pa.table({"block": pa.array([t.column("block")[0].as_py()], pa.int32()), "x": pa.array([x.tobytes()], pa.binary())})


def latent_space(lines: DataFrame, weight: np.ndarray, seed: int = 7) -> np.ndarray:
    """Right singular vectors (dimensions by rank) of the windows of ``lines``
    (lists array<array<bigint>>), by randomised subspace iteration on A'A."""
    rank = RANK + OVERSAMPLE
    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((DIMENSIONS, rank)))[0]
    for _ in range(POWER):
        parts = lines.mapInArrow(_project(basis.astype(np.float32), weight), "block int, x binary")
        summed = parts.groupBy("block").applyInArrow(_sum_blocks, "block int, x binary").collect()  # 16 blocks
        total = np.concatenate([np.frombuffer(r.x, np.float64) for r in sorted(summed, key=lambda r: r.block)]).reshape(DIMENSIONS, rank)
        basis = np.linalg.svd(total, full_matrices=False)[0]
    return basis[:, :RANK]


# --- search and checks --------------------------------------------------------------------


def common_subsequence(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, by bits of one machine-long number."""
    places: dict[int, int] = {}
    for j, y in enumerate(b):
        places[y] = places.get(y, 0) | 1 << j
    full = (1 << len(b)) - 1
    row = full
    for x in a:
        own = row & places.get(x, 0)
        row = (row + own | row - own) & full
    return len(b) - row.bit_count()


def stretches(n: int) -> list[tuple[int, int]]:
    """Overlapping stretches of a line; the last one is flush with the end."""
    starts = list(range(0, max(n - STRETCH, 0) + 1, STEP))
    if starts[-1] + STRETCH < n:
        starts.append(n - STRETCH)
    return [(s, min(s + STRETCH, n)) for s in starts]


class Item:
    """One held-out item: its runs for the exact check, its stretches for the alignment."""

    def __init__(self, item_id: int, ids: np.ndarray, weight: np.ndarray):
        self.item_id, self.ids = item_id, ids.tolist()
        self.runs = {tuple(self.ids[k : k + RUN]) for k in range(len(self.ids) - RUN + 1)}
        self.parts = []
        rare = dict(zip(self.ids, weight[dimension(ids)].tolist()))
        for a, b in stretches(len(self.ids)):
            own = self.ids[a:b]
            answer = set(sorted(set(own), key=lambda x: (-rare[x], x))[:ANSWERS])
            self.parts.append((own, Counter(own), answer))

    def alignment(self, line: list[int], held: set[int]) -> tuple[int, float] | None:
        """Words in common, in order, and share of answer words found in the document, of the
        best stretch (or the item as a whole) that is alike; None if none is."""
        best = None
        own = [(line[a:b], Counter(line[a:b])) for a, b in stretches(len(line))]
        for words, bag, answer in self.parts:
            share = len(answer & held) / len(answer)
            if share < ANSWER_SHARE:
                continue
            least = ALIKE * len(words)
            for mine, mine_bag in own:
                if (mine_bag & bag).total() >= least:
                    common = common_subsequence(mine, words)
                    if common >= least:
                        best = max(best or (0, 0.0), (common, share))
        whole = common_subsequence(line, self.ids)
        if best:
            return max(whole, best[0]), best[1]
        answers = set().union(*(a for *_, a in self.parts))
        share = len(answers & held) / len(answers)
        return (whole, share) if len(line) <= 2 * len(self.ids) and whole >= ALIKE * len(self.ids) and share >= ANSWER_SHARE else None


    def alike_anywhere(self, ids: np.ndarray, held: set[int]) -> bool:
        """As ``alignment`` of stretches, at every position of a text."""
        for words, _, answer in self.parts:
            if len(answer & held) < ANSWER_SHARE * len(answer):
                continue
            least, width = ALIKE * len(words), min(STRETCH, len(ids))
            count = np.concatenate([[0], np.cumsum(np.isin(ids, words))])
            for a in np.flatnonzero(count[width:] - count[:-width] >= least).tolist():
                if common_subsequence(ids[a : a + width].tolist(), words) >= least:
                    return True
        return False


FOUND = "doc_id bigint, item_id bigint, verbatim boolean, cosine double, common_words int, answer_share double"
_FOUND = pa.schema([
    ("doc_id", pa.int64()), ("item_id", pa.int64()), ("verbatim", pa.bool_()), ("cosine", pa.float64()),
    ("common_words", pa.int32()), ("answer_share", pa.float64()),
])


def _search(block: list[tuple[int, list[int]]], space: np.ndarray, weight: np.ndarray, least: float, paraphrases: bool):
    """Latent search of a block of items among the passages, then the checks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines = [np.array(ids, np.int64) for _, ids in block]
        items = [Item(i, ids, weight) for (i, _), ids in zip(block, lines)]
        q, owner = window_rows(lines, weight, space)
        q, firsts = np.ascontiguousarray(_unit(q).T), np.searchsorted(owner, np.arange(len(items)))
        for b in batches:
            rows = []
            for doc_id, lists in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                held = {w for s in lists for w in s} if paraphrases else set()
                found: dict[int, tuple] = {}
                for line in lists:
                    runs = {tuple(line[k : k + RUN]) for k in range(len(line) - RUN + 1)}
                    x = _unit(window_rows([np.array(line, np.int64)], weight, space)[0])
                    best = np.full(len(items), -1.0, np.float32)
                    for k in range(0, len(x), 512):
                        best = np.maximum(best, np.maximum.reduceat((x[k : k + 512] @ q).max(axis=0), firsts))
                    for n in np.flatnonzero(best >= least).tolist():
                        old = found.get(n, (False, -1.0, None))
                        verbatim = old[0] or not items[n].runs.isdisjoint(runs)
                        aligned = items[n].alignment(line, held) if paraphrases else None
                        found[n] = (verbatim, max(old[1], float(best[n])), max(filter(None, (old[2], aligned)), default=None))
                for n, (verbatim, cosine, aligned) in sorted(found.items()):
                    if verbatim or aligned:
                        rows.append((doc_id, items[n].item_id, verbatim, cosine, *(aligned or (None, None))))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _FOUND)], schema=_FOUND)

    return run


def held_out(heldout: DataFrame) -> DataFrame:
    """item_id, ids of the items that are long enough to leak."""
    numbered = heldout.select("item_id", "text").where("text is not null").mapInArrow(_numbered, "item_id bigint, ids array<bigint>")
    return materialise(numbered.where(F.size("ids") >= RUN), "items")


def _block(items: DataFrame, k: int, blocks: int) -> list[tuple[int, list[int]]]:
    return [(r.item_id, r.ids) for r in items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k).collect()]


def _read_corpus(docs: DataFrame, items: DataFrame, shortest: int) -> tuple[DataFrame, np.ndarray]:
    """Passages of the documents, and the inverse document frequencies."""
    bitmap = np.zeros(MEMBERS, np.uint8)
    places = items.select(F.explode("ids").alias("w")).select(F.shiftright("w", 24).bitwiseAND(F.lit(MEMBERS - 1).cast("bigint")).alias("p"))
    blocks = places.groupBy(F.shiftright("p", 12).alias("block")).agg(F.collect_set(F.col("p").bitwiseAND(F.lit(4095).cast("bigint"))).alias("at"))
    for r in blocks.collect():  # at most 512 blocks of 4,096 places
        bitmap[r.block * 4096 + np.array(r.at)] = 1
    read = _read(np.packbits(bitmap).tobytes(), least_shared(shortest))
    table = materialise(spread(docs.select("doc_id", "text")).mapInArrow(read, PASSAGES), "passages")
    counts = np.zeros(DIMENSIONS)
    sums = table.where("documents is not null").select(F.inline(F.arrays_zip("dims", "counts"))).groupBy("dims").agg(F.sum("counts").alias("c"))
    for r in sums.collect():
        counts[r.dims] = r.c
    n_docs = table.agg(F.sum("documents")).first()[0] or 0
    return table.where("lists is not null").select("doc_id", "lists"), (np.log((1 + n_docs) / (1 + counts)) + 1).astype(np.float32)


def leaks(docs: DataFrame, heldout: DataFrame, least: float = LEAST_COSINE, paraphrases: bool = False) -> DataFrame:
    """doc_id, item_id of each document and item that leaked into it (see FOUND).

    The items are the query set. They are searched in blocks of about BLOCK_WORDS
    words, all in one space; what travels to the workers is a bitmap (256 KB), the
    space (1 MB) and one block of items, whatever the tables hold.
    """
    spark = docs.sparkSession
    items = held_out(heldout)
    total, shortest = items.agg(F.sum(F.size("ids")), F.min(F.size("ids"))).first()
    if not total:
        return spark.createDataFrame([], FOUND)
    passages, weight = _read_corpus(docs, items, shortest)
    size = F.aggregate("lists", F.lit(0), lambda a, x: a + F.size(x))
    n_words = passages.agg(F.sum(size)).first()[0] or 0
    # a share of the documents that holds about FIT_WINDOWS windows, and every item, fit the space
    share = int(min(1.0, FIT_WINDOWS / max(n_words, 1)) * (1 << 20))
    fitted = passages.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share).select("lists").unionByName(items.select(F.array("ids").alias("lists")))
    space = latent_space(fitted, weight).astype(np.float32)
    blocks = -(-int(total) // BLOCK_WORDS)
    found = spark.createDataFrame([], FOUND) if blocks > 1 else None
    for k in range(blocks):
        block = _block(items, k, blocks)
        if block:
            part = passages.mapInArrow(_search(block, space, weight, least, paraphrases), FOUND)
            found = part if found is None else found.unionByName(part)
    return found


# --- recall --------------------------------------------------------------------------------


def _brute(block: list[tuple[int, list[int]]], weight: np.ndarray):
    """All (document, item) pairs that the checks accept, on whole texts and at every
    position, without passages, space or cosine."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = Numbers()
        items = [Item(i, np.array(ids, np.int64), weight) for i, ids in block]
        for b in batches:
            rows = []
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = numbers.line(text)
                line = ids.tolist()
                held = set(line)
                runs = {tuple(line[k : k + RUN]) for k in range(len(line) - RUN + 1)}
                for item in items:
                    verbatim = not item.runs.isdisjoint(runs)
                    if verbatim or item.alike_anywhere(ids, held):
                        rows.append((doc_id, item.item_id, verbatim, None, None, None))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _FOUND)], schema=_FOUND)

    return run


def recall(docs: DataFrame, heldout: DataFrame) -> DataFrame:
    """kind, n_true, n_found: leaks of the documents whose id is divisible by 50, by brute
    force and by the search."""
    spark = docs.sparkSession
    items = held_out(heldout)
    total, shortest = items.agg(F.sum(F.size("ids")), F.min(F.size("ids"))).first()
    if not total:
        return spark.createDataFrame([], "kind string, n_true bigint, n_found bigint")
    _, weight = _read_corpus(docs, items, shortest)
    asked = docs.where(F.col("doc_id") % 50 == 0)
    blocks = -(-int(total) // BLOCK_WORDS)
    true = spark.createDataFrame([], FOUND)
    for k in range(blocks):
        true = true.unionByName(spread(asked.select("doc_id", "text")).mapInArrow(_brute(_block(items, k, blocks), weight), FOUND))
    found = leaks(docs, heldout, paraphrases=True).select(F.col("doc_id").alias("f_doc"), F.col("item_id").alias("f_item"))
    hit = true.join(found, (F.col("doc_id") == F.col("f_doc")) & (F.col("item_id") == F.col("f_item")), "left")
    kind = F.when(F.col("verbatim"), "verbatim").otherwise("paraphrased")
    return hit.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n_true"), F.count("f_doc").alias("n_found"))
