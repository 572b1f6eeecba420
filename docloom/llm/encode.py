"""Encoding of a corpus with a public byte-level BPE tokenizer.

Frequent words are compiled into a minimal acyclic automaton with shared
suffixes. Each state knows how many words lie below each of its edges, so the
walk of a word also adds up its rank, and the rank points at its token ids. The
automaton is packed into one file in the shared folder which every Python
worker maps into memory. All words of a batch are looked up together, one byte
position at a time. Words outside the lexicon are merged exactly by the
tokenizer's own BPE, so the ids never depend on the lexicon.

Defined cases: null and empty texts have an empty list of ids.
"""

from __future__ import annotations

import base64
import json
import os
import re
import sys
import unicodedata
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from docloom.session import delete_at_exit, materialise, scratch_path, spread

LEXICON_WORDS = 65_536
LONGEST_WORD = 24
CACHE_WORDS = 1_000_000


# --- the automaton -----------------------------------------------------------


class Lexicon:
    """Minimal acyclic automaton over byte strings; a word's rank selects its ids."""

    ARRAYS = ("keys", "targets", "before", "final", "offsets", "ids")

    def __init__(self, **arrays: np.ndarray):
        self.__dict__.update(arrays)

    @classmethod
    def compile(cls, words: dict[bytes, list[int]]) -> Lexicon:
        """Incremental construction from sorted words: the path of the word before
        is frozen bottom-up, equal states (same finality and edges) become one."""
        order = sorted(words)
        register: dict[tuple, int] = {}
        frozen: list[tuple[bool, tuple]] = []
        path: list[tuple[bool, list]] = [(False, [])]  # open states of the last word

        def freeze(depth: int) -> None:
            while len(path) > depth + 1:
                final, edges = path.pop()
                key = (final, tuple(edges))
                if key not in register:
                    register[key] = len(frozen)
                    frozen.append(key)
                byte, _ = path[-1][1][-1]
                path[-1][1][-1] = (byte, register[key])

        last = b""
        for w in order:
            same = 0
            while same < min(len(w), len(last)) and w[same] == last[same]:
                same += 1
            freeze(same)
            for byte in w[same:]:
                path[-1][1].append((byte, -1))
                path.append((False, []))
            path[-1] = (True, path[-1][1])
            last = w
        freeze(0)
        frozen.append((path[0][0], tuple(path[0][1])))
        below = np.zeros(len(frozen), dtype=np.int64)
        keys, targets, before = [], [], []
        for s, (final, edges) in enumerate(frozen):  # targets come before sources
            total = int(final)
            for byte, target in edges:
                keys.append(s << 8 | byte)
                targets.append(target)
                before.append(total)
                total += int(below[target])
            below[s] = total
        lists = [words[w] for w in order]
        return cls(
            keys=np.array(keys, dtype=np.int64), targets=np.array(targets, dtype=np.int32),
            before=np.array(before, dtype=np.int32), final=np.array([f for f, _ in frozen], dtype=np.int8),
            offsets=np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32),
            ids=np.array([i for x in lists for i in x], dtype=np.int32),
        )

    def ranks(self, words: list[bytes]) -> np.ndarray:
        """Rank of each word, -1 if it isn't in the lexicon."""
        n = len(words)
        out = np.full(n, -1, dtype=np.int64)
        if not n or not len(self.keys):
            return out
        length = np.fromiter(map(len, words), dtype=np.int64, count=n)
        start = np.concatenate([[0], np.cumsum(length)[:-1]])
        flat = np.frombuffer(b"".join(words), dtype=np.uint8)
        live, state = np.arange(n), np.full(n, len(self.final) - 1, dtype=np.int64)
        rank = np.zeros(n, dtype=np.int64)
        for at in range(int(length.max()) + 1):
            ended = length[live] == at
            done = live[ended]
            out[done] = np.where(self.final[state[done]] == 1, rank[done], -1)
            live = live[~ended]
            if not len(live):
                break
            key = state[live] << 8 | flat[start[live] + at]
            i = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            found = self.keys[i] == key
            live, i = live[found], i[found]
            state[live] = self.targets[i]
            rank[live] += self.before[i]
        return out

    def pack(self) -> bytes:
        arrays = {k: np.ascontiguousarray(getattr(self, k)) for k in self.ARRAYS}
        head = json.dumps({k: [a.dtype.str, len(a)] for k, a in arrays.items()}).encode()
        body = [len(head).to_bytes(8, "little"), head]
        size = 8 + len(head)
        for a in arrays.values():
            pad = -size % 8
            body += [b"\0" * pad, a.tobytes()]
            size += pad + a.nbytes
        return b"".join(body)

    @classmethod
    def open(cls, path: str) -> Lexicon:
        """The packed lexicon, mapped into memory."""
        raw = np.memmap(path, dtype=np.uint8, mode="r")
        n = int.from_bytes(raw[:8].tobytes(), "little")
        at, out = 8 + n, {}
        for k, (dtype, count) in json.loads(raw[8 : 8 + n].tobytes()).items():
            at += -at % 8
            size = count * np.dtype(dtype).itemsize
            out[k] = raw[at : at + size].view(dtype)
            at += size
        return cls(**out)


# --- the tokenizer -----------------------------------------------------------


def _other_numbers() -> str:
    """Class body of the characters that are numbers but no decimal digits."""
    points = [c for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c)) in ("No", "Nl")]
    spans, first = [], points[0]
    for a, b in zip(points, [*points[1:], None]):
        if b != a + 1:
            spans.append(f"{re.escape(chr(first))}-{re.escape(chr(a))}")
            first = b
    return "".join(spans)


class Tokenizer:
    """Word splitting and exact merging of a public byte-level BPE vocabulary."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bpe = tiktoken.Encoding("public", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        # the public pattern in the standard library's dialect, which is twice as fast;
        # its white space also holds the separators U+001C..U+001F, such texts take the slow way
        n = _other_numbers()
        self.find = re.compile(
            rf"'(?:[stmd]|re|ve|ll)| ?[^\W\d_{n}]+| ?[\d{n}]+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"
        ).findall
        self.odd = re.compile("[\x1c-\x1f]").search

    def merge(self, word: str) -> list[int]:
        return self.bpe._encode_single_piece(word)


_tokenizers: dict = {}
_lexicons: dict = {}
_cache: dict[str, bytes] = {}


def tokenizer(path: str, pattern: str) -> Tokenizer:
    if path not in _tokenizers:
        _tokenizers.clear()
        _tokenizers[path] = Tokenizer(path, pattern)
    return _tokenizers[path]


def lexicon(place: str) -> Lexicon:
    """The mapped lexicon of this worker: in the shared folder if that is mounted, else Spark's copy."""
    if place not in _lexicons:
        from pyspark import SparkFiles

        _lexicons.clear()
        _cache.clear()
        path = urlparse(place).path
        mounted = urlparse(place).scheme in ("", "file") and os.path.exists(path)
        _lexicons[place] = Lexicon.open(path if mounted else SparkFiles.get(os.path.basename(path)))
    return _lexicons[place]


def _learn(words: list[str], lex: Lexicon, tok: Tokenizer) -> None:
    """Put the ids of unseen words into the worker's cache."""
    if len(_cache) + len(words) > CACHE_WORDS:
        _cache.clear()
    for w, r in zip(words, lex.ranks([w.encode() for w in words]).tolist()):
        if r >= 0:
            _cache[w] = lex.ids[lex.offsets[r] : lex.offsets[r + 1]].tobytes()
        else:
            _cache[w] = np.array(tok.merge(w), dtype=np.int32).tobytes()


def encode_texts(texts: list[str | None], lex: Lexicon, tok: Tokenizer) -> pa.ListArray:
    """Token ids of each text as an Arrow list array."""
    out, size, step = [], [0], 256
    for k in range(0, len(texts), step):
        chunk = [t or "" for t in texts[k : k + step]]
        split = [tok.find(t) if not tok.odd(t) else None for t in chunk]
        new = set().union(*(s for s in split if s)).difference(_cache)
        if new:
            if len(_cache) + len(new) > CACHE_WORDS:
                _cache.clear()
                new = set().union(*(s for s in split if s))
            _learn(list(new), lex, tok)
        get = _cache.__getitem__
        for t, s in zip(chunk, split):
            ids = b"".join(map(get, s)) if s is not None else np.array(tok.bpe.encode_ordinary(t), np.int32).tobytes()
            out.append(ids)
            size.append(size[-1] + len(ids) // 4)
    flat = np.frombuffer(b"".join(out), dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(size, pa.int32()), pa.array(flat, pa.int32()))


def _encode(place: str, path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex, tok = lexicon(place), tokenizer(path, pattern)
        for b in batches:
            for k in range(0, b.num_rows, 2048):
                part = b.slice(k, 2048)
                ids = encode_texts(part.column(1).to_pylist(), lex, tok)
                yield pa.RecordBatch.from_arrays([part.column(0), ids], names=["doc_id", "ids"])

    return run


LEVELS, BINS = 64, 4096  # classes of counts per factor of two; hash bins of the class that fits only in part


def frequent_words(docs: DataFrame, n: int = LEXICON_WORDS) -> list[str]:
    """The most frequent blank-separated words of all documents, never more than ``n``.

    Counted on the JVM side with partial sums before the shuffle. The words are
    classed by the logarithm of their counts (some 3,000 classes whatever the
    corpus holds); whole classes are taken from the top while they fit. Of the
    first class that doesn't, words are taken by bins of their hash while these
    fit, so ties of any number neither pass ``n`` nor empty the list. Only the
    two histograms and the list itself reach the driver.
    Words above ``LONGEST_WORD`` characters are left to the exact merge: they
    only cost speed there and in scripts without blanks they hardly repeat.
    """
    words = docs.select(F.explode(F.split("text", "[ \n]", -1)).alias("w")).where(
        F.char_length("w").between(1, LONGEST_WORD)
    )
    counts = materialise(words.groupBy("w").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "words")
    classed = counts.select("w", F.floor(F.log2("n") * LEVELS).alias("level"), F.pmod(F.xxhash64("w"), F.lit(BINS)).alias("bin"))
    top, room = None, n
    part: int | None = None
    for r in sorted(classed.groupBy("level").agg(F.count(F.lit(1)).alias("words")).collect(), key=lambda r: -r["level"]):
        if r["words"] > room:
            part = r["level"]
            break
        top, room = r["level"], room - r["words"]
    chosen = F.lit(False) if top is None else F.col("level") >= top
    if part is not None:
        bins = 0
        for r in sorted(classed.where(F.col("level") == part).groupBy("bin").agg(F.count(F.lit(1)).alias("words")).collect()):
            if r["words"] > room:
                break
            bins, room = r["bin"] + 1, room - r["words"]
        chosen = chosen | (F.col("level") == part) & (F.col("bin") < bins)
    return sorted(r.w for r in classed.where(chosen).select("w").collect())


def build_lexicon(spark: SparkSession, docs: DataFrame, path: str, pattern: str) -> str:
    """Compile the frequent words and publish the packed automaton.

    Bounded by ``LEXICON_WORDS`` words, a few MB. Returns its address; Spark
    distributes it to workers that don't mount the shared folder.
    """
    tok = tokenizer(path, pattern)
    words = {p for w in frequent_words(docs) for x in (w, f" {w}") for p in tok.find(x)}
    packed = Lexicon.compile({w.encode(): tok.merge(w) for w in words}).pack()
    uri = scratch_path(spark, "lexicon")
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(uri)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    out = fs.create(target, False)
    out.write(bytearray(packed))
    out.close()
    delete_at_exit(spark, uri)
    spark.sparkContext.addFile(uri)
    return uri


def public_tokenizer() -> tuple[str, str]:
    """Path and word pattern of the installed public vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def encode_documents(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id and ids of every document."""
    if path is None or pattern is None:
        path, pattern = public_tokenizer()
    place = build_lexicon(docs.sparkSession, docs, path, pattern)
    return spread(docs.select("doc_id", "text")).mapInArrow(_encode(place, path, pattern), "doc_id bigint, ids array<int>")
