"""Abusive, hateful and sexual content: cumulative-link ordinal regression.

A text is read without markup and with its disguises undone (invisible and
look-alike characters, digits and signs for letters, stretched and spaced
letters). Each sentence, in any language, is cut into windows of words; a window
gives sparse features: hashed words, word pairs (adjacent and one apart) and
character n-grams. There is no word list: all weights come from the labels.

For each category a proportional-odds model (weights shared by two ordered
thresholds: some rater names the category, most do) is fitted on moderators'
labels with ridge penalties. A label belongs to a document, not to a sentence:
the window that scores highest stands for its document, and choosing it and
fitting the weights take turns. A document's score is its expected severity.

The model is fitted on about MAX_LABELS labels at most, a documented bound (all
labels of a share of the range of document hashes); every document is scored.

Defined cases: null, empty and blank texts score zero; labels without a
category, of unknown documents or of unknown categories are not used; without a
label of a category every text has the small severity that the thresholds start
from; copies of a text score alike.
"""

from __future__ import annotations

import html
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docloom.llm.leakage import _COMMAND, _INVISIBLE, _LINK, _STRIP
from docloom.session import spread

CATEGORIES = ("abusive", "hateful", "sexual")
MAX_LABELS = 20_000
HASHED = 1 << 18
FOUND_SEVERITY = 0.5  # of two grades; raters overlook cases, so a text all agree on seldom reaches two

WINDOW, STRIDE = 24, 16  # words
PAIRS = (1, 2)  # distances of word pairs
GRAMS, GRAMS_BEYOND = (3, 4, 5), (2, 3)  # character n-grams, in Latin and in other scripts
LONGEST_WORD = 20  # longer ones are no words (dumps, keys): they have no n-grams
FULL_WORDS = 8  # longer windows are scaled down by the root of their length

# Characters that stand in for a letter.
LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ѕ": "s", "ј": "j", "к": "k", "м": "m",
    "т": "t", "в": "b", "н": "h", "ԁ": "d", "ɡ": "g", "ո": "n", "ѵ": "v", "ԝ": "w", "α": "a", "ο": "o", "ρ": "p", "ε": "e",
    "ι": "i", "κ": "k", "ν": "v", "τ": "t", "υ": "u", "ı": "i", "ß": "ss", "æ": "ae", "œ": "oe", "ø": "o", "đ": "d", "ł": "l",
    "@": "a", "$": "s", "€": "e", "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b",
}


def _table() -> dict[int, str]:
    """Lower-case letters without accents and disguises; anything else is a blank."""
    out: dict[int, str] = {}
    for c in range(0x20, 0x500):
        ch = chr(c)
        base = unicodedata.normalize("NFKD", ch.lower())[:1]
        out[c] = base if base.isalnum() else " "
    for a, b in LOOKALIKES.items():
        out[ord(a)] = b
        out.setdefault(ord(a.upper()[:1]), b)
        if len(a.upper()) == 1:
            out[ord(a.upper())] = b
    for c in ("'", "’", "́", "̀", "̈"):
        out[ord(c)] = ""
    out[ord("*")] = "*"
    for c in "–—“”„«»…·•。！？，、；：「」（）\t\n\r":
        out[ord(c)] = " "
    return out


_FOLD = _table()
_STRETCH = re.compile(r"(.)\1+")
_SPELLED = re.compile(r"(?<!\w)\w(?:[ .,\-_*·•/|]{1,2}\w){2,}(?!\w)")  # letters set apart
_SPELLED_HINT = re.compile(r" \w[.,*-]? \w[.,*-]? \w")  # what such letters in pieces of their own hold; cheap to search
_SEPARATORS = re.compile(r"[ .,\-_*·•/|]+")
_MARKS = re.compile(r"'{2,}|\*\*|__|~~|`|(?<!\w)_(?=\w)|(?<=\w)_(?!\w)")
_TEMPLATE = re.compile(r"\{\{(?:[^{}|]*\|)?([^{}|]*)\}\}|\[\[(?:[^\[\]|]*\|)?([^\[\]|]*)\]\]|\[https?://\S+ ([^\[\]]*)\]|\{\\[a-z]+ ([^{}]*)\}")
_CLAUSES = re.compile(r"\n|[.!?…।؟]\s+|[。！？]")


def visible(text: str) -> str:
    """The text without markup and invisible characters, spelled-out words joined."""
    if "<" in text:
        for p, to in _STRIP:
            text = p.sub(to, text)
    if "&" in text:
        text = html.unescape(text)
    if "](" in text:
        text = _LINK.sub(r"\1", text)
    if "{" in text or "[" in text:
        text = _TEMPLATE.sub(lambda m: m.group(m.lastindex) if m.lastindex else "", text)
    if "\\" in text:
        text = _COMMAND.sub("", text)
    if not text.isascii():
        text = _INVISIBLE.sub("", unicodedata.normalize("NFKC", text))
    if "_" in text or "`" in text or "**" in text or "''" in text or "~~" in text:
        text = _MARKS.sub("", text)
    return _SPELLED.sub(_joined, text) if _SPELLED_HINT.search(text) else text


def _joined(m: re.Match) -> str:
    return _SEPARATORS.sub("", m.group())


def folded(text: str) -> list[str]:
    """Words with disguises undone and stretched letters squeezed."""
    return _STRETCH.sub(r"\1", text.translate(_FOLD)).split()


def word_features(word: str) -> np.ndarray:
    """Hashed word and character n-grams."""
    out = {zlib.crc32(word.encode()) % HASHED}
    latin = max(word) < "ɐ"
    if latin and len(word) > LONGEST_WORD:
        sizes = ()
    else:
        sizes = GRAMS if latin else GRAMS_BEYOND
    line = f"<{word}>" if latin else word
    for n in sizes:
        out.update(zlib.crc32(b"#" + line[k : k + n].encode()) % HASHED for k in range(len(line) - n + 1))
    return np.array(sorted(out), np.int32)


def pair_features(a: np.ndarray, b: np.ndarray, distance: int) -> np.ndarray:
    """Hashed pairs of word hashes."""
    mixed = (a * np.uint64(0x9E3779B97F4A7C15) + b + np.uint64(distance)) * np.uint64(0xC2B2AE3D27D4EB4F)
    return ((mixed >> np.uint64(40)) % np.uint64(HASHED)).astype(np.int32)


class Windows:
    """Windows of words, each word by its number in ``Words``, of many texts."""

    def __init__(self, flat: np.ndarray, size: np.ndarray, hashes: np.ndarray):
        self.flat, self.size = flat, size
        self.starts = np.cumsum(size) - size
        self.scale = 1 / np.sqrt(np.maximum(1.0, size / FULL_WORDS))
        owner = np.repeat(np.arange(len(size)), size)
        self.pairs = []
        for g in PAIRS:
            same = np.flatnonzero(owner[:-g] == owner[g:]) if len(owner) > g else np.zeros(0, np.int64)
            self.pairs.append((owner[same].astype(np.int32), pair_features(hashes[flat[same]], hashes[flat[same + g]], g)))
        self.owner = owner

    def scores(self, word_sums: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Scaled sum of the weights of each window's features."""
        z = np.add.reduceat(word_sums[self.flat], self.starts).astype(float) if len(self.flat) else np.zeros(0)
        for owner, feature in self.pairs:
            z += np.bincount(owner, weights[feature], len(z))
        return z * self.scale

    def take(self, chosen: np.ndarray, hashes: np.ndarray) -> Windows:
        size = self.size[chosen]
        at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(self.starts[chosen], size)
        return Windows(self.flat[at], size, hashes)


class Words:
    """Words seen so far, each folded and hashed once; pieces are blank-separated."""

    MOST_PIECES = 300_000

    def __init__(self):
        self.ids: dict[str, int] = {}
        self.pieces: dict[str, list[int]] = {}
        self.names: list[str] = []
        self.hash: list[int] = []
        self.feature: list[np.ndarray] = []
        self.sums: np.ndarray | None = None

    def number(self, word: str) -> int:
        i = self.ids.get(word)
        if i is None:
            i = self.ids[word] = len(self.hash)
            self.names.append(word)
            self.hash.append(zlib.crc32(word.encode()))
            self.feature.append(word_features(word))
        return i

    def windows(self, text: str) -> list[list[int]]:
        """Distinct windows of the text's sentences."""
        get, out = self.pieces.get, {}
        for clause in _CLAUSES.split(visible(text)):
            line: list[int] = []
            for piece in clause.split():
                own = get(piece)
                if own is None:
                    own = self.pieces[piece] = [self.number(w) for w in folded(_SPELLED.sub(_joined, piece))]
                line += own
            if len(line) <= WINDOW:
                if line:
                    out[tuple(line)] = line
            else:
                for a in range(0, len(line) - (WINDOW - STRIDE), STRIDE):
                    out[tuple(line[a : a + WINDOW])] = line[a : a + WINDOW]
        return list(out.values())

    def hashes(self) -> np.ndarray:
        return np.array(self.hash, np.uint64)

    def sums_of(self, weights: np.ndarray) -> np.ndarray:
        """Sum of the weights of each word's features, words by categories."""
        done = 0 if self.sums is None else len(self.sums)
        if done < len(self.feature):
            new = self.feature[done:]
            size = np.array([len(f) for f in new])
            rows = np.add.reduceat(weights[:, np.concatenate(new)], np.cumsum(size) - size, axis=1).T
            self.sums = rows if self.sums is None else np.concatenate([self.sums, rows])
        return self.sums

    def trim(self) -> None:
        if len(self.pieces) > self.MOST_PIECES:
            self.__init__()


# --- cumulative-link model -----------------------------------------------------------


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Ordinal:
    """P(grade >= k) = sigmoid(w x - t_k), k = 1, 2, with t_1 <= t_2 and shared w."""

    RIDGE, SPARED = 1.0, 1.0  # penalty of a weight; a feature's documents without the category that double it
    ANCHOR, ANCHOR_MASS, LEAST = (4.0, 5.0), 5.0, 2.0  # where the thresholds start, how firmly, and the least first one

    def __init__(self, weights: np.ndarray, thresholds=ANCHOR):
        self.w, self.t = weights, np.array(thresholds, float)

    def severity(self, z: np.ndarray) -> np.ndarray:
        return _sigmoid(z - self.t[0]) + _sigmoid(z - self.t[1])

    @classmethod
    def fit(cls, data: Sample, grades: np.ndarray, mass: np.ndarray, rounds: int = 4, steps: int = 60) -> Ordinal:
        """Weights from the documents' grades (0..2), each of weight ``mass``."""
        if not grades.any():
            return cls(np.zeros(HASHED))
        seen, hot, spared = data.counts(np.array([mass, mass * grades / 2, mass * (grades == 0)]))
        base = (mass * grades).sum() / 2 / mass.sum()
        # what many documents without the category hold says little: one label can't lend it weight
        ridge = cls.RIDGE * (1 + spared / cls.SPARED)
        model = cls(np.clip(np.log((hot + 5 * base) / ((seen + 5) * base)), 0, None) * 0.25)
        for turn in range(rounds):
            chosen, doc = data.worst(model.w, grades, 3 if turn < rounds - 1 else 2)
            part = data.windows.take(chosen, data.hashes)
            g, m = grades[doc], mass[doc]
            square = (part.scale**2 * m * data.feature_count(part))
            curvature = ridge + 0.125 * data.spread_back(part, square)
            w, last = model.w, model.w
            for k in range(steps):
                ahead = w + (w - last) * (k / (k + 3))
                last = w
                z = part.scores(data.word_sums(ahead), ahead)
                errors = [m * (_sigmoid(z - model.t[i]) - (g > i)) for i in (0, 1)]
                w = ahead - (data.spread_back(part, sum(errors) * part.scale) + ridge * ahead) / curvature
                for i, e in enumerate(errors):
                    model.t[i] += (e.sum() - cls.ANCHOR_MASS * (model.t[i] - cls.ANCHOR[i])) / (cls.ANCHOR_MASS + 0.5 * m.sum())
                model.t[0] = max(model.t[0], cls.LEAST)
                model.t[1] = max(model.t[1], model.t[0] + 0.1)
            model.w = w
        return model


class Sample:
    """The labelled texts on the driver: windows of words, words by features."""

    def __init__(self, words: Words, documents: list[list[list[int]]]):
        numbers: dict[tuple, int] = {}
        own = [[numbers.setdefault(tuple(w), len(numbers)) for w in d] for d in documents]
        size = np.array([len(w) for w in numbers], np.int64)
        self.hashes = words.hashes()
        self.windows = Windows(np.fromiter((x for w in numbers for x in w), np.int32, int(size.sum())), size, self.hashes)
        self.count = np.array([len(d) for d in own], np.int64)
        self.of = np.fromiter((i for d in own for i in d), np.int64, int(self.count.sum()))
        self.doc = np.repeat(np.arange(len(own)), self.count)
        self.feature_size = np.array([len(f) for f in words.feature], np.int64)
        self.features = np.concatenate(words.feature) if words.feature else np.zeros(0, np.int32)
        self.feature_starts = np.cumsum(self.feature_size) - self.feature_size
        self.word_of = np.repeat(np.arange(len(self.feature_size)), self.feature_size)

    def word_sums(self, weights: np.ndarray) -> np.ndarray:
        return np.add.reduceat(weights[self.features], self.feature_starts)

    def feature_count(self, part: Windows) -> np.ndarray:
        n = np.add.reduceat(self.feature_size[part.flat], part.starts)
        return n + sum(np.bincount(o, minlength=len(part.size)) for o, _ in part.pairs)

    def spread_back(self, part: Windows, value: np.ndarray) -> np.ndarray:
        """Sum of the windows' values over each feature they hold."""
        by_word = np.bincount(part.flat, value[part.owner], len(self.feature_size))
        out = np.bincount(self.features, by_word[self.word_of], HASHED)
        for owner, feature in part.pairs:
            out += np.bincount(feature, value[owner], HASHED)
        return out

    def counts(self, values: np.ndarray) -> list[np.ndarray]:
        """Sums of document values over the words and pairs that each document holds, once each."""
        out = [np.zeros(HASHED) for _ in values]
        size = self.windows.size[self.of]
        at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(self.windows.starts[self.of], size)
        held = np.unique(np.repeat(self.doc, size) * len(self.feature_size) + self.windows.flat[at])
        doc, word = held // len(self.feature_size), held % len(self.feature_size)
        for o, v in zip(out, values):
            o += np.bincount(self.features, np.bincount(word, v[doc], len(self.feature_size))[self.word_of], HASHED)
        pairs = self.windows.take(self.of, self.hashes).pairs
        for owner, feature in pairs:
            held = np.unique(self.doc[owner] * HASHED + feature)
            doc, feature = held // HASHED, held % HASHED
            for o, v in zip(out, values):
                o += np.bincount(feature, v[doc], HASHED)
        return out

    def worst(self, weights: np.ndarray, grades: np.ndarray, spared: int) -> tuple[np.ndarray, np.ndarray]:
        """Highest window of each document (``spared`` ones of those without the category)."""
        z = self.windows.scores(self.word_sums(weights), weights)
        order = np.lexsort((z[self.of], self.doc))
        last = np.cumsum(self.count) - 1
        chosen, docs = [], []
        for j in range(spared):
            own = np.flatnonzero((self.count > j) & ((grades == 0) | (j == 0)))
            chosen.append(self.of[order[last[own] - j]])
            docs.append(own)
        return np.concatenate(chosen), np.concatenate(docs)


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct windows of each labelled text: words by blanks, windows by line breaks."""
    words = Words()
    for b in batches:
        out = []
        for t in b.column(1).to_pylist():
            own = words.windows(t) if t else []
            out.append("\n".join(" ".join(words.names[i] for i in w) for w in own))
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], names=["doc_id", "windows"])
        words.trim()


def fit_models(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELS) -> list[Ordinal]:
    """One model per category from the moderators' labels.

    Grades of a document: 0 no rater names the category, 1 some, 2 most.
    """
    usable = labels.where(F.col("category").isin("none", *CATEGORIES) & F.col("doc_id").isNotNull())
    # all labels of the documents in a share of the hash range that holds about ``limit`` labels: no sort, no gathering
    share = min(1.0, limit / max(usable.count(), 1))
    sample = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20))).select("doc_id", "category")
    votes = sample.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("category") == c).alias(c) for c in CATEGORIES]
    ).withColumnRenamed("doc_id", "v_doc")
    texts = docs.select("doc_id", "text").where(F.col("text").isNotNull())
    # votes hold at most about MAX_LABELS small rows: broadcast, so no text is shuffled
    labelled = texts.join(F.broadcast(votes.select("v_doc")), F.col("doc_id") == F.col("v_doc"), "left_semi").mapInArrow(
        _sampled, "doc_id bigint, windows string"
    )
    rows = labelled.join(F.broadcast(votes), F.col("doc_id") == F.col("v_doc")).where("windows <> ''").select("windows", "n", *CATEGORIES).collect()
    if not rows:
        return [Ordinal(np.zeros(HASHED)) for _ in CATEGORIES]
    words = Words()
    data = Sample(words, [[[words.number(w) for w in line.split(" ")] for line in r["windows"].split("\n")] for r in rows])
    n = np.array([r["n"] for r in rows], float)
    out = []
    for c in CATEGORIES:
        named = np.array([r[c] for r in rows])
        out.append(Ordinal.fit(data, np.where(named == 0, 0, np.where(2 * named > n, 2, 1)), np.sqrt(n)))
    return out


SCORES = "doc_id bigint, source string, abusive double, hateful double, sexual double"


def score_texts(models: list[Ordinal], texts: list[str | None], words: Words | None = None) -> np.ndarray:
    """Expected severity of each text in each category: that of its highest window."""
    words = words or Words()
    out = np.zeros((len(texts), len(models)))
    flat, size, owner = [], [], []
    for r, t in enumerate(texts):
        for w in words.windows(t) if t else ():
            flat += w
            size.append(len(w))
            owner.append(r)
    if size:
        weights = np.array([m.w for m in models])
        sums = words.sums_of(weights)
        windows = Windows(np.array(flat), np.array(size), words.hashes())
        for k, m in enumerate(models):
            np.maximum.at(out[:, k], owner, m.severity(windows.scores(sums[:, k], weights[k])))
    words.trim()
    return out


def _score(weights: np.ndarray, thresholds: list[np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models, words = [Ordinal(w, t) for w, t in zip(weights.astype(np.float64), thresholds)], Words()
        for b in batches:
            for k in range(0, b.num_rows, 1024):
                part = b.slice(k, 1024)
                scores = score_texts(models, part.column(2).to_pylist(), words)
                columns = [pa.array(scores[:, i], pa.float64()) for i in range(len(models))]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *columns], names=["doc_id", "source", *CATEGORIES])

    return run


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Expected severity (0..2) of every document in each category.

    The weights that travel to the workers are 3 MB, whatever the labels hold.
    """
    models = fit_models(docs, labels)
    run = _score(np.array([m.w for m in models], np.float32), [m.t for m in models])
    return spread(docs.select("doc_id", "source", "text")).mapInArrow(run, SCORES)


def found_categories(scores: DataFrame) -> DataFrame:
    each = [F.when(F.col(c) >= FOUND_SEVERITY, F.lit(c)) for c in CATEGORIES]
    return scores.select("doc_id", F.explode(F.filter(F.array(*each), F.isnotnull)).alias("category"))
