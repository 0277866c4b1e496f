"""Toxicity scores of text restored by a noisy-channel decoder.

Words are hidden by look-alike characters (1d10t), by spacing (m o r o n) and
by repeated letters (looooser). A hidden spelling is a lattice: every
character offers the letters it may stand for, or nothing, or a word break; a
run of three or more of one letter offers one, two or all of them, and every
space of a spaced run may be a word break. Spellings may have any length. Viterbi decoding picks the
path with the best sum of channel costs and character trigram
log-probabilities. The trigram model is counted over all documents. Only
spellings that need it are decoded; plain words are their own best path.

A document's features are its restored words and their beginnings (inflected
forms of one stem share them), as they are and with runs of a letter as one. A logistic regression over the features most
associated with the label is fitted on a bounded sample of labelled training
rows (SAMPLE_ROWS); scores look at text alone.

Defined results: null and empty texts score what the model gives a document
without features; without usable labels every document scores 0; repeated
rows score alike. A label is used once per matching document row; an id with
several labels counts as 1 if one of them is 1.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendloom.llm.common import by_batch, free_name, saved, texts

#: Letters that the character model tells apart; 0 is a boundary, 1 any other letter.
LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
SIZE = 64
_CLASS = {c: i + 2 for i, c in enumerate(LETTERS)}

#: What a look-alike may stand for.
LOOKALIKES = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "tl", "8": "b", "9": "g",
              "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i"}
STAND_IN_COST = 1.0
DROP_COST, BREAK_COST = 2.0, 1.0  # of a symbol: nothing, or a word break
LOOKALIKE_DROP_COST, LOOKALIKE_BREAK_COST = 9.0, 9.0  # of each character that may stand for a letter
REPEAT_COST = 0.7  # for each letter taken off a run
JOIN_COST = 0.5  # for each space taken out of a spaced word
REMEMBERED = 64  # letters of a decoded spelling that is kept in memory

_SPACED = re.compile(r"(?<!\w)(?:[^\W_][ .\-_*]){2,}[^\W_](?!\w)")
_TRIPLE = re.compile(r"([^\W\d_])\1\1")
_RUNS = re.compile(r"[^\W\d_]+")
_REPEATED = re.compile(r"(.)\1+", re.S)
_EDGES = re.compile(r"[\W_]+")
_TAIL = re.compile(r"[\W_]+$")
_EDGE_LETTERS = frozenset("@$+(|€£")  # not ! or <, which mostly end or open something


def letter_table() -> np.ndarray:
    """Class of each code point below 0x250; letters beyond are 1, all else 0."""
    table = np.zeros(0x250, np.int64)
    for code in range(0x250):
        if chr(code).isalpha():
            table[code] = _CLASS.get(chr(code), 1)
    return table


_TABLE = letter_table()


def trigram_counts(text: str) -> np.ndarray:
    """Counts of class trigrams, as one flat array; a break counts as one boundary."""
    codes = np.frombuffer(("  " + text.lower() + "  ").encode("utf-32-le", "surrogatepass"), np.uint32)
    classes = np.where(codes < 0x250, _TABLE[np.minimum(codes, 0x24F)], (codes >= 0x250) & (codes < 0xD800))
    # words keep two boundaries before them and one after
    return np.bincount(classes[:-2] * SIZE * SIZE + classes[1:-1] * SIZE + classes[2:], minlength=SIZE**3)


def character_model(docs: DataFrame) -> np.ndarray:
    """log P(c | a, b) over all documents, as a (SIZE, SIZE, SIZE) table."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SIZE**3, np.int64)
        for batch in batches:
            held, size = [], 0
            for text in [*batch.column("text").to_pylist(), None]:
                if held and (text is None or size > 1 << 20):
                    total += trigram_counts("  ".join(held))
                    held, size = [], 0
                if text:
                    held.append(text)
                    size += len(text)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(total[found])], names=["trigram", "n"])

    rows = docs.select("text").mapInArrow(count, "trigram int, n long").groupBy("trigram").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(SIZE**3)
    counts[[r.trigram for r in rows]] = [r.n for r in rows]
    return log_probabilities(counts.reshape(SIZE, SIZE, SIZE))


def log_probabilities(counts: np.ndarray) -> np.ndarray:
    """Trigrams smoothed by bigrams, these by single characters."""
    one = counts.sum((0, 1)) + 0.5
    one /= one.sum()
    two = counts.sum(0)
    two = (two + 20 * one) / (two.sum(1, keepdims=True) + 20)
    three = (counts + 5 * two[None]) / (counts.sum(2, keepdims=True) + 5)
    return np.log(three).astype(np.float32)


class Restorer:
    """Restores the words of a text; decoded spellings are remembered."""

    def __init__(self, model: np.ndarray, limit: int = 200_000):
        self.model, self.limit = model, limit
        self.known: dict[str, tuple[str, ...]] = {}

    def words(self, text: str) -> list[str]:
        text = text.lower()
        out: list[str] = []
        if " " in text:
            text = _SPACED.sub(self._spaced, text)
        for token in text.split():
            if token.isalpha():
                if not _TRIPLE.search(token):
                    out.append(token)
                    continue
            out += self.token(token)
        return out

    def _spaced(self, match: re.Match) -> str:
        """A run of single characters, joined into words where the model prefers that."""
        found = match[0]
        words = self.decode(found[::2], spaced=True)[0]
        # digits alone are no words unless they stand in for one whole word
        return found if len(words) != 1 and not any(map(str.isalpha, found)) else " ".join(words)

    def token(self, token: str) -> tuple[str, ...]:
        core = token
        if not token.isalpha():
            edges = _EDGES.match(token)
            core = token[len(edges[0]) if edges else 0 :]
            tail = _TAIL.search(core)
            core, after = (core[: tail.start()], tail[0]) if tail else (core, "")
            before = edges[0] if edges else ""
            if not core:
                return ()
            # a look-alike at an edge is part of the word unless it is doubled decoration
            if before[-1:] in _EDGE_LETTERS and before[-2:-1] != before[-1:]:
                core = before[-1:] + core
            if after[:1] in _EDGE_LETTERS and after[1:2] != after[:1]:
                core += after[:1]
        if core.isalpha() and not _TRIPLE.search(core):
            return (core,)
        if not self._mostly_letters(core) and not self._mostly_letters(_REPEATED.sub(r"\1", core)) and not self._all_stand_in(core):
            return tuple(_RUNS.findall(core))
        if len(core) > REMEMBERED:
            return self.decode(core)[0]
        found = self.known.get(core)
        if found is None:
            if len(self.known) >= self.limit:
                self.known.clear()
            found = self.known[core] = self.decode(core)[0]
        return found

    @staticmethod
    def _mostly_letters(core: str) -> bool:
        return 2 * sum(map(str.isalpha, core)) >= len(core)

    @staticmethod
    def _all_stand_in(core: str) -> bool:
        return any(map(str.isalpha, core)) and all(c.isalpha() or c in LOOKALIKES for c in core)

    def decode(self, spelling: str, spaced: bool = False) -> tuple[tuple[str, ...], float]:
        """(words, cost) of the best path through the lattice of a spelling, in time linear in its length.

        Between the characters of a `spaced` spelling there is a space, to be
        kept as a word break or taken out.
        """
        # state: classes of the last two letters; value: cost and path, as (letters, path before)
        states: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
        for at, (c, run) in enumerate(groupby(spelling)):
            n = len(list(run))
            edges: list[tuple[float, str]] = []
            if c.isalpha():
                edges.append((0.0, c * n))
                if n > 2:
                    edges += [(REPEAT_COST * (n - k), c * k) for k in (1, 2)]
            elif c in LOOKALIKES:
                lengths = (n,) if n < 3 else (1, 2)
                edges += [(STAND_IN_COST + REPEAT_COST * (n - k), letter * k) for letter in LOOKALIKES[c] for k in lengths]
                edges += [(LOOKALIKE_DROP_COST * n, ""), (LOOKALIKE_BREAK_COST * n, " ")]
            else:
                edges += [(DROP_COST, ""), (BREAK_COST, " ")]
            if spaced:
                if at:
                    states = self._step(states, [(JOIN_COST, ""), (0.0, " ")])
                edges = [(cost + JOIN_COST * (n - 1), letters) for cost, letters in edges]
                if n > 1 and c.isalpha():
                    # one word ends and the next begins in the run, or every letter stands alone
                    edges += [(JOIN_COST * (n - 2) + REPEAT_COST * (n - i - k), c * i + " " + c * k) for i in (1, 2) for k in (1, 2) if i + k <= n]
                    edges.append((0.0, " ".join(c * n)))
            states = self._step(states, edges)
        cost, path = min(((cost - float(self.model[a, b, 0]), path) for (a, b), (cost, path) in states.items()), key=lambda x: x[0])
        letters = []
        while path:
            letters.append(path[0])
            path = path[1]
        return tuple("".join(reversed(letters)).split()), cost

    def _step(self, states: dict[tuple[int, int], tuple[float, tuple | None]], edges: list[tuple[float, str]]) -> dict[tuple[int, int], tuple[float, tuple | None]]:
        """The best way into each state by one of the edges."""
        model = self.model
        after: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for (a, b), (cost, path) in states.items():
            for extra, letters in edges:
                x, y, total = a, b, cost + extra
                for letter in letters:
                    z = 0 if letter == " " else _CLASS.get(letter, 1)
                    total -= float(model[x, y, z])
                    x, y = (0, 0) if z == 0 else (y, z)
                if (x, y) not in after or total < after[x, y][0]:
                    after[x, y] = (total, (letters, path) if letters else path)
        return after


#: Features are words and their first 3 to 7 letters, hashed.
BEGINNINGS = range(3, 8)
FEATURE_BITS = 22
SAMPLE_ROWS = 20_000
SELECTED = 4_000
LEAST_Z = 3.0
RIDGE = 0.3
ROUNDS = 300


def word_features(word: str) -> tuple[int, ...]:
    names = []
    for form in {word, _REPEATED.sub(r"\1", word)}:
        names += ["=" + form] + [form[:k] for k in BEGINNINGS if k <= len(form)]
    return tuple(zlib.crc32(n.encode("utf-8", "surrogatepass")) >> (32 - FEATURE_BITS) for n in names)


class FeatureWords(dict):
    """word -> its features among `wanted` (all if None), remembered up to a limit."""

    def __init__(self, wanted: frozenset[int] | None, limit: int = 300_000):
        self.wanted, self.limit = wanted, limit

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= self.limit:
            self.clear()
        found = word_features(word)
        if self.wanted is not None:
            found = tuple(f for f in found if f in self.wanted)
        self[word] = found
        return found

    def of(self, words: list[str]) -> set[int]:
        return set().union(*map(self.__getitem__, set(words)))


def select_features(counts: DataFrame, n_toxic: int, n_clean: int) -> list[int]:
    """Features most associated with the label: log odds ratio over its standard error."""
    a, b = F.col("toxic") + 0.5, F.col("clean") + 0.5
    c, d = F.lit(n_toxic) - F.col("toxic") + 0.5, F.lit(n_clean) - F.col("clean") + 0.5
    odds = F.log(a / c) - F.log(b / d)
    z = odds / F.sqrt(1 / a + 1 / b + 1 / c + 1 / d)
    # sure features first: a stem that clean documents never have
    ranked = counts.filter(F.col("toxic") >= 3).withColumn("z", z).filter(F.col("z") >= LEAST_Z).orderBy(F.col("z").desc(), "feature").limit(SELECTED)
    return [r.feature for r in ranked.select("feature").collect()]


def fit(rows: list[np.ndarray], labels: np.ndarray, size: int) -> tuple[np.ndarray, float]:
    """Ridge logistic regression on sparse presence features, by accelerated gradient steps."""
    lengths = np.array([len(r) for r in rows])
    column = np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64)
    line = np.repeat(np.arange(len(rows)), lengths)
    share = labels.mean()
    weights, bias = np.zeros(size), math.log(share / (1 - share))
    w_ahead, b_ahead = weights.copy(), bias
    # curvature bounds by coordinate: presence counts
    scale = 0.25 * np.bincount(column, minlength=size) * max(1.0, lengths.mean()) + RIDGE
    b_scale = 0.25 * len(rows) * max(1.0, lengths.mean())
    for step in range(ROUNDS):
        score = np.bincount(line, w_ahead[column], minlength=len(rows)) + b_ahead
        error = 1 / (1 + np.exp(-np.clip(score, -30, 30))) - labels
        new = w_ahead - (np.bincount(column, error[line], minlength=size) + RIDGE * w_ahead) / scale
        new_b = b_ahead - error.sum() / b_scale
        pull = step / (step + 3)
        w_ahead, b_ahead = new + pull * (new - weights), new_b + pull * (new_b - bias)
        weights, bias = new, new_b
    return weights, float(bias)


class Model:
    """What scoring needs: the character model and the fitted weights."""

    def __init__(self, characters: np.ndarray, features: list[int], weights: np.ndarray, bias: float):
        self.characters, self.bias = characters, bias
        self.weights = dict(zip(features, weights.tolist()))

    def scorer(self):
        restorer, words = Restorer(self.characters), FeatureWords(frozenset(self.weights))
        weights, bias = self.weights, self.bias

        def score(text: str) -> float:
            total = bias + math.fsum(weights[f] for f in words.of(restorer.words(text)))
            return 1 / (1 + math.exp(-max(-30.0, min(30.0, total))))

        return score


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", sample_rows: int = SAMPLE_ROWS) -> Model | None:
    """Fit on rows of `docs` (doc_id, text) that `labels` marks; None if a class is missing.

    At most about `sample_rows` labelled rows are used, chosen by a hash of the id.
    """
    characters = character_model(docs)
    marks = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("label")).filter("doc_id is not null and label in (0, 1)")
    part = max(1, -(-marks.count() // sample_rows))
    marks = marks.filter(F.expr(f"pmod(xxhash64(doc_id, 'sample'), {part}) = 0")).groupBy("doc_id").agg(F.max("label").alias("label"))
    sample = saved(docs.join(marks, "doc_id").select("text", F.col("label").cast("int").alias("label")), "labelled")
    sizes = {r.label: r["count"] for r in sample.groupBy("label").count().collect()}
    if len(sizes) < 2:
        return None

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, 1 << FEATURE_BITS), np.int32)
        restorer, words = Restorer(characters), FeatureWords(None)
        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                seen[label, list(words.of(restorer.words(text)))] += 1
        found = np.flatnonzero(seen.any(axis=0))
        for at in range(0, len(found), 100_000):
            part = found[at : at + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(seen[1, part].astype(np.int64)), pa.array(seen[0, part].astype(np.int64))],
                                             names=["feature", "toxic", "clean"])

    counts = sample.mapInArrow(count, "feature int, toxic long, clean long").groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    features = select_features(counts, sizes[1], sizes[0])
    place = {f: i for i, f in enumerate(features)}

    def present(batch: pa.RecordBatch) -> pa.RecordBatch:
        restorer, words = Restorer(characters), FeatureWords(frozenset(place))
        rows = [sorted(place[f] for f in words.of(restorer.words(t))) for t in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("label"), pa.array(rows, pa.list_(pa.int32()))], names=["label", "found"])

    rows = by_batch(sample, present, "label int, found array<int>").collect()
    rows.sort(key=lambda r: (r.label, r.found))
    weights, bias = fit([np.array(r.found, np.int64) for r in rows], np.array([r.label for r in rows], float), len(features))
    return Model(characters, features, weights, bias)


def score(docs: DataFrame, model: Model | None, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """All columns of `docs` and the score (0 to 1)."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = model.scorer() if model else lambda _: 0.0
        for batch in batches:
            if batch.num_rows:
                found = [judge(t or "") for t in batch.column(names.index(text_col)).to_pylist()]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], names=[*names, score_col])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, f"{fields}, `{score_col}` double")


def training_labels(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Labels of the rows outside the held-out third: crc32 of the id's text mod 3 is not 1."""
    return labels.filter(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 != 1)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of `docs`."""
    base = texts(docs, id_col, text_col)
    model = train(base, training_labels(labels, id_col))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    scored = score(base, model).select("doc_id", held_out.alias("held_out"), "score")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """The rows of `docs` whose score is below the threshold, all columns as they are."""
    model = train(texts(docs, id_col, text_col), training_labels(labels, id_col))
    name = free_name(docs, "score")
    return score(docs, model, text_col, name).filter(F.col(name) < threshold).drop(name)
