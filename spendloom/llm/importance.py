"""Importance resampling towards a target distribution, over hashed n-gram features.

A text's features are its runs of one to three consecutive words, joined by a
space; a feature's bucket is the CRC-32 of its bytes modulo the number of
buckets. Buckets that the target holds more often than the corpus gain weight,
and a document's weight is the sum of its features' gains. Documents are drawn
without replacement by Gumbel noise: the highest sums of weight and noise.

Buckets are found by a head and a tail. The head holds frequent words with
their exact CRC states (of the word, and of the word after a space) and the
buckets and states of frequent pairs; it is broadcast. A feature of head words
needs no bytes: CRC is linear, so the state of `a` followed by `b` is the state
of `a` shifted by the length of `b`, plus the state of `b`, for whole arrays at
once. A feature with a word outside the head takes the CRC of its bytes. Both
give the same buckets, so what the head holds decides nothing but speed. It is
gathered from all documents: every task keeps a bounded summary of its counts
(when full, all counts are lowered by the largest that goes), and the sums of
these summaries name every word or pair that is frequent enough.

Bucket totals are exact sums over all documents and all target texts: one row
per bucket and task, added by Spark. Only the totals (one number per bucket)
and the bounded head reach the driver.

Defined results: null or empty text and text without words has no features and
weight 0; it is never drawn if `min_words` is above 0. A null id is hashed as
empty text and comes last among ties. Repeated rows are documents of their own
and draw the same noise. An empty target gains 0 everywhere it can.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendloom.llm.common import saved, utf8
from spendloom.operators.rank import placed

BUCKETS = 10_000
#: Bounds of the head: words, pairs of them, and bytes of a word.
HEAD_WORDS, HEAD_PAIRS, HEAD_BYTES = 1 << 15, 1 << 16, 48
#: Words handled at once; a longer text is handled alone.
GROUP_WORDS = 200_000

#: Every byte that is no word character (ASCII letters and digits, any byte of a longer character) becomes a space.
_WORD_BYTES = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Words in lower case (A-Z only), as UTF-8."""
    return utf8(text or "").translate(_WORD_BYTES).split()


def shift_tables(longest: int) -> np.ndarray:
    """(length, byte place, byte) -> the part of a CRC state after so many more bytes."""
    bits = np.zeros((longest + 1, 32), np.uint32)
    for bit in range(32):
        state = 1 << bit
        bits[0, bit] = state
        for k in range(1, longest + 1):
            # a zero byte, without the inversions that zlib adds at both ends
            state = zlib.crc32(b"\0", state ^ 0xFFFFFFFF) ^ zlib.crc32(b"\0", 0xFFFFFFFF)
            bits[k, bit] = state
    table = np.zeros((longest + 1, 4, 256), np.uint32)
    for place in range(4):
        for bit in range(8):
            having = (np.arange(256) >> bit & 1).astype(bool)
            table[:, place, having] ^= bits[:, 8 * place + bit, None]
    return table


class Head:
    """Frequent words with CRC states, frequent pairs with theirs, and shift tables."""

    def __init__(self, words: list[bytes], pairs: list[tuple[bytes, bytes]]):
        self.ids = {w: i for i, w in enumerate(words)}
        self.alone = np.array([zlib.crc32(w) for w in words] + [0], np.uint32)
        self.after = np.array([zlib.crc32(b" " + w) for w in words] + [0], np.uint32)
        self.size = np.array([len(w) + 1 for w in words] + [0], np.int64)
        self.shift = shift_tables(HEAD_BYTES + 1)
        known = sorted({self.ids[a] * len(words) + self.ids[b]: zlib.crc32(a + b" " + b) for a, b in pairs if a in self.ids and b in self.ids}.items())
        self.pairs = np.array([k for k, _ in known] + [np.iinfo(np.int64).max], np.int64)
        self.pair_states = np.array([s for _, s in known] + [0], np.uint32)
        self.n = len(words)

    def followed(self, state: np.ndarray, word: np.ndarray) -> np.ndarray:
        """States of texts with a space and a head word after them."""
        size, out = self.size[word], self.after[word].copy()
        for place in range(4):
            out ^= self.shift[size, place, state >> np.uint32(8 * place) & np.uint32(255)]
        return out

    def buckets(self, texts: list[list[bytes]], n_buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """(bucket, text number) of every feature of the texts, in no order."""
        words = [w for text in texts for w in text]
        n = len(words)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        sizes = np.array([len(t) for t in texts])
        number = np.repeat(np.arange(len(texts)), sizes)
        left = np.repeat(np.cumsum(sizes), sizes) - np.arange(n)  # words from here to the text's end
        ids = np.fromiter(map(self.ids.get, words, [self.n] * n), np.int64, n)
        head = ids < self.n
        one = self.alone[ids]
        for i in np.flatnonzero(~head).tolist():
            one[i] = zlib.crc32(words[i])
        out, owner = [one], [number]
        state, at = one, np.arange(n)
        for width in (2, 3):
            at = at[left[at] >= width]
            if not len(at):
                break
            last = at + width - 1
            in_head = head[at] & head[last] & (head[at + 1] if width == 3 else True)
            states = np.zeros(n, np.uint32)
            known = at[in_head]
            if width == 2:
                key = ids[known] * self.n + ids[known + 1]
                place = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
                frequent = self.pairs[place] == key
                states[known[frequent]] = self.pair_states[place[frequent]]
                known = known[~frequent]
            states[known] = self.followed(state[known], ids[known + width - 1])
            for i in at[~in_head].tolist():
                states[i] = zlib.crc32(b" ".join(words[i : i + width]))
            state = states
            out.append(states[at])
            owner.append(number[at])
        return np.concatenate(out).astype(np.int64) % n_buckets, np.concatenate(owner)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, list[list[bytes]]]]:
    """(batch, first row, word lists) of runs of rows of bounded size."""
    for batch in batches:
        held: list[list[bytes]] = []
        first, size = 0, 0
        column = batch.column("text")
        for i in range(batch.num_rows):
            held.append(words_of(column[i].as_py()))
            size += len(held[-1])
            if size >= GROUP_WORDS or i == batch.num_rows - 1:
                yield batch, first, held
                held, first, size = [], i + 1, 0


def _lowered(counts: Counter, keep: int) -> Counter:
    """The `keep` largest counts, lowered by the largest of the others."""
    if len(counts) <= keep:
        return counts
    values = np.fromiter(counts.values(), np.int64, len(counts))
    cut = int(np.partition(values, len(values) - keep - 1)[len(values) - keep - 1])
    return Counter({k: v - cut for k, v in counts.items() if v > cut})


def find_head(docs: DataFrame, n_words: int = HEAD_WORDS, n_pairs: int = HEAD_PAIRS) -> Head:
    """The head of all texts, by mergeable summaries of counts."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (Counter(), n_words), (Counter(), n_pairs)
        for _, _, texts in _groups(batches):
            for text in texts:
                kinds[0][0].update(text)
                kinds[1][0].update(zip(text, text[1:]))
            for counts, keep in kinds:
                if len(counts) > 4 * keep:
                    lower = _lowered(counts, keep)
                    counts.clear()
                    dict.update(counts, lower)
        for pair, (counts, keep) in enumerate(kinds):
            kept = [(k, v) for k, v in _lowered(counts, keep).items() if max(map(len, k if pair else [k])) <= HEAD_BYTES]
            for at in range(0, len(kept), 50_000):
                part = kept[at : at + 50_000]
                keys = [b" ".join(k) if pair else k for k, _ in part]
                yield pa.RecordBatch.from_arrays([pa.array([bool(pair)] * len(part)), pa.array(keys, pa.binary()), pa.array([v for _, v in part], pa.int64())], names=["pair", "key", "n"])

    found = docs.select("text").mapInArrow(summarise, "pair boolean, key binary, n long").groupBy("pair", "key").agg(F.sum("n").alias("n"))
    found = saved(found, "head")

    def largest(pair: bool, limit: int) -> list[bytes]:
        rows = found.filter(F.col("pair") == pair).orderBy(F.col("n").desc(), "key").limit(limit).select("key").collect()
        return [bytes(r.key) for r in rows]

    return Head(largest(False, n_words), [tuple(k.split(b" ")) for k in largest(True, n_pairs)])


def bucket_totals(docs: DataFrame, head: Head, n_buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts by bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_buckets, np.int64)
        for _, _, texts in _groups(batches):
            total += np.bincount(head.buckets(texts, n_buckets)[0], minlength=n_buckets)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(total[found])], names=["bucket", "n"])

    rows = docs.select("text").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(n_buckets, np.int64)
    out[[r.bucket for r in rows]] = [r.n for r in rows]
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the ratio of the smoothed shares), by bucket."""
    n, s_all, t_all = len(corpus), float(corpus.sum()), float(target.sum())
    ratios = ((float(t) + 1) * (s_all + n) / ((float(s) + 1) * (t_all + n)) for s, t in zip(corpus.tolist(), target.tolist()))
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], np.int64)


def document_weights(docs: DataFrame, head: Head, gains: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight) per row of (doc_id, text)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_words", "n_features", "weight"]

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, first, texts in _groups(batches):
            bucket, owner = head.buckets(texts, len(gains))
            weight = np.zeros(len(texts), np.int64)
            np.add.at(weight, owner, gains[bucket])
            n_words = np.array([len(t) for t in texts], np.int64)
            n_features = n_words + np.maximum(n_words - 1, 0) + np.maximum(n_words - 2, 0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, len(texts)), pa.array(n_words), pa.array(n_features), pa.array(weight)], names=names)

    return docs.mapInArrow(weigh, f"doc_id {kind}, n_words long, n_features long, weight long")


def importance_sample(docs: DataFrame, target: DataFrame, percent: int = 5, min_words: int = 20, seed: int = 42, n_buckets: int = BUCKETS,
                      id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text") -> DataFrame:
    """(doc_id, n_features, weight, score, rank) per row of `docs`.

    `rank` is 1, 2, 3... along falling scores (ties: smaller id) of the drawn
    documents: floor(percent / 100 of the documents with at least `min_words`
    words); null for the others.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    goal = target.select(F.col(target_text_col).alias("text"))
    head = find_head(base)
    gains = bucket_gains(bucket_totals(base, head, n_buckets), bucket_totals(goal, head, n_buckets))
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    uniform = (F.conv(F.substring(hashed, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    noise = F.floor(-1000 * F.log(-F.log(uniform)))
    scored = saved(document_weights(base, head, gains).withColumn("score", F.col("weight") + noise), "weights")
    able = F.col("n_words") >= min_words
    n_drawn = percent * scored.filter(able).count() // 100
    order = F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features").desc(), F.col("weight").desc()
    columns = ["doc_id", "n_features", "weight", "score"]
    # only documents that can be drawn are sorted; scores above the n-th are found by the places themselves
    drawn = placed(scored.filter(able).select(*columns), *order, out="place")
    rank = F.when(F.col("place") < n_drawn, F.col("place") + 1).cast("long").alias("rank")
    others = scored.filter(~able).select(*columns, F.lit(None).cast("long").alias("rank"))
    return drawn.select(*columns, rank).unionByName(others)
