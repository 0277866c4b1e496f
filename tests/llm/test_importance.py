"""Importance resampling against a plain version."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from spendloom.llm import importance

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    return words, [" ".join(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]


def bucket(feature, n=10000):
    return zlib.crc32(feature.encode()) % n


def brute(rows, target, percent=5, min_words=20):
    held = [(i, *features(t)) for i, t in rows]
    s = Counter(bucket(f) for _, _, fs in held for f in fs)
    t = Counter(bucket(f) for x in target for f in features(x)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + 10000) / ((s[b] + 1) * (big_t + 10000)))) for b in range(10000)]
    out = []
    for i, words, fs in held:
        weight = sum(gain[bucket(f)] for f in fs)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words)])
    able = sorted((r for r in out if r[4] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0, -r[1]))
    n = percent * len(able) // 100
    rank = Counter()
    result = Counter((*r[:4], None) for r in out if r[4] < min_words)
    result.update((*r[:4], k + 1 if k < n else None) for k, r in enumerate(able))
    return result


def test_against_brute_force(spark, docs, rows):
    target = ["alphabeta GAMMA delta", None, "", "word word word one, two", rows[3][1], rows[35][1]]
    goal = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string").withColumn("doc_id", F.lit("kept"))
    for percent in (5, 30):
        got = importance.importance_sample(docs, goal, percent=percent)
        assert got.dtypes == [("doc_id", "bigint"), ("n_features", "bigint"), ("weight", "bigint"), ("score", "bigint"), ("rank", "bigint")]
        assert Counter(map(tuple, got.collect())) == brute([(r[0], r[1]) for r in rows], target, percent)


def test_a_small_head_changes_nothing(spark, docs, rows, monkeypatch):
    texts = [importance.words_of(r[1]) for r in rows]
    want = sorted(bucket(f) for _, t, *_ in rows for f in features(t)[1])
    every = Counter(w for t in texts for w in t)
    pairs = [p for p, _ in Counter(p for t in texts for p in zip(t, t[1:])).most_common(300)]
    short = [w for w, _ in every.most_common() if len(w) <= importance.HEAD_BYTES]
    for n_words, n_pairs in ((0, 0), (1, 1), (40, 10), (len(short), 300)):
        got, owner = importance.Head(short[:n_words], pairs[:n_pairs]).buckets(texts, 10000)
        assert sorted(got.tolist()) == want
        assert np.bincount(owner, minlength=len(texts)).tolist() == [len(features(t)[1]) for _, t, *_ in rows]


def test_words_and_summaries(spark):
    assert importance.words_of("Ab-C9_é ÄB\x7f漢字 x") == [w.encode() for w in ("ab", "c9", "é", "Äb", "漢字", "x")]
    kept = importance._lowered(Counter({"a": 9, "b": 7, "c": 2, "d": 2, "e": 1}), 2)
    assert kept == {"a": 7, "b": 5}
    docs = spark.createDataFrame([("a b a b",), ("a c",), ("x" * 60 + " a",), (None,)], "text string").repartition(2)
    head = importance.find_head(docs)
    assert set(head.ids) == {b"a", b"b", b"c"} and len(head.pairs) == 4  # a b, b a, a c and the end


def test_empty_tables(spark, empty, docs, rows):
    none = spark.createDataFrame([], "item_id long, text string")
    assert importance.importance_sample(empty, none).count() == 0
    got = importance.importance_sample(docs, none)
    assert Counter(map(tuple, got.collect())) == brute([(r[0], r[1]) for r in rows], [])
