"""Quality scores: each part against a plain version, the whole by held-out accuracy and edge cases."""

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from spendloom.llm import quality_score as q


def test_features_approximate_a_gaussian_kernel():
    rnd = np.random.default_rng(1)
    x = rnd.standard_normal((60, len(q.STATISTICS)))
    features = q.RandomFeatures(np.zeros(x.shape[1]), np.ones(x.shape[1]), size=8192, width=1.2)
    z = features.of(x)[:, :-1]
    far = ((x[:, None] - x[None]) ** 2).sum(-1)
    want = np.exp(-far / (2 * 1.2**2 * x.shape[1]))
    assert np.abs(z @ z.T / z.shape[1] - want).max() < 0.06


def test_pool_adjacent_violators():
    rnd = np.random.default_rng(2)
    for _ in range(50):
        n = rnd.integers(1, 6, 12).astype(float)
        ones = np.minimum(n, rnd.integers(0, 6, 12)).astype(float)
        centres, shares = q.pool_adjacent(np.arange(12.0), n, ones)
        assert (np.diff(shares) > 0).all() and (np.diff(centres) > 0).all()
        # the isotonic fit by its min-max formula
        total = lambda a, k: k[a[0] : a[1] + 1].sum()
        want = [max(min(total((i, j), ones) / total((i, j), n) for j in range(k, 12)) for i in range(k + 1)) for k in range(12)]
        got = shares[np.searchsorted(np.cumsum(_sizes(want, shares)), np.arange(12), "right")]
        assert np.allclose(got, want)


def _sizes(want, shares):
    return [int(np.isclose(want, share).sum()) for share in shares]


def _labelled(spark, rnd, n):
    x = rnd.standard_normal((n, len(q.STATISTICS))).astype(np.float32)
    label = (x[:, 0] * x[:, 1] + 0.3 * rnd.standard_normal(n) > 0).astype(int)
    return x, label, spark.createDataFrame([(r.tolist(), int(v), i % 2) for i, (r, v) in enumerate(zip(x, label))], "x array<float>, label int, fold int")


def test_sums_do_not_depend_on_partitions(spark):
    x, label, df = _labelled(spark, np.random.default_rng(3), 300)
    mean, spread = q.moments(df)
    assert np.allclose(mean, x.mean(0), atol=1e-4) and np.allclose(spread, x.std(0), atol=1e-3)
    features = q.RandomFeatures(mean, spread, size=24)
    sums = [q.normal_equations(df.repartition(k), features) for k in (1, 5)]
    assert (sums[0] == sums[1]).all()
    z = np.hstack([features.of(x.astype(float)), label[:, None]])
    for fold in (0, 1):
        own = z[np.arange(300) % 2 == fold]
        assert np.allclose(sums[0][fold], own.T @ own, atol=1e-6)
    models = [q.fit(df.repartition(k)) for k in (1, 4)]
    assert (models[0].weights == models[1].weights).all() and (models[0].shares == models[1].shares).all()
    assert q.fit(df.limit(0)) is None


def prose(rnd, n):
    words = ["".join(rnd.choice("aeioulnrst") for _ in range(rnd.randint(2, 8))) for _ in range(n)]
    return "\n".join(" ".join(words[i : i + 12]).capitalize() + "." for i in range(0, n, 12))


def _documents(rnd, n):
    rows = []
    for i in range(n):
        text, good = prose(rnd, rnd.randint(30, 150)), int(rnd.random() < 0.7)
        if not good:
            kind = rnd.randrange(3)
            text = text.upper() if kind == 0 else " ".join(w + rnd.choice(["###", "$$$", "&&"]) for w in text.split()) if kind == 1 else " ".join([text.split()[0]] * 80)
        rows.append((i, text, good))
    return rows


def _held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


def test_held_out_accuracy_and_edge_cases(spark):
    rows = _documents(random.Random(5), 900)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(5000, None), (5001, ""), (5002, " \n\t"), (5003, "x" * 100_000), (None, rows[0][1]), (0, rows[0][1])],
                                 "doc_id long, text string").repartition(3).select("*", *[F.lit("kept").alias(c) for c in ("x", "label", "fold", "score")])
    labels = spark.createDataFrame([(i, g, 0) for i, _, g in rows] + [(rows[1][0], 0, 0), (None, 1, 0), (5001, 7, 0)], "doc_id long, quality int, toxic int")
    out = q.quality_scores(docs, labels).collect()
    assert len(out) == 906 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)
    assert all(r.held_out == (r.doc_id is not None and _held(r.doc_id)) for r in out)
    good = {i: g for i, _, g in rows}
    held = [(r.predicted, good[r.doc_id]) for r in out if r.held_out and r.doc_id in good]
    assert sum(a == b for a, b in held) >= 0.97 * len(held) > 0
    # labels of the held-out third are not read, and equal texts score alike
    other = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r.doc_id: r.score for r in q.quality_scores(docs.repartition(7), other).collect()}
    assert all(abs(again[r.doc_id] - r.score) < 1e-9 for r in out)
    assert len({r.score for r in out if r.doc_id in (None, 0)}) == 1 and len({r.score for r in out if r.doc_id in (5000, 5001, 5002)}) == 1


def test_without_labels_or_documents(spark, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert [(r.score, r.predicted) for r in q.quality_scores(docs, none).collect()] == [(0.5, 1)] * 2
    assert q.quality_scores(empty, none).count() == 0
    one = spark.createDataFrame([(2, 1, 0), (1, 1, 0)], "doc_id long, quality int, toxic int")
    assert all(r.score > 0.9 for r in q.quality_scores(docs, one).collect())
