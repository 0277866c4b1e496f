"""Sums of doubles equal math.fsum, whatever the order and partitions."""

import math
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spendloom.functions import exact_sum
from spendloom.operators import cumulatives, spend_by


def _totals(spark, groups, parts):
    rows = [(k, v) for k, vs in groups.items() for v in vs]
    random.Random(parts).shuffle(rows)
    df = spark.createDataFrame(rows, "k int, v double").repartition(parts)
    return {r.k: r.t for r in df.groupBy("k").agg(exact_sum("v").alias("t")).collect()}


def _same(got, want):
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == want[k], (k, got[k], want[k])


def test_sums_of_all_kinds(spark):
    rnd = random.Random(7)
    groups = {
        0: [0.1] * 10, 1: [1e16, 1.0, -1e16], 2: [1e23, 3.14, -1e23, 1e-9], 3: [-0.01] * 7 + [0.07],
        4: [rnd.uniform(-1e6, 1e6) for _ in range(500)], 5: [rnd.uniform(0, 1e-6) for _ in range(200)],
        6: [round(rnd.uniform(0, 1e5), 2) for _ in range(1000)], 7: [2.0**53, 1.0, 2.0**-60], 8: [2.0**53, 1.0], 9: [-(2.0**53), -1.0, -(2.0**-80)],
        10: [0.0, -0.0], 11: [2.0**53 + 2, 1.0], 12: [rnd.choice([-1, 1]) * rnd.random() * 10.0 ** rnd.randint(-10, 23) for _ in range(400)],
    }
    want = {k: math.fsum(v) for k, v in groups.items()}
    for parts in (1, 5):
        _same(_totals(spark, groups, parts), want)


def test_missing_and_too_large(spark):
    df = spark.createDataFrame([(1, None), (2, float("nan")), (2, 2.5), (3, float("inf")), (4, 1e24), (4, 1.5), (5, None), (5, 0.25)], "k int, v double")
    got = {r.k: r.t for r in df.groupBy("k").agg(exact_sum("v").alias("t")).collect()}
    assert got == {1: None, 2: 2.5, 3: None, 4: 1.5, 5: 0.25}
    assert df.where("k > 9").agg(exact_sum("v")).first()[0] is None
    assert {r.k: r.t for r in spend_by(df.withColumn("v", F.col("v").cast("string")), "k", "v", "t").collect()} == got
    dec = spark.createDataFrame([(1, "900000000000000.01"), (1, "0.03")], "k int, v string").withColumn("v", F.col("v").cast("decimal(18,2)"))
    assert spend_by(dec, "k", "v", "t").first().t == 900000000000000.04


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(st.floats(-1e20, 1e20).filter(lambda x: x == 0 or abs(x) > 1e-10), min_size=1, max_size=30), min_size=1, max_size=40))
def test_any_sums(spark, lists):
    _same(_totals(spark, dict(enumerate(lists)), 3), {k: math.fsum(v) for k, v in enumerate(lists)})


def test_running_totals(spark):
    rnd = random.Random(3)
    rows = [(i, round(rnd.uniform(-1e5, 1e5), 4) if i % 9 else None) for i in range(300)]
    df = spark.createDataFrame(rows, "i int, v double").withColumn("d", F.expr("date'2024-01-01' + i"))
    got = cumulatives(df, "d", "v", {"m": "month", "y": "year"}, order=["d"], chunk_rows=20).collect()
    for r in got:
        assert r.y == math.fsum(v or 0.0 for i, v in rows if i <= r.i)
        assert r.m == math.fsum(x.v or 0.0 for x in got if x.i <= r.i and x.d.month == r.d.month)
