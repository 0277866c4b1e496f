"""Two-level ordered scans equal a single ordered pass (brute force)."""

import datetime as dt
import random

from pyspark.sql import functions as F

from spendloom.operators.ordered import fill_forward, previous_value, rollover_count, running_sum, scan


def _data(seed=3, n=400):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        # "" is the NULL stand-in of the scan keys: both must stay separate groups.
        part = rnd.choice(["a", "b", "c", "", None])
        val = None if rnd.random() < 0.3 else round(rnd.uniform(-50, 50), 2)
        rows.append((part, i, val))
    rnd.shuffle(rows)
    return rows


def _brute(rows):
    by_part = {}
    for p, i, v in sorted(rows, key=lambda r: r[1]):
        by_part.setdefault(p, []).append((i, v))
    run, ffill, prev = {}, {}, {}
    for p, seq in by_part.items():
        total, last, before = 0.0, None, None
        for k, (i, v) in enumerate(seq):
            total = round(total + (v or 0.0), 2)
            run[i] = total
            if v is not None:
                last = v
            ffill[i] = last
            prev[i] = before
            before = v
    return run, ffill, prev


SIZES = (1, 7, 1000)


def test_scans_match_brute_force_for_any_chunking(spark):
    rows = _data()
    df = spark.createDataFrame(rows, "p string, i long, v double").repartition(5)
    run, ffill, prev = _brute(rows)
    exact = df.withColumn("d", F.coalesce("v", F.lit(0.0)).cast("decimal(18,2)"))
    for size in SIZES:
        r = running_sum(exact, "d", "out", part="p", order="i", chunk_rows=size)
        assert {x.i: float(x.out) for x in r.collect()} == run
        f = fill_forward(df, "v", "out", part="p", order="i", chunk_rows=size)
        assert {x.i: x.out for x in f.collect()} == ffill
        g = previous_value(df, "v", "out", part="p", order="i", chunk_rows=size)
        assert {x.i: x.out for x in g.collect()} == prev


def test_strictly_before_and_leading_nulls(spark):
    rows = [("a", i, float(i) if i % 4 == 2 else None) for i in range(40)]
    df = spark.createDataFrame(rows, "p string, i long, v double")
    for size in SIZES:
        f = fill_forward(df, "v", "out", part="p", order="i", chunk_rows=size, inclusive=False)
        want = {i: max((k for k in range(2, i, 4)), default=None) for i in range(40)}
        assert {x.i: x.out for x in f.collect()} == {i: w if w is None else float(w) for i, w in want.items()}
        r = running_sum(df, "v", "out", part="p", order="i", chunk_rows=size)
        sums = {i: sum(k for k in range(2, i + 1, 4)) if i > 1 else None for i in range(40)}
        assert {x.i: x.out for x in r.collect()} == sums


def test_several_order_columns_of_mixed_kinds(spark):
    rnd = random.Random(5)
    day0 = dt.datetime(2024, 1, 1)
    rows = [(None if n % 7 == 0 else day0 + dt.timedelta(hours=rnd.randint(0, 500)), n, rnd.randint(0, 9)) for n in range(300)]
    want, total, last, bumps = {}, 0, None, 0
    for t, n, v in sorted(rows, key=lambda r: (r[0] is not None, r[0] or day0, r[1])):
        total += v
        bumps += last is not None and v < last
        last = v
        want[n] = (total, bumps)
    for kind in ("timestamp", "timestamp_ntz", "date"):
        df = spark.createDataFrame(rows, "t timestamp_ntz, n long, v long").withColumn("t", F.col("t").cast(kind))
        if kind == "date":  # another order: ties by n
            want, total, last, bumps = {}, 0, None, 0
            for t, n, v in sorted(rows, key=lambda r: (r[0] is not None, r[0].date() if r[0] else day0.date(), r[1])):
                total += v
                bumps += last is not None and v < last
                last = v
                want[n] = (total, bumps)
        for size in SIZES:
            both = rollover_count(running_sum(df, "v", "s", order=["t", "n"], chunk_rows=size), "v", "b", order=["t", "n"], chunk_rows=size)
            assert {x.n: (x.s, x.b) for x in both.collect()} == want


def test_global_order_without_partition(spark):
    rows = [(None, i, float(i) if i % 3 == 0 else None) for i in range(50)]
    df = spark.createDataFrame(rows, "p string, i long, v double")
    f = fill_forward(df, "v", "out", order="i", chunk_rows=4)
    got = {x.i: x.out for x in f.collect()}
    assert got == {i: float(i - i % 3) for i in range(50)}


def _hot(spark, n=30_000):
    """A third of all rows on one key, the others on small keys."""
    return spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 997 + 1).alias("p"),
                                 F.date_add(F.lit(dt.date(2020, 1, 1)), (F.col("id") % 2000).cast("int")).alias("day"),
                                 F.col("id").alias("i"), (F.col("id") % 11).alias("v"))


def test_a_hot_key_is_many_small_groups(spark):
    df = _hot(spark)
    s = scan(df, "p", ["day", "i"], chunk_rows=500)
    groups = s.rows.groupBy("p", "__chunk").count().agg(F.max("count")).first()[0]
    carry = s.rows.where("__large").select("p", "__chunk").distinct().groupBy("p").count().agg(F.max("count")).first()[0]
    assert groups <= 1500  # of 10,000 rows on the key
    assert carry <= 10_000 // 500 + 1  # the longest carry group
    plain = running_sum(df, "v", "out", "p", ["day", "i"])
    cut = running_sum(df, "v", "out", "p", ["day", "i"], chunk_rows=500)
    assert cut.exceptAll(plain).count() == 0 and plain.exceptAll(cut).count() == 0


def _exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning")


def test_the_big_side_is_shuffled_once(spark, monkeypatch):
    from spendloom.operators import ordered

    df = _hot(spark)
    assert _exchanges(running_sum(df, "v", "out", "p", ["day", "i"])) == 1
    # with large keys and without broadcast: one exchange for the rows, two for the summaries
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert _exchanges(running_sum(df, "v", "out", "p", ["day", "i"], chunk_rows=500)) <= 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # beyond the broadcast bound the same result comes from plain joins
    want = running_sum(df, "v", "out", "p", ["day", "i"])
    monkeypatch.setattr(ordered, "BROADCAST_ROWS", 0)
    got = running_sum(df, "v", "out", "p", ["day", "i"], chunk_rows=500)
    assert got.exceptAll(want).count() == 0


def test_null_keys_stay_apart(spark):
    """NULL date keys and 1970-01-01 keys are separate groups; a NULL order
    value sorts first in its group, across chunks."""
    epoch, other = dt.date(1970, 1, 1), dt.date(2024, 5, 6)
    rnd = random.Random(11)
    rows = []
    keys = [None, epoch, other]
    for n in range(300):
        # One NULL order value per group (rows 0-2), so the order is total.
        p = keys[n] if n < 3 else rnd.choice(keys)
        rows.append((p, None if n < 3 else n, n % 13 + 1))
    df = spark.createDataFrame(rows, "p date, i long, v long").repartition(4)
    want = {}
    for key in keys:
        total = 0
        for r in sorted((r for r in rows if r[0] == key), key=lambda r: (r[1] is not None, r[1] or 0)):
            total += r[2]
            want[(key, r[1])] = total
    for size in (1, 5, 1000):
        r = running_sum(df, "v", "out", part="p", order="i", chunk_rows=size)
        assert {(x.p, x.i): x.out for x in r.collect()} == want


def test_empty_input(spark):
    df = spark.createDataFrame([], "p string, i long, v long")
    assert running_sum(df, "v", "out", "p", "i").count() == 0
    assert fill_forward(df, "v", "out", order="i").count() == 0


def _longest(df, part, order, chunk_rows):
    return scan(df, part, order, chunk_rows=chunk_rows).rows.groupBy(*([part] if part else []), "__chunk").count().agg(F.max("count")).first()[0]


def test_chunks_follow_places_not_values(spark):
    n = 20_000
    outlier = spark.range(n).select(F.when(F.col("id") == 7, F.lit(10**15)).otherwise(F.col("id")).alias("i"), (F.col("id") % 5).alias("v"))
    assert _longest(outlier, None, ["i"], 1000) <= 1000
    same_day = spark.range(n).select(F.lit(1).alias("k"), F.lit(dt.date(2024, 1, 1)).alias("day"), F.concat(F.lit("row "), F.col("id").cast("string")).alias("t"), F.col("id"))
    assert _longest(same_day, "k", ["day", "t"], 1000) <= 1000
    seconds = same_day.withColumn("at", F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, id)"))
    assert _longest(seconds, "k", ["at"], 1000) <= 1000
    equal = spark.range(n).select(F.lit("x").alias("k"), F.lit(1).alias("o"), F.lit(2).alias("v"))
    assert _longest(equal, "k", ["o"], 1000) <= 1000


def test_text_orders_and_ties_in_the_leading_column(spark):
    rnd = random.Random(9)
    rows = [("k%d" % (i % 3 and 1), "same", rnd.choice(["a", "B", "ab", "é"]) + str(i), rnd.randint(-9, 9)) for i in range(300)]
    want, total, before = {}, {}, {}
    for k, lead, t, v in sorted(rows, key=lambda r: r[2].encode()):
        total[k] = total.get(k, 0) + v
        want[t] = (total[k], before.get(k))
        before[k] = v
    df = spark.createDataFrame(rows, "k string, lead string, t string, v long").repartition(4)
    for size in SIZES:
        got = previous_value(running_sum(df, "v", "s", "k", ["lead", "t"], size), "v", "p", "k", ["lead", "t"], size)
        assert {r.t: (r.s, r.p) for r in got.collect()} == want


def test_rows_equal_in_the_whole_order_have_one_sequence(spark):
    df = spark.createDataFrame([(1, 1)] * 60, "o long, v long")
    for size in SIZES:
        assert sorted(r.s for r in running_sum(df, "v", "s", order="o", chunk_rows=size).collect()) == list(range(1, 61))
