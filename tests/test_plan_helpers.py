"""``bind`` (evaluate once, filters stay above), the session and its scratch folder."""

import pytest
from pyspark.sql import functions as F

from spendloom.operators.bind import bind
from spendloom.session import checkpoint_dir, get_session


def test_bind_values_equal_unbound_expressions(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None), (3, "x")], "i int, t string")
    exprs = [F.upper("t").alias("u"), F.length("t").alias("n")]
    got = sorted(bind(df, *exprs).select("i", "u", "n").collect())
    want = sorted(df.select("i", *exprs).collect())
    assert got == want
    assert bind(df, *exprs, keep=["i"]).columns == ["i", "u", "n"]


def test_filter_on_bound_column_is_not_inlined(spark):
    df = spark.range(50).select(F.col("id"), F.concat(F.lit("k"), F.col("id").cast("string")).alias("t"))
    heavy = F.regexp_replace(F.upper("t"), "K", "Q")
    q = bind(df, heavy.alias("h")).where(F.col("h").startswith("Q") & F.col("h").endswith("7"))
    plan = q._jdf.queryExecution().optimizedPlan().toString()
    filt = [ln for ln in plan.splitlines() if "Filter" in ln]
    # The pushed-down filter reads the bound attribute, not the expression.
    assert filt and all("regexp_replace" not in ln for ln in filt)
    assert plan.count("regexp_replace") == 1
    assert sorted(r.id for r in q.collect()) == [7, 17, 27, 37, 47]


def test_launcher_settings_survive(spark):
    keys = {"spark.sql.session.timeZone": "Asia/Kolkata", "spark.sql.adaptive.skewJoin.enabled": "false"}
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        again = get_session("another")
        assert {k: again.conf.get(k) for k in keys} == keys
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_no_machine_local_scratch_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError):
        checkpoint_dir(Session())
