"""Queries over orders without a date agree with their oracles: no row is lost."""

import datetime as dt
import random

import duckdb
import pytest

from spendloom.plans.catalog import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", ["consolidate", "statement_text", "cumulative_spend"])
def test_orders_without_a_date(spark, tmp_dir, name):
    rnd = random.Random(8)
    day = lambda: dt.datetime(1995, 1, 1) + dt.timedelta(days=rnd.randint(0, 2500))
    rows = [(i, rnd.randint(0, 600), rnd.choice("OFP"), round(rnd.uniform(1000, 9000), 2), None if rnd.random() < 0.2 else day(), "1-URGENT") for i in range(300)]
    schema = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_dir}/orders.parquet")
    df = QUERIES[name](spark, tmp_dir)
    got = [tuple(r[c] for c in sorted(df.columns)) for r in df.collect()]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW orders AS SELECT * FROM read_parquet('{tmp_dir}/orders.parquet/*.parquet')")
    rel = con.sql(ORACLE_SQL[name])
    at = [rel.columns.index(c) for c in sorted(rel.columns)]
    want = [tuple(r[i] for i in at) for r in rel.fetchall()]
    assert len(got) == len(rows) and sorted(df.columns) == sorted(rel.columns)
    assert sorted(map(str, got)) == sorted(map(str, want))
