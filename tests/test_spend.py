"""Sheet path: S1 read, A11 dates, L2 fill-forward, G1/G4 totals, L3 cumulative."""

import datetime as dt
import os

from pyspark.sql import functions as F

from spendloom.functions import parse_sheet_date
from spendloom.operators import cumulative, cumulatives, fill_forward, spend_by, spend_by_period
from spendloom.sources import read_sheet

HEADER = "Date,Item,Expenditure,Cumulative - Monthly,Cumulative - Yearly,Comments,Category\n"

F1 = HEADER + """1-6-2025,Bus,125,,,,Auto
,"Apples, Pears",300.5,,,,Food/Grocery
,Shared bill share,,,,-22.5,
2-6-25,Cake,130,555.5,555.5,,Food/Grocery
"""

TWO_MONTHS = HEADER + """30-6-2025,Rent,1000,,,,Home
,Tea,10,,,,Food
1-7-25,Bus,20,,,,Auto
,Milk,5.5,1035.5,1035.5,,Food
"""


def _write(tmp_dir, name, text):
    path = os.path.join(tmp_dir, name)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def _dated_sheet(spark, path):
    sheet = read_sheet(spark, path).withColumn("d", parse_sheet_date("Date"))
    return fill_forward(sheet, "d", order=["source_file", "line_no"])


def test_spend_by_category_fixture_f1(spark, tmp_dir):
    df = read_sheet(spark, _write(tmp_dir, "f1.csv", F1))
    got = {r.Category: r.Total_Expenditure for r in spend_by(df).collect()}
    assert got == {"Auto": 125.0, "Food/Grocery": 430.5, None: None}


def test_inferred_schema_matches_explicit(spark, tmp_dir):
    path = _write(tmp_dir, "f1.csv", F1)
    inferred = read_sheet(spark, path, infer=True, with_order=False)
    assert dict(inferred.dtypes)["Expenditure"] == "double"
    assert dict(inferred.dtypes)["Comments"] == "double"
    got = {r.Category: r.Total_Expenditure for r in spend_by(inferred).collect()}
    assert got == {"Auto": 125.0, "Food/Grocery": 430.5, None: None}


def test_fill_forward_blank_dates(spark, tmp_dir):
    out = _dated_sheet(spark, _write(tmp_dir, "f1.csv", F1)).orderBy("line_no").collect()
    assert [r.d for r in out] == [dt.date(2025, 6, 1)] * 3 + [dt.date(2025, 6, 2)]


def test_cumulative_resets_by_month_and_year(spark, tmp_dir):
    dated = _dated_sheet(spark, _write(tmp_dir, "two.csv", TWO_MONTHS))
    order = ["d", "line_no"]
    out = cumulative(cumulative(dated, "d", "Expenditure", "month", order=order),
                     "d", "Expenditure", "year", order=order).orderBy("line_no").collect()
    assert [r.cumulative_month for r in out] == [1000.0, 1010.0, 20.0, 25.5]
    assert [r.cumulative_year for r in out] == [1000.0, 1010.0, 1030.0, 1035.5]
    # The last yearly figure equals the sheet's own cell and the G4 total.
    assert out[-1].cumulative_year == out[-1]["Cumulative - Yearly"]
    totals = {r.period: r.total for r in spend_by_period(dated, "d", "Expenditure", "year").collect()}
    assert totals == {dt.date(2025, 1, 1): 1035.5}
    months = {r.period: r.total for r in spend_by_period(dated, "d", "Expenditure", "month").collect()}
    assert months == {dt.date(2025, 6, 1): 1010.0, dt.date(2025, 7, 1): 25.5}


def test_comments_sum_like_golden_fact(spark, tmp_dir):
    # Numeric comments may carry a split bill; they sum like any amount column.
    df = read_sheet(spark, _write(tmp_dir, "f1.csv", F1))
    assert spend_by(df.withColumn("k", F.lit(1)), "k", "Comments", "t").first().t == -22.5


def _shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_month_and_year_in_one_scan(spark):
    import datetime as dt
    import math
    import random

    rnd = random.Random(4)
    rows = [(rnd.choice(["a", "b", None]), None if i % 50 == 0 else dt.date(2023, 1, 1) + dt.timedelta(days=rnd.randint(0, 700)), i, rnd.randint(1, 999) / 100) for i in range(600)]
    rows += [("hot", dt.date(2024, 5, 1 + i % 9), 1000 + i, 1.25) for i in range(300)]
    want, sums = {}, {}
    for k, d, i, v in sorted(rows, key=lambda r: (r[1] is not None, r[1] or dt.date.min, r[2])):
        for grain in ((k, d and d.year), (k, d and d.year, d and d.month)):
            sums.setdefault(grain, []).append(v)
        want[i] = (math.fsum(sums[k, d and d.year, d and d.month]), math.fsum(sums[k, d and d.year]))
    df = spark.createDataFrame(rows, "k string, d date, i long, v double").repartition(4)
    for size in (7, 100_000):
        got = cumulatives(df, "d", "v", {"m": "month", "y": "year"}, order=["d", "i"], keys=["k"], chunk_rows=size)
        assert {r.i: (r.m, r.y) for r in got.collect()} == want
    assert _shuffles(cumulatives(df, "d", "v", {"m": "month", "y": "year"}, order=["d", "i"], keys=["k"])) == 1
