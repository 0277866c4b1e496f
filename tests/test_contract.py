"""The contract gate (S2), statement states (G2) and the chain of periods."""

import datetime as dt
import os
import random
from collections import Counter

from pyspark.sql import functions as F

from spendloom.operators import extraction_stats, infer_year, normalise_statements, period_chain, rows_in_several_periods
from spendloom.operators.normalise import dated_rows
from spendloom.schema import RAW_ROWS_SCHEMA
from spendloom.sources import check_contract, consolidate, contract, read_statement_text, split_contract, statement_meta
from test_io import P1, P2, _files, _stmt

HEADS = ["Value Date", "Deposits", "Withdrawals", "Balance"]


def _row(s, t, i, text, heads=HEADS, extra=()):
    return (s, t, i, heads, [text, None, "1.00", "2.00", *extra])


ROWS = [
    _row("a", 0, 0, "Dec 30 x"), _row("a", 0, 1, "Jan 02 x"), _row("a", 0, 1, "Jan 02 x"), _row("a", 0, 1, "Jan 02 x"),  # twice too often
    _row("b", 0, 0, "Feb 01 x"), _row("b", 0, 0, "Feb 01 y"), _row("b", 0, 0, "Feb 01 y"),  # another row at its place
    _row("c", 0, 0, "Mar 01 x", extra=["more"]), _row("c", 0, 0, "Mar 02 x"),  # the good row of the place stays
    _row("d", 0, 0, "Apr 01 x", extra=["more"]), (None, 0, 0, HEADS, ["x"]), ("e", 0, 0, HEADS, None), ("f", 0, 0, None, ["x"]),
    ("g", 0, 0, ["Name"], ["Omar 12"]), _row("h", 0, 0, "no date"), ("i", 0, None, HEADS, ["x"]), _row("j", 0, 0, "May 05 x"),
]


def test_gate(spark, monkeypatch):
    raw = spark.createDataFrame(ROWS, RAW_ROWS_SCHEMA).repartition(4)
    for bound in (100_000, 0):
        monkeypatch.setattr(contract, "BROADCAST_KEYS", bound)
        checked = check_contract(raw).collect()
        assert sum(r.copies for r in checked) == len(ROWS)
        got = Counter({(r.statement_id, r.reason): r.copies for r in checked if r.reason})
        assert got == {("a", "repeated"): 2, ("b", "conflict"): 2, ("c", "more_cells"): 1, ("d", "more_cells"): 1, (None, "no_key"): 1,
                       ("e", "no_cells"): 1, ("f", "more_cells"): 1, ("i", "no_key"): 1}
        kept = [(r.statement_id, r.table_idx, r.row_idx, r.cells[0]) for r in checked if not r.reason]
        assert len({k[:3] for k in kept}) == len(kept) and ("b", 0, 0, "Feb 01 x") in kept and ("c", 0, 0, "Mar 02 x") in kept


def test_gate_with_many_copies_of_one_row_and_empty_table(spark):
    hot = spark.range(3000).select(F.lit("s").alias("statement_id"), F.lit(0).alias("table_idx"),
                                   F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).cast("long").alias("row_idx"),
                                   F.array(F.lit("Date")).alias("headers"), F.array(F.lit("x")).alias("cells"))
    kept, rejected = split_contract(hot)
    assert kept.count() == 2001 and [(r.reason, r.copies) for r in rejected.collect()] == [("repeated", 999)]
    none = spark.createDataFrame([], RAW_ROWS_SCHEMA)
    assert check_contract(none).count() == 0


def test_years_never_see_a_tie(spark):
    rnd = random.Random(2)
    days = [rnd.choice(["Jan 05", "Mar 09", "Dec 30"]) for _ in range(40)]
    rows = [_row("s", 0, i, d + " x") for i, d in enumerate(days)]
    twice = rows + [rows[i] for i in (0, 7, 7, 12)] + [_row("s", 0, 20, "Z Jul 01")]
    want = {r.row_idx: r.year for r in infer_year(dated_rows(spark.createDataFrame(rows, RAW_ROWS_SCHEMA))).collect()}
    for parts in (1, 3):
        kept, _ = split_contract(spark.createDataFrame(twice, RAW_ROWS_SCHEMA).repartition(parts))
        got = [(r.row_idx, r.year) for r in infer_year(dated_rows(kept)).collect()]
        assert dict(got) == want and len(got) == len(want)


def test_states_of_statements(spark):
    raw = spark.createDataFrame(ROWS, RAW_ROWS_SCHEMA)
    kept, rejected = split_contract(raw)
    asked = spark.createDataFrame([(x, "cannot be opened" if x in "jz" else None) for x in "abcdefghijyz"], "statement_id string, error string")
    stats = {r.statement_id: r for r in extraction_stats(kept, normalise_statements(kept, sort=False), asked, rejected).collect()}
    assert {s: r.status for s, r in stats.items()} == {
        "a": "partly_rejected", "b": "partly_rejected", "c": "partly_rejected", "d": "rejected", "e": "rejected", "f": "rejected",
        "g": "no_usable_table", "h": "empty_ledger", "i": "rejected", "j": "failed", "y": "no_table", "z": "failed"}
    assert stats["z"].error == "cannot be opened" and stats["j"].ledger_rows == 1 and stats["a"].rejected_rows == 2
    alone = {r.statement_id: r.status for r in extraction_stats(kept, normalise_statements(kept, sort=False), rejected=rejected).collect()}
    assert alone["d"] == "rejected" and "y" not in alone and None not in alone and alone["j"] == "ok"


def _periods(spark, rows):
    day = lambda t: t and dt.date.fromisoformat(t)
    return spark.createDataFrame([(a, n, day(s), day(e), o, c) for a, n, s, e, o, c in rows],
                                 "account string, n int, period_start date, period_end date, opening_balance double, closing_balance double")


def test_period_chain(spark):
    rows = [
        ("a", 0, "2024-01-01", "2024-01-31", 10.0, 20.0), ("a", 1, "2024-02-01", "2024-02-29", 20.0, 30.0),
        ("a", 2, "2024-03-03", "2024-03-31", 30.0, 40.0),  # two days missing
        ("a", 3, "2024-03-30", "2024-04-30", 40.0, 50.0),  # two days twice
        ("a", 4, "2024-04-05", "2024-04-10", 50.0, None),  # inside the one before
        ("a", 5, "2024-05-01", "2024-05-31", 50.5, 60.0), ("a", 6, "2024-06-01", "2024-06-30", None, 61.0),
        ("b", 0, "2024-01-01", "2024-12-31", 0.1, 0.3), ("b", 1, "2025-01-01", "2025-12-31", 0.3, 0.3),
        ("b", 2, "2025-12-31", "2025-01-01", 0.0, 9.0), (None, 0, "2024-01-01", "2024-01-02", 1.0, 1.0), ("b", 3, None, "2024-01-01", 0.0, 9.0),
    ]
    want = {("a", 0): ("first", None, None, None), ("a", 1): ("ok", 0, 0, 0.0), ("a", 2): ("gap", 2, 0, 0.0), ("a", 3): ("overlap", 0, 2, 0.0),
            ("a", 4): ("overlap", 0, 6, 0.0), ("a", 5): ("balance", 0, 0, 0.5), ("a", 6): ("ok", 0, 0, None), ("b", 0): ("first", None, None, None),
            ("b", 1): ("ok", 0, 0, 0.0), ("b", 2): ("undated", None, None, None), (None, 0): ("first", None, None, None), ("b", 3): ("undated", None, None, None)}
    df = _periods(spark, rows)
    for size in (1, 2, 100):
        got = period_chain(df, tie="n", chunk_rows=size).collect()
        assert {(r.account, r.n): (r.status, r.gap_days, r.overlap_days, r.opening_diff) for r in got} == want
    assert period_chain(df.limit(0)).count() == 0


def test_chain_of_text_statements(spark, tmp_dir):
    late = _stmt("1,00,000.00", "3 Mar 2024", "31 Mar 2024", [["3 Mar 2024", "3 Mar 2024", "x", "", " ", "5.00", "1,00,005.00"]])
    again = P2.replace("Start Date          :\t1 Feb", "Start Date          :\t31 Jan")
    for names, states, repeats in (({"p1.txt": P1, "p2.txt": P2}, ["first", "ok"], 0), ({"p1.txt": P1, "p2.txt": P2, "p3.txt": late}, ["first", "ok", "gap"], 0),
                                   ({"p1.txt": P1, "p2.txt": again}, ["first", "overlap"], 0), ({"p1.txt": P1, "p2.txt": P1}, ["first", "overlap"], 2)):
        folder = os.path.join(tmp_dir, str(len(os.listdir(tmp_dir))))
        os.mkdir(folder)
        _files(folder, names)
        parts = [read_statement_text(spark, os.path.join(folder, n)) for n in names]
        rows = consolidate(*parts).withColumn("account", F.lit("x"))
        closing = rows.groupBy("statement_id").agg(F.max_by("balance", "line_no").alias("closing_balance"))
        periods = statement_meta(spark, f"{folder}/*.txt").join(closing, "statement_id").withColumn("account", F.lit("x"))
        got = period_chain(periods, tie="statement_id").orderBy("period_start", "statement_id").collect()
        assert [r.status for r in got] == states
        same = rows_in_several_periods(rows, ["value_date", "description", "debit", "credit", "balance"])
        assert same.count() == repeats and {r.n_periods for r in same.collect()} <= {2}
