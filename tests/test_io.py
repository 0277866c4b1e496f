"""Statement readers (S5-S7), consolidation (U2), reconciliation (L4), sinks."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from spendloom.operators import extraction_stats, normalise_statements, reconcile, running_sum, spend_by
from spendloom.schema import LEDGER_SCHEMA, RAW_ROWS_SCHEMA
from spendloom.sources import (captioned_csv, consolidate, preview, read_raw_tables, read_sheet, read_statement_csv,
                               read_statement_periods, read_statement_text, recover_ledger, sinks, statement_meta, write_ledger)

T = "\t"
HDR = T.join(["Txn Date", "Value Date", "Description", "Ref No./Cheque No.", "        Debit",
              "Credit", "Balance"]) + T


def _stmt(opening, start, end, rows):
    lines = [f"Account Name       :{T}X", f"Balance on {start}        :{T}{opening}",
             f"Start Date          :{T}{start}", f"End Date            :{T}{end}", HDR]
    lines += [T.join(r) for r in rows]
    lines += ["", "**This is a computer generated statement."]
    return "\n".join(lines) + "\n"


P1 = _stmt("1,000.00", "1 Jan 2024", "31 Jan 2024", [
    ["1 Jan 2024", "1 Jan 2024", "   TO TRANSFER-UPI/DR/000000000001/PAYEE A/BANK/id/UPI--", "REF 1", "400.00", " ", "600.00"],
    ["2 Jan 2024", "2 Jan 2024", "   CREDIT INTEREST---", "", " ", "1,00,000.00", "1,00,600.00"],
])
P2 = _stmt("1,00,600.00", "1 Feb 2024", "29 Feb 2024", [
    ["3 Feb 2024", "3 Feb 2024", "   ATM WDL", "REF 2", "600.00", " ", "1,00,000.00"],
])
CSV = ("﻿Value Date,Description,Ref No./Cheque No.,        Debit,Credit,Balance\n"
       "01-Jan-24,   TO TRANSFER-UPI/DR/000000000001/PAYEE A/BANK/id/UPI--,REF 1,400.00, ,600.00\n"
       "02-Jan-24,   CREDIT INTEREST---,, ,\"1,00,000.00\",\"1,00,600.00\"\n"
       "03-Feb-24,   ATM WDL,REF 2,600.00, ,\"1,00,000.00\"\n")


def _files(tmp_dir, named):
    for name, text in named.items():
        with open(os.path.join(tmp_dir, name), "w", encoding="utf-8") as f:
            f.write(text)
    return tmp_dir


def test_statement_text_rows(spark, tmp_dir):
    d = _files(tmp_dir, {"p1.txt": P1, "p2.txt": P2})
    rows = read_statement_text(spark, os.path.join(d, "*.txt")).orderBy("txn_date").collect()
    assert [(r.txn_date, r.debit, r.credit, r.balance) for r in rows] == [
        (dt.date(2024, 1, 1), 400.0, None, 600.0),
        (dt.date(2024, 1, 2), None, 100000.0, 100600.0),
        (dt.date(2024, 2, 3), 600.0, None, 100000.0),
    ]
    assert rows[0].description == "TO TRANSFER-UPI/DR/000000000001/PAYEE A/BANK/id/UPI--"
    assert rows[0].ref_no == "REF 1" and rows[1].ref_no == ""


def test_statement_meta(spark, tmp_dir):
    d = _files(tmp_dir, {"p1.txt": P1, "p2.txt": P2})
    meta = {os.path.basename(r.statement_id): r for r in statement_meta(spark, os.path.join(d, "*.txt")).collect()}
    m1, m2 = meta["p1.txt"], meta["p2.txt"]
    assert (m1.period_start, m1.period_end) == (dt.date(2024, 1, 1), dt.date(2024, 1, 31))
    assert (m1.opening_balance, m1.opening_balance_date) == (1000.0, dt.date(2024, 1, 1))
    assert m2.opening_balance == 100600.0
    assert set(m1.asDict()) == {"statement_id", "period_start", "period_end", "opening_balance",
                                "opening_balance_date", "status"}


def test_header_less_and_repeated_opening_balance(spark, tmp_dir):
    twice = P1.replace("Start Date", f"Balance on 31 Jan 2024        :{T}10.00\nStart Date", 1)
    long_key = P1.replace("Balance on 1 Jan 2024", "Balance on" + " " * 80 + "1 Jan 2024")
    d = _files(tmp_dir, {"p1.txt": P1, "none.txt": f"Start Date :{T}1 Jan 2024\nno header here\n", "twice.txt": twice, "long.txt": long_key})
    meta = {os.path.basename(r.statement_id): r for r in statement_meta(spark, os.path.join(d, "*.txt")).collect()}
    assert meta["none.txt"].status == "no_header" and meta["none.txt"].period_start == dt.date(2024, 1, 1)
    for name in ("p1.txt", "twice.txt", "long.txt"):
        m = meta[name]
        assert (m.status, m.opening_balance, m.opening_balance_date) == ("ok", 1000.0, dt.date(2024, 1, 1))
    rows = read_statement_text(spark, os.path.join(d, "*.txt"))
    assert {os.path.basename(r.statement_id) for r in rows.collect()} == {"p1.txt", "twice.txt", "long.txt"}


def test_every_csv_file_has_its_own_column_order(spark, tmp_dir):
    swapped = "Credit,Balance,Value Date,Extra\n10.00,\"1,010.00\",05-Mar-24,x\n\n , 900.00 ,06-Mar-24,\"a,b\"\n"
    d = _files(tmp_dir, {"a.csv": CSV, "b.csv": swapped})
    rows = {os.path.basename(r.statement_id) + str(r.value_date): r for r in read_statement_csv(spark, os.path.join(d, "*.csv")).collect()}
    b = rows["b.csv2024-03-05"]
    assert (b.debit, b.credit, b.balance, b.description) == (None, 10.0, 1010.0, None)
    assert rows["b.csv2024-03-06"].credit is None and rows["b.csv2024-03-06"].balance == 900.0
    assert rows["a.csv2024-01-01"].debit == 400.0 and len(rows) == 5


def _split_settings(spark, n):
    spark.conf.set("spark.sql.files.minPartitionNum", str(n))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000" if n > 4 else "128m")
    spark.conf.set("spark.sql.files.openCostInBytes", "1" if n > 4 else "4m")


def test_rows_do_not_depend_on_how_files_are_split(spark, tmp_dir):
    """Header, blank-line and row scans agree, also when the settings change between building and running."""
    n = 700
    rows = [[f"{1 + i % 28} Jan 2024", f"{1 + i % 28} Jan 2024", f"row {i}", "", "1.00", " ", f"{i}.00"] for i in range(n)]
    order = ["Balance", "Value Date", "Description", "Debit", "Credit"]
    for k in range(6):
        cut = rows[k * 100 :]
        text = _stmt("1.00", "1 Jan 2024", "31 Jan 2024", cut) + "9\ttrailing line\n" * 50
        heads = order[k % 3 :] + order[: k % 3]
        named = {"Balance": lambda i: f"{i}.00", "Value Date": lambda i: "05-Mar-24", "Description": lambda i: f"row {i}", "Debit": lambda i: "1.00", "Credit": lambda i: ""}
        csv = "\n" * k + ",".join(heads) + "\r\n" + "".join(",".join(named[h](i) for h in heads) + ("\r\n" if i % 2 else "\n\n") for i in range(k * 100, n))
        _files(tmp_dir, {f"t{k}.txt": text, f"c{k}.csv": csv})
    seen = []
    try:
        for building, running in ((2, 2), (2, 16), (16, 2)):
            _split_settings(spark, building)
            frames = [read_statement_text(spark, f"{tmp_dir}/*.txt"), read_statement_csv(spark, f"{tmp_dir}/*.csv"), captioned_csv(spark, f"{tmp_dir}/*.csv")]
            meta = statement_meta(spark, f"{tmp_dir}/*.txt")
            _split_settings(spark, running)
            assert [f.count() for f in frames] == [2700, 2700, 2700] and meta.where("status = 'ok'").count() == 6
            assert frames[1].where("balance is null or description = 'Description'").count() == 0
            seen.append([sorted(map(tuple, f.drop("debit", "credit").collect()), key=str) for f in frames])
    finally:
        for key in ("minPartitionNum", "maxPartitionBytes", "openCostInBytes"):
            spark.conf.unset(f"spark.sql.files.{key}")
    assert seen[0] == seen[1] == seen[2]
    text, csv = seen[0][0], seen[0][1]
    assert {(os.path.basename(r[0]), r[1], r[4]) for r in text} == {(f"t{k}.txt", 5 + i - 100 * k, f"row {i}") for k in range(6) for i in range(100 * k, n)}


def test_inferred_columns_of_files_with_other_captions(spark, tmp_dir):
    d = _files(tmp_dir, {"a.csv": "Day,Spent,n\n2024-01-05,1.5,3\n,2,4000000000\n", "b.csv": "n,Note,Spent\n7, 12x ,\n"})
    df = read_sheet(spark, f"{d}/*.csv", infer=True)
    assert dict(df.dtypes) == {"source_file": "string", "line_no": "bigint", "Day": "date", "Spent": "double", "n": "bigint", "Note": "string"}
    rows = {(os.path.basename(r.source_file), r.line_no): (r.Day, r.Spent, r.n, r.Note) for r in df.collect()}
    assert rows == {("a.csv", 1): (dt.date(2024, 1, 5), 1.5, 3, None), ("a.csv", 2): (None, 2.0, 4000000000, None), ("b.csv", 1): (None, None, 7, " 12x ")}


def test_sheet_columns_by_caption(spark, tmp_dir):
    d = _files(tmp_dir, {"s.csv": "Category,Expenditure,Date,Item\nFood,\"1,250.50\",1-6-2025,\"Apples, Pears\"\nAuto,n/a,,Bus\n"})
    rows = read_sheet(spark, os.path.join(d, "s.csv")).orderBy("line_no").collect()
    assert (rows[0].Date, rows[0].Item, rows[0].Expenditure, rows[0].Category, rows[0].bad_cells) == ("1-6-2025", "Apples, Pears", 1250.5, "Food", 0)
    assert (rows[1].Date, rows[1].Expenditure, rows[1].Comments, rows[1].bad_cells) == (None, None, None, 1)


def test_missing_balance_hides_no_break(spark):
    rows = [("a", 0, None, None, 100.0), ("a", 1, None, None, None), ("a", 2, None, None, 500.0), ("a", 3, 50.0, None, 450.0)]
    df = spark.createDataFrame(rows, "acct string, n int, debit double, credit double, balance double")
    got = [(r.n, r.status, r.prev_balance, r.diff) for r in
           reconcile(df, "acct", "n", "debit", "credit", "balance").orderBy("n").collect()]
    assert got == [(1, "no_balance", 100.0, None), (2, "break", 100.0, -400.0)]
    for size in (1, 2):
        cut = reconcile(df, "acct", "n", "debit", "credit", "balance", chunk_rows=size).orderBy("n").collect()
        assert [(r.n, r.status, r.prev_balance, r.diff) for r in cut] == got


def test_reconcile_shuffles_the_rows_once_and_counts_once(spark):
    rows = [("a" if n % 3 else "b", n, None, 1.0, float(n)) for n in range(60)]
    df = spark.createDataFrame(rows, "acct string, n int, debit double, credit double, balance double")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("reconcile-sizes", "size job")
    out = reconcile(df, "acct", "n", "debit", "credit", "balance", breaks_only=False)
    assert len(tracker.getJobIdsForGroup("reconcile-sizes")) <= 3  # one collect, split into jobs by AQE
    spark.sparkContext.setJobGroup("", "")
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    whole = {r.n: (r.status, r.prev_balance, r.diff) for r in out.collect()}
    for size in (1, 7):
        cut = reconcile(df, "acct", "n", "debit", "credit", "balance", breaks_only=False, chunk_rows=size)
        assert {r.n: (r.status, r.prev_balance, r.diff) for r in cut.collect()} == whole


def test_large_amounts_are_exact_or_missing(spark):
    df = spark.createDataFrame([("a", 0.005), ("a", 0.005), ("b", 1e17), ("c", 1e300), ("c", 1.0)], "k string, v double")
    assert {r.k: r.t for r in spend_by(df, "k", "v", "t").collect()} == {"a": 0.01, "b": 1e17, "c": 1.0}
    big = spark.createDataFrame([("a", 1, "900000000000000.01"), ("a", 2, "0.03")], "p string, i int, v string").withColumn("v", F.col("v").cast("decimal(18,2)"))
    assert [str(r.s) for r in running_sum(big, "v", "s", "p", "i").orderBy("i").collect()] == ["900000000000000.01", "900000000000000.04"]


def test_refused_target_falls_back(spark, tmp_dir):
    target = os.path.join(tmp_dir, "ledger.csv")
    os.mkdir(target, 0o555)
    written = write_ledger(spark.createDataFrame([], LEDGER_SCHEMA), target, now=dt.datetime(2026, 6, 1, 12, 0, 5))
    assert written == os.path.join(tmp_dir, "ledger_processed_20260601_120005.csv")
    assert os.listdir(target) == [] and os.listdir(written)


LEDGER = [("2024-01-01", "new", None, 1.0, 2.0)]


def _texts(path):
    return "".join(open(f, encoding="utf-8").read() for f in sorted(glob.glob(os.path.join(path, "*.csv"))))


def _beside(tmp_dir):
    return sorted(os.listdir(tmp_dir))


def test_ledger_is_replaced_whole(spark, tmp_dir):
    target = os.path.join(tmp_dir, "ledger.csv")
    write_ledger(spark.createDataFrame([("2023-01-01", "old", None, 1.0, 2.0)] * 3, LEDGER_SCHEMA), target)
    assert write_ledger(spark.createDataFrame(LEDGER, LEDGER_SCHEMA), target) == target
    assert "new" in _texts(target) and "old" not in _texts(target) and _beside(tmp_dir) == ["ledger.csv"]


def test_target_refused_after_the_check(spark, tmp_dir, monkeypatch):
    target, now = os.path.join(tmp_dir, "ledger.csv"), dt.datetime(2026, 6, 1, 12, 0, 5)
    write_ledger(spark.createDataFrame([("2023-01-01", "old", None, 1.0, 2.0)], LEDGER_SCHEMA), target)
    rename = sinks._Files.renamed
    for refused in (lambda s, t: s == target, lambda s, t: t == target and sinks.STAGING in s):  # neither may the old one move nor the new one come
        for f in glob.glob(os.path.join(tmp_dir, "*_processed_*")):
            os.rename(f, f + ".seen")
        monkeypatch.setattr(sinks._Files, "renamed", lambda self, s, t: not refused(s, t) and rename(self, s, t))
        got = write_ledger(spark.createDataFrame(LEDGER, LEDGER_SCHEMA), target, now=now)
        assert got == os.path.join(tmp_dir, "ledger_processed_20260601_120005.csv")
        assert "new" in _texts(got) and "old" in _texts(target) and "new" not in _texts(target)
        assert not [f for f in _beside(tmp_dir) if sinks.STAGING in f or sinks.OLD in f]


def test_job_that_dies_leaves_one_ledger_whole(spark, tmp_dir, monkeypatch):
    target = os.path.join(tmp_dir, "ledger.csv")
    write_ledger(spark.createDataFrame([("2023-01-01", "old", None, 1.0, 2.0)], LEDGER_SCHEMA), target)
    broken = spark.createDataFrame(LEDGER, LEDGER_SCHEMA).withColumn("description", F.raise_error(F.lit("lost")))
    with pytest.raises(Exception, match="lost"):
        write_ledger(broken, target)
    assert "old" in _texts(target)
    rename = sinks._Files.renamed

    def dies(self, source, to):
        if to == target:
            raise KeyboardInterrupt
        return rename(self, source, to)

    monkeypatch.setattr(sinks._Files, "renamed", dies)
    with pytest.raises(KeyboardInterrupt):
        write_ledger(spark.createDataFrame(LEDGER, LEDGER_SCHEMA), target)
    monkeypatch.undo()
    assert not os.path.exists(target)  # it died between the two renames
    assert recover_ledger(spark, target) and "old" in _texts(target) and not recover_ledger(spark, target)
    assert write_ledger(spark.createDataFrame(LEDGER, LEDGER_SCHEMA), target) == target and "new" in _texts(target)


def test_nowhere_to_write(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(sinks._Files, "renamed", lambda self, s, t: False)
    with pytest.raises(PermissionError, match="the ledger is in"):
        write_ledger(spark.createDataFrame(LEDGER, LEDGER_SCHEMA), os.path.join(tmp_dir, "ledger.csv"))


def test_statement_without_any_table(spark):
    from test_normalise import F2_ROWS
    raw = spark.createDataFrame(F2_ROWS, RAW_ROWS_SCHEMA)
    asked = spark.createDataFrame([("A",), ("C",)], "statement_id string")
    stats = {r.statement_id: r for r in extraction_stats(raw, normalise_statements(raw, sort=False), asked).collect()}
    assert set(stats) == {"A", "C"} and (stats["C"].tables_found, stats["C"].ledger_rows) == (0, 0)


def test_consolidated_csv_equals_text_periods(spark, tmp_dir):
    d = _files(tmp_dir, {"p1.txt": P1, "p2.txt": P2, "all.csv": CSV})
    cols = ["value_date", "description", "debit", "credit", "balance"]
    p1 = read_statement_text(spark, os.path.join(d, "p1.txt"))
    p2 = read_statement_text(spark, os.path.join(d, "p2.txt"))
    both = consolidate(p1, p2)
    csv = read_statement_csv(spark, os.path.join(d, "all.csv"))
    assert csv.count() == 3
    assert both.select(cols).exceptAll(csv.select(cols)).count() == 0
    assert csv.select(cols).exceptAll(both.select(cols)).count() == 0
    assert sorted(r.period_idx for r in both.collect()) == [0, 0, 1]
    for k, text in enumerate((P1, P2)):
        os.makedirs(os.path.join(tmp_dir, f"period={k}"))
        _files(os.path.join(tmp_dir, f"period={k}"), {"s.txt": text})
    once = read_statement_periods(spark, os.path.join(tmp_dir, "period=*", "*.txt"))
    assert sorted(map(str, once.select("period_idx", "line_no", *cols).collect())) == sorted(map(str, both.select("period_idx", "line_no", *cols).collect()))


def test_reconcile_chain_and_planted_break(spark, tmp_dir):
    bad = CSV.replace('"1,00,600.00"', '"1,00,601.00"')
    d = _files(tmp_dir, {"ok.csv": CSV, "bad.csv": bad})
    order = ["line_no"]
    ok = read_statement_csv(spark, os.path.join(d, "ok.csv"))
    assert reconcile(ok, part="statement_id", order=order, debit="debit", credit="credit").count() == 0
    broken = read_statement_csv(spark, os.path.join(d, "bad.csv"))
    breaks = reconcile(broken, part="statement_id", order=order, debit="debit", credit="credit").collect()
    assert sorted(r.diff for r in breaks) == [-1.0, 1.0]
    # Across periods: each period opens at the previous closing balance.
    p = consolidate(read_statement_text(spark, os.path.join(_files(tmp_dir, {"p1.txt": P1}), "p1.txt")),
                    read_statement_text(spark, os.path.join(_files(tmp_dir, {"p2.txt": P2}), "p2.txt")))
    acct = p.withColumn("account", F.lit("a"))
    assert reconcile(acct, part="account", order=["period_idx", "line_no"],
                     debit="debit", credit="credit").count() == 0


def test_write_ledger_header_only_when_empty(spark, tmp_dir):
    out = os.path.join(tmp_dir, "empty_ledger")
    written = write_ledger(spark.createDataFrame([], LEDGER_SCHEMA), out)
    assert written == out
    texts = [open(f, encoding="utf-8").read() for f in glob.glob(os.path.join(out, "*.csv"))]
    assert "Value Date,Description,Deposit,Withdrawal,Balance\n" in texts


def test_write_ledger_sorted_rows(spark, tmp_dir):
    from test_normalise import F2_ROWS
    raw = spark.createDataFrame(F2_ROWS, RAW_ROWS_SCHEMA)
    out = os.path.join(tmp_dir, "ledger")
    write_ledger(normalise_statements(raw), out)
    back = spark.read.option("header", True).csv(out)
    assert back.columns == ["Value Date", "Description", "Deposit", "Withdrawal", "Balance"]
    assert sorted(r["Value Date"] for r in back.collect()) == ["2024-12-30", "2025-01-02", "2025-02-99"]
    head, total = preview(normalise_statements(raw), n=2, show=False)
    assert total == 3 and [r.value_date for r in head] == ["2024-12-30", "2025-01-02"]


def test_raw_tables_roundtrip(spark, tmp_dir):
    from test_normalise import F2_ROWS
    path = os.path.join(tmp_dir, "raw")
    spark.createDataFrame(F2_ROWS, RAW_ROWS_SCHEMA).write.partitionBy("statement_id").parquet(path)
    back = read_raw_tables(spark, path)
    assert back.count() == len(F2_ROWS)
    assert normalise_statements(back).count() == 3
