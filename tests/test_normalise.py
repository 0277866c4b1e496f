"""The hand-computed statement of FIXTURES F2, plus ordering properties."""

from pyspark.sql import functions as F

from spendloom.operators import (extraction_stats, header_inventory, infer_year,
                                 normalise_statements, dated_rows)
from spendloom.schema import RAW_ROWS_SCHEMA

H1 = [" Value Date ", "Deposits", "Withdrawals", "Balance"]
H2 = ["Date", "Credit", "Debit", "Closing Balance"]
F2_ROWS = [
    ("A", 0, 0, ["Name", "Value"], ["x", "y"]),
    ("A", 1, 0, H1, ["Dec 30 SHOP/ab12/ref", None, "1,234.50", "8,765.50"]),
    ("A", 1, 1, H1, ["Balance Brought Forward Dec 31", None, None, "8,765.50"]),
    ("A", 1, 2, H1, ["continued text", None, None, None]),
    ("A", 2, 0, H2, ["Jan 02 SALARY", "50,000.00", None, "58,765.50"]),
    ("A", 2, 1, H2, ["NEFT 12 Mar 05", None, "10.00", "58,755.50"]),
    ("A", 2, 2, H2, ["Feb 99 ODD", None, "5.00", "58,750.50"]),
    ("B", 0, 0, ["Name", "Value"], ["x", "y"]),
]


def raw(spark, rows=F2_ROWS):
    return spark.createDataFrame(rows, RAW_ROWS_SCHEMA)


def test_fixture_f2_ledger(spark):
    out = normalise_statements(raw(spark)).collect()
    got = [(r.statement_id, r.value_date, r.description, r.deposit, r.withdrawal, r.balance,
            r.value_date_valid) for r in out]
    assert got == [
        ("A", "2024-12-30", "Dec 30 SHOP (ab12) - ref", None, 1234.5, 8765.5,
         __import__("datetime").date(2024, 12, 30)),
        ("A", "2025-01-02", "Jan 02 SALARY", 50000.0, None, 58765.5,
         __import__("datetime").date(2025, 1, 2)),
        ("A", "2025-02-99", "Feb 99 ODD", None, 5.0, 58750.5, None),
    ]


def test_rollover_on_any_decrease(spark):
    rows = [("S", 0, i, ["Date", "Balance"], [t, "1"]) for i, t in
            enumerate(["Dec 30 a", "Jan 02 b", "Jan 01 c", "Jan 01 d", "Mar 3 e"])]
    out = normalise_statements(raw(spark, rows)).orderBy("row_idx").collect()
    assert [r.value_date for r in out] == ["2024-12-30", "2025-01-02", "2026-01-01",
                                         "2026-01-01", "2026-03-03"]


def test_year_scan_independent_of_chunking(spark):
    # Many rows, tiny chunks: the two-level scan must equal one big window.
    import random
    rnd = random.Random(7)
    months = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
    rows = []
    for s in range(3):
        for t in range(4):
            for i in range(60):
                rows.append((f"s{s}", t, i, ["Date", "Balance"],
                             [f"{rnd.choice(months)} {rnd.randint(1, 28)} x", "1"]))
    df = raw(spark, rows).repartition(7)
    small = infer_year(dated_rows(df), chunk_rows=5).select("statement_id", "table_idx", "row_idx", "year")
    big = infer_year(dated_rows(df), chunk_rows=1 << 20).select("statement_id", "table_idx", "row_idx", "year")
    assert small.exceptAll(big).count() == 0 and big.exceptAll(small).count() == 0
    # Brute force in Python.
    exp = {}
    for s in range(3):
        prev, year = None, 2024
        for r in sorted([r for r in rows if r[0] == f"s{s}"], key=lambda r: (r[1], r[2])):
            m, d = r[4][0].split()[:2]
            md = (months.index(m) + 1, int(d))
            if prev is not None and md < prev:
                year += 1
            prev = md
            exp[(r[0], r[1], r[2])] = year
    got = {(r.statement_id, r.table_idx, r.row_idx): r.year for r in small.collect()}
    assert got == exp


def test_extraction_stats_keeps_empty_statements(spark):
    df = raw(spark)
    stats = {r.statement_id: r for r in extraction_stats(df, normalise_statements(df, sort=False)).collect()}
    assert (stats["A"].tables_found, stats["A"].usable_tables, stats["A"].raw_rows, stats["A"].ledger_rows) == (3, 2, 7, 3)
    assert (stats["B"].tables_found, stats["B"].usable_tables, stats["B"].ledger_rows) == (1, 0, 0)


def test_header_inventory(spark):
    inv = header_inventory(raw(spark), n=2).orderBy("statement_id", "table_idx").collect()
    assert [(r.statement_id, r.table_idx) for r in inv] == [("A", 0), ("A", 1), ("B", 0)]
    assert inv[1].headers == H1
