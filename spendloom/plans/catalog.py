"""Registered queries over the driver tables and their DuckDB oracles.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
tables. Each oracle is plain SQL over the same tables, written independently:
where it can, it states the expected value from the planted case
(``CASE`` on the shape key) instead of re-running the cleaner's regexes.
Column names and types match between the two sides.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendloom.functions import scalars as S
from spendloom.operators import normalise as N
from spendloom.operators.ordered import running_sum
from spendloom.operators.quality import extraction_stats, header_inventory, period_chain, reconcile, rows_in_several_periods
from spendloom.operators.spend import cumulatives, fill_forward, spend_by, spend_by_period
from spendloom.plans import derive as D
from spendloom.session import scratch_table_path
from spendloom.schema import LEDGER_HEADERS
from spendloom.sources.contract import check_contract, split_contract
from spendloom.sources.readers import (read_raw_tables, read_sheet, read_statement_csv, read_statement_periods,
                                       read_statement_text, statement_meta)
from spendloom.sources.sinks import preview, write_ledger

#: "Today" for the date cleaners, fixed so results are repeatable.
TODAY = _dt.date(2026, 6, 1)
#: The header inventory reports this many tables per statement.
INVENTORY_TABLES = 3

Query = Callable[[SparkSession, str], DataFrame]


def _orders(spark, sf, cpu_heavy=False):
    return D.table(spark, sf, "orders", cpu_heavy)


def _raw(spark, sf):
    return D.orders_raw_rows(_orders(spark, sf, cpu_heavy=True))


# ---------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------

def q_spend_by_category(spark, sf):
    o = _orders(spark, sf)
    sheet = o.select(F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("Category"),
                     F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice")).alias("Expenditure"))
    return spend_by(sheet, "Category", "Expenditure", "Total_Expenditure")


def q_spend_by_month(spark, sf):
    o = _orders(spark, sf).select(F.to_date("o_orderdate").alias("d"), "o_totalprice")
    return spend_by_period(o, "d", "o_totalprice", "month", alias="total")


def q_spend_by_year(spark, sf):
    o = _orders(spark, sf).select(F.to_date("o_orderdate").alias("d"), "o_totalprice")
    return spend_by_period(o, "d", "o_totalprice", "year", alias="total")


def q_clean_amount(spark, sf):
    li = D.lineitem_amount_text(D.table(spark, sf, "lineitem", cpu_heavy=True))
    return li.select("l_orderkey", "l_linenumber", "raw_amount", S.clean_amount("raw_amount").alias("amount"))


def q_clean_date_compat(spark, sf):
    t = D.orders_date_text(_orders(spark, sf, cpu_heavy=True))
    return t.select("o_orderkey", "date_text", S.clean_date("date_text", TODAY, "compat").alias("clean_date"))


def q_clean_date_strict(spark, sf):
    t = D.orders_date_text(_orders(spark, sf, cpu_heavy=True))
    return t.select("o_orderkey", "date_text", S.clean_date("date_text", TODAY, "strict").alias("clean_date"))


def q_clean_description(spark, sf):
    d = D.documents_with_boilerplate(D.table(spark, sf, "documents", cpu_heavy=True))
    return d.select("doc_id", S.clean_description("txt").alias("description"))


def q_format_description(spark, sf):
    p = D.pages_payment_paths(D.table(spark, sf, "pages", cpu_heavy=True))
    return p.select("page_id", S.format_description("txt").alias("description"),
                    S.is_bank_transfer("txt").alias("is_transfer"))


def q_month_day(spark, sf):
    t = D.orders_month_day_text(_orders(spark, sf, cpu_heavy=True))
    md = S.month_day("txt")
    return t.select("o_orderkey", "txt", md["month"].cast("long").alias("month"),
                    md["day"].cast("long").alias("day"))


def q_extract_withdrawal(spark, sf):
    t = D.orders_payment_text(_orders(spark, sf, cpu_heavy=True))
    return t.select("o_orderkey", S.extract_withdrawal_amount("txt", "withdrawal_cell", "balance_cell")
                    .alias("withdrawal"))


def q_extract_deposit(spark, sf):
    t = D.orders_payment_text(_orders(spark, sf, cpu_heavy=True))
    return t.select("o_orderkey", S.extract_deposit_amount("txt", "deposit_cell", "balance_cell")
                    .alias("deposit"))


def q_map_roles(spark, sf):
    r = N.map_roles(_raw(spark, sf))
    return r.select("statement_id", F.col("table_idx").cast("long").alias("table_idx"), "row_idx",
                    *[F.col(f"pos_{k}").cast("long").alias(f"pos_{k}") for k in N.ROLES], "usable")


def q_infer_year(spark, sf):
    raw = _raw(spark, sf)
    y = N.infer_year(N.dated_rows(raw), sizes_from=raw)
    return y.select("statement_id", F.col("table_idx").cast("long").alias("table_idx"), "row_idx",
                    F.col("year").cast("long").alias("year"), "value_date")


def q_is_txn(spark, sf):
    d = N.dated_rows(_raw(spark, sf))
    has_txn, is_noise = N.transaction_predicates(
        F.col("cell_date_desc"), F.col("cell_deposit"), F.col("cell_withdrawal"),
        F.col("cell_balance"), F.col("has_deposit"), F.col("has_withdrawal"))
    return d.select("statement_id", F.col("table_idx").cast("long").alias("table_idx"), "row_idx",
                    has_txn.alias("has_txn"), is_noise.alias("is_noise"),
                    (has_txn & ~is_noise).alias("kept"))


def q_normalise_statements(spark, sf):
    led = N.normalise_statements(_raw(spark, sf))
    return led.withColumn("table_idx", F.col("table_idx").cast("long"))


def q_ledger_head(spark, sf):
    return q_normalise_statements(spark, sf).limit(10)


def q_extraction_stats(spark, sf):
    """Every customer's statement, also those that extraction found no table in."""
    raw = _raw(spark, sf)
    asked = D.table(spark, sf, "customer").select(F.concat(F.lit("stmt-"), F.col("c_custkey").cast("string")).alias("statement_id"))
    stats = extraction_stats(raw, N.normalise_statements(raw, sort=False), asked)
    return stats.select("statement_id", "tables_found", "usable_tables", "raw_rows", "ledger_rows")


def _faulty(spark, sf):
    """(raw rows with planted faults, one row per customer's statement with the error of those that broke off)."""
    statements = D.customer_statements(D.table(spark, sf, "customer"))
    return D.with_faults(_raw(spark, sf), statements), statements


def q_raw_contract(spark, sf):
    """The contract gate over rows with planted faults: what stays, what goes and why."""
    checked = check_contract(_faulty(spark, sf)[0])
    return checked.select("statement_id", F.col("table_idx").cast("long").alias("table_idx"), "row_idx",
                          F.size("cells").cast("long").alias("n_cells"), "reason", "copies")


def q_extraction_status(spark, sf):
    """G2 with the gate before it: rejected rows, broken-off statements and the state of each statement."""
    raw, statements = _faulty(spark, sf)
    kept, rejected = split_contract(raw)
    stats = extraction_stats(kept, N.normalise_statements(kept, sort=False), statements, rejected)
    return stats.select("statement_id", "tables_found", "usable_tables", "raw_rows", "ledger_rows", "rejected_rows", "error", "status")


def q_raw_tables(spark, sf):
    """Land the extracted tables, read the contract back, normalise."""
    path = scratch_table_path(spark, f"raw-{uuid.uuid4().hex}")
    _raw(spark, sf).write.parquet(path)
    led = N.normalise_statements(read_raw_tables(spark, path), sort=False)
    return led.withColumn("table_idx", F.col("table_idx").cast("long"))


def q_ledger_csv(spark, sf):
    """The five-column ledger as written, read back as text."""
    ledger = N.drop_empty_rows(N.normalise_statements(_raw(spark, sf)))
    path = write_ledger(ledger, scratch_table_path(spark, f"ledger-{uuid.uuid4().hex}"))
    return spark.read.option("header", True).csv(path, schema=", ".join(f"`{c}` string" for c in LEDGER_HEADERS))


def q_preview(spark, sf):
    """The first rows of the ordered ledger and its size."""
    ledger = q_normalise_statements(spark, sf)
    head, total = preview(ledger, n=10, show=False)
    shown = spark.createDataFrame(head, ledger.schema)
    return shown.select("statement_id", "row_idx", "value_date", "description").withColumn("total_rows", F.lit(total).cast("long"))


def q_header_inventory(spark, sf):
    inv = header_inventory(_raw(spark, sf), n=INVENTORY_TABLES)
    return inv.select("statement_id", F.col("table_idx").cast("long").alias("table_idx"),
                      F.array_join("headers", "|").alias("headers_text"))


def q_fill_forward(spark, sf):
    ev = D.table(spark, sf, "events").select(
        "event_id", F.when(F.col("event_id") % 4 == 0, F.col("ts")).alias("ts"))
    return fill_forward(ev, "ts", order="event_id", out="ts_filled").select("event_id", "ts_filled")


def q_cumulative_spend(spark, sf):
    o = _orders(spark, sf).select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    y = cumulatives(o, "o_orderdate", "o_totalprice", {"cumulative_month": "month", "cumulative_year": "year"},
                    order=["o_orderdate", "o_orderkey"], keys=["o_custkey"])
    return y.select("o_orderkey", "o_custkey", "cumulative_month", "cumulative_year")


def q_reconcile_balance(spark, sf):
    """Accounts far above 1e15, with planted breaks (key % 97) and planted missing balances (key % 89)."""
    mv = D.orders_account_movements(_orders(spark, sf))
    dec = "decimal(28,2)"
    mv = mv.withColumn("__delta", F.coalesce(F.col("credit").cast(dec), F.lit(0).cast(dec))
                       - F.coalesce(F.col("debit").cast(dec), F.lit(0).cast(dec)))
    order = ["o_orderdate", "o_orderkey"]
    run = running_sum(mv, "__delta", "__running", part="o_custkey", order=order)
    planted = F.when(F.col("o_orderkey") % 97 == 0, F.lit(1)).otherwise(F.lit(0))
    balance = (F.col("__running") + F.lit(D.ACCOUNT_OPENING).cast(dec) + planted).cast(dec)
    acct = run.withColumn("balance", F.when(F.col("o_orderkey") % 89 != 0, balance))
    breaks = reconcile(acct, part="o_custkey", order=order, debit="debit", credit="credit", balance="balance")
    return breaks.select("o_custkey", "o_orderkey", F.col("balance").cast("double").alias("balance"), "prev_balance", "diff", "status")


def q_period_chain(spark, sf):
    """Yearly statement periods per group of customers, with planted gaps, overlaps and changed opening balances."""
    return period_chain(D.orders_periods(_orders(spark, sf), running_sum), "stmt").select(
        "stmt", "year", "period_start", "period_end", "gap_days", "overlap_days", "opening_diff", "status")


def q_period_repeats(spark, sf):
    """Movements that stand in two periods: every 37th order is also listed in the year after its own."""
    rows = D.orders_period_rows(_orders(spark, sf))
    return rows_in_several_periods(rows, ["o_orderkey", "day", "amount"], "stmt", "year")


def q_parse_sheet_date(spark, sf):
    t = D.orders_sheet_date_text(_orders(spark, sf, cpu_heavy=True))
    return t.select("o_orderkey", "sheet_text", S.parse_sheet_date("sheet_text").alias("sheet_date"))


#: First days of the second and later statement periods that U2 joins; orders without a date are a last period of their own.
PERIOD_STARTS = ("1997-01-01", "1999-01-01")


def q_consolidate(spark, sf):
    """Text statements of all periods, written in one pass, read back in one and joined."""
    period = F.lit(len(PERIOD_STARTS) + 1)
    for k, first in reversed(list(enumerate((*PERIOD_STARTS, "9999-12-31")))):
        period = F.when(F.col("o_orderdate") < F.lit(first).cast("timestamp_ntz"), k).otherwise(period)
    rows = read_statement_periods(spark, _statement_files(spark, _orders(spark, sf), "text", period))
    return rows.select(_stmt_no(), F.col("period_idx").cast("long").alias("period_idx"), "value_date", "description",
                       "ref_no", "debit", "credit", "balance")


def _statement_files(spark, orders, kind: str, period=None) -> str:
    """Write the derived statement files to a fresh folder under the shared
    checkpoint location and return the glob of the files."""
    mv = D.orders_statement_movements(orders, running_sum, period)
    lines = D.statement_text_lines(mv) if kind == "text" else D.statement_csv_lines(mv)
    path = scratch_table_path(spark, f"statements-{kind}-{uuid.uuid4().hex}")
    D.write_statement_files(lines, path)
    return f"{path}/period=*/stmt=*/*.txt"


def _stmt_no(c="statement_id"):
    return F.regexp_extract(F.col(c), r"stmt=([0-9]+)", 1).cast("long").alias("stmt")


def q_statement_text(spark, sf):
    rows = read_statement_text(spark, _statement_files(spark, _orders(spark, sf), "text"))
    return rows.select(_stmt_no(), "txn_date", "value_date", "description", "ref_no",
                       "debit", "credit", "balance")


def q_statement_meta(spark, sf):
    meta = statement_meta(spark, _statement_files(spark, _orders(spark, sf), "text"))
    return meta.select(_stmt_no(), "period_start", "period_end", "opening_balance", "opening_balance_date", "status")


def q_statement_csv(spark, sf):
    rows = read_statement_csv(spark, _statement_files(spark, _orders(spark, sf), "csv"))
    return rows.select(_stmt_no(), "value_date", "description", "ref_no", "debit", "credit", "balance")


def _filled_sheets(spark, sf):
    """S1 + A11 + L2: sheets written from orders, read back, blank dates filled
    from the row above within each file."""
    rows = D.orders_sheet_rows(_orders(spark, sf))
    path = scratch_table_path(spark, f"sheets-{uuid.uuid4().hex}")
    D.write_sheet_files(rows, path)
    sheet = read_sheet(spark, f"{path}/grp=*/*.csv").withColumn("d", S.parse_sheet_date("Date"))
    filled = fill_forward(sheet, "d", order=["line_no"], part="source_file",
                          out="sheet_date")
    grp = F.regexp_extract(F.col("source_file"), r"grp=([0-9]+)", 1).cast("long")
    return filled.withColumn("grp", grp)


def q_sheet_fill_forward(spark, sf):
    return _filled_sheets(spark, sf).select("grp", F.col("Item").alias("item"), "sheet_date")


def q_sheet_spend_by_month(spark, sf):
    return spend_by_period(_filled_sheets(spark, sf), "sheet_date", "Expenditure", "month",
                           keys=["Category"], alias="total")


QUERIES: dict[str, Query] = {
    "spend_by_category": q_spend_by_category,
    "spend_by_month": q_spend_by_month,
    "spend_by_year": q_spend_by_year,
    "clean_amount": q_clean_amount,
    "clean_date_compat": q_clean_date_compat,
    "clean_date_strict": q_clean_date_strict,
    "clean_description": q_clean_description,
    "format_description": q_format_description,
    "month_day": q_month_day,
    "extract_withdrawal": q_extract_withdrawal,
    "extract_deposit": q_extract_deposit,
    "map_roles": q_map_roles,
    "infer_year": q_infer_year,
    "is_txn": q_is_txn,
    "normalise_statements": q_normalise_statements,
    "ledger_head": q_ledger_head,
    "extraction_stats": q_extraction_stats,
    "extraction_status": q_extraction_status,
    "header_inventory": q_header_inventory,
    "raw_contract": q_raw_contract,
    "raw_tables": q_raw_tables,
    "ledger_csv": q_ledger_csv,
    "preview": q_preview,
    "fill_forward": q_fill_forward,
    "cumulative_spend": q_cumulative_spend,
    "reconcile_balance": q_reconcile_balance,
    "parse_sheet_date": q_parse_sheet_date,
    "consolidate": q_consolidate,
    "period_chain": q_period_chain,
    "period_repeats": q_period_repeats,
    "statement_text": q_statement_text,
    "statement_meta": q_statement_meta,
    "statement_csv": q_statement_csv,
    "sheet_fill_forward": q_sheet_fill_forward,
    "sheet_spend_by_month": q_sheet_spend_by_month,
}


# ---------------------------------------------------------------------------
# DuckDB oracles
# ---------------------------------------------------------------------------

#: Python-style whitespace for RE2 (no (?U) there).
_WS = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_WS}+|{_WS}+$', '', 'g')"


def _clean_amount(x: str) -> str:
    z = f"regexp_replace(CAST({x} AS VARCHAR), '[^0-9.\\-]', '', 'g')"
    return (f"(CASE WHEN {z} LIKE '-%' THEN -TRY_CAST(regexp_replace({z}, '^-', '') AS DOUBLE) "
            f"ELSE TRY_CAST({z} AS DOUBLE) END)")


def _exact(x: str, over: str = "") -> str:
    """The exact sum of doubles: whole multiples of 2**-50, summed as integers, rounded once (by the addition of two exact parts)."""
    total = f"SUM(CAST({x} * 1125899906842624 AS HUGEINT)){over}"
    return f"(CAST({total} // 1099511627776 AS DOUBLE) * 1099511627776 + CAST({total} % 1099511627776 AS DOUBLE)) / 1125899906842624"


_MONEY = "CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR)"
_PRICE = "CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE)"

# The derived statements, stated from the planted kind and variant.
_ORDERS_BASE = f"""
o AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_totalprice, o_orderdate,
         CAST(o_orderkey % 10 AS INTEGER) AS kind,
         CAST(year(o_orderdate) - 1995 AS BIGINT) AS table_idx,
         CASE WHEN o_custkey % 50 = 0 THEN 3
              ELSE CAST((o_custkey + year(o_orderdate) - 1995) % 3 AS INTEGER) END AS variant,
         'stmt-' || CAST(o_custkey AS VARCHAR) AS statement_id,
         CAST(o_orderkey AS BIGINT) AS row_idx,
         strftime(o_orderdate, '%b') AS mon, strftime(o_orderdate, '%d') AS dd,
         month(o_orderdate) AS m, day(o_orderdate) AS d
  FROM orders),
dated AS (
  SELECT *, m * 100 + d AS md FROM o
  WHERE variant IN (0, 1) AND kind NOT IN (3, 8, 9)),
bumps AS (
  SELECT *, CASE WHEN md < LAG(md) OVER (PARTITION BY statement_id ORDER BY table_idx, row_idx)
                 THEN 1 ELSE 0 END AS bump
  FROM dated),
years AS (
  SELECT *, CAST(2024 + SUM(bump) OVER (PARTITION BY statement_id ORDER BY table_idx, row_idx
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS year
  FROM bumps),
ledger AS (
  SELECT statement_id, table_idx, row_idx,
         printf('%04d-%02d-%02d', year, m, d) AS value_date,
         TRY_CAST(printf('%04d-%02d-%02d', year, m, d) AS DATE) AS value_date_valid,
         CASE kind
           WHEN 0 THEN mon || ' ' || dd || ' SHOP (' || o_orderpriority || ')'
           WHEN 1 THEN mon || ' ' || dd || ' UPI (' || o_orderpriority || ') - ref' || CAST(o_orderkey AS VARCHAR)
           WHEN 2 THEN mon || ' ' || dd
           WHEN 4 THEN mon || ' ' || dd || ' ATM WDL ' || CAST(o_orderkey AS VARCHAR)
           WHEN 6 THEN lower(mon) || ' ' || dd || ' atm cash'
         END AS description,
         CASE WHEN o_orderstatus = 'O' THEN {_PRICE} END AS deposit,
         CASE WHEN o_orderstatus = 'F' THEN {_PRICE} END AS withdrawal,
         {_PRICE} AS balance
  FROM years WHERE kind NOT IN (5, 7))
"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


_DATE_SHAPES = """
t AS (
  SELECT o_orderkey, o_orderdate, CAST(o_orderkey % 10 AS INTEGER) AS k,
         CASE o_orderkey % 10
           WHEN 0 THEN strftime(o_orderdate, '%d/%m/%Y')
           WHEN 1 THEN strftime(o_orderdate, '%d-%m-%Y')
           WHEN 2 THEN strftime(o_orderdate, '%d/%m/%y')
           WHEN 3 THEN strftime(o_orderdate, '%b %d %Y')
           WHEN 4 THEN strftime(o_orderdate, '%d %b %Y')
           WHEN 5 THEN strftime(o_orderdate, '%b %d')
           WHEN 6 THEN strftime(o_orderdate, '%d %b')
           WHEN 7 THEN 'Paid on ' || strftime(o_orderdate, '%d/%m/%Y') || ' ref 12'
           WHEN 8 THEN strftime(o_orderdate, '%B %d %Y')
           ELSE strftime(o_orderdate, '%Y-%m-%d') END AS date_text,
         strftime(o_orderdate, '%Y-%m-%d') AS iso,
         CASE WHEN month(o_orderdate) = 2 AND day(o_orderdate) = 29 THEN NULL
              ELSE '2026-' || strftime(o_orderdate, '%m-%d') END AS this_year
  FROM orders)
"""

# The planted payment rows: which number a text leads with, told from its shape.
# The first token of an amount pattern is at most three digits long unless a
# two-digit fraction follows them.
_PAYMENT = f"""
t AS (
  SELECT o_orderkey, o_orderkey % 5 AS k, {_PRICE} AS bal,
         o_orderkey % 1000 + 1 AS units, CAST(o_custkey % 100 AS DOUBLE) / 100 AS cents,
         NULLIF(CAST(substr(CAST(o_custkey AS VARCHAR), 1, 3) AS DOUBLE), 0) AS payee,
         NULLIF(CAST(substr(CAST(o_orderkey AS VARCHAR), 1, 3) AS DOUBLE), 0) AS ref,
         o_orderstatus AS status, o_orderkey % 3 = 0 AS has_cell
  FROM orders),
v AS (
  SELECT *, CAST(units AS DOUBLE) + cents AS amt,
         CASE WHEN units = 1000 THEN 100.0 ELSE CAST(units AS DOUBLE) + cents END AS lead
  FROM t)
"""


def _oracles() -> dict[str, str]:
    sql: dict[str, str] = {}
    sql["spend_by_category"] = f"""
SELECT NULLIF(o_orderpriority, '5-LOW') AS Category,
       {_exact("CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice END")} AS Total_Expenditure
FROM orders GROUP BY 1"""
    for grain in ("month", "year"):
        sql[f"spend_by_{grain}"] = f"""
SELECT CAST(date_trunc('{grain}', o_orderdate) AS DATE) AS period,
       {_exact("o_totalprice")} AS total
FROM orders GROUP BY 1"""
    grouped = "format('{:,.2f}', CAST(l_extendedprice AS DECIMAL(12,2)))"
    plain = "CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR)"
    sql["clean_amount"] = f"""
WITH t AS (
  SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
         CASE l_linenumber
           WHEN 1 THEN {plain}
           WHEN 2 THEN '₹' || {grouped}
           WHEN 3 THEN '(' || {plain} || ')'
           WHEN 4 THEN '-' || {grouped}
           WHEN 5 THEN {plain} || '-'
           WHEN 6 THEN 'Rs. ' || {plain}
           ELSE 'USD ' || {grouped} || ' Cr' END AS raw_amount,
         CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DOUBLE) AS v
  FROM lineitem)
SELECT l_orderkey, l_linenumber, raw_amount,
       CASE l_linenumber WHEN 4 THEN -v WHEN 5 THEN NULL WHEN 6 THEN NULL ELSE v END AS amount
FROM t"""
    sql["clean_date_compat"] = _with(_DATE_SHAPES) + """
SELECT o_orderkey, date_text,
       CASE k WHEN 0 THEN iso WHEN 2 THEN iso WHEN 3 THEN iso WHEN 6 THEN this_year WHEN 7 THEN iso
              WHEN 8 THEN CASE WHEN month(o_orderdate) = 5 THEN iso END END AS clean_date
FROM t"""
    sql["clean_date_strict"] = _with(_DATE_SHAPES) + """
SELECT o_orderkey, date_text,
       CASE k WHEN 5 THEN this_year WHEN 6 THEN this_year
              WHEN 8 THEN CASE WHEN month(o_orderdate) = 5 THEN iso END
              ELSE iso END AS clean_date
FROM t"""
    # With a phone marker the statement date line goes, up to the marker; a
    # closing balance line and a header caption go; the rest keeps its words.
    sql["clean_description"] = f"""
WITH t AS (
  SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'tail' WHEN 3 THEN 'ACCOUNT NO ' || text ELSE text END AS left_over
  FROM documents)
SELECT doc_id, NULLIF({_strip(f"regexp_replace(left_over, '{_WS}+', ' ', 'g')")}, '') AS description FROM t"""
    sql["format_description"] = f"""
WITH t AS (
  SELECT page_id,
         CASE page_id % 4
           WHEN 0 THEN url
           WHEN 1 THEN ' ' || replace(url, '/', ' / ') || ' '
           WHEN 2 THEN url || '/'
           ELSE 'NEFT CRED ' || replace(url, '/', '') END AS txt
  FROM pages),
s AS (SELECT page_id, txt, {_strip('txt')} AS st FROM t),
q AS (SELECT *, string_split(st, '/') AS parts FROM s)
SELECT page_id,
       CASE WHEN txt IS NULL THEN NULL
            WHEN strpos(st, '/') > 0 THEN
              {_strip('parts[1]')}
              || CASE WHEN {_strip('parts[2]')} <> '' THEN ' (' || {_strip('parts[2]')} || ')' ELSE '' END
              || CASE WHEN len(parts) > 2 AND {_strip('parts[-1]')} <> '' THEN ' - ' || {_strip('parts[-1]')}
                      ELSE '' END
            ELSE st END AS description,
       regexp_matches(txt, '(?i)(RTGS|NEFT)\\s+(CRED|DEB)') AS is_transfer
FROM q"""
    sql["month_day"] = """
WITH t AS (
  SELECT o_orderkey, CAST(o_orderkey % 6 AS INTEGER) AS k,
         CAST(month(o_orderdate) AS BIGINT) AS m, CAST(day(o_orderdate) AS BIGINT) AS d,
         CAST(substr(strftime(o_orderdate, '%Y'), 1, 2) AS BIGINT) AS century_digits,
         CASE o_orderkey % 6
           WHEN 0 THEN strftime(o_orderdate, '%b %d') || ' SHOP'
           WHEN 1 THEN 'NEFT ' || strftime(o_orderdate, '%d') || ' ' || strftime(o_orderdate, '%b')
           WHEN 2 THEN 'O' || lower(strftime(o_orderdate, '%b')) || ' ' || strftime(o_orderdate, '%d')
           WHEN 3 THEN upper(strftime(o_orderdate, '%b')) || '  ' || strftime(o_orderdate, '%d')
           WHEN 4 THEN 'ref ' || strftime(o_orderdate, '%b') || ' ' || strftime(o_orderdate, '%Y')
           ELSE 'no date here' END AS txt
  FROM orders)
SELECT o_orderkey, txt,
       CASE WHEN k IN (0, 2, 3, 4) THEN m END AS month,
       CASE WHEN k IN (0, 2, 3) THEN d WHEN k = 4 THEN century_digits END AS day
FROM t"""
    # UPI, NEFT and POS PURCHASE rows are withdrawals, SALARY and NEFT CREDIT rows deposits
    sql["extract_withdrawal"] = _with(_PAYMENT) + """
SELECT o_orderkey, CASE WHEN status = 'F' AND has_cell AND amt <> bal THEN amt
                        WHEN k = 0 THEN COALESCE(payee, lead) WHEN k = 2 THEN COALESCE(ref, lead) WHEN k = 3 THEN lead END AS withdrawal
FROM v"""
    sql["extract_deposit"] = _with(_PAYMENT) + """
SELECT o_orderkey, CASE WHEN status = 'O' AND has_cell AND amt <> bal THEN amt
                        WHEN k = 1 THEN lead WHEN k = 2 THEN COALESCE(ref, lead) END AS deposit
FROM v"""
    sql["map_roles"] = _with(_ORDERS_BASE) + """
SELECT statement_id, table_idx, row_idx,
       CAST(CASE variant WHEN 3 THEN 0 ELSE 1 END AS BIGINT) AS pos_date_desc,
       CAST(CASE variant WHEN 0 THEN 2 WHEN 1 THEN 3 ELSE 0 END AS BIGINT) AS pos_deposit,
       CAST(CASE variant WHEN 0 THEN 3 WHEN 1 THEN 2 ELSE 0 END AS BIGINT) AS pos_withdrawal,
       CAST(CASE WHEN variant IN (0, 1) THEN 4 ELSE 0 END AS BIGINT) AS pos_balance,
       variant IN (0, 1) AS usable
FROM o"""
    sql["infer_year"] = _with(_ORDERS_BASE) + """
SELECT statement_id, table_idx, row_idx, year, printf('%04d-%02d-%02d', year, m, d) AS value_date
FROM years"""
    sql["is_txn"] = _with(_ORDERS_BASE) + """
SELECT statement_id, table_idx, row_idx, kind <> 7 AS has_txn, kind = 5 AS is_noise,
       kind NOT IN (5, 7) AS kept
FROM dated"""
    sql["normalise_statements"] = _with(_ORDERS_BASE) + "SELECT * FROM ledger"
    sql["ledger_head"] = (_with(_ORDERS_BASE) +
                          "SELECT * FROM ledger ORDER BY value_date, statement_id, table_idx, row_idx LIMIT 10")
    sql["extraction_stats"] = _with(_ORDERS_BASE) + """
SELECT s.statement_id,
       CAST(COUNT(DISTINCT o.table_idx) AS BIGINT) AS tables_found,
       CAST(COUNT(DISTINCT CASE WHEN o.variant IN (0, 1) THEN o.table_idx END) AS BIGINT) AS usable_tables,
       CAST(COUNT(o.row_idx) AS BIGINT) AS raw_rows,
       CAST(COUNT(l.row_idx) AS BIGINT) AS ledger_rows
FROM (SELECT 'stmt-' || CAST(c_custkey AS VARCHAR) AS statement_id FROM customer) s
LEFT JOIN o ON o.statement_id = s.statement_id
LEFT JOIN ledger l ON o.statement_id = l.statement_id AND o.row_idx = l.row_idx
GROUP BY s.statement_id"""
    # Planted: every 70th row twice, a longer cell beside every 110th + 1, a fifth cell in every 130th + 2.
    faults = f"""
st AS (
  SELECT 'stmt-' || CAST(c_custkey AS VARCHAR) AS statement_id,
         CASE WHEN c_custkey % 41 = 0 THEN 'page ' || CAST(c_custkey % 7 AS VARCHAR) || ' unreadable' END AS error,
         c_custkey % 41 = 0 AND c_custkey % 2 = 0 AS nothing
  FROM customer),
f AS (
  SELECT o.*, CASE variant WHEN 2 THEN 3 WHEN 3 THEN 2 ELSE 4 END AS n_headers
  FROM o JOIN st ON o.statement_id = st.statement_id AND NOT st.nothing),
gate AS (
  SELECT *, CAST(n_headers + CASE WHEN o_orderkey % 130 = 2 THEN 1 ELSE 0 END AS BIGINT) AS n_cells,
         CASE WHEN o_orderkey % 130 = 2 THEN 'more_cells' END AS reason FROM f
  UNION ALL SELECT *, CAST(n_headers AS BIGINT), 'repeated' FROM f WHERE o_orderkey % 70 = 0
  UNION ALL SELECT *, CAST(n_headers AS BIGINT), 'conflict' FROM f WHERE o_orderkey % 110 = 1)"""
    sql["raw_contract"] = _with(_ORDERS_BASE, faults) + """
SELECT statement_id, table_idx, row_idx, n_cells, reason, CAST(1 AS BIGINT) AS copies FROM gate"""
    # A kept row is a ledger row if its table is usable and its kind is none of the undated and rejected ones.
    sql["extraction_status"] = _with(_ORDERS_BASE, faults, """
s AS (
  SELECT st.statement_id, error,
         COUNT(DISTINCT CASE WHEN reason IS NULL THEN table_idx END) AS tables_found,
         COUNT(DISTINCT CASE WHEN reason IS NULL AND variant IN (0, 1) THEN table_idx END) AS usable_tables,
         COUNT(CASE WHEN reason IS NULL THEN row_idx END) AS raw_rows,
         COUNT(CASE WHEN reason IS NULL AND variant IN (0, 1) AND kind NOT IN (3, 5, 7, 8, 9) THEN row_idx END) AS ledger_rows,
         COUNT(reason) AS rejected_rows
  FROM st LEFT JOIN gate ON gate.statement_id = st.statement_id GROUP BY 1, 2)""") + """
SELECT *, CASE WHEN error IS NOT NULL THEN 'failed' WHEN tables_found + rejected_rows = 0 THEN 'no_table'
               WHEN tables_found = 0 THEN 'rejected' WHEN usable_tables = 0 THEN 'no_usable_table'
               WHEN ledger_rows = 0 THEN 'empty_ledger' WHEN rejected_rows > 0 THEN 'partly_rejected' ELSE 'ok' END AS status
FROM s"""
    sql["raw_tables"] = _with(_ORDERS_BASE) + "SELECT * FROM ledger"
    sql["ledger_csv"] = _with(_ORDERS_BASE) + """
SELECT value_date AS "Value Date", description AS "Description", CAST(deposit AS VARCHAR) AS "Deposit",
       CAST(withdrawal AS VARCHAR) AS "Withdrawal", CAST(balance AS VARCHAR) AS "Balance"
FROM ledger"""
    sql["preview"] = _with(_ORDERS_BASE) + """
SELECT statement_id, row_idx, value_date, description, (SELECT COUNT(*) FROM ledger) AS total_rows
FROM ledger ORDER BY value_date, statement_id, table_idx, row_idx LIMIT 10"""
    sql["header_inventory"] = _with(_ORDERS_BASE) + f"""
SELECT statement_id, table_idx,
       CASE variant WHEN 0 THEN ' Value Date |Deposits|Withdrawals|Balance'
                    WHEN 1 THEN 'Date|Debit|Credit|Closing Balance'
                    WHEN 2 THEN 'Txn Date|Description|Amount'
                    ELSE 'Name|Value' END AS headers_text
FROM (SELECT DISTINCT statement_id, table_idx, variant FROM o)
QUALIFY row_number() OVER (PARTITION BY statement_id ORDER BY table_idx) <= {INVENTORY_TABLES}"""
    sql["fill_forward"] = """
SELECT event_id,
       LAST_VALUE(CASE WHEN event_id % 4 = 0 THEN ts END IGNORE NULLS)
         OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ts_filled
FROM events"""
    running = {grain: _exact("o_totalprice", f""" OVER (
         PARTITION BY o_custkey, date_trunc('{grain}', o_orderdate) ORDER BY o_orderdate NULLS FIRST, o_orderkey
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""") for grain in ("month", "year")}
    sql["cumulative_spend"] = f"""
SELECT o_orderkey, o_custkey,
       {running["month"]} AS cumulative_month,
       {running["year"]} AS cumulative_year
FROM orders"""
    sql["reconcile_balance"] = f"""
WITH mv AS (
  SELECT o_custkey, o_orderkey, o_orderdate,
         CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN -1 ELSE 0 END * CAST(o_totalprice AS DECIMAL(12,2)) AS move
  FROM orders),
acct AS (
  SELECT *, SUM(move) OVER (PARTITION BY o_custkey ORDER BY o_orderdate NULLS FIRST, o_orderkey
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS moved,
         CASE WHEN o_orderkey % 97 = 0 THEN 1 ELSE 0 END AS planted
  FROM mv),
bal AS (
  SELECT *, CASE WHEN o_orderkey % 89 <> 0 THEN CAST({D.ACCOUNT_OPENING} AS DECIMAL(28,2)) + moved + planted END AS bal FROM acct),
chk AS (
  SELECT *, LAST_VALUE(bal IGNORE NULLS) OVER w AS prev,
         LAST_VALUE(CASE WHEN bal IS NOT NULL THEN planted END IGNORE NULLS) OVER w AS prev_planted
  FROM bal WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate NULLS FIRST, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT o_custkey, o_orderkey, CAST(bal AS DOUBLE) AS balance, CAST(prev AS DOUBLE) AS prev_balance,
       CASE WHEN bal IS NOT NULL THEN CAST(prev_planted - planted AS DOUBLE) END AS diff,
       CASE WHEN bal IS NULL THEN 'no_balance' ELSE 'break' END AS status
FROM chk WHERE bal IS NULL OR prev_planted <> planted"""
    sql["parse_sheet_date"] = """
SELECT o_orderkey,
       CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%-d-%-m-%Y')
            ELSE strftime(o_orderdate, '%-d-%-m-%y') END AS sheet_text,
       CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderdate AS DATE)
            ELSE make_date(CAST(2000 + year(o_orderdate) % 100 AS BIGINT), month(o_orderdate),
                           day(o_orderdate)) END AS sheet_date
FROM orders"""
    stmt_rows = f"""
WITH mv AS (
  SELECT CAST(o_custkey // {D.STATEMENT_CUSTOMERS} AS BIGINT) AS stmt, o_orderkey, o_orderdate, o_orderpriority,
         o_orderstatus,
         CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(12,2)) END AS debit,
         CASE WHEN o_orderstatus = 'O' THEN CAST(o_totalprice AS DECIMAL(12,2)) END AS credit
  FROM orders),
bal AS (
  SELECT *, {D.OPENING_BALANCE} + SUM(COALESCE(credit, 0) - COALESCE(debit, 0)) OVER (
              PARTITION BY stmt ORDER BY o_orderdate NULLS FIRST, o_orderkey
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS balance
  FROM mv)"""
    cols = """o_orderpriority || '/' || o_orderstatus || '/' || CAST(o_orderkey AS VARCHAR) AS description,
       'REF ' || CAST(o_orderkey AS VARCHAR) AS ref_no,
       CAST(debit AS DOUBLE) AS debit, CAST(credit AS DOUBLE) AS credit, CAST(balance AS DOUBLE) AS balance"""
    sql["statement_text"] = stmt_rows + f"""
SELECT stmt, CAST(o_orderdate AS DATE) AS txn_date, CAST(o_orderdate AS DATE) AS value_date,
       {cols}
FROM bal"""
    # Every period's file opens at the same balance and runs on its own.
    sql["consolidate"] = stmt_rows.replace("PARTITION BY stmt", "PARTITION BY stmt, period_idx").replace(
        "SELECT CAST(o_custkey //", """SELECT CAST(CASE WHEN o_orderdate < TIMESTAMP '1997-01-01' THEN 0
                   WHEN o_orderdate < TIMESTAMP '1999-01-01' THEN 1 WHEN o_orderdate IS NOT NULL THEN 2 ELSE 3 END AS BIGINT) AS period_idx,
         CAST(o_custkey //""") + f"""
SELECT stmt, period_idx, CAST(o_orderdate AS DATE) AS value_date,
       {cols}
FROM bal"""
    # Years follow each other; what was planted is told from stmt + year, and what it does to the next period too.
    sql["period_chain"] = f"""
WITH mv AS (
  SELECT CAST(o_custkey // {D.STATEMENT_CUSTOMERS} AS BIGINT) AS stmt, CAST(year(o_orderdate) AS BIGINT) AS year,
         SUM(CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN -1 ELSE 0 END * CAST(o_totalprice AS DECIMAL(12,2))) AS moved
  FROM orders GROUP BY 1, 2),
p AS (
  SELECT stmt, year, (stmt + year) % 5 AS planted,
         {D.OPENING_BALANCE} + SUM(moved) OVER (PARTITION BY stmt ORDER BY year) AS closing, moved,
         LAG(year) OVER (PARTITION BY stmt ORDER BY year) AS last_year
  FROM mv),
q AS (
  SELECT *, CASE planted WHEN 1 THEN make_date(year, 2, 1) WHEN 2 THEN make_date(year - 1, 12, 21) ELSE make_date(year, 1, 1) END AS period_start,
         make_date(year, 12, 31) AS period_end FROM p)
SELECT stmt, year, period_start, period_end,
       CAST(CASE WHEN last_year IS NOT NULL THEN GREATEST(date_diff('day', make_date(last_year, 12, 31), period_start) - 1, 0) END AS BIGINT) AS gap_days,
       CAST(CASE WHEN last_year IS NOT NULL THEN GREATEST(1 - date_diff('day', make_date(last_year, 12, 31), period_start), 0) END AS BIGINT) AS overlap_days,
       CASE WHEN last_year IS NOT NULL THEN CAST(CASE planted WHEN 3 THEN 1 ELSE 0 END AS DOUBLE) END AS opening_diff,
       CASE WHEN last_year IS NULL THEN 'first' WHEN last_year = year - 1 AND planted = 2 THEN 'overlap'
            WHEN last_year < year - 1 OR planted = 1 THEN 'gap' WHEN planted = 3 THEN 'balance' ELSE 'ok' END AS status
FROM q"""
    sql["period_repeats"] = f"""
SELECT CAST(o_custkey // {D.STATEMENT_CUSTOMERS} AS BIGINT) AS stmt, o_orderkey, CAST(o_orderdate AS DATE) AS day,
       o_totalprice AS amount, CAST(2 AS BIGINT) AS n_periods, CAST(year(o_orderdate) AS BIGINT) AS first_period
FROM orders WHERE o_orderkey % 37 = 0"""
    sql["statement_csv"] = stmt_rows + f"""
SELECT stmt, CAST(o_orderdate AS DATE) AS value_date,
       {cols}
FROM bal"""
    sql["statement_meta"] = f"""
SELECT CAST(o_custkey // {D.STATEMENT_CUSTOMERS} AS BIGINT) AS stmt,
       CAST(MIN(o_orderdate) AS DATE) AS period_start, CAST(MAX(o_orderdate) AS DATE) AS period_end,
       CAST({D.OPENING_BALANCE} AS DOUBLE) AS opening_balance,
       CAST(MIN(o_orderdate) AS DATE) AS opening_balance_date, 'ok' AS status
FROM orders GROUP BY 1"""
    # Sheets: the dated rows' dates, carried down each file in key order.
    sheets = f"""
WITH s AS (
  SELECT CAST(o_custkey // {D.SHEET_CUSTOMERS} AS BIGINT) AS grp, o_orderkey,
         'order ' || CAST(o_orderkey AS VARCHAR) AS item,
         CASE WHEN o_orderkey % 8 = 1 THEN CAST(o_orderdate AS DATE)
              WHEN o_orderkey % 4 = 1 THEN make_date(CAST(2000 + year(o_orderdate) % 100 AS BIGINT),
                                                     month(o_orderdate), day(o_orderdate))
         END AS d,
         CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS expenditure,
         NULLIF(o_orderpriority, '5-LOW') AS category
  FROM orders),
f AS (
  SELECT grp, item, expenditure, category,
         last_value(d IGNORE NULLS) OVER (PARTITION BY grp ORDER BY o_orderkey
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sheet_date
  FROM s)
"""
    sql["sheet_fill_forward"] = sheets + "SELECT grp, item, sheet_date FROM f"
    sql["sheet_spend_by_month"] = sheets + """
SELECT category AS Category, CAST(date_trunc('month', sheet_date) AS DATE) AS period,
       """ + _exact("expenditure") + """ AS total
FROM f GROUP BY 1, 2"""
    return {k: v.strip() for k, v in sql.items()}


ORACLE_SQL: dict[str, str] = _oracles()
