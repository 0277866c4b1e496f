"""Deterministic statement-shaped inputs derived from the driver tables.

No bank statements ship with the test data, so the registered queries build
them from ``orders``, ``lineitem``, ``events``, ``pages`` and ``documents``
inside the plan: every derived row comes from one source row by column
expressions only, so the work grows with the tables and nothing is sampled.
The DuckDB oracles in ``catalog`` build the same inputs independently.

Derived statements (``orders_raw_rows``)
----------------------------------------
* statement = customer (``stmt-<o_custkey>``), table = order year - 1995,
  row = ``o_orderkey``.
* header variant per table: ``(o_custkey + table_idx) % 3``; customers with
  ``o_custkey % 50 = 0`` only get an unusable ``Name, Value`` table.
  0: `` Value Date , Deposits, Withdrawals, Balance``;
  1: ``Date, Debit, Credit, Closing Balance`` (amount columns swapped);
  2: ``Txn Date, Description, Amount`` (no balance: table skipped).
* row kind ``o_orderkey % 10`` plants every case of the normaliser:
  0 payee with slash, 1 UPI path, 2 header caption before the date,
  3 ``NEFT dd Mon`` (undated), 4 whitespace noise, 5 ``Balance Brought
  Forward`` (rejected, still dated), 6 lower-case month, 7 account line
  without amounts (rejected), 8 missing text, 9 continuation line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

START_YEAR_OFFSET = 1995


#: Session setting: deal the rows of ``cpu_heavy`` inputs out to so many tasks.
#: Unset by default; for tables stored as one row group, which no reader
#: setting can split.
INPUT_PARTITIONS = "spendloom.input.partitions"


def table(spark: SparkSession, sf_dir: str, name: str, cpu_heavy: bool = False) -> DataFrame:
    """A driver table. ``cpu_heavy`` marks inputs whose per-row work before the
    first shuffle dominates (text cleaners, statement normalisation); only for
    those, INPUT_PARTITIONS counts."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    wanted = spark.conf.get(INPUT_PARTITIONS, None) if cpu_heavy else None
    return df.repartition(int(wanted)) if wanted else df


def money_text(c: Column) -> Column:
    """``123456.50``: the value as 2-decimal text."""
    return c.cast("decimal(12,2)").cast("string")


def grouped_text(c: Column) -> Column:
    """``123,456.50``: 2-decimal text with thousands separators."""
    return F.format_number(c.cast("decimal(28,2)"), 2)


def orders_raw_rows(orders: DataFrame) -> DataFrame:
    """Extracted-table rows (``raw_rows`` contract) derived from orders."""
    o = orders
    kind = (F.col("o_orderkey") % 10).cast("int")
    table_idx = (F.year("o_orderdate") - START_YEAR_OFFSET).cast("int")
    variant = (F.when(F.col("o_custkey") % 50 == 0, F.lit(3))
               .otherwise(((F.col("o_custkey") + table_idx) % 3).cast("int")))
    mon = F.date_format("o_orderdate", "MMM")
    dd = F.date_format("o_orderdate", "dd")
    md = F.concat(mon, F.lit(" "), dd)
    key = F.col("o_orderkey").cast("string")
    date_desc = (
        F.when(kind == 0, F.concat(md, F.lit(" SHOP/"), F.col("o_orderpriority")))
        .when(kind == 1, F.concat(md, F.lit(" UPI/"), F.col("o_orderpriority"), F.lit("/"),
                                  F.col("o_orderstatus"), F.lit("/ref"), key))
        .when(kind == 2, F.concat(F.lit("Date   Value Description Date "), md))
        .when(kind == 3, F.concat(F.lit("NEFT "), dd, F.lit(" "), mon))
        .when(kind == 4, F.concat(md, F.lit(" ATM  WDL\t"), key))
        .when(kind == 5, F.concat(F.lit("Balance Brought Forward "), md))
        .when(kind == 6, F.concat(F.lower(mon), F.lit(" "), dd, F.lit("   atm  cash ")))
        .when(kind == 7, F.concat(md, F.lit(" Account summary")))
        .when(kind == 8, F.lit(None).cast("string"))
        .otherwise(F.lit("continued text")))
    amounts = ~kind.isin(7, 9)
    price = F.col("o_totalprice")
    deposit = F.when(amounts & (F.col("o_orderstatus") == "O"), money_text(price))
    withdrawal = F.when(amounts & (F.col("o_orderstatus") == "F"),
                        F.concat(F.lit("₹"), grouped_text(price)))
    balance = F.when(amounts, F.concat(money_text(price), F.lit(" Cr")))
    headers = (
        F.when(variant == 0, F.array(*map(F.lit, [" Value Date ", "Deposits", "Withdrawals", "Balance"])))
        .when(variant == 1, F.array(*map(F.lit, ["Date", "Debit", "Credit", "Closing Balance"])))
        .when(variant == 2, F.array(*map(F.lit, ["Txn Date", "Description", "Amount"])))
        .otherwise(F.array(*map(F.lit, ["Name", "Value"]))))
    # One CASE per cell position, so the date text is built once per row.
    name = F.concat(F.lit("cust "), F.col("o_custkey").cast("string"))
    c1 = F.when(variant == 3, name).otherwise(date_desc)
    c2 = (F.when(variant == 0, deposit).when(variant == 1, withdrawal)
          .when(variant == 2, F.lit("x")).otherwise(money_text(price)))
    c3 = F.when(variant == 0, withdrawal).when(variant == 1, deposit).otherwise(money_text(price))
    width = F.when(variant <= 1, 4).when(variant == 2, 3).otherwise(2)
    cells = F.slice(F.array(c1, c2, c3, balance), F.lit(1), width)
    return o.select(
        F.concat(F.lit("stmt-"), F.col("o_custkey").cast("string")).alias("statement_id"),
        table_idx.alias("table_idx"),
        F.col("o_orderkey").cast("long").alias("row_idx"),
        headers.alias("headers"),
        cells.alias("cells"),
    )


def customer_statements(customer: DataFrame) -> DataFrame:
    """Every customer's statement and, for ``c_custkey % 41 = 0``, why its extraction broke off."""
    key = F.col("c_custkey")
    error = F.when(key % 41 == 0, F.concat(F.lit("page "), (key % 7).cast("string"), F.lit(" unreadable")))
    return customer.select(F.concat(F.lit("stmt-"), key.cast("string")).alias("statement_id"), error.alias("error"),
                           ((key % 41 == 0) & (key % 2 == 0)).alias("nothing"))


def with_faults(raw: DataFrame, statements: DataFrame) -> DataFrame:
    """``raw_rows`` with planted breaches of the contract, told from the row number (the order's key).

    ``% 70 = 0``: the row is there twice; ``% 110 = 1``: another row, with a
    longer first cell, stands at its position; ``% 130 = 2``: one cell more
    than headers. Statements marked ``nothing`` lose all rows.
    """
    n = F.col("row_idx")
    here = raw.join(statements.where("not nothing").select("statement_id"), "statement_id", "left_semi")
    more = F.when(n % 130 == 2, F.concat("cells", F.array(F.lit("extra")))).otherwise(F.col("cells"))
    longer = F.transform("cells", lambda c, i: F.when(i == 0, F.concat(c, F.lit("~"))).otherwise(c))
    every = (F.when(n % 70 == 0, F.array("cells", "cells")).when(n % 110 == 1, F.array("cells", longer)).otherwise(F.array(more)))
    return here.select("statement_id", "table_idx", "row_idx", "headers", F.explode(every).alias("cells"))


def lineitem_amount_text(lineitem: DataFrame) -> DataFrame:
    """``l_extendedprice`` dressed up as statement amount text by line number."""
    p = F.col("l_extendedprice")
    n = F.col("l_linenumber")
    raw = (F.when(n == 1, money_text(p))
           .when(n == 2, F.concat(F.lit("₹"), grouped_text(p)))
           .when(n == 3, F.concat(F.lit("("), money_text(p), F.lit(")")))
           .when(n == 4, F.concat(F.lit("-"), grouped_text(p)))
           .when(n == 5, F.concat(money_text(p), F.lit("-")))
           .when(n == 6, F.concat(F.lit("Rs. "), money_text(p)))
           .otherwise(F.concat(F.lit("USD "), grouped_text(p), F.lit(" Cr"))))
    return lineitem.select("l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"),
                           raw.alias("raw_amount"))


def orders_date_text(orders: DataFrame) -> DataFrame:
    """``o_orderdate`` printed in one of ten shapes chosen by ``o_orderkey % 10``."""
    d = F.col("o_orderdate")
    k = F.col("o_orderkey") % 10
    txt = (F.when(k == 0, F.date_format(d, "dd/MM/yyyy"))
           .when(k == 1, F.date_format(d, "dd-MM-yyyy"))
           .when(k == 2, F.date_format(d, "dd/MM/yy"))
           .when(k == 3, F.date_format(d, "MMM dd yyyy"))
           .when(k == 4, F.date_format(d, "dd MMM yyyy"))
           .when(k == 5, F.date_format(d, "MMM dd"))
           .when(k == 6, F.date_format(d, "dd MMM"))
           .when(k == 7, F.concat(F.lit("Paid on "), F.date_format(d, "dd/MM/yyyy"), F.lit(" ref 12")))
           .when(k == 8, F.date_format(d, "MMMM dd yyyy"))
           .otherwise(F.date_format(d, "yyyy-MM-dd")))
    return orders.select("o_orderkey", txt.alias("date_text"))


def orders_month_day_text(orders: DataFrame) -> DataFrame:
    """Month-day text with noise, shape by ``o_orderkey % 6``."""
    d = F.col("o_orderdate")
    mon, dd = F.date_format(d, "MMM"), F.date_format(d, "dd")
    k = F.col("o_orderkey") % 6
    txt = (F.when(k == 0, F.concat(mon, F.lit(" "), dd, F.lit(" SHOP")))
           .when(k == 1, F.concat(F.lit("NEFT "), dd, F.lit(" "), mon))
           .when(k == 2, F.concat(F.lit("O"), F.lower(mon), F.lit(" "), dd))
           .when(k == 3, F.concat(F.upper(mon), F.lit("  "), dd))
           .when(k == 4, F.concat(F.lit("ref "), mon, F.lit(" "), F.date_format(d, "yyyy")))
           .otherwise(F.lit("no date here")))
    return orders.select("o_orderkey", txt.alias("txt"))


def orders_payment_text(orders: DataFrame) -> DataFrame:
    """Row text with payment keywords, amount cells and balance, by ``o_orderkey % 5``."""
    key = F.col("o_orderkey")
    amt = F.concat((key % 1000 + 1).cast("string"), F.lit("."),
                   F.lpad((F.col("o_custkey") % 100).cast("string"), 2, "0"))
    k = key % 5
    txt = (F.when(k == 0, F.concat(F.lit("UPI/PAYEE "), F.col("o_custkey").cast("string"), F.lit("/"), amt))
           .when(k == 1, F.concat(F.lit("SALARY CREDIT "), amt))
           .when(k == 2, F.concat(F.lit("NEFT CREDIT ref "), key.cast("string"), F.lit(" amt "), amt))
           .when(k == 3, F.concat(F.lit("POS PURCHASE "), amt, F.lit(" bal "), money_text(F.col("o_totalprice"))))
           .otherwise(F.concat(F.lit("misc "), amt)))
    every3 = key % 3 == 0
    return orders.select(
        "o_orderkey", txt.alias("txt"),
        F.when((F.col("o_orderstatus") == "F") & every3, amt).alias("withdrawal_cell"),
        F.when((F.col("o_orderstatus") == "O") & every3, amt).alias("deposit_cell"),
        money_text(F.col("o_totalprice")).alias("balance_cell"))


def documents_with_boilerplate(documents: DataFrame) -> DataFrame:
    """Whole document texts with statement boilerplate planted by ``doc_id % 5``."""
    t = F.col("text")
    k = F.col("doc_id") % 5
    txt = (F.when(k == 0, F.concat(F.lit("STATEMENT DATE "), t, F.lit(" Phone No.: 12345 tail")))
           .when(k == 1, F.concat(t, F.lit(" Balance Brought Forward")))
           .when(k == 2, F.concat(F.lit("Date   Value Description Date "), t))
           .when(k == 3, F.concat(F.lit("ACCOUNT NO "), t))
           .otherwise(t))
    return documents.select("doc_id", txt.alias("txt"))


def pages_payment_paths(pages: DataFrame) -> DataFrame:
    """Slash-delimited texts from page URLs, shape by ``page_id % 4``."""
    u = F.col("url")
    k = F.col("page_id") % 4
    txt = (F.when(k == 0, u)
           .when(k == 1, F.concat(F.lit(" "), F.replace(u, F.lit("/"), F.lit(" / ")), F.lit(" ")))
           .when(k == 2, F.concat(u, F.lit("/")))
           .otherwise(F.concat(F.lit("NEFT CRED "), F.replace(u, F.lit("/"), F.lit("")))))
    return pages.select("page_id", txt.alias("txt"))


def orders_account_movements(orders: DataFrame) -> DataFrame:
    """Per-customer account: debit for F orders, credit for O orders."""
    price = F.col("o_totalprice").cast("decimal(12,2)")
    return orders.select(
        "o_custkey", "o_orderkey", "o_orderdate",
        F.when(F.col("o_orderstatus") == "F", price).cast("double").alias("debit"),
        F.when(F.col("o_orderstatus") == "O", price).cast("double").alias("credit"))


def orders_sheet_date_text(orders: DataFrame) -> DataFrame:
    """Sheet-style ``d-M-yyyy`` / ``d-M-yy`` dates, by ``o_orderkey % 2``."""
    d = F.col("o_orderdate")
    txt = F.when(F.col("o_orderkey") % 2 == 0, F.date_format(d, "d-M-yyyy")).otherwise(F.date_format(d, "d-M-yy"))
    return orders.select("o_orderkey", txt.alias("sheet_text"))


# ---------------------------------------------------------------------------
# Statement files (text and consolidated CSV) written from orders
# ---------------------------------------------------------------------------

#: Customers per derived statement (file): ``o_custkey div STATEMENT_CUSTOMERS``,
#: so the number of statements follows the data.
STATEMENT_CUSTOMERS = 256
#: Opening balance of every derived account: beyond what a double holds to the cent.
ACCOUNT_OPENING = "1000000000000000000"
#: Opening balance of every derived statement.
OPENING_BALANCE = 100000
STATEMENT_HEADER = "\t".join(["Txn Date", "Value Date", "Description", "Ref No./Cheque No.",
                              "        Debit", "Credit", "Balance"]) + "\t"
STATEMENT_CSV_HEADER = "﻿Value Date,Description,Ref No./Cheque No.,        Debit,Credit,Balance"


def orders_statement_movements(orders: DataFrame, running_sum, period: Column | None = None) -> DataFrame:
    """Per statement (and ``period``, 0 by default): one movement per order and the running balance after it.

    ``running_sum`` is the library's skew-safe scan (passed in to keep this
    module free of operator imports).
    """
    price = F.col("o_totalprice").cast("decimal(12,2)")
    mv = orders.select(
        F.expr(f"o_custkey div {STATEMENT_CUSTOMERS}").alias("stmt"), (F.lit(0) if period is None else period).alias("period"),
        "o_orderkey", "o_orderdate", "o_orderpriority", "o_orderstatus",
        F.when(F.col("o_orderstatus") == "F", price).alias("debit"),
        F.when(F.col("o_orderstatus") == "O", price).alias("credit"))
    dec = "decimal(18,2)"
    mv = mv.withColumn("__delta", F.coalesce(F.col("credit").cast(dec), F.lit(0).cast(dec))
                       - F.coalesce(F.col("debit").cast(dec), F.lit(0).cast(dec)))
    run = running_sum(mv, "__delta", "__run", part=["period", "stmt"] if period is not None else "stmt", order=["o_orderdate", "o_orderkey"])
    return run.withColumn("balance", (F.col("__run") + F.lit(OPENING_BALANCE)).cast("decimal(28,2)")).drop("__delta", "__run")


def orders_periods(orders: DataFrame, running_sum) -> DataFrame:
    """One row per statement and year: stmt, year, period_start, period_end, opening_balance, closing_balance.

    Planted by ``(stmt + year) % 5``: 1 begins a month late, 2 begins eleven
    days early, 3 opens one higher than the year before closed.
    """
    year = F.year("o_orderdate")
    moves = orders_statement_movements(orders, running_sum)
    moved = F.coalesce(F.col("credit"), F.lit(0)) - F.coalesce(F.col("debit"), F.lit(0))
    place = F.struct("o_orderdate", "o_orderkey")
    p = (moves.select("stmt", year.cast("long").alias("year"), place.alias("at"), "balance", (F.col("balance") - moved).alias("before"))
         .groupBy("stmt", "year").agg(F.min_by("before", "at").alias("before"), F.max_by("balance", "at").alias("closing_balance")))
    planted = (F.col("stmt") + F.col("year")) % 5
    jan1 = F.make_date(F.col("year").cast("int"), F.lit(1), F.lit(1))
    start = F.when(planted == 1, F.add_months(jan1, 1)).when(planted == 2, F.date_sub(jan1, 11)).otherwise(jan1)
    return p.select("stmt", "year", start.alias("period_start"), F.make_date(F.col("year").cast("int"), F.lit(12), F.lit(31)).alias("period_end"),
                    (F.col("before") + F.when(planted == 3, 1).otherwise(0)).alias("opening_balance"), "closing_balance")


def orders_period_rows(orders: DataFrame) -> DataFrame:
    """Movements by statement and year; every 37th order also stands in the year after."""
    year = F.year("o_orderdate").cast("long")
    years = F.when(F.col("o_orderkey") % 37 == 0, F.array(year, year + 1)).otherwise(F.array(year))
    return orders.select(F.expr(f"o_custkey div {STATEMENT_CUSTOMERS}").alias("stmt"), F.explode(years).alias("year"), "o_orderkey",
                         F.to_date("o_orderdate").alias("day"), F.col("o_totalprice").alias("amount"))


def _blank_or(text: Column) -> Column:
    return F.coalesce(text, F.lit(" "))


def statement_text_lines(mv: DataFrame) -> DataFrame:
    """Statement text lines with a per-file sort key: preamble, header, rows,
    blank line, trailer. Columns: period, stmt, section, k1, k2, value."""
    d = F.col("o_orderdate")
    day = _blank_or(F.date_format(d, "d MMM yyyy"))
    row = F.concat_ws("\t", day, day,
                      F.concat(F.lit("   "), F.col("o_orderpriority"), F.lit("/"), F.col("o_orderstatus"),
                               F.lit("/"), F.col("o_orderkey").cast("string")),
                      F.concat(F.lit("REF "), F.col("o_orderkey").cast("string")),
                      _blank_or(grouped_text(F.col("debit"))), _blank_or(grouped_text(F.col("credit"))),
                      grouped_text(F.col("balance")))
    rows = mv.select("period", "stmt", F.lit(2).alias("section"), d.alias("k1"), F.col("o_orderkey").alias("k2"),
                     row.alias("value"))
    span = mv.groupBy("period", "stmt").agg(F.min(d).alias("first"), F.max(d).alias("last"))
    opening = F.format_number(F.lit(OPENING_BALANCE).cast("decimal(18,2)"), 2)
    pre = [
        F.concat(F.lit("Account Name       :\tStatement "), F.col("stmt").cast("string")),
        F.concat(F.lit("Balance on "), _blank_or(F.date_format("first", "d MMM yyyy")), F.lit("        :\t"), opening),
        F.concat(F.lit("Start Date          :\t"), _blank_or(F.date_format("first", "d MMM yyyy"))),
        F.concat(F.lit("End Date            :\t"), _blank_or(F.date_format("last", "d MMM yyyy"))),
        F.lit(STATEMENT_HEADER),
    ]
    fixed = span.select("period", "stmt", F.explode(F.array(*[
        F.struct(F.lit(s).alias("section"), F.lit(i).cast("long").alias("k2"), v.alias("value"))
        for i, (s, v) in enumerate([(0, p) for p in pre[:4]] + [(1, pre[4])])
    ] + [
        F.struct(F.lit(3).alias("section"), F.lit(0).cast("long").alias("k2"), F.lit("").alias("value")),
        F.struct(F.lit(4).alias("section"), F.lit(0).cast("long").alias("k2"),
                 F.lit("**This is a computer generated statement.").alias("value")),
    ])).alias("l")).select("period", "stmt", "l.section", F.lit(None).cast("timestamp_ntz").alias("k1"), "l.k2", "l.value")
    return rows.unionByName(fixed)


def statement_csv_lines(mv: DataFrame) -> DataFrame:
    """Consolidated-CSV lines (BOM header, quoted grouped amounts, ' ' blanks)."""
    d = F.col("o_orderdate")

    def q(c: Column) -> Column:
        return F.concat(F.lit('"'), grouped_text(c), F.lit('"'))
    row = F.concat_ws(",", _blank_or(F.date_format(d, "dd-MMM-yy")),
                      F.concat(F.lit("   "), F.col("o_orderpriority"), F.lit("/"), F.col("o_orderstatus"),
                               F.lit("/"), F.col("o_orderkey").cast("string")),
                      F.concat(F.lit("REF "), F.col("o_orderkey").cast("string")),
                      _blank_or(q(F.col("debit"))), _blank_or(q(F.col("credit"))), q(F.col("balance")))
    rows = mv.select("period", "stmt", F.lit(2).alias("section"), d.alias("k1"), F.col("o_orderkey").alias("k2"),
                     row.alias("value"))
    head = mv.select("period", "stmt").distinct().select(
        "period", "stmt", F.lit(1).alias("section"), F.lit(None).cast("timestamp_ntz").alias("k1"),
        F.lit(0).cast("long").alias("k2"), F.lit(STATEMENT_CSV_HEADER).alias("value"))
    return rows.unionByName(head)


def write_statement_files(lines: DataFrame, path: str) -> str:
    """One file per statement, lines in order: ``<path>/period=<k>/stmt=<n>/part-*``.

    Rows are hash-partitioned by statement and sorted within each task, so
    every statement is written by one task in line order.
    """
    (lines.repartition("period", "stmt")
     .sortWithinPartitions("period", "stmt", "section", "k1", "k2")
     .select("period", "stmt", F.coalesce("value", F.lit("")).alias("value"))
     .write.mode("overwrite").partitionBy("period", "stmt").text(path))
    return path


# ---------------------------------------------------------------------------
# Expense sheets (CSV) written from orders
# ---------------------------------------------------------------------------

#: Customers per derived sheet (file): ``o_custkey div SHEET_CUSTOMERS``.
SHEET_CUSTOMERS = 1024


def orders_sheet_rows(orders: DataFrame) -> DataFrame:
    """Expense-sheet rows in the sheet's column order, plus ``grp`` and ``o_orderkey``.

    Only every fourth order (``o_orderkey % 4 = 1``) carries a date, as
    ``d-M-yyyy`` when ``o_orderkey % 8 = 1`` and ``d-M-yy`` otherwise; the
    rest are blank and are filled from the row above. Expenditure is blank
    for status ``P``; ``5-LOW`` orders have no category.
    """
    k = F.col("o_orderkey")
    d = F.col("o_orderdate")
    date_text = F.when(k % 4 == 1, F.when(k % 8 == 1, F.date_format(d, "d-M-yyyy"))
                       .otherwise(F.date_format(d, "d-M-yy")))
    none = F.lit(None).cast("double")
    return orders.select(
        F.expr(f"o_custkey div {SHEET_CUSTOMERS}").alias("grp"), "o_orderkey",
        date_text.alias("Date"),
        F.concat(F.lit("order "), k.cast("string")).alias("Item"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("Expenditure"),
        none.alias("Cumulative - Monthly"), none.alias("Cumulative - Yearly"), none.alias("Comments"),
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("Category"))


def write_sheet_files(rows: DataFrame, path: str) -> str:
    """One CSV per sheet with its header, rows in key order: ``<path>/grp=<n>/part-*``."""
    (rows.repartition("grp")
     .sortWithinPartitions("grp", "o_orderkey")
     .drop("o_orderkey")
     .write.mode("overwrite").partitionBy("grp").option("header", True).csv(path))
    return path
