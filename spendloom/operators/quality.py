"""Extraction statistics, header inventory, running-balance reconciliation and the chain of statement periods."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendloom.operators.normalise import map_roles
from spendloom.operators.ordered import DEFAULT_CHUNK_ROWS, scan
from spendloom.schema import MONEY_DECIMAL


#: States of a statement, the first that applies.
STATEMENT_STATES = ("failed", "no_table", "rejected", "no_usable_table", "empty_ledger", "partly_rejected", "ok")


def extraction_stats(raw_rows: DataFrame, ledger: DataFrame, statements: DataFrame | None = None,
                     rejected: DataFrame | None = None) -> DataFrame:
    """Per statement, tables found, usable tables, raw rows, ledger rows, rejected rows, status.

    Statements with no usable table or no ledger row are kept (ledger rows
    0). ``statements`` (``statement_id``, and ``error``: why extraction failed,
    NULL if it did not) also brings in statements for which extraction found
    no table at all or broke off. ``rejected`` are the rows that the contract
    gate took out of ``raw_rows`` (``sources.split_contract``), each with its
    number of ``copies``.

    ``status`` is one of STATEMENT_STATES: ``failed`` (there is an error,
    which is repeated in ``error``; the counts say how far it came),
    ``no_table``, ``rejected`` (all its rows were), ``no_usable_table``,
    ``empty_ledger``, ``partly_rejected`` or ``ok``.

    Two-step aggregation (per table, then per statement) so a statement with
    many tables is combined map-side.
    """
    # Headers belong to the table, so the role test runs once per table.
    tables = (raw_rows.groupBy("statement_id", "table_idx")
              .agg(F.min_by("headers", "row_idx").alias("headers"),
                   F.count(F.lit(1)).alias("rows")))
    per_table = (map_roles(tables.withColumn("cells", F.array().cast("array<string>")))
                 .select("statement_id", "table_idx", F.col("usable").cast("int").alias("usable"), "rows"))
    stats = (per_table.groupBy("statement_id")
             .agg(F.count(F.lit(1)).alias("tables_found"),
                  F.sum("usable").cast("long").alias("usable_tables"),
                  F.sum("rows").cast("long").alias("raw_rows")))
    out_rows = ledger.groupBy("statement_id").agg(F.count(F.lit(1)).alias("ledger_rows"))
    stats = stats.join(out_rows, "statement_id", "left")
    none = F.lit(None)
    if rejected is not None:
        # a row without a statement id belongs to no statement
        lost = rejected.where("statement_id is not null").groupBy("statement_id").agg(F.sum("copies").alias("rejected_rows"))
        stats = stats.join(lost, "statement_id", "full")
    else:
        stats = stats.withColumn("rejected_rows", none.cast("long"))
    if statements is not None:
        error = F.max("error") if "error" in statements.columns else F.max(none.cast("string"))
        stats = statements.groupBy("statement_id").agg(error.alias("error")).join(stats, "statement_id", "left")
    else:
        stats = stats.withColumn("error", none.cast("string"))
    counts = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
              for c in ("tables_found", "usable_tables", "raw_rows", "ledger_rows", "rejected_rows")]
    status = (F.when(F.col("error").isNotNull(), "failed")
              .when((F.col("tables_found") == 0) & (F.col("rejected_rows") == 0), "no_table")
              .when(F.col("tables_found") == 0, "rejected")
              .when(F.col("usable_tables") == 0, "no_usable_table")
              .when(F.col("ledger_rows") == 0, "empty_ledger")
              .when(F.col("rejected_rows") > 0, "partly_rejected").otherwise("ok"))
    return stats.select("statement_id", *counts, "error").withColumn("status", status)


def header_inventory(raw_rows: DataFrame, n: int = 30) -> DataFrame:
    """``(statement_id, table_idx, headers)`` of the first ``n`` tables.

    Tables are first reduced to one row each (partial aggregation); the
    ``row_number() <= n`` filter is planned as a window group limit, so each
    map task forwards at most ``n`` tables per statement before the shuffle.
    """
    tables = (raw_rows.groupBy("statement_id", "table_idx")
              .agg(F.min_by("headers", "row_idx").alias("headers")))
    w = Window.partitionBy("statement_id").orderBy("table_idx")
    return (tables.withColumn("__rn", F.row_number().over(w))
            .where(F.col("__rn") <= n).drop("__rn"))


def reconcile(ledger: DataFrame, part: Sequence[str] | str = "statement_id",
              order: Sequence[str] | str = ("table_idx", "row_idx"),
              debit: str = "withdrawal", credit: str = "deposit", balance: str = "balance",
              chunk_rows: int = DEFAULT_CHUNK_ROWS, breaks_only: bool = True) -> DataFrame:
    """L4: check ``previous balance - debit + credit = balance`` row by row.

    Adds ``prev_balance`` (the last known balance before the row), ``diff``
    (what the movements since then lead to, minus the row's balance; decimal
    arithmetic, returned as double) and ``status``: ``ok``, ``break``,
    ``no_balance`` (the row's balance is missing, so it cannot be checked; the
    next known one is checked across it) or ``first`` (nothing known before
    it). With ``breaks_only`` rows of status ``break`` and ``no_balance`` stay.
    """
    zero = F.lit(0).cast(MONEY_DECIMAL)

    def money(c: str) -> Column:
        return F.coalesce(F.col(c).try_cast(MONEY_DECIMAL), zero)

    known = F.col(balance).try_cast(MONEY_DECIMAL)
    # One scan carries both states: what has moved so far, and the last known balance with what had moved by then.
    s = scan(ledger.withColumn("__move", money(credit) - money(debit)), part, order, chunk_rows)
    rows = s.rows.withColumn("__moved", F.sum("__move").over(s.up_to_here()))
    rows = rows.withColumn("__known", F.when(known.isNotNull(), F.struct(known.alias("balance"), F.col("__moved").alias("moved"))))
    earlier = s.window().rowsBetween(Window.unboundedPreceding, -1)
    before = rows.withColumn("__before", F.last("__known", ignorenulls=True).over(earlier))
    if s.carry_rows:
        place = F.when(F.col("__known").isNotNull(), F.struct(*s.order))
        ends = s.summaries(rows, F.sum("__move").alias("__total"), F.max_by("__known", place).alias("__last"))
        ends = ends.withColumn("__start", F.coalesce(F.sum("__total").over(s.chunks_before()), zero))
        last = F.struct(F.col("__last.balance").alias("balance"), (F.col("__last.moved") + F.col("__start")).alias("moved"))
        ends = ends.withColumn("__last", F.when(F.col("__last").isNotNull(), last))
        carry = ends.select(*s.part, "__chunk", "__start", F.last("__last", ignorenulls=True).over(s.chunks_before()).alias("__carried"))
        before = s.join_back(before, carry)
        start = F.coalesce(F.col("__start"), zero)
        here = F.struct(F.col("__before.balance").alias("balance"), (F.col("__before.moved") + start).alias("moved"))
        before = (before.withColumn("__moved", F.col("__moved") + start)
                  .withColumn("__before", F.when(F.col("__before").isNotNull(), here).otherwise(F.col("__carried"))))
    diff = F.col("__before.balance") + (F.col("__moved") - F.col("__before.moved")) - known
    status = (F.when(known.isNull(), "no_balance").when(F.col("__before").isNull(), "first")
              .when(diff != 0, "break").otherwise("ok"))
    out = (before.withColumn("prev_balance", F.col("__before.balance").cast("double"))
           .withColumn("status", status).withColumn("diff", diff.cast("double")))
    out = s.done(out, "__move", "__moved", "__known", "__before", "__start", "__carried")
    return out.where(F.col("status").isin("break", "no_balance")) if breaks_only else out


def period_chain(periods: DataFrame, part: Sequence[str] | str = "account", start: str = "period_start", end: str = "period_end",
                 opening: str = "opening_balance", closing: str = "closing_balance", tie: Sequence[str] | str = (),
                 chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Do the statement periods of an account follow each other without gap or overlap, and does each open where the last closed?

    Periods are taken by start, end and ``tie``. Adds ``gap_days`` (days
    between the latest end so far and this start that no period covers),
    ``overlap_days`` (days of this period up to the latest end so far),
    ``opening_diff`` (opening balance minus the last known closing balance,
    NULL if one is unknown) and ``status``: ``undated`` (start or end is
    missing, or they are the wrong way round; such a period is not compared),
    ``first``, ``overlap``, ``gap``, ``balance`` (the amounts differ) or ``ok``.

    One ordered scan carries the latest end and the last closing balance.
    """
    part = [part] if isinstance(part, str) else list(part)
    tie = [tie] if isinstance(tie, str) else list(tie)
    dated = F.coalesce(F.col(start) <= F.col(end), F.lit(False))
    rows = periods.select("*", F.when(dated, F.col(end)).alias("__end"),
                          F.when(dated, F.col(closing).try_cast(MONEY_DECIMAL)).alias("__close"))
    s = scan(rows, part, [start, end, *tie], chunk_rows)
    earlier = s.window().rowsBetween(Window.unboundedPreceding, -1)
    seen = s.rows.select("*", F.max("__end").over(earlier).alias("__until"), F.last("__close", ignorenulls=True).over(earlier).alias("__closed"))
    if s.carry_rows:
        place = F.when(F.col("__close").isNotNull(), F.struct(*s.order))
        ends = s.summaries(s.rows, F.max("__end").alias("__until"), F.max_by("__close", place).alias("__closed"))
        carry = ends.select(*s.keys(), F.max("__until").over(s.chunks_before()).alias("__until0"),
                            F.last("__closed", ignorenulls=True).over(s.chunks_before()).alias("__closed0"))
        seen = s.join_back(seen, carry)
        seen = seen.withColumn("__until", F.greatest("__until", "__until0")).withColumn("__closed", F.coalesce("__closed", "__closed0"))
    after = F.date_diff(F.col(start), F.col("__until"))  # 1: the day after
    diff = F.col(opening).try_cast(MONEY_DECIMAL) - F.col("__closed")
    known = dated & F.col("__until").isNotNull()
    over = F.least(1 - after, F.date_diff(F.col(end), F.col(start)) + 1)
    out = seen.select("*", F.when(known, F.greatest(after - 1, F.lit(0))).cast("long").alias("gap_days"),
                      F.when(known, F.greatest(over, F.lit(0))).cast("long").alias("overlap_days"),
                      F.when(known, diff).cast("double").alias("opening_diff"))
    status = (F.when(~dated, "undated").when(F.col("__until").isNull(), "first").when(F.col("overlap_days") > 0, "overlap")
              .when(F.col("gap_days") > 0, "gap").when(F.col("opening_diff") != 0, "balance").otherwise("ok"))
    return s.done(out.withColumn("status", status), "__end", "__close", "__until", "__closed", "__until0", "__closed0")


def rows_in_several_periods(rows: DataFrame, row: Sequence[str], part: Sequence[str] | str = "account", period: str = "period_idx") -> DataFrame:
    """Rows of an account that stand in more than one of its periods.

    ``row`` names the columns that make two rows the same transaction; with
    the running balance among them, equal payments of one day stay apart.
    Returns part, ``row``, ``n_periods`` and ``first_period``. Copies are
    combined map-side, so a row repeated very often is one row per task.
    """
    part = [part] if isinstance(part, str) else list(part)
    once = rows.select(*part, *row, period).distinct()
    found = once.groupBy(*part, *row).agg(F.count(F.lit(1)).alias("n_periods"), F.min(period).alias("first_period"))
    return found.where("n_periods > 1")
