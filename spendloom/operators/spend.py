"""Spending analytics: totals by key and period, fill-forward, cumulative spend.

Totals of doubles are exact sums, rounded once (``functions.exact``), so they
do not depend on the partitioning; an amount of 1e24 or more counts as
missing. Decimals are summed as decimals. Aggregations are partial + final
(map-side combine), so a hot category costs one row per map task in the
shuffle. Ordered work goes through the skew-safe scans in ``ordered``.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from spendloom.functions.exact import amount_digits, digits_total, exact_sum
from spendloom.operators.ordered import fill_forward as _fill_forward
from spendloom.operators.ordered import DEFAULT_CHUNK_ROWS, scan

GRAINS = ("month", "year")


def money_sum(c) -> Column:
    """Exact money total of doubles, rounded once to a double (NULL if all NULL)."""
    return exact_sum(c)


def _total(df: DataFrame, amount: str) -> Column:
    if isinstance(df.schema[amount].dataType, DecimalType):
        return F.sum(amount).cast("double")
    return money_sum(amount)


def spend_by(df: DataFrame, keys: Sequence[str] | str = "Category",
             amount: str = "Expenditure", alias: str = "Total_Expenditure") -> DataFrame:
    """G1: ``sum(amount) AS alias`` grouped by ``keys``; the NULL key is a group.

    A group whose amounts are all NULL totals NULL, not 0.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(_total(df, amount).alias(alias))


def period_start(date_col, grain: str) -> Column:
    """First day of the month / year holding ``date_col`` (a date)."""
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {GRAINS}")
    col = F.col(date_col) if isinstance(date_col, str) else date_col
    return F.trunc(col, grain)


def spend_by_period(df: DataFrame, date_col: str, amount: str, grain: str = "month",
                    keys: Sequence[str] = (), alias: str = "total") -> DataFrame:
    """Totals per period (``period`` = first day of month / year)."""
    return (df.groupBy(*keys, period_start(date_col, grain).alias("period"))
            .agg(_total(df, amount).alias(alias)))


def fill_forward(df: DataFrame, column: str, order: Sequence[str] | str,
                 part: Sequence[str] | str | None = None, out: str | None = None,
                 chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """L2: replace a NULL ``column`` with the last non-NULL value before it.

    ``order`` must be a total order within ``part`` (no partition = one
    ordered sheet; still spread over many tasks by chunks).
    """
    order = [order] if isinstance(order, str) else list(order)
    return _fill_forward(df, column, out or column, part=part, order=order, chunk_rows=chunk_rows)


def cumulative(df: DataFrame, date_col: str, amount: str, grain: str = "month",
               order: Sequence[str] | str = (), keys: Sequence[str] = (),
               out: str | None = None, chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """L3: running spend that resets every calendar month / year.

    Rows with a NULL amount add nothing but still carry the running figure.
    ``order`` defaults to ``date_col``; add a unique tie-breaker for a total
    order.
    """
    return cumulatives(df, date_col, amount, {out or f"cumulative_{grain}": grain}, order, keys, chunk_rows)


def cumulatives(df: DataFrame, date_col: str, amount: str, grains: Mapping[str, str],
                order: Sequence[str] | str = (), keys: Sequence[str] = (),
                chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """L3 for several periods at once: ``grains`` maps output columns to grains.

    The rows are counted and shuffled once, by the coarsest period; every
    finer one is a running sum that starts anew within it.
    """
    order = [order] if isinstance(order, str) else list(order)
    order = order or [date_col]
    coarsest = max(grains.values(), key=GRAINS.index)
    periods = {grain: f"__{grain}" for grain in grains.values()}
    digits = [F.coalesce(d, F.lit(0).cast("long")) for d in amount_digits(F.col(amount).try_cast("double"))]
    parts = [f"__d{k}" for k in range(len(digits))]
    dated = df.select("*", *[d.alias(n) for d, n in zip(digits, parts)], *[period_start(date_col, grain).alias(name) for grain, name in periods.items()])
    s = scan(dated, [*keys, periods[coarsest]], order, chunk_rows)
    rows = s.rows
    for grain, name in sorted(periods.items(), key=lambda p: -GRAINS.index(p[0])):
        rows = rows.select("*", *[F.sum(d).over(s.up_to_here(within=[name])).alias(f"{name}{d}") for d in parts])
    if s.carry_rows:
        # a period's chunks before this one, the finer period being part of the key
        for grain, name in periods.items():
            totals = s.summaries(rows, *[F.sum(d).alias(d) for d in parts], within=[name])
            starts = [F.sum(d).over(s.chunks_before(within=[name])).alias(f"__start{name}{d}") for d in parts]
            rows = s.join_back(rows, totals.select(*s.keys([name]), *starts), within=[name])
            for d in parts:
                rows = rows.withColumn(f"{name}{d}", F.col(f"{name}{d}") + F.coalesce(F.col(f"__start{name}{d}"), F.lit(0)))
    rows = rows.select("*", *[digits_total([F.col(f"{periods[grain]}{d}") for d in parts]).alias(out) for out, grain in grains.items()])
    names = [*periods.values()]
    return s.done(rows, *parts, *names, *[f"{kind}{name}{d}" for name in names for d in parts for kind in ("", "__start")])
