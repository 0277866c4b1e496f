"""Statement normalisation: ragged extracted tables -> one ordered ledger.

Plan (all lazy, one logical plan):

``raw_rows`` -> P1 header normalise -> P2 role positions -> P3 usable tables
-> A6 month/day of the date-description cell -> F3 dated rows only
-> L1 year inference (skew-safe ordered scan per statement)
-> F1/F2 transaction and boilerplate predicates -> A1 amounts
-> A3 + A4 description -> P4 canonical columns -> O1 sort.

Row order is data: ``(statement_id, table_idx, row_idx)``. Year state moves on
every dated row of a usable table, including rows the predicates reject
later, so L1 runs before F1/F2. Undated rows never touch the state and are
never emitted, so they are dropped before the scan's shuffle.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendloom.functions.scalars import (clean_amount, clean_description,
                                         format_description, iso_date_text,
                                         month_day, regex_escape,
                                         valid_date)
from spendloom.operators.bind import bind
from spendloom.operators.ordered import DEFAULT_CHUNK_ROWS, rollover_count
from spendloom.schema import (BROAD_NOISE_TERMS, DEFAULT_START_YEAR,
                              LEDGER_COLUMNS, LEDGER_SCHEMA, NARROW_NOISE_TERMS,
                              ROLE_ALIASES)

ROLES = list(ROLE_ALIASES)


def _any(preds) -> Column:
    preds = list(preds)
    return reduce(lambda a, b: a | b, preds) if preds else F.lit(False)


#: Joins the headers of a row into one string; never inside a caption.
HEADER_SEP = "\u0001"


def joined_headers(headers: Column) -> Column:
    """Lower-cased headers in one ``HEADER_SEP``-separated string (NULL -> 'nan')."""
    return F.lower(F.array_join(headers, HEADER_SEP, "nan"))


def role_position(joined: Column, aliases: Sequence[str]) -> Column:
    """1-based position of the first header holding any alias; 0 if none.

    Works on ``joined_headers``: the earliest alias hit in the joined string
    lies in the left-most header holding one (aliases never contain the
    separator), and the separators before it give the position. Stripping
    the captions first (P1) cannot change a substring test, because no alias
    starts or ends with whitespace. Plain regexes, so it stays in codegen.
    """
    if not aliases:  # a role without aliases is absent from every table
        return F.lit(0)
    alt = "(?:" + "|".join(regex_escape(a) for a in aliases) + ")"
    prefix = F.regexp_extract(joined, f"(?s)^(.*?){alt}", 1)
    seps = F.length(prefix) - F.length(F.replace(prefix, F.lit(HEADER_SEP), F.lit("")))
    return F.when(joined.rlike(alt), seps + 1).otherwise(F.lit(0)).cast("int")


def map_roles(raw_rows: DataFrame, aliases: dict[str, list[str]] | None = None) -> DataFrame:
    """Add ``pos_<role>`` (0 = absent) and ``cell_<role>`` per row.

    Roles are independent (one column may serve several); among columns the
    left-most match wins. A role whose column is absent yields NULL cells.
    Also adds ``usable``: the table has both a date/description and a
    balance column (P3).
    """
    aliases = {role: list((aliases or ROLE_ALIASES).get(role, ())) for role in ROLES}
    hdr = joined_headers(F.col("headers"))
    # Positions and the cells array are bound: the role cells, ``usable`` and
    # every later filter read them, and an inlined position (or a derived
    # cells expression) would be re-evaluated at each reference.
    df = bind(raw_rows, *[role_position(hdr, opts).alias(f"pos_{role}")
                          for role, opts in aliases.items()], F.col("cells").alias("__cells"))
    df = df.select("*", *[F.when(F.col(f"pos_{role}") > 0, F.get(F.col("__cells"), F.col(f"pos_{role}") - 1))
                          .alias(f"cell_{role}") for role in aliases]).drop("__cells")
    return df.withColumn("usable", (F.col("pos_date_desc") > 0) & (F.col("pos_balance") > 0))


def noise_regex(terms: Iterable[str], extra_terms: Iterable[str] = ()) -> str:
    """Case-insensitive alternation of literal terms."""
    alts = [t for t in terms] + [regex_escape(t) for t in extra_terms]
    return "(?i)(" + "|".join(alts) + ")"


def transaction_predicates(date_desc: Column, deposit: Column, withdrawal: Column,
                           balance: Column, has_deposit: Column, has_withdrawal: Column,
                           extra_noise_terms: Iterable[str] = ()) -> tuple[Column, Column]:
    """F1 and F2 as two boolean columns ``(has_txn_data, is_noise)``.

    F1: an amount cell of a present role is non-NULL, or the balance is, or
    the text is non-NULL and holds no broad boilerplate term.
    F2: the text holds a narrow boilerplate term (rejects even with amounts).
    """
    extra = list(extra_noise_terms)
    broad = noise_regex(BROAD_NOISE_TERMS, extra)
    narrow = noise_regex(NARROW_NOISE_TERMS, extra)
    has_txn = ((has_withdrawal & withdrawal.isNotNull())
               | (has_deposit & deposit.isNotNull())
               | balance.isNotNull()
               | (date_desc.isNotNull() & ~F.coalesce(date_desc.rlike(broad), F.lit(False))))
    is_noise = F.coalesce(date_desc.rlike(narrow), F.lit(False))
    return has_txn, is_noise


def dated_rows(raw_rows: DataFrame, aliases: dict[str, list[str]] | None = None) -> DataFrame:
    """P1-P3 + A6 + F3: rows of usable tables whose own text carries a month-day.

    Columns: statement_id, table_idx, row_idx, month, day, md (month*100+day)
    and the four role cells plus the role-present flags.
    """
    roles = map_roles(raw_rows, aliases).where(F.col("usable"))
    # A missing date/description cell reads as the text "nan", which has no date.
    md = month_day(F.coalesce(F.col("cell_date_desc"), F.lit("nan")))
    return (bind(roles, md.alias("__md"))
            .where(F.col("__md.month").isNotNull())
            .select("statement_id", "table_idx", "row_idx",
                    F.col("__md.month").alias("month"), F.col("__md.day").alias("day"),
                    (F.col("__md.month") * 100 + F.col("__md.day")).alias("md"),
                    "cell_date_desc", "cell_deposit", "cell_withdrawal", "cell_balance",
                    (F.col("pos_deposit") > 0).alias("has_deposit"),
                    (F.col("pos_withdrawal") > 0).alias("has_withdrawal")))


def infer_year(dated: DataFrame, start_year: int = DEFAULT_START_YEAR,
               chunk_rows: int = DEFAULT_CHUNK_ROWS, sizes_from: DataFrame | None = None) -> DataFrame:
    """L1: ``year`` and ``value_date`` text for dated rows, per statement.

    The year starts at ``start_year`` and moves on by one each time
    (month, day) strictly decreases from the previous dated row; the state
    crosses table boundaries within a statement and never crosses statements.
    ``sizes_from``: the raw rows ``dated`` was made of, so that the sizes of
    statements are counted without reading headers and dates.
    """
    out = rollover_count(dated, key="md", out="__bumps", part="statement_id",
                         order=["table_idx", "row_idx"], chunk_rows=chunk_rows, sizes_from=sizes_from)
    year = F.lit(start_year) + F.col("__bumps")
    return (out.withColumn("year", year.cast("int"))
            .withColumn("value_date", iso_date_text(F.col("year"), F.col("month"), F.col("day")))
            .drop("__bumps"))


def normalise_statements(raw_rows: DataFrame, start_year: int = DEFAULT_START_YEAR,
                         extra_noise_terms: Iterable[str] = (),
                         aliases: dict[str, list[str]] | None = None,
                         chunk_rows: int = DEFAULT_CHUNK_ROWS,
                         sort: bool = True) -> DataFrame:
    """Raw extracted tables -> ledger with lineage columns.

    Output: statement_id, table_idx, row_idx, value_date (text, day not
    validated), value_date_valid (date or NULL), description, deposit,
    withdrawal, balance. Amounts are cleaned once (applying the cleaner a
    second time, as the original does, only corrupts |x| >= 1e16 and
    0 < |x| < 1e-4).
    """
    extra = list(extra_noise_terms)
    dated = dated_rows(raw_rows, aliases)
    years = infer_year(dated, start_year, chunk_rows, sizes_from=raw_rows)
    has_txn, is_noise = transaction_predicates(
        F.col("cell_date_desc"), F.col("cell_deposit"), F.col("cell_withdrawal"),
        F.col("cell_balance"), F.col("has_deposit"), F.col("has_withdrawal"), extra)
    # The description cleaner is its own projection, so the formatter below
    # reads a column instead of copying the regex chain into each branch.
    ledger = (years.where(has_txn & ~is_noise)
              .withColumn("__desc", clean_description(F.col("cell_date_desc"), extra))
              .select("statement_id", "table_idx", "row_idx", "value_date",
                      valid_date(F.col("year"), F.col("month"), F.col("day")).alias("value_date_valid"),
                      format_description(F.col("__desc")).alias("description"),
                      clean_amount(F.col("cell_deposit")).alias("deposit"),
                      clean_amount(F.col("cell_withdrawal")).alias("withdrawal"),
                      clean_amount(F.col("cell_balance")).alias("balance")))
    # P5 (drop all-NULL rows) cannot fire here: every kept row has its own
    # value_date. Applying it anyway would make Catalyst push the check below
    # the projection and copy the description chain into the filter.
    return sort_ledger(ledger) if sort else ledger


def sort_ledger(ledger: DataFrame) -> DataFrame:
    """O1: value date ascending as *text*, ties broken by the row order."""
    keys = [c for c in ("value_date", "statement_id", "table_idx", "row_idx") if c in ledger.columns]
    return ledger.orderBy(*keys)


def drop_empty_rows(df: DataFrame) -> DataFrame:
    """P5: drop rows whose canonical ledger columns are all NULL."""
    return df.na.drop(how="all", subset=[c for c in LEDGER_COLUMNS if c in df.columns])


def to_ledger(df: DataFrame) -> DataFrame:
    """The five canonical columns in fixed order; absent ones as NULL."""
    cols = []
    for f in LEDGER_SCHEMA.fields:
        if f.name in df.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)
