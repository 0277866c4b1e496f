"""The gate of the ``raw_rows`` contract: what keeps it, what does not, and why.

Everything that depends on the order of a statement's rows relies on
``(statement_id, table_idx, row_idx)`` being unique. Table extractors that run
twice, or land a page from two jobs, break that; so do rows with more cells
than their table has headers, whose amounts would be read from wrong columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendloom.operators.rank import written

KEY = ["statement_id", "table_idx", "row_idx"]
#: Positions with several rows up to which they are broadcast.
BROADCAST_KEYS = 100_000


def check_contract(raw_rows: DataFrame) -> DataFrame:
    """``raw_rows`` with ``reason`` (NULL: the row keeps the contract) and ``copies``.

    Reasons, the first that applies: ``no_key`` (a part of the position is
    missing), ``no_cells``, ``more_cells`` (than headers), ``repeated`` (the
    same row stands at its position already) and ``conflict`` (another row
    stands there: the one with the smallest headers and cells stays). Equal
    rows of one position are one row of the result with the number of its
    ``copies``; all others have 1.

    Only positions are counted over all rows, with map-side combine. Rows of
    positions that are there once go straight through; the others are first
    reduced to distinct rows, so many copies of one row are no hot group.
    What makes ``raw_rows`` may be expensive, so it runs once: the rows are
    written first, and every step reads them from there.
    """
    reason = (F.when(F.col("statement_id").isNull() | F.col("table_idx").isNull() | F.col("row_idx").isNull(), "no_key")
              .when(F.col("cells").isNull(), "no_cells")
              .when(F.size("cells") > F.coalesce(F.size("headers"), F.lit(0)), "more_cells"))
    rows = written(raw_rows.withColumn("reason", reason), "raw-rows")
    several = rows.where("reason is null").groupBy(*KEY).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").drop("__n")
    several = written(several, "repeated-positions")
    n = several.count()
    one = F.lit(1).cast("long").alias("copies")
    if not n:
        return rows.select("*", one)
    small = n <= BROADCAST_KEYS
    marks = several.withColumn("__several", F.lit(True))
    marked = rows.join(F.broadcast(marks) if small else marks, KEY, "left")
    again = F.col("reason").isNull() & F.col("__several").isNotNull()
    distinct = marked.where(again).groupBy(*KEY, "headers", "cells").agg(F.count(F.lit(1)).alias("copies"))
    content = F.struct("headers", "cells")
    first = distinct.groupBy(*KEY).agg(F.min(content).alias("__first"))
    distinct = distinct.join(F.broadcast(first) if small else first, KEY)
    kept = content.eqNullSafe(F.col("__first"))
    # the row that stays, and what is rejected beside it
    parts = F.when(kept, F.array(F.struct(F.lit(None).cast("string").alias("reason"), one),
                                 F.struct(F.lit("repeated").alias("reason"), (F.col("copies") - 1).alias("copies"))))
    parts = parts.otherwise(F.array(F.struct(F.lit("conflict").alias("reason"), F.col("copies"))))
    split = distinct.select(*KEY, "headers", "cells", F.inline(parts)).where("copies > 0")
    columns = [*KEY, "headers", "cells", "reason"]
    return marked.where(~again).select(*columns, one).unionByName(split.select(*columns, "copies"))


def split_contract(raw_rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that keep the contract, the others with ``reason`` and ``copies``), checked and written once."""
    checked = written(check_contract(raw_rows), "checked-rows")
    return checked.where("reason is null").drop("reason", "copies"), checked.where("reason is not null")
