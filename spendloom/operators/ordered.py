"""Ordered scans: running sums, fill-forward, lag and year roll-over, safe for hot keys.

A plain ``Window.partitionBy(key).orderBy(...)`` sends every row of a key to
one task. That is right for the many small keys and wrong for a statement,
account or month that holds a third of all rows. So each scan first counts its
keys: one aggregation with map-side combine. Keys of at most ``chunk_rows`` rows
are one chunk. The rows of larger keys are written once, range-partitioned
along key and order, and get their exact place in it (``rank.placed``); every
``chunk_rows`` places are a chunk. No chunk is larger than that, however the
order's values are spread: outliers, ties in the leading columns, text and
timestamps of any kind are cut alike, since places follow the whole order. Then

1. the local windows run per ``(key, chunk)``;
2. each chunk of a large key is reduced to one summary row;
3. a window over a key's summaries carries the state from chunk to chunk: at
   most about ``rows / chunk_rows`` rows in one group;
4. the carry is joined back on ``(key, chunk)``. The sizes say how many carry
   rows there can be, so the carry is broadcast while they are few and joined
   on the window's own partitioning beyond that.

Without large keys, steps 2 to 4 have no rows and are left out, and nothing is
written. The result is exact in any case: nothing is capped or sampled.

Several states over the same keys and order share one scan: one count, one
shuffle of the rows, one summary and one join (see ``quality.reconcile`` and
``spend.cumulatives``).
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from spendloom.operators.rank import placed, written

#: Rows above which a key is cut into chunks, and the most rows of a chunk.
DEFAULT_CHUNK_ROWS = 1 << 17
#: Large keys, or carry rows, up to which the small side is broadcast.
BROADCAST_ROWS = 100_000

_CHUNK, _PLACE = "__chunk", "__place"


def _cols(names) -> list[str]:
    if names is None:
        return []
    if isinstance(names, str):
        return [names]
    return list(names)


@dataclass
class Scan:
    """Rows with a chunk number, and what is needed to scan them in order."""

    rows: DataFrame
    part: list[str]
    order: list[str]  # ends with the place, which settles ties in large keys
    carry_rows: int  # 0: no key is cut

    def keys(self, within: Sequence[str] = ()) -> list[str]:
        """What a group of the local windows agrees in: key, chunk and, to start anew inside a chunk, ``within``."""
        return [*self.part, _CHUNK, *[c for c in within if c not in self.part]]

    def window(self, within: Sequence[str] = ()) -> WindowSpec:
        return Window.partitionBy(*self.keys(within)).orderBy(*self.order)

    def up_to_here(self, within: Sequence[str] = ()) -> WindowSpec:
        return self.window(within).rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def chunks(self, within: Sequence[str] = ()) -> WindowSpec:
        """Over the summaries of one key."""
        return Window.partitionBy(*[c for c in self.keys(within) if c != _CHUNK]).orderBy(_CHUNK)

    def chunks_before(self, within: Sequence[str] = ()) -> WindowSpec:
        return self.chunks(within).rowsBetween(Window.unboundedPreceding, -1)

    def summaries(self, rows: DataFrame, *aggregates: Column, within: Sequence[str] = ()) -> DataFrame:
        """One row per chunk of every key that is cut."""
        return rows.where("__large").groupBy(*self.keys(within)).agg(*aggregates)

    def join_back(self, rows: DataFrame, carry: DataFrame, within: Sequence[str] = ()) -> DataFrame:
        """Left join of the carry on (key, chunk), NULL keys included."""
        keys = self.keys(within)
        right = carry.select(*[F.col(k).alias(f"{k}__r") for k in keys], *[c for c in carry.columns if c not in keys])
        # periods inside a chunk may be more rows than chunks: Spark decides for them
        right = F.broadcast(right) if self.carry_rows <= BROADCAST_ROWS and len(keys) == len(self.keys()) else right
        matched = [rows[k].eqNullSafe(right[f"{k}__r"]) for k in keys]
        return rows.join(right, on=matched, how="left").drop(*[f"{k}__r" for k in keys])

    def done(self, rows: DataFrame, *extra: str) -> DataFrame:
        return rows.drop(*extra, _CHUNK, _PLACE, "__large")


def scan(df: DataFrame, part=None, order=(), chunk_rows: int = DEFAULT_CHUNK_ROWS,
         sizes_from: DataFrame | None = None) -> Scan:
    """Number the chunks of ``df``; runs the size aggregation, and the sort of large keys if there are any.

    ``sizes_from`` may name a cheaper frame to take the sizes from: the same
    keys, and at least the rows of ``df`` (say, ``df`` before an expensive
    filter).
    """
    part, order = _cols(part), _cols(order)
    source = df if sizes_from is None else sizes_from
    sizes = source.groupBy(*part).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > chunk_rows)
    n_large, carry_rows = sizes.agg(F.count(F.lit(1)), F.sum(F.ceil(F.col("__n") / F.lit(chunk_rows)) + 1)).first()

    def whole(rows: DataFrame) -> DataFrame:
        return rows.select("*", F.lit(0).cast("long").alias(_PLACE), F.lit(0).cast("long").alias(_CHUNK), F.lit(False).alias("__large"))

    if not n_large:
        return Scan(whole(df), part, order, 0)

    if part:
        # so few rows are kept as they are, and not counted again
        keys = df.sparkSession.createDataFrame(sizes.collect(), sizes.schema) if n_large <= BROADCAST_ROWS else written(sizes, "large-keys")
        keys = keys.select(*[F.col(k).alias(f"{k}__s") for k in part])
        keys = F.broadcast(keys) if n_large <= BROADCAST_ROWS else keys
        same = [df[k].eqNullSafe(keys[f"{k}__s"]) for k in part]
        small, large = df.join(keys, on=same, how="left_anti"), df.join(keys, on=same, how="left_semi")
    else:
        small, large = None, df
    # the rows are written before they are sorted: the sort reads its input twice, and what made it may be expensive
    rows = placed(written(large, "large-rows"), *[F.col(c).asc_nulls_first() for c in (*part, *order)], out=_PLACE)
    rows = rows.select("*", F.floor(F.col(_PLACE) / F.lit(chunk_rows)).alias(_CHUNK), F.lit(True).alias("__large"))
    if small is not None:
        rows = rows.unionByName(whole(small))
    return Scan(rows, part, [*order, _PLACE], carry_rows)


def _order_struct(order: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in order])


def running_sum(df: DataFrame, value: str, out: str, part=None, order=(),
                chunk_rows: int = DEFAULT_CHUNK_ROWS, sizes_from: DataFrame | None = None) -> DataFrame:
    """``out`` = sum of ``value`` over rows up to and including this one, per ``part``.

    Decimals stay decimals: sums are exact and independent of the partitioning.
    """
    s = scan(df, part, order, chunk_rows, sizes_from)
    rows = s.rows.withColumn(out, F.sum(value).over(s.up_to_here()))
    if not s.carry_rows:
        return s.done(rows)
    totals = s.summaries(s.rows, F.sum(value).alias("__total"))
    carry = totals.select(*s.part, _CHUNK, F.sum("__total").over(s.chunks_before()).alias("__carry"))
    rows = s.join_back(rows, carry)
    dtype = rows.schema[out].dataType
    # a running sum is NULL until the first value
    total = F.when(F.col(out).isNull(), F.col("__carry").cast(dtype)).otherwise(
        (F.col(out) + F.coalesce(F.col("__carry"), F.lit(0))).cast(dtype))
    return s.done(rows.withColumn(out, total), "__carry")


def fill_forward(df: DataFrame, column: str, out: str, part=None, order=(), chunk_rows: int = DEFAULT_CHUNK_ROWS,
                 sizes_from: DataFrame | None = None, inclusive: bool = True) -> DataFrame:
    """``out`` = last non-NULL ``column`` at or before this row, per ``part``.

    Not ``inclusive``: strictly before this row.
    """
    s = scan(df, part, order, chunk_rows, sizes_from)
    frame = s.window().rowsBetween(Window.unboundedPreceding, Window.currentRow if inclusive else -1)
    rows = s.rows.withColumn("__local", F.last(column, ignorenulls=True).over(frame))
    if not s.carry_rows:
        return s.done(rows.withColumn(out, F.col("__local")), "__local")
    # max_by skips NULL orderings, so a chunk without a value has NULL here
    known = F.when(F.col(column).isNotNull(), _order_struct(s.order))
    lasts = s.summaries(s.rows, F.max_by(F.col(column), known).alias("__last"))
    carry = lasts.select(*s.part, _CHUNK, F.last("__last", ignorenulls=True).over(s.chunks_before()).alias("__carry"))
    rows = s.join_back(rows, carry)
    return s.done(rows.withColumn(out, F.coalesce(F.col("__local"), F.col("__carry"))), "__local", "__carry")


def previous_value(df: DataFrame, column: str, out: str, part=None, order=(),
                   chunk_rows: int = DEFAULT_CHUNK_ROWS, sizes_from: DataFrame | None = None) -> DataFrame:
    """``out`` = ``column`` of the previous row in order (``lag``), per ``part``."""
    s = scan(df, part, order, chunk_rows, sizes_from)
    rows = s.rows.withColumn("__lag", F.lag(column).over(s.window()))
    if not s.carry_rows:
        return s.done(rows.withColumn(out, F.col("__lag")), "__lag")
    rows = rows.withColumn("__first", F.row_number().over(s.window()) == 1)
    lasts = s.summaries(s.rows, F.max_by(F.col(column), _order_struct(s.order)).alias("__last"))
    carry = lasts.select(*s.part, _CHUNK, F.lag("__last").over(s.chunks()).alias("__carry"))
    rows = s.join_back(rows, carry)
    value = F.when(F.col("__first"), F.col("__carry")).otherwise(F.col("__lag"))
    return s.done(rows.withColumn(out, value), "__lag", "__first", "__carry")


def rollover_count(df: DataFrame, key: str, out: str, part=None, order=(),
                   chunk_rows: int = DEFAULT_CHUNK_ROWS, sizes_from: DataFrame | None = None) -> DataFrame:
    """``out`` = number of strict decreases of ``key`` up to this row, per ``part``.

    Rows must all carry a non-NULL ``key`` (filter first). Used for year
    inference: every time (month, day) goes backwards the year moves on.
    """
    s = scan(df, part, order, chunk_rows, sizes_from)
    bump = F.coalesce((F.col(key) < F.lag(key).over(s.window())).cast("int"), F.lit(0))
    bumped = s.rows.withColumn("__bump", bump)
    rows = bumped.withColumn("__local", F.sum("__bump").over(s.up_to_here()))
    if not s.carry_rows:
        return s.done(rows.withColumn(out, F.col("__local").cast("int")), "__bump", "__local")
    place = _order_struct(s.order)
    summary = s.summaries(bumped, F.min_by(F.col(key), place).alias("__first_key"),
                          F.max_by(F.col(key), place).alias("__last_key"), F.sum("__bump").alias("__inner"))
    edge = F.coalesce((F.col("__first_key") < F.lag("__last_key").over(s.chunks())).cast("int"), F.lit(0))
    so_far = s.chunks().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carry = (summary.withColumn("__edge", edge)
             .withColumn("__carry", F.sum(F.col("__edge") + F.col("__inner")).over(so_far) - F.col("__inner"))
             .select(*s.part, _CHUNK, "__carry"))
    rows = s.join_back(rows, carry)
    total = (F.col("__local") + F.coalesce(F.col("__carry"), F.lit(0))).cast("int")
    return s.done(rows.withColumn(out, total), "__bump", "__local", "__carry")
