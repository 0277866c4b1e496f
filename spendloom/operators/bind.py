"""Evaluate expressions once per row, behind a filter-pushdown barrier.

Catalyst pushes a filter through a projection by substituting each alias
with its defining expression, so a predicate that refers to a derived column
three times evaluates (and generates code for) its whole definition three
times. ``bind`` computes the given columns inside a one-row ``inline``
generator: they become plain attributes of the output, later filters stay
above the generator and refer to the computed values, and the generator runs
inside the same whole-stage-codegen span as its neighbours.

Use it only for expensive columns that later steps reference more than once:
the struct's fields are not pruned, so every bound column is computed even
when nothing downstream reads it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bind(df: DataFrame, *cols: Column, keep: list[str] | None = None) -> DataFrame:
    """``df``'s columns (or ``keep``) plus the aliased ``cols``, each evaluated once."""
    base = list(keep) if keep is not None else list(df.columns)
    return df.select(*base, F.inline(F.array(F.struct(*cols))))
