"""Full-row distinct and keep-first per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def _asc(c) -> Column:
    if isinstance(c, Column):
        return c
    return F.col(c).asc_nulls_last()


def order_spec(order: Sequence) -> list[Column]:
    """Column names sort ascending with NULLs last (PostgreSQL order, quirk Q21);
    pass a Column (e.g. ``F.col('x').desc_nulls_last()``) for anything else."""
    return [_asc(c) for c in order]


def distinct_rows(df: DataFrame) -> DataFrame:
    """Full-row dedup (NULL equals NULL).  Partial aggregation runs before the
    shuffle, so a hot row value is collapsed map-side."""
    return df.distinct()


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """First row per ``keys`` in ``order`` (NULLs last).

    ``row_number() == 1`` is planned with a partial ``WindowGroupLimit`` before
    the shuffle, so a key holding a third of the table ships one row per map
    task, not all of its rows.  ``order`` should make the choice unique.
    """
    if not keys:
        raise ValueError("keep_first needs at least one key; use distinct_rows for full rows")
    w = Window.partitionBy(*keys).orderBy(*order_spec(order))
    rn = "_keep_first_rn"
    return df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) == 1).drop(rn)
