"""Projections, kept / rejected splits, counts."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .lookup import REASON

log = logging.getLogger(__name__)


def tolerant_select(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Keep the expected columns that exist, warn about the rest
    (plan-time only; no data is touched)."""
    have = set(df.columns)
    missing = [c for c in expected if c not in have]
    if missing:
        log.warning("columns missing from input: %s", missing)
    return df.select(*[c for c in expected if c in have])


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename only the columns present."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def null_columns(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """P5: typed NULL literal columns (``{'name': 'bigint'}``)."""
    return df.withColumns({n: F.lit(None).cast(t) for n, t in columns.items()})


def classify(df: DataFrame, rules: Sequence[tuple[str, Column]], kept: str = "kept") -> DataFrame:
    """A ``reason`` column from the first matching reject rule.

    ``rules`` is an ordered list of ``(reason, predicate)``; rows matching none
    get ``kept``.  One pass, no row is lost: kept and rejected rows are two
    filters of the same frame.
    """
    expr = None
    for reason, pred in rules:
        expr = F.when(pred, F.lit(reason)) if expr is None else expr.when(pred, F.lit(reason))
    expr = F.lit(kept) if expr is None else expr.otherwise(F.lit(kept))
    return df.withColumn(REASON, expr)


def split_kept(df: DataFrame, kept: str = "kept") -> tuple[DataFrame, DataFrame]:
    """(kept rows without the reason column, rejected rows with it)."""
    return (df.where(F.col(REASON) == kept).drop(REASON), df.where(F.col(REASON) != kept))


def count_metrics(df: DataFrame, kept: str = "kept") -> DataFrame:
    """A5: read / kept / rejected counts as one aggregate row."""
    return df.agg(F.count(F.lit(1)).alias("n_read"),
                  F.count_if(F.col(REASON) == kept).alias("n_kept"),
                  F.count_if(F.col(REASON) != kept).alias("n_rejected"))


def observed(df: DataFrame, name: str = "counts", kept: str = "kept") -> tuple[DataFrame, Observation]:
    """A5 without an extra job: counts gathered while ``df`` is written."""
    obs = Observation(name)
    out = df.observe(obs, F.count(F.lit(1)).alias("n_read"),
                     F.count_if(F.col(REASON) == kept).alias("n_kept"))
    return out, obs
