"""Registry of the queries run on the driver's tables.

Each query is ``fn(spark, sf_dir) -> DataFrame`` and, where the semantics
are expressible in SQL, carries the DuckDB SQL that must give the same rows.
Column names match on both sides; timestamps leave as text (one format on
both sides) and money sums go through DECIMAL so results are bit-identical.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# Fixed text formats shared by the Spark side and the SQL side.
TS_FMT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
SQL_TS_FMT = "%Y-%m-%d %H:%M:%S.%f"


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def tbl(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


def ts_text(c) -> Column:
    return F.date_format(F.col(c) if isinstance(c, str) else c, TS_FMT)


def ts_lit(text: str) -> Column:
    """A TIMESTAMP_NTZ literal (constant-folded, so it reaches PushedFilters)."""
    return F.lit(text).cast("timestamp_ntz")


def in_year(c: str, year: int) -> Column:
    """``year(c) = year`` as a range, which Parquet row groups can skip on."""
    return (F.col(c) >= ts_lit(f"{year}-01-01")) & (F.col(c) < ts_lit(f"{year + 1}-01-01"))
