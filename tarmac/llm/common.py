"""Shared pieces of the operators: table access, word patterns, text columns."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a maximal run of anything but space and U+0009..U+000D.
WORD = r"[^\x20\x09-\x0D]+"

#: Order id of a row without a doc_id: after all others.
NO_ID = 2**63 - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(df: DataFrame, col: str = "text") -> Column:
    """The text, a null as the empty text."""
    return F.coalesce(df[col].cast("string"), F.lit(""))


def column(df: DataFrame, name: str) -> Column:
    """A column by its whole name, whatever characters that holds."""
    return df["`" + name.replace("`", "``") + "`"]


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Jobs in here drop their shuffle files when they end, not when the driver happens to collect garbage.

    For operators of many rounds whose results are checkpointed; a DataFrame that is run twice would shuffle again.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def small_broadcasts(spark: SparkSession, most: int = 1 << 20) -> Iterator[None]:
    """Joins in here broadcast no side of more than ``most`` bytes by Spark's own choice.

    For operators of many joins: the driver keeps each broadcast table, several times its bytes, until it collects
    garbage."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    if spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold() > most:
        spark.conf.set(name, str(most))
    try:
        yield
    finally:
        spark.conf.set(name, before)
