"""K5: one batch to several tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from .tables import write_parquet


def fan_out_by(df: DataFrame, route_col: str, root: str, mode: str = "append") -> None:
    """Route rows to ``root/<route_col>=<value>/`` in one pass (dynamic targets)."""
    write_parquet(df, root, mode=mode, partition_by=[route_col])
