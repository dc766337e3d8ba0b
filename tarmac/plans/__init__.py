"""Composed plans: driver-table queries, entity loads, stream processors, reports."""

from . import q_columns, q_entities, q_pipelines, q_relational, q_reports, q_streams, q_updates  # noqa: F401  (register queries)
from .registry import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
