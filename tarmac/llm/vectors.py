"""Vectors in Arrow batches: rows that take part, floors of components, exact integer scores."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A finite double that scaling cannot exceed.
LARGEST = 1.7e308
_LONG = (np.iinfo(np.int64).min, np.iinfo(np.int64).max)


@dataclass
class Rows:
    """ids, labels, one line of whole numbers (as doubles) per row, and the rows' numbers in their table."""

    ids: np.ndarray
    labels: np.ndarray
    m: np.ndarray
    numbers: np.ndarray

    def parts(self, size: int) -> Iterator[Rows]:
        for at in range(0, len(self.ids), size):
            cut = slice(at, at + size)
            yield Rows(self.ids[cut], self.labels[cut], self.m[cut], self.numbers[cut])


def finite_rows(rows: DataFrame) -> DataFrame:
    """(vec_id, label, x) of the rows that have an id, a label and only finite components."""
    out = rows.select(rows["vec_id"].cast("bigint").alias("vec_id"), rows["label"].cast("bigint").alias("label"),
                      rows["embedding"].cast("array<double>").alias("x"))
    finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return out.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & finite)


def matrix(lists: pa.Array | pa.ChunkedArray, scale: float = 1.0) -> np.ndarray:
    """floor(scale * x) of lists of numbers, one line each, shorter ones padded with zeros."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    n = len(lists)
    width = np.diff(lists.offsets.to_numpy())
    m = np.zeros((n, int(width.max()) if n else 0))
    first = np.cumsum(width) - width
    values = lists.flatten().to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore"):
        m[np.repeat(np.arange(n), width), np.arange(len(values)) - np.repeat(first, width)] = np.floor(values * scale)
    return np.clip(m, -LARGEST, LARGEST, out=m)


def floors(batch: pa.RecordBatch | pa.Table, scale: float) -> Rows:
    """The rows of a batch (vec_id, label, x)."""
    column = lambda i: np.asarray(batch.column(i)).astype(np.int64)
    return Rows(column(0), column(1), matrix(batch.column(2), scale), np.arange(batch.num_rows, dtype=np.int64))


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of all lines of ``a`` with all of ``b``, exact; beyond 64 bits the largest 64-bit value."""
    dim = min(a.shape[1], b.shape[1])
    a, b = a[:, :dim], b[:, :dim]
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    if float(np.abs(a).max()) * float(np.abs(b).max()) * dim < 2.0 ** 53:
        return (a @ b.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    return whole(a).dot(whole(b).T).clip(*_LONG).astype(np.int64)
