"""Exact top-k search by distributed histogram selection.

Candidates are scored where they are read.  Of the queries, a wave of bounded
bytes at a time is sent to all tasks; a task scores its candidates as matrix
products, and no score row leaves it.  What leaves it is, per query and round,
a histogram of ``BINS`` bins over the query's current score range.  Spark adds
the histograms up; the bin that holds the k-th best score becomes the next
range, until the range is one integer wide: the k-th value itself.  A last pass
emits the scores above it, and of those equal to it each task's k smallest
vec_ids, and a window per query orders them.

Ranges start from the true minimum and maximum of each query's scores.  The
state of a wave's queries (three numbers each) and their histograms are bounded
by the wave; no candidate is shuffled.  Scores are exact integers.

Defined cases: a null vector, or one with a null, NaN or infinite component,
takes no part, neither do rows without a vec_id; a shorter vector counts as
padded with zeros; every row but those with the query's own vec_id is a
candidate, so repeated ids are ranked as often as they occur; query rows that
repeat an id are searched one by one, and the k best of all their scores count;
a query with fewer than k candidates gets all of them; an empty table gives no
rows; a score beyond 64 bits is held at the largest 64-bit value.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .vectors import LARGEST, Rows, matrix, scores

BINS = 64
#: Bytes of query components that are sent to the tasks at once.
WAVE_BYTES = 1 << 22
#: Scores that a task holds at once.
_CELLS = 1 << 20
_LONG = (np.iinfo(np.int64).min, np.iinfo(np.int64).max)


def quantized(embeddings: DataFrame, scale: int = 1024) -> DataFrame:
    """(vec_id, v): floor(scale * x) of every component of the vectors that take part, as whole doubles."""
    rows = embeddings.select(embeddings["vec_id"].cast("bigint").alias("vec_id"),
                             embeddings["embedding"].cast("array<double>").alias("x"))
    finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(math.inf)))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & finite)

    def whole(c):
        y = F.greatest(F.least(c * F.lit(float(scale)), F.lit(LARGEST)), F.lit(-LARGEST))
        return F.when(F.abs(y) < 2.0 ** 53, F.floor(y).cast("double")).otherwise(y)  # a double that large is whole
    return rows.select("vec_id", F.transform("x", whole).alias("v"))


def _rows(batch: pa.RecordBatch | pa.Table) -> Rows:
    ids = np.asarray(batch.column(0)).astype(np.int64)
    return Rows(ids, ids, matrix(batch.column(1)), np.arange(len(ids), dtype=np.int64))


def _cells(batches: Iterator[pa.RecordBatch], q: Rows) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(candidate ids, scores of all queries, whether the candidate is another row)."""
    for batch in batches:
        for part in _rows(batch).parts(max(1, _CELLS // max(len(q.ids), 1))):
            yield part.ids, scores(q.m, part.m), part.ids[None, :] != q.ids[:, None]


def _ranges(batches: Iterator[pa.RecordBatch], q: Rows) -> Iterator[pa.RecordBatch]:
    """(query, n, lo, hi): candidates of a query in the task, and the range of their scores."""
    n, lo, hi = (np.full(len(q.ids), x, np.int64) for x in (0, _LONG[1], _LONG[0]))
    for _, s, ok in _cells(batches, q):
        n += ok.sum(axis=1)
        lo = np.minimum(lo, np.where(ok, s, _LONG[1]).min(axis=1, initial=_LONG[1]))
        hi = np.maximum(hi, np.where(ok, s, _LONG[0]).max(axis=1, initial=_LONG[0]))
    some = n > 0
    yield pa.RecordBatch.from_pydict({"query": q.numbers[some], "n": n[some], "lo": lo[some], "hi": hi[some]})


def bin_width(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Width of a bin, for ranges of up to all 64 bits."""
    span = hi.view(np.uint64) - lo.view(np.uint64)  # hi - lo, which may exceed a signed long
    return span // np.uint64(BINS) + np.uint64(1)


def _histograms(batches: Iterator[pa.RecordBatch], q: Rows, lo: np.ndarray, hi: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(query, bin, n): bins count from the best score down; queries whose range is one value have none."""
    width, count = bin_width(lo, hi), np.zeros(len(q.ids) * BINS, np.int64)
    for _, s, ok in _cells(batches, q):
        of, at = np.nonzero(ok & (s >= lo[:, None]) & (s <= hi[:, None]) & (lo < hi)[:, None])
        bins = (hi[of].view(np.uint64) - s[of, at].view(np.uint64)) // width[of]
        count += np.bincount(of * BINS + bins.astype(np.int64), minlength=len(count))
    some = np.flatnonzero(count)
    yield pa.RecordBatch.from_pydict({"query": q.numbers[some // BINS], "bin": (some % BINS).astype(np.int32), "n": count[some]})


def _select(batches: Iterator[pa.RecordBatch], q: Rows, kth: np.ndarray, k: int) -> Iterator[pa.RecordBatch]:
    """(query_id, vec_id, score): above the k-th value all, equal to it the k smallest ids of the task."""
    tied = [np.zeros(0, np.int64), np.zeros(0, np.int64)]  # query, vec_id
    for ids, s, ok in _cells(batches, q):
        of, at = np.nonzero(ok & (s > kth[:, None]))
        yield pa.RecordBatch.from_pydict({"query_id": q.ids[of], "vec_id": ids[at], "score": s[of, at]})
        of, at = np.nonzero(ok & (s == kth[:, None]))
        tied = [np.r_[tied[0], of], np.r_[tied[1], ids[at]]]
        order = np.lexsort(tied[::-1])
        query = tied[0][order]
        start = np.flatnonzero(np.r_[True, query[1:] != query[:-1]]) if len(query) else query
        kept = order[np.arange(len(query)) - np.repeat(start, np.diff(np.r_[start, len(query)])) < k]
        tied = [tied[0][kept], tied[1][kept]]
    yield pa.RecordBatch.from_pydict({"query_id": q.ids[tied[0]], "vec_id": tied[1], "score": kth[tied[0]]})


def _kth(run: Callable, q: Rows, k: int) -> np.ndarray:
    """The k-th best score of each query (the least one, if it has fewer): ``run(task function, schema)`` is a
    frame of what the tasks found.  What is fetched is bounded by the wave: three numbers a query, or its bins."""
    found = run(lambda it: _ranges(it, q), "query long, n long, lo long, hi long").groupBy("query").agg(
        F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).toArrow().to_pydict()
    want, lo, hi = (np.zeros(len(q.ids), np.int64) for _ in range(3))
    at = np.array(found["query"], np.int64)
    want[at], lo[at], hi[at] = np.minimum(np.array(found["n"], np.int64), k), found["lo"], found["hi"]
    while (lo < hi).any():
        bound = (lo, hi)
        counts = run(lambda it: _histograms(it, q, *bound), "query long, bin int, n long").groupBy("query", "bin").agg(
            F.sum("n").alias("n")).toArrow().to_pydict()
        table = np.zeros((len(q.ids), BINS), np.int64)
        table[np.array(counts["query"], np.int64), np.array(counts["bin"], np.int64)] = counts["n"]
        upto = np.cumsum(table, axis=1)
        row = np.flatnonzero(lo < hi)
        hit = (upto[row] >= want[row, None]).argmax(axis=1)
        want[row] -= upto[row, hit] - table[row, hit]
        width = bin_width(lo, hi)[row]
        top = (hi[row].view(np.uint64) - hit.astype(np.uint64) * width).view(np.int64)
        room = top.view(np.uint64) - lo[row].view(np.uint64)
        low = (top.view(np.uint64) - np.minimum(width - np.uint64(1), room)).view(np.int64)
        lo, hi = lo.copy(), hi.copy()
        lo[row], hi[row] = low, top
    return lo


def search(queries: DataFrame, candidates: DataFrame, k: int = 10, wave_bytes: int = WAVE_BYTES) -> DataFrame:
    """The ``k`` best of ``candidates`` for each of ``queries`` (both vec_id, v): query_id, rank, vec_id, score.

    Query rows that repeat a vec_id share its ``k`` ranks; ties go to the smaller vec_id.
    """
    spark = queries.sparkSession
    size = queries.agg(F.count(F.lit(1)), F.max(F.size("v"))).head()
    waves = max(1, -(-size[0] * 8 * max(size[1] or 1, 1) // wave_bytes))
    # Equal query rows are dealt apart, so a wave is of about wave_bytes whatever repeats.
    asked = queries.select("vec_id", "v", F.pmod(F.xxhash64("vec_id", "v", F.monotonically_increasing_id()), F.lit(waves))
                           .alias("wave")).checkpoint()
    chosen = None
    for w in range(waves):
        sent = spark.sparkContext.broadcast(_rows(asked.where(F.col("wave") == w).select("vec_id", "v").toArrow()))

        def run(task: Callable, schema: str) -> DataFrame:
            return candidates.select("vec_id", "v").mapInArrow(task, schema)

        found = _wave(run, sent, k)
        chosen = found if chosen is None else chosen.unionByName(found)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (chosen.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _wave(run: Callable, sent, k: int) -> DataFrame:
    kth = _kth(run, sent.value, k)
    return run(lambda it: _select(it, sent.value, kth, k), "query_id long, vec_id long, score long")


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND list_count(embedding) = len(embedding)
    AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 10
"""
