"""Drain-style micro-batches over file-backed streams.

* T1 - ``trigger(availableNow=True)``: read everything new, then stop (one
  scheduled run), or ``processingTime`` for a long-running query.
* T2 - the position per source lives in the query's ``checkpointLocation``.
* T3 - ``foreachBatch`` is at-least-once; the ledger below plus natural-key
  anti joins make a replayed batch a no-op (effectively once).
* T4-T6 - keep-first within the batch, anti join against the target (the
  target table is the state), ids continued from the target's max.
* T7 / T8 - routing by topic and ordered follow-ups are plain calls inside
  one batch function.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.keys import assign_ids, max_id
from ..operators.lookup import insert_candidates
from ..operators.upsert import insert_new
from ..sources.tables import VersionedTable, if_present

BatchFn = Callable[[DataFrame, int], None]


class Ledger:
    """Batch ids already applied to a set of tables.

    Rows ``(batch_id, scope)`` are appended to ``root/_ledger``.  A lookup is
    an existence test for one id (a filtered scan; only a boolean reaches the
    driver), so the ledger can grow for the life of a stream.  Batch ids start
    anew with every checkpoint, so the scope must name the stream
    (see :func:`stream_id`).
    """

    SCHEMA = "batch_id BIGINT, scope STRING"

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.path = root.rstrip("/") + "/_ledger"
        self._known: set[tuple[int, str]] = set()

    def applied(self, batch_id: int, scope: str = "") -> bool:
        key = (int(batch_id), scope)
        if key not in self._known:
            df = if_present(lambda: self.spark.read.schema(self.SCHEMA).parquet(self.path))
            if df is None or df.where((F.col("batch_id") == key[0]) & (F.col("scope") == scope)).isEmpty():
                return False
            self._known.add(key)
        return True

    def record(self, batch_id: int, scope: str = "") -> None:
        (self.spark.range(1).select(F.lit(batch_id).cast("bigint").alias("batch_id"),
                                    F.lit(scope).alias("scope"))
             .coalesce(1).write.mode("append").parquet(self.path))
        self._known.add((int(batch_id), scope))


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark wrote into a started query's checkpoint; a new checkpoint has a new one."""
    row = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()
    return json.loads(row[0])["id"]


def once(ledger: Ledger, fn: BatchFn, scope: str = "", checkpoint: str | None = None) -> BatchFn:
    """Wrap a batch function so a replayed batch id of the same stream is skipped.

    ``checkpoint`` tells streams apart that write to the same tables.  The
    ledger row is written after the batch's tables, so a crash in between
    replays the batch; ``fn`` itself must absorb that."""
    def run(batch: DataFrame, batch_id: int) -> None:
        own = f"{scope}@{stream_id(ledger.spark, checkpoint)}" if checkpoint else scope
        if ledger.applied(batch_id, own):
            return
        fn(batch, batch_id)
        ledger.record(batch_id, own)
    return run


def run_available_now(stream: DataFrame, fn: BatchFn, checkpoint: str,
                      name: str | None = None) -> None:
    """T1 + T2: process all new input as micro-batches, then stop."""
    w = stream.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if name:
        w = w.queryName(name)
    q = w.start()
    try:
        q.awaitTermination()
    finally:
        q.stop()


def keep_first_into(target: VersionedTable, keys: Sequence[str], order: Sequence) -> BatchFn:
    """T4 + T5: append each batch's first row per key unless the key exists."""
    def fn(batch: DataFrame, batch_id: int) -> None:
        new = insert_new(target.read(), batch, keys, order, small_batch=True)
        target.append(new)
    return fn


def ids_into(dim: VersionedTable, key: str, id_col: str, order: Sequence[str],
             prepare: Callable[[DataFrame], DataFrame]) -> BatchFn:
    """T5 + T6: keys new to ``dim`` get ids continuing from its max."""
    def fn(batch: DataFrame, batch_id: int) -> None:
        current = dim.read()
        cand = insert_candidates(prepare(batch), current, key, small_batch=True)
        new = assign_ids(cand, order, id_col=id_col, start=max_id(current, id_col))
        dim.append(new.select(*current.columns))
    return fn


def dedup_within_watermark(stream: DataFrame, keys: Sequence[str], event_time: str,
                           delay: str = "1 hour") -> DataFrame:
    """T4 for long-running streams: Spark's stateful dedup keeps each key for
    the watermark delay in the state store (RocksDB on a cluster), so a
    duplicate arriving within ``delay`` is dropped without reading the target.
    The first arrival wins.  Use with the anti join of ``keep_first_into``
    when duplicates can arrive later than the delay."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))
