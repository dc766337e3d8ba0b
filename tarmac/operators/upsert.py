"""Insert-if-absent and set-based guarded updates.

Parquet tables have no UPDATE or MERGE, so an update computes the table's new
contents with one join and the caller writes them as a new version
(``sources.tables.VersionedTable``).  Each function is ``DataFrame ->
DataFrame``; with a transactional table format the same bodies become
``MERGE INTO``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clean import all_present, any_missing
from .dedup import keep_first
from .lookup import insert_candidates

U = "_u_"


def _keys(on) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def insert_new(target: DataFrame, batch: DataFrame, on: str | Sequence[str],
               order: Sequence | None = None, small_batch: bool = False) -> DataFrame:
    """U4: batch rows to append - first per key within the batch (T4, in
    ``order``), minus keys already in ``target`` (T5).  Rows with a NULL key
    are never inserted.  Appending the result is idempotent.
    ``small_batch`` selects the micro-batch plan of ``insert_candidates``
    (batch keys broadcast against a large target when Spark sizes them small)."""
    keys = _keys(on)
    b = batch.where(all_present(*keys))
    if order is not None:
        b = keep_first(b, keys, order)
    return insert_candidates(b, target, keys, small_batch=small_batch)


def _latest_update(updates: DataFrame, keys: list[str], order: Sequence | None) -> DataFrame:
    """Several updates for one row: the last in ``order`` wins, as in a loop."""
    if order is None:
        return updates
    # Names sort descending (last first); pass Columns for explicit directions.
    rev = [F.col(o).desc_nulls_last() if isinstance(o, str) else o for o in order]
    return keep_first(updates, keys, rev)


def update_guarded(target: DataFrame, updates: DataFrame, on: str | Sequence[str],
                   assignments: Mapping[str, str], order: Sequence | None = None) -> DataFrame:
    """``UPDATE t SET a=u.a, b=u.b WHERE key AND (a IS NULL OR b IS NULL)``,
    applied only when every new value is present.

    ``assignments`` maps target column -> update column.  Returns the full new
    contents of ``target`` with its column order.
    """
    keys = _keys(on)
    u = _latest_update(updates, keys, order)
    u = u.select(*keys, *[F.col(src).alias(U + dst) for dst, src in assignments.items()],
                 F.lit(True).alias(U + "hit"))
    j = target.join(u, keys, "left")
    new_cols = [U + d for d in assignments]
    guard = (F.col(U + "hit").isNotNull() & all_present(*new_cols)
             & any_missing(*assignments.keys()))
    # Evaluate the guard once, on the old values, before any column changes.
    out = j.withColumn(U + "guard", guard)
    for dst in assignments:
        out = out.withColumn(dst, F.when(F.col(U + "guard"), F.col(U + dst)).otherwise(F.col(dst)))
    return out.select(*target.columns)


def update_from(target: DataFrame, updates: DataFrame, on: str | Sequence[str],
                set_col: str, new_col: str, order: Sequence | None = None) -> tuple[DataFrame, Column]:
    """``UPDATE t SET c = u.v FROM u WHERE key AND c IS DISTINCT FROM u.v``.

    Returns ``(new_contents, changed)`` where ``changed`` is the per-row
    Boolean of the SET (usable only on the returned frame), so the count of
    changed rows is one aggregate on the same plan.
    """
    keys = _keys(on)
    u = _latest_update(updates, keys, order).select(*keys, F.col(new_col).alias(U + "new"),
                                                    F.lit(True).alias(U + "hit"))
    j = target.join(u, keys, "left")
    changed = F.col(U + "hit").isNotNull() & ~F.col(set_col).eqNullSafe(F.col(U + "new"))
    out = (j.withColumn(U + "changed", changed)
            .withColumn(set_col, F.when(F.col(U + "changed"), F.col(U + "new")).otherwise(F.col(set_col))))
    return out.select(*target.columns, F.col(U + "changed").alias("_changed")), F.col("_changed")


def update_from_top1(target: DataFrame, top: DataFrame, on: str | Sequence[str],
                     assignments: Mapping[str, str | Column]) -> DataFrame:
    """Set columns of ``target`` from a one-row-per-key frame (e.g. ``top1``).

    ``assignments`` maps target column -> column of ``top`` or a literal Column
    (e.g. ``F.lit(None)`` to clear a value).  Unmatched rows keep their values.
    """
    keys = _keys(on)
    sel = [F.lit(True).alias(U + "hit")]
    for dst, src in assignments.items():
        col = F.col(src) if isinstance(src, str) else src
        sel.append(col.alias(U + dst))
    t = top.select(*keys, *sel)
    j = target.join(t, keys, "left")
    hit = F.col(U + "hit").isNotNull()
    out = j
    types = dict(target.dtypes)
    for dst in assignments:
        out = out.withColumn(dst, F.when(hit, F.col(U + dst).cast(types[dst])).otherwise(F.col(dst)))
    return out.select(*target.columns)


def apply_insert(target: DataFrame, batch: DataFrame, on: str | Sequence[str],
                 order: Sequence | None = None) -> DataFrame:
    """Target contents after U4: ``target ∪ insert_new(target, batch)``."""
    new = insert_new(target, batch, on, order)
    return target.unionByName(new.select(*target.columns))

