"""Natural-key lookups with a reject output.

Dimension sides are *not* force-broadcast: Spark's planner broadcasts them
when their (static or, with AQE, runtime) size is under
``spark.sql.autoBroadcastJoinThreshold`` and falls back to a shuffled join
otherwise, so a dimension that grows with the data cannot blow up executors.
Pass ``broadcast=True`` only for a side whose size is bounded by construction,
and ``broadcast=False`` for a side derived from a fact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REASON = "reason"


def _maybe_broadcast(df: DataFrame, broadcast: bool | None) -> DataFrame:
    """``True``: a side of bounded size, broadcast.  ``False``: a side that
    grows with the fact (e.g. a keep-first of the fact itself), never
    broadcast - sort-merge join, which also reuses a partitioning on the join
    keys that the side already has.  ``None``: Spark decides by size."""
    if broadcast is None:
        return df
    return F.broadcast(df) if broadcast else df.hint("merge")


def _keys(on) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def with_reason(df: DataFrame, reason: str) -> DataFrame:
    return df.withColumn(REASON, F.lit(reason))


HIT = "_resolved"


def resolve_tagged(df: DataFrame, dim: DataFrame, on: str | Sequence[str], take: Sequence[str],
                   broadcast: bool | None = None) -> DataFrame:
    """J1 / J2 in one join: every row of ``df`` with the ``take`` columns and a
    ``_resolved`` flag, so resolved rows and rejects are two filters of one
    plan (one scan of ``df`` when both are written together)."""
    keys = _keys(on)
    side = _maybe_broadcast(dim.select(*keys, *take).withColumn(HIT, F.lit(True)), broadcast)
    return df.join(side, keys, "left").withColumn(HIT, F.coalesce(F.col(HIT), F.lit(False)))


def resolve(df: DataFrame, dim: DataFrame, on: str | Sequence[str], take: Sequence[str],
            how: str = "inner", reason: str = "unresolved",
            broadcast: bool | None = None) -> tuple[DataFrame, DataFrame]:
    """Map natural key(s) ``on`` to the ``take`` columns of ``dim``.

    ``how='inner'`` (J1 / J2): returns ``(resolved, rejects)``, rejects being
    the rows whose key is NULL or absent from ``dim`` with a ``reason``
    column.  ``how='left'`` (J3): every row is kept, misses get NULLs, and
    rejects is empty.  ``dim`` must be unique on ``on`` (dedup it first).
    """
    keys = _keys(on)
    side = _maybe_broadcast(dim.select(*keys, *take), broadcast)
    if how == "left":
        return df.join(side, keys, "left"), df.limit(0).transform(lambda d: with_reason(d, reason))
    if how != "inner":
        raise ValueError(f"unsupported lookup mode {how!r}")
    resolved = df.join(side, keys, "inner")
    rejects = with_reason(df.join(side.select(*keys), keys, "left_anti"), reason)
    return resolved, rejects


def heavy_keys(df: DataFrame, on: Sequence[str], share: float, most: int = 64) -> list[int]:
    """Hashes of the keys that hold at least ``share`` of the rows, by a sketch of fixed size (one pass; what
    reaches the driver is at most ``most`` numbers).  The sketch may name a key that holds a little less."""
    found = df.select(F.xxhash64(*on).alias("_h")).agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(_h, {int(most)}, {int(most) * 64})").alias("top")).first()
    return [t["item"] for t in found["top"] if t["count"] >= share * found["n"] and t["count"] > 1]


def resolve_spread(df: DataFrame, dim: DataFrame, on: str | Sequence[str], take: Sequence[str], how: str = "inner",
                   share: float = 0.01, parts: int = 32) -> DataFrame:
    """J1 / J2 / J3 where a few keys may hold much of ``df``: one shuffled join, heavy keys spread.

    Rows of a heavy key (:func:`heavy_keys`) are dealt over ``parts`` salts, and the one dimension row of
    such a key is replicated to each; all other rows have salt 0 and join as ever.  The salt is made of the
    row and its partition, so a task that runs again deals its rows the same way.  ``dim`` must be unique
    on ``on``.
    """
    keys, salt = _keys(on), "_salt"
    heavy = heavy_keys(df, keys, share)
    # Keys are hashed on both sides, so they must be of one type there.
    side = dim.select(*[F.col(k).cast(df.schema[k].dataType).alias(k) for k in keys], *take)
    if not heavy:
        return df.join(_maybe_broadcast(side, False), keys, how)
    is_heavy = F.xxhash64(*keys).isin(heavy)
    dealt = F.pmod(F.xxhash64(*df.columns) + F.spark_partition_id(), F.lit(parts)).cast("int")
    spread = df.withColumn(salt, F.when(is_heavy, dealt).otherwise(F.lit(0)))
    copies = F.when(is_heavy, F.sequence(F.lit(0), F.lit(parts - 1))).otherwise(F.array(F.lit(0)))
    side = side.withColumn(salt, F.explode(copies))
    return spread.join(_maybe_broadcast(side, False), [*keys, salt], how).drop(salt)


def exists_flag(df: DataFrame, keys_df: DataFrame, on: Sequence[str], value_col: str,
                out_col: str | None = None) -> DataFrame:
    """Keep ``value_col`` only where ``on`` exists in ``keys_df`` (else NULL)."""
    on = list(on)
    flag = "_exists"
    present = keys_df.select(*on).distinct().withColumn(flag, F.lit(True))
    joined = df.join(present, on, "left")
    return (joined.withColumn(out_col or value_col,
                              F.when(F.col(flag), F.col(value_col)))
                  .drop(flag))


def insert_candidates(batch: DataFrame, target: DataFrame, on: str | Sequence[str],
                      small_batch: bool = False) -> DataFrame:
    """Batch rows whose key is not yet in ``target`` (NULL-safe anti join).

    ``small_batch=True`` is the micro-batch form: the batch's distinct keys
    semi-join the target's key column first, and the batch is anti-joined
    with the (at most batch-sized) set of keys found.  A left anti join can
    only broadcast its right side (the large target); the semi join lets
    Spark broadcast the *batch* keys when their estimated size is under
    ``spark.sql.autoBroadcastJoinThreshold`` - the target is then scanned
    (key column only) but never shuffled - and it falls back to a shuffled
    join when the batch is large.  No extra job is run to decide.
    """
    keys = _keys(on)
    if small_batch:
        batch_keys = batch.select(*keys).distinct()
        existing = target.select(*keys).join(batch_keys, keys, "left_semi")
        return batch.join(existing, keys, "left_anti")
    return batch.join(target.select(*keys), keys, "left_anti")


def first_of_many(df: DataFrame, many: DataFrame, on: Sequence[str], pick: str,
                  out_col: str) -> DataFrame:
    """Attach ``min(pick)`` of the matching rows of ``many``.

    The nested scan of the reference becomes one pre-aggregation (partial
    aggregate before the shuffle) and one equi-join.
    """
    on = list(on)
    agg = many.groupBy(*on).agg(F.min(pick).alias(out_col))
    return df.join(agg, on, "left")
