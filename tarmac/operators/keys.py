"""Max id, dense surrogate ids, lookup-or-create.

Dense ids are positions in a total order.  A global ``row_number()`` over an
unpartitioned window would pull the whole table into one task, so positions
are computed the distributed way instead:

1. range-partition and sort by (group, order) - a hot group is split across
   many partitions by the range partitioner;
2. tag each row with its partition and in-partition offset
   (``monotonically_increasing_id``) and checkpoint, which fixes positions
   (a re-run task cannot reshuffle them) and cuts the lineage;
3. count rows per (group, partition) - at most one row per group per
   partition - and prefix-sum those counts per group;
4. position = rows in earlier partitions of the group + offset in this one.

The checkpoint is required, not an optimisation: the range partitioner
samples its bounds with a seed derived from the RDD id, so two evaluations
of the same sorted plan (the count branch and the row branch, or a
recomputed task) can disagree on which partition a row lands in.  Reading
both branches from one checkpoint makes them agree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .dedup import order_spec


def max_id(target: DataFrame, id_col: str) -> Column:
    """``SELECT MAX(id) FROM t`` ``or 0`` as a scalar-subquery Column (A3)."""
    return target.agg(F.coalesce(F.max(id_col), F.lit(0)).cast("bigint")).scalar()


def positions(df: DataFrame, order: Sequence, name: str = "pos",
              group: Sequence[str] | None = None) -> DataFrame:
    """1-based position of each row in ``order`` (within ``group`` if given).

    ``order`` must be a total order (include a unique column) for the result
    to be deterministic.
    """
    group = list(group or [])
    ensure_checkpoint_dir(df.sparkSession)
    spec = [F.col(g).asc_nulls_last() for g in group] + order_spec(order)
    tagged = (df.orderBy(*spec)
                .withColumn("_mid", F.monotonically_increasing_id())
                .withColumn("_pid", F.shiftright(F.col("_mid"), 33))
                .checkpoint(eager=True))
    blocks = (tagged.groupBy(*group, "_pid")
                    .agg(F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_n")))
    w = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_before", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    # Fresh names: blocks derives from tagged, so shared names would make the
    # join condition ambiguous.
    blocks = blocks.select(*[F.col(g).alias(f"_g_{g}") for g in group],
                           F.col("_pid").alias("_bpid"), "_first", "_before")
    cond = [F.col("_pid") == F.col("_bpid")] + [F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in group]
    if not group:
        # One row per partition of the sort: bounded by the partition count.
        blocks = F.broadcast(blocks)
    out = tagged.join(blocks, cond, "inner")
    pos = (F.col("_before") + (F.col("_mid") - F.col("_first")) + 1).cast("bigint")
    return out.select(*df.columns, pos.alias(name))


def assign_ids(df: DataFrame, order: Sequence, id_col: str = "id", start=0,
               group: Sequence[str] | None = None) -> DataFrame:
    """Dense ids ``start+1, start+2, ...`` in ``order``.

    ``start`` is an int or a Column such as ``max_id(target, 'id')``.
    """
    start_c = start if isinstance(start, Column) else F.lit(start).cast("bigint")
    out = positions(df, order, name="_pos", group=group)
    return out.withColumn(id_col, (start_c + F.col("_pos")).cast("bigint")).drop("_pos")


def lookup_or_create(refs: DataFrame, dim: DataFrame, ref_col: str, id_col: str,
                     order: Sequence | None = None) -> tuple[DataFrame, DataFrame]:
    """Ids for every distinct ref in ``refs``; refs unknown to ``dim``
    get new ids after ``max(dim.id)`` in ``order`` (default: the ref text).

    Returns ``(dim_with_new, new_rows)``; join ``refs`` to the first (J1) to
    resolve.  Two new rows sharing one new ref get one id.
    """
    new_refs = (refs.select(ref_col).where(F.col(ref_col).isNotNull()).distinct()
                    .join(dim.select(ref_col), ref_col, "left_anti"))
    new_rows = assign_ids(new_refs, order or [ref_col], id_col=id_col, start=max_id(dim, id_col))
    merged = (dim.select(ref_col, id_col, F.lit(False).alias("created"))
                 .unionByName(new_rows.select(ref_col, id_col, F.lit(True).alias("created"))))
    return merged, new_rows
