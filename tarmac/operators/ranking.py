"""Top-1, take-while, paging, per-group picks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dedup import keep_first, order_spec
from .keys import positions


def top1(df: DataFrame, group: Sequence[str], order: Sequence) -> DataFrame:
    """The first row per group (NULLs last, ``order`` breaks ties).

    Unlike ``min_by``, a NULL order value still yields a row when it is the
    only one.  Planned with a partial ``WindowGroupLimit`` before the shuffle.
    """
    return keep_first(df, group, order)


def global_top1(df: DataFrame, order: Sequence, n: int = 1) -> DataFrame:
    """L1: ``ORDER BY .. LIMIT n`` (TakeOrderedAndProject: per-partition top-n,
    then a merge of n rows per partition)."""
    return df.orderBy(*order_spec(order)).limit(n)


def order_key(order: Sequence[str]) -> Column:
    """The order as one comparable value; a single column stays plain, which keeps
    its minimum in hash aggregation (a struct needs a sort)."""
    return F.col(order[0]) if len(order) == 1 else F.struct(*[F.col(c) for c in order])


def least_of_group(df: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The smallest ``order`` per group, as columns ``_least_0``, ``_least_1`` ... beside the group's.

    One minimum after the other, each among the rows that tie on those before: plain minima stay in hash
    aggregation (that of a struct needs a sort), and after the first shuffle all steps share its
    partitioning.  A NULL group is a group; ``order`` must hold no NULLs."""
    rows = df.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)])
    keys = [f"_g{i}" for i in range(len(group))]
    out = None
    for i in range(len(order)):
        least = rows.groupBy(*keys, *[f"_least_{j}" for j in range(i)]).agg(F.min(f"_o{i}").alias(f"_least_{i}"))
        out = least
        if i < len(order) - 1:
            same = least.select(*[F.col(k).alias(f"{k}_of") for k in keys], f"_least_{i}")
            on = [F.col(k).eqNullSafe(F.col(f"{k}_of")) for k in keys] + [F.col(f"_o{i}") == F.col(f"_least_{i}")]
            rows = rows.join(same, on).drop(*[f"{k}_of" for k in keys])
    return out.select(*[F.col(f"_g{i}").alias(g) for i, g in enumerate(group)], *[f"_least_{i}" for i in range(len(order))])


def _first_stop(df: DataFrame, group: Sequence[str], order: Sequence[str],
                stop: Column) -> DataFrame:
    """Smallest order key of a stop row per group (aggregates with a map-side
    partial, so a hot group is pre-reduced before the shuffle)."""
    found = least_of_group(df.where(stop), group, order)
    at = [F.col(f"_least_{i}").alias(c) for i, c in enumerate(order)]
    return found.select(*group, (at[0] if len(order) == 1 else F.struct(*at)).alias("_stop_at"))


def take_while(df: DataFrame, order: Sequence[str], stop: Column,
               group: Sequence[str] | None = None, inclusive: bool = False) -> DataFrame:
    """Keep rows before the first ``stop`` row (per group, or overall).

    ``order`` must be plain column names with no NULLs.  Instead of a running
    sum over a per-group window (which sorts a hot group in one task), the
    first stop key per group is found by aggregation and joined back; rows of
    groups without a stop are all kept.  Without ``group`` the first stop is a
    scalar subquery over ``df``; checkpoint an expensive ``df`` first so it
    is computed once.
    """
    order = list(order)
    key = order_key(order)
    if group:
        stops = _first_stop(df, group, order, stop)
        stops = stops.select(*[F.col(g).alias(f"_s_{g}") for g in group], "_stop_at")
        cond = [F.col(g).eqNullSafe(F.col(f"_s_{g}")) for g in group]       # a NULL group is a group
        joined = df.join(stops, cond, "left").drop(*[f"_s_{g}" for g in group])
        at = F.col("_stop_at")
    else:
        at = df.where(stop).agg(F.min(key)).scalar()
        joined = df
    keep = at.isNull() | ((key <= at) if inclusive else (key < at))
    out = joined.where(keep)
    return out.drop("_stop_at") if group else out


def page_numbers(df: DataFrame, order: Sequence, page_size: int = 30,
                 group: Sequence[str] | None = None, name: str = "page") -> DataFrame:
    """L2: ``page = floor((row_number - 1) / page_size)`` in ``order``.

    Positions come from the distributed ranking in ``keys.positions`` (no
    single-partition window).
    """
    ranked = positions(df, order, name="_pos", group=group)
    return (ranked.withColumn(name, F.floor((F.col("_pos") - 1) / F.lit(page_size)).cast("bigint"))
                  .withColumn("page_offset", ((F.col("_pos") - 1) % F.lit(page_size)).cast("bigint"))
                  .drop("_pos"))


def one_page(df: DataFrame, order: Sequence, offset: int, limit: int) -> DataFrame:
    """L2 single page: ``ORDER BY .. OFFSET offset LIMIT limit``."""
    return df.orderBy(*order_spec(order)).offset(offset).limit(limit)


def pick_by(value: str | Column, order: str | Column, smallest: bool = True) -> Column:
    """A4: value of the row with the smallest (or largest) ``order`` in a group
    (``min_by``/``max_by``; rows with a NULL order are ignored)."""
    v = F.col(value) if isinstance(value, str) else value
    o = F.col(order) if isinstance(order, str) else order
    return F.min_by(v, o) if smallest else F.max_by(v, o)


def rank_within(df: DataFrame, group: Sequence[str], order: Sequence, ties: Sequence[str],
                unique: Sequence[str], name: str = "rnk") -> DataFrame:
    """R2: SQL ``rank()`` per group without a per-group window.

    Rows are numbered by the distributed ``positions`` in ``order`` then
    ``unique`` (a total order); rows equal on the non-NULL ``ties`` columns
    share the smallest number, which is exactly ``rank()``.
    """
    ranked = positions(df, list(order) + list(unique), name="_pos", group=group)
    cols = [*group, *ties]
    firsts = (ranked.groupBy(*cols).agg(F.min("_pos").alias(name))
                    .select(*[F.col(c).alias(f"_t_{c}") for c in cols], name))
    cond = [F.col(c).eqNullSafe(F.col(f"_t_{c}")) for c in cols]       # NULL groups / ties rank too
    return ranked.join(firsts, cond).drop("_pos", *[f"_t_{c}" for c in cols])
