"""Connected components of a link table by alternating large-star and small-star rounds.

Every round is two aggregations and joins on the link table, which never
holds more rows than links.  The minimum next to each node is aggregated and
checkpointed before it is joined: the join's small side then has a size of its
own, and skew-join handling can split the links of a node that has very many.
Of few nodes the minimums are broadcast.  Rounds end when all links are stars
around their smallest node; links that are so from the start need none.
Each round is checkpointed under ``spark.checkpoint.dir``, so a lost executor
costs one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Nodes whose minimums are broadcast at most, about 80 bytes each in the driver, which keeps those of several
#: rounds until it collects garbage.
SMALL = 1 << 16


def _lowest(pairs: DataFrame, few: bool) -> DataFrame:
    """Of (u, v) rows, every row with the smallest node next to or at u."""
    low = pairs.groupBy("u").agg(F.min("v").alias("low")).select(
        F.col("u").alias("lu"), F.least("u", "low").alias("low")).checkpoint()
    if few:
        low = F.broadcast(low)
    return pairs.join(low, pairs["u"] == low["lu"]).select("u", "v", "low")


def _large_star(edges: DataFrame, few: bool) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (_lowest(both, few).where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("low").alias("v")).where("u <> v").distinct())


def _down(edges: DataFrame) -> DataFrame:
    return edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))


def _small_star(edges: DataFrame, few: bool) -> DataFrame:
    low = _lowest(_down(edges), few)
    out = (low.select(F.col("v").alias("u"), F.col("low").alias("v"))
           .unionByName(low.select("u", F.col("low").alias("v"))))
    return out.where("u <> v").distinct()


def _state(edges: DataFrame) -> tuple[int, int]:
    """Nodes, and nodes that are in no star: below two nodes, or both below and above one."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("below"), F.lit(0).alias("above")) \
        .unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("below"), F.lit(1).alias("above")))
    ends = ends.groupBy("node").agg(F.sum("below").alias("below"), F.max("above").alias("above"))
    r = ends.agg(F.count(F.lit(1)), F.count(F.when((F.col("below") > 1) | ((F.col("below") > 0) & (F.col("above") > 0)), 1))).head()
    return r[0], r[1]


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (u, v); root is the smallest node reachable."""
    cur = _down(edges).where("u <> v").distinct().checkpoint()
    nodes, loose = _state(cur)
    while loose:
        cur = _small_star(_large_star(cur, nodes <= SMALL), nodes <= SMALL).checkpoint()
        _, loose = _state(cur)
    roots = cur.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return cur.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
