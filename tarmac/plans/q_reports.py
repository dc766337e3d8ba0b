"""Reporting queries R1-R3 on the driver's star schema.

Each fact is aggregated at its own grain *before* it is joined (map-side
partial aggregation, then a join of much smaller inputs); sums are exact
DECIMAL so they compose across the two aggregation levels.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ranking
from .registry import query, tbl

DEC = "decimal(18,2)"


def _money(c):
    return F.round(F.col(c).cast("double"), 2)


@query("driver_performance", """
SELECT n.n_name, CAST(year(o.o_orderdate) AS BIGINT) AS season,
       ROUND(CAST(SUM(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE), 2) AS total_price,
       COUNT(*) AS n_orders, MIN(o.o_totalprice) AS min_price
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY 1, 2
""")
def driver_performance(spark, d):
    """Totals, counts and best (minimum) per entity and season."""
    per_cust = (tbl(spark, d, "orders")
                .groupBy("o_custkey", F.year("o_orderdate").cast("bigint").alias("season"))
                .agg(F.sum(F.col("o_totalprice").cast(DEC)).alias("s"), F.count(F.lit(1)).alias("c"),
                     F.min("o_totalprice").alias("m")))
    cust = tbl(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    nation = tbl(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    joined = per_cust.join(cust, "o_custkey").join(nation, "c_nationkey")
    out = joined.groupBy("n_name", "season").agg(F.sum("s").alias("s"), F.sum("c").alias("n_orders"),
                                                 F.min("m").alias("min_price"))
    return out.select("n_name", "season", _money("s").alias("total_price"), "n_orders", "min_price")


@query("constructor_rank", """
WITH r AS (SELECT l_suppkey, CAST(year(l_shipdate) AS BIGINT) AS season,
                  SUM(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS rev
           FROM lineitem GROUP BY 1, 2)
SELECT r.l_suppkey, s.s_name, r.season, ROUND(CAST(r.rev AS DOUBLE), 4) AS revenue,
       CAST(rank() OVER (PARTITION BY r.season ORDER BY r.rev DESC) AS BIGINT) AS rnk
FROM r JOIN supplier s ON s.s_suppkey = r.l_suppkey
""")
def constructor_rank(spark, d):
    """R2: revenue per entity and season, ranked within the season."""
    li = tbl(spark, d, "lineitem")
    rev = (F.col("l_extendedprice").cast(DEC) * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)")))
    per = (li.groupBy("l_suppkey", F.year("l_shipdate").cast("bigint").alias("season"))
             .agg(F.sum(rev).alias("rev")))
    ranked = ranking.rank_within(per, ["season"], [F.col("rev").desc()], ties=["rev"], unique=["l_suppkey"])
    sup = tbl(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    return (ranked.join(sup, "l_suppkey")
                  .select("l_suppkey", "s_name", "season",
                          F.round(F.col("rev").cast("double"), 4).alias("revenue"), "rnk"))


@query("race_stats", """
WITH s AS (SELECT l_orderkey, COUNT(*) AS n_lines, MIN(l_quantity) AS min_qty, MAX(l_quantity) AS max_qty,
                  SUM(l_quantity) / COUNT(*) AS avg_qty,
                  ROUND(CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE), 2) AS line_total
           FROM lineitem GROUP BY l_orderkey)
SELECT o.o_orderkey, c.c_name, s.n_lines, s.min_qty, s.max_qty, s.avg_qty, s.line_total
FROM orders o JOIN s ON s.l_orderkey = o.o_orderkey JOIN customer c ON c.c_custkey = o.o_custkey
""")
def race_stats(spark, d):
    """Per-event statistics of a child fact, pre-aggregated, with the entity name."""
    stats = (tbl(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey"))
             .agg(F.count(F.lit(1)).alias("n_lines"), F.min("l_quantity").alias("min_qty"),
                  F.max("l_quantity").alias("max_qty"), F.sum("l_quantity").alias("_q"),
                  F.sum(F.col("l_extendedprice").cast(DEC)).alias("_p")))
    o = tbl(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    c = tbl(spark, d, "customer").select("c_custkey", "c_name")
    return (o.join(stats, "o_orderkey").join(c, "c_custkey")
             .select("o_orderkey", "c_name", "n_lines", "min_qty", "max_qty",
                     (F.col("_q") / F.col("n_lines")).alias("avg_qty"), _money("_p").alias("line_total")))
