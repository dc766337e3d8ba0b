"""Queries for projections, dedup, lookups, ids, ranking, paging, set ops."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.clean import to_bigint
from ..operators import dedup, filters, keys, lookup, ranking
from ..session import ensure_checkpoint_dir
from .registry import SQL_TS_FMT, in_year, query, tbl, ts_lit, ts_text

LINE_REST = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
             "l_returnflag", "l_linestatus", "l_shipdate"]
LINE_COLS = ["l_orderkey", "l_linenumber"] + LINE_REST
SQL_LINE_REST = ", ".join(f"{c} ASC NULLS LAST" for c in LINE_REST)
SQL_LINE_SELECT = ", ".join(LINE_COLS[:-1]) + f", strftime(l_shipdate, '{SQL_TS_FMT}') AS l_shipdate"
CHEAPEST = ["l_extendedprice", "l_linenumber", "l_partkey", "l_suppkey"]
SQL_CHEAPEST = "l_extendedprice ASC NULLS LAST, l_linenumber, l_partkey, l_suppkey"


@query("distinct_dim", "SELECT DISTINCT p_brand, p_type FROM part")
def distinct_dim(spark, d):
    """P1 + A1: full-row distinct of a projection."""
    return dedup.distinct_rows(tbl(spark, d, "part").select("p_brand", "p_type"))


@query("keep_first", f"""
SELECT {SQL_LINE_SELECT} FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {SQL_LINE_REST}) = 1
""")
def keep_first(spark, d):
    """A2 + W1: first row per (orderkey, linenumber) ordered by the other columns."""
    li = tbl(spark, d, "lineitem")
    out = dedup.keep_first(li, ["l_orderkey", "l_linenumber"], LINE_REST)
    return out.select(*LINE_COLS[:-1], ts_text("l_shipdate").alias("l_shipdate"))


@query("season_filter", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders
WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'
""")
def season_filter(spark, d, season: int = 1997):
    """One season; the range predicate reaches the Parquet scan."""
    o = tbl(spark, d, "orders")
    return o.where(in_year("o_orderdate", season)).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


@query("rename_project", """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_totalprice AS total_price,
       CAST(NULL AS BIGINT) AS standings_id
FROM orders
""")
def rename_project(spark, d):
    """P2 + P3 + P5: tolerant projection (one expected column is absent), renames, NULL column."""
    o = tbl(spark, d, "orders")
    df = filters.tolerant_select(o, ["o_orderkey", "o_custkey", "o_totalprice", "o_comment"])
    df = filters.rename(df, {"o_orderkey": "order_id", "o_custkey": "customer_id",
                             "o_totalprice": "total_price", "o_comment": "comment"})
    return filters.null_columns(df, {"standings_id": "bigint"})


_REJECT_SQL = """
SELECT CASE WHEN TRY_CAST(id_text AS BIGINT) IS NULL THEN 'bad_id'
            WHEN l_linenumber > 5 THEN 'out_of_range' ELSE 'kept' END AS reason
FROM (SELECT l_linenumber,
             CASE WHEN l_linenumber = 1 THEN CAST(l_orderkey AS VARCHAR) || 'x'
                  ELSE CAST(l_orderkey AS VARCHAR) END AS id_text
      FROM lineitem)
"""


def _classified_lines(spark, d):
    li = tbl(spark, d, "lineitem")
    id_text = (F.when(F.col("l_linenumber") == 1, F.concat(F.col("l_orderkey").cast("string"), F.lit("x")))
                .otherwise(F.col("l_orderkey").cast("string")))
    li = li.select("l_orderkey", "l_linenumber", id_text.alias("id_text"))
    return filters.classify(li, [("bad_id", to_bigint("id_text").isNull()),
                                 ("out_of_range", F.col("l_linenumber") > 5)])


@query("range_reject", f"SELECT reason, COUNT(*) AS n FROM ({_REJECT_SQL}) GROUP BY reason")
def range_reject(spark, d):
    """P8 + P9 + T9: invalid ids and out-of-range rows go to rejects with a reason."""
    return _classified_lines(spark, d).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query("count_metrics", f"""
SELECT COUNT(*) AS n_read, COUNT(*) FILTER (WHERE reason = 'kept') AS n_kept,
       COUNT(*) FILTER (WHERE reason <> 'kept') AS n_rejected
FROM ({_REJECT_SQL})
""")
def count_metrics(spark, d):
    """A5: read / kept / rejected counts of ``range_reject``."""
    return filters.count_metrics(_classified_lines(spark, d))


@query("lookup_inner", """
SELECT o.o_orderkey, c.c_custkey,
       CASE WHEN c.c_custkey IS NULL THEN 'unresolved' ELSE 'ok' END AS status
FROM orders o
LEFT JOIN (SELECT c_name, c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') c
  ON c.c_name = 'Customer#' || lpad(CAST(o.o_custkey AS VARCHAR), 9, '0')
""")
def lookup_inner(spark, d, segment: str = "BUILDING"):
    """J1 + T9: resolve a reference text to an id; misses go to rejects."""
    o = tbl(spark, d, "orders").select("o_orderkey",
                                       F.format_string("Customer#%09d", F.col("o_custkey")).alias("c_name"))
    dim = tbl(spark, d, "customer").where(F.col("c_mktsegment") == segment)
    # Resolved rows and rejects come from one join (one scan of orders).
    tagged = lookup.resolve_tagged(o, dim, "c_name", ["c_custkey"])
    status = F.when(F.col(lookup.HIT), F.lit("ok")).otherwise(F.lit("unresolved"))
    return tagged.select("o_orderkey", "c_custkey", status.alias("status"))


@query("lookup_composite", f"""
WITH dim AS (
  SELECT l_orderkey, l_linenumber, l_partkey AS first_partkey FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {SQL_LINE_REST}) = 1)
SELECT f.l_orderkey, f.l_linenumber, f.l_partkey, dim.first_partkey
FROM lineitem f JOIN dim ON f.l_orderkey = dim.l_orderkey AND f.l_linenumber = dim.l_linenumber
""")
def lookup_composite(spark, d):
    """Composite-key lookup against a keep-first dimension."""
    li = tbl(spark, d, "lineitem")
    dim = (dedup.keep_first(li, ["l_orderkey", "l_linenumber"], LINE_REST)
                .select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("first_partkey")))
    # The dimension is a keep-first of the fact itself: it grows with the data,
    # so it is never broadcast; the sort-merge join reuses its partitioning.
    ok, _ = lookup.resolve(li.select("l_orderkey", "l_linenumber", "l_partkey"), dim,
                           ["l_orderkey", "l_linenumber"], ["first_partkey"], broadcast=False)
    return ok


@query("lookup_hot_key", f"""
WITH f AS (SELECT *, CASE WHEN l_partkey % 3 = 0 THEN 0 ELSE l_orderkey END AS k1,
                  CASE WHEN l_partkey % 3 = 0 THEN 1 ELSE l_linenumber END AS k2 FROM lineitem),
dim AS (SELECT k1, k2, l_partkey AS first_partkey FROM f
        QUALIFY row_number() OVER (PARTITION BY k1, k2 ORDER BY {SQL_LINE_REST}) = 1)
SELECT f.l_orderkey, f.l_linenumber, f.l_partkey, f.k1, dim.first_partkey FROM f JOIN dim USING (k1, k2)
""")
def lookup_hot_key(spark, d):
    """J2 where one key holds a third of the rows: heavy keys are found by a sketch and spread over salts."""
    odd = F.col("l_partkey") % 3 == 0
    li = (tbl(spark, d, "lineitem").withColumn("k1", F.when(odd, F.lit(0)).otherwise(F.col("l_orderkey")))
          .withColumn("k2", F.when(odd, F.lit(1)).otherwise(F.col("l_linenumber"))))
    dim = dedup.keep_first(li, ["k1", "k2"], LINE_REST).select("k1", "k2", F.col("l_partkey").alias("first_partkey"))
    return lookup.resolve_spread(li.select("l_orderkey", "l_linenumber", "l_partkey", "k1", "k2"), dim, ["k1", "k2"],
                                 ["first_partkey"]).drop("k2")


@query("lookup_left", """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, p.p_name
FROM lineitem l LEFT JOIN (SELECT p_partkey, p_name FROM part WHERE p_size < 25) p ON l.l_partkey = p.p_partkey
""")
def lookup_left(spark, d):
    """Optional lookup; misses keep the row with NULL."""
    li = tbl(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    dim = tbl(spark, d, "part").where(F.col("p_size") < 25).withColumnRenamed("p_partkey", "l_partkey")
    out, _ = lookup.resolve(li, dim, "l_partkey", ["p_name"], how="left")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "p_name")


@query("exists_flag", """
SELECT o.o_orderkey,
       CAST(CASE WHEN EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_linenumber = 7)
                 THEN 7 END AS BIGINT) AS lap
FROM orders o
""")
def exists_flag(spark, d, line: int = 7):
    """Keep a value only if the referenced row exists."""
    o = tbl(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"),
                                       F.lit(line).cast("bigint").alias("l_linenumber"))
    li = tbl(spark, d, "lineitem").where(F.col("l_linenumber") == line)
    out = lookup.exists_flag(o, li.withColumn("l_linenumber", F.col("l_linenumber").cast("bigint")),
                             ["l_orderkey", "l_linenumber"], "l_linenumber", "lap")
    return out.select(F.col("l_orderkey").alias("o_orderkey"), "lap")


@query("anti_existing", """
SELECT c_custkey, c_name FROM customer c
WHERE c_nationkey = 7
  AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderpriority = '1-URGENT')
""")
def anti_existing(spark, d, nation: int = 7):
    """J5 + O3: rows whose key is absent from another table (NULL-safe anti join)."""
    c = tbl(spark, d, "customer").where(F.col("c_nationkey") == nation).select("c_custkey", "c_name")
    urgent = (tbl(spark, d, "orders").where(F.col("o_orderpriority") == "1-URGENT")
                  .select(F.col("o_custkey").alias("c_custkey")))
    return lookup.insert_candidates(c, urgent, "c_custkey")


@query("first_of_many", """
SELECT o.o_orderkey, CAST(m.first_line AS BIGINT) AS first_line
FROM orders o LEFT JOIN (SELECT l_orderkey, MIN(l_linenumber) AS first_line FROM lineitem GROUP BY 1) m
  ON o.o_orderkey = m.l_orderkey
""")
def first_of_many(spark, d):
    """The first of many matches, as pre-aggregate + join."""
    o = tbl(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"))
    li = tbl(spark, d, "lineitem")
    out = lookup.first_of_many(o, li, ["l_orderkey"], "l_linenumber", "first_line")
    return out.select(F.col("l_orderkey").alias("o_orderkey"), F.col("first_line").cast("bigint"))


@query("lookup_or_create", """
WITH known AS (SELECT p_name, MIN(p_partkey) AS name_id FROM part WHERE p_name < 'm' GROUP BY p_name),
fresh AS (
  SELECT p_name, (SELECT COALESCE(MAX(name_id), 0) FROM known) + row_number() OVER (ORDER BY p_name) AS name_id
  FROM (SELECT DISTINCT p_name FROM part p WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.p_name = p.p_name))),
dim AS (SELECT p_name, name_id, false AS created FROM known
        UNION ALL SELECT p_name, name_id, true AS created FROM fresh)
SELECT p.p_partkey, p.p_name, CAST(dim.name_id AS BIGINT) AS name_id, dim.created
FROM part p JOIN dim ON p.p_name = dim.p_name
""")
def lookup_or_create(spark, d):
    """J8 + O2 + W2: unknown refs get new ids after the dimension's max, in name order.

    The known set is the names before ``'m'`` (32 of 64 names).  Splitting by
    ``p_partkey < 500`` would already cover every name in this data, so no
    ref would be new and the create path would go untested."""
    part = tbl(spark, d, "part")
    dim = (part.where(F.col("p_name") < "m").groupBy("p_name")
               .agg(F.min("p_partkey").alias("name_id")))
    refs = part.select("p_partkey", "p_name")
    merged, _ = keys.lookup_or_create(refs, dim, "p_name", "name_id")
    return refs.join(merged, "p_name").select("p_partkey", "p_name", "name_id", "created")


@query("max_plus_one", """
WITH u AS (SELECT user_id, MIN(ts) AS first_ts FROM events GROUP BY user_id)
SELECT user_id,
       CAST((SELECT MAX(c_custkey) FROM customer) + row_number() OVER (ORDER BY first_ts, user_id) AS BIGINT) AS new_id
FROM u
""")
def max_plus_one(spark, d):
    """A3 + W2: new ids from max(existing)+1 in first-seen order."""
    users = tbl(spark, d, "events").groupBy("user_id").agg(F.min("ts").alias("first_ts"))
    start = keys.max_id(tbl(spark, d, "customer"), "c_custkey")
    out = keys.assign_ids(users, ["first_ts", "user_id"], id_col="new_id", start=start)
    return out.select("user_id", "new_id")


@query("conditional_agg", f"""
SELECT l_orderkey, COUNT(*) AS n_lines,
       arg_min(l_quantity, row(l_extendedprice, l_linenumber, l_partkey, l_suppkey, l_quantity)) AS top_quantity,
       strftime(arg_min(l_shipdate, row(l_extendedprice, l_linenumber, l_partkey, l_suppkey, l_quantity)), '{SQL_TS_FMT}') AS top_shipdate
FROM lineitem GROUP BY l_orderkey
""")
def conditional_agg(spark, d):
    """A4: per group, values of one rank-1 row (cheapest line, ties broken) next to counts."""
    li = tbl(spark, d, "lineitem")
    top = ranking.top1(li, ["l_orderkey"], ["l_extendedprice", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"])
    n = li.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_lines"))         # both sides are dealt by the order
    return n.join(top, "l_orderkey").select("l_orderkey", "n_lines", F.col("l_quantity").alias("top_quantity"),
                                            ts_text("l_shipdate").alias("top_shipdate"))


@query("rank_filter_agg", f"""
SELECT l_orderkey, COUNT(*) AS n_lines, MAX(l_quantity) FILTER (WHERE l_linenumber = 1) AS first_quantity
FROM lineitem GROUP BY l_orderkey
""")
def rank_filter_agg(spark, d):
    """A4, FILTER form: a value of the rows with rank 1, and counts of all."""
    li = tbl(spark, d, "lineitem")
    return li.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.max(F.when(F.col("l_linenumber") == 1, F.col("l_quantity"))).alias("first_quantity"))


@query("top1_per_group", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY {SQL_CHEAPEST}) = 1
""")
def top1_per_group(spark, d):
    """A6 + W3: cheapest line per order, NULL prices last."""
    li = tbl(spark, d, "lineitem")
    return ranking.top1(li, ["l_orderkey"], CHEAPEST).select("l_orderkey", "l_linenumber", "l_partkey",
                                                             "l_extendedprice")


@query("global_top1", f"""
SELECT event_id, strftime(ts, '{SQL_TS_FMT}') AS ts, user_id, event_type FROM events
ORDER BY events.ts DESC NULLS LAST, event_id DESC LIMIT 1
""")
def global_top1(spark, d):
    """L1: newest event (``ORDER BY .. LIMIT 1``)."""
    ev = tbl(spark, d, "events")
    top = ranking.global_top1(ev, [F.col("ts").desc_nulls_last(), F.col("event_id").desc()])
    return top.select("event_id", ts_text("ts").alias("ts"), "user_id", "event_type")


@query("page_number", """
SELECT CAST(page AS BIGINT) AS page, COUNT(*) AS n, MIN(event_id) AS first_event, MAX(event_id) AS last_event
FROM (SELECT event_id, (row_number() OVER (ORDER BY event_id) - 1) // 30 AS page FROM events)
GROUP BY page
""")
def page_number(spark, d, page_size: int = 30):
    """L2: page numbers of a global order (distributed positions), rows per page."""
    ev = tbl(spark, d, "events").select("event_id")
    paged = ranking.page_numbers(ev, ["event_id"], page_size)
    return paged.groupBy("page").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_event"),
                                     F.max("event_id").alias("last_event"))


@query("take_while_group", """
SELECT event_id, user_id, event_type FROM (
  SELECT *, SUM(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END)
              OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS errs
  FROM events)
WHERE errs = 0
""")
def take_while_group(spark, d):
    """W4 per group: each user's events before their first error."""
    ev = tbl(spark, d, "events")
    out = ranking.take_while(ev, ["ts", "event_id"], F.col("event_type") == "error", group=["user_id"])
    return out.select("event_id", "user_id", "event_type")


@query("take_while_all", """
WITH d AS (SELECT CAST(ts AS DATE) AS day, COUNT(*) AS n FROM events GROUP BY 1),
t AS (SELECT SUM(n) AS total, COUNT(*) AS ndays FROM d),
s AS (SELECT MIN(day) AS stop_day FROM d, t WHERE d.n * 40 * t.ndays < 39 * t.total)
SELECT strftime(day, '%Y-%m-%d') AS day, n FROM d, s WHERE s.stop_day IS NULL OR d.day < s.stop_day
""")
def take_while_all(spark, d):
    """W4 overall: daily counts up to the first day below 97.5% of the mean day
    (the threshold scales with the data)."""
    # One row per day.  Checkpointed once so the three scalar subqueries below
    # read it instead of each re-aggregating the whole events table.
    ensure_checkpoint_dir(spark)
    daily = (tbl(spark, d, "events").groupBy(F.to_date("ts").alias("day"))
                 .agg(F.count(F.lit(1)).alias("n"))).checkpoint(eager=True)
    total = daily.agg(F.sum("n")).scalar()
    ndays = daily.agg(F.count(F.lit(1))).scalar()
    low = F.col("n") * 40 * ndays < total * 39
    out = ranking.take_while(daily, ["day"], low)
    return out.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "n")


@query("history_current", """
SELECT o_orderkey, o_custkey, o_totalprice, CAST(year(o_orderdate) AS BIGINT) AS season FROM orders
WHERE o_orderdate < TIMESTAMP '1998-01-01'
UNION ALL
SELECT o_orderkey, o_custkey, o_totalprice, CAST(year(o_orderdate) AS BIGINT) AS season FROM orders
WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1999-01-01'
""")
def history_current(spark, d, current: int = 1998):
    """P6 + O1: history (<= previous season) and current season.  Both come from one table here, so
    their union is one scan under an OR; two sources are put together by ``unionByName`` (producers)."""
    o = tbl(spark, d, "orders")
    history = F.col("o_orderdate") < ts_lit(f"{current}-01-01")
    return o.where(history | in_year("o_orderdate", current)).select(
        "o_orderkey", "o_custkey", "o_totalprice", F.year("o_orderdate").cast("bigint").alias("season"))
