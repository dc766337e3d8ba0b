"""Queries for the scalar functions F1-F24 and P10 on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions import clean as C
from ..session import work_path
from ..sources.csv import read_wide_csv, write_csv
from ..sources.tables import write_stage
from .registry import TS_FMT, query, tbl, ts_text

def prio(i: int):
    """The i-th ``-``-separated part of the order priority text (1-based)."""
    return F.split_part(F.col("o_orderpriority"), F.lit("-"), F.lit(i))


@query("coerce_number", """
SELECT o_orderkey,
       COALESCE(TRY_CAST(split_part(o_orderpriority, '-', 1) AS DOUBLE), 0) AS prio_num,
       COALESCE(TRY_CAST(o_orderpriority AS DOUBLE), 0) AS prio_whole
FROM orders
""")
def coerce_number(spark, d):
    """F1 + F5: text -> number, bad -> NULL -> 0."""
    df = tbl(spark, d, "orders").select(
        "o_orderkey",
        C.to_number(prio(1)).alias("prio_num"),
        C.to_number("o_orderpriority").alias("prio_whole"))
    return C.fill_zero(df, ["prio_num", "prio_whole"])


@query("coerce_time", """
WITH t AS (
  SELECT event_id,
         CASE WHEN event_type = 'error' THEN 'bad-' || CAST(event_id AS VARCHAR)
              ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS txt
  FROM events),
p AS (SELECT event_id, try_strptime(txt, '%Y-%m-%d %H:%M:%S') AS parsed FROM t)
SELECT event_id,
       strftime(parsed, '%Y-%m-%d %H:%M:%S') AS ts_text,
       strftime(parsed, '%H:%M:%S') AS time_of_day,
       strftime(parsed, '%Y-%m-%d') || 'T00:00:00' AS day_text
FROM p
""")
def coerce_time(spark, d):
    """F2 + F3 + F14: timestamp text with bad rows -> NULL; time of day; day text."""
    ev = tbl(spark, d, "events")
    txt = (F.when(F.col("event_type") == "error", F.concat(F.lit("bad-"), F.col("event_id").cast("string")))
             .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")))
    parsed = C.to_timestamp_fmt(txt)
    return ev.select("event_id",
                     F.date_format(parsed, "yyyy-MM-dd HH:mm:ss").alias("ts_text"),
                     C.time_of_day(parsed).alias("time_of_day"),
                     C.date_to_ts_text(parsed).alias("day_text"))


@query("sentinel_null", r"""
SELECT NULLIF(CASE WHEN event_type = 'view' THEN '\N' ELSE event_type END, '\N') AS event_type,
       COUNT(*) AS n
FROM events GROUP BY 1
""")
def sentinel_null(spark, d):
    """``\\N`` written for one type, read back as NULL, counted by type."""
    ev = tbl(spark, d, "events")
    raw = F.when(F.col("event_type") == "view", F.lit(C.NULL_SENTINEL)).otherwise(F.col("event_type"))
    return (ev.select(C.null_sentinel(raw).alias("event_type"))
              .groupBy("event_type").agg(F.count(F.lit(1)).alias("n")))


def _lap_ms():
    return F.pmod(F.col("event_id") * 7919, F.lit(240000))


def _lap_text(x):
    frac = F.lpad((x % 1000).cast("string"), 3, "0")
    with_min = F.concat(F.floor(x / 60000).cast("string"), F.lit(":"),
                        F.lpad(F.floor((x % 60000) / 1000).cast("string"), 2, "0"), F.lit("."), frac)
    no_min = F.concat(F.floor(x / 1000).cast("string"), F.lit("."), frac)
    return F.when(x >= 60000, with_min).otherwise(no_min)


@query("duration_ms", """
WITH x AS (SELECT event_id, ((event_id * 7919) % 240000 + 240000) % 240000 AS x FROM events),
t AS (
  SELECT event_id, x,
         CASE WHEN x >= 60000
              THEN CAST(x // 60000 AS VARCHAR) || ':' || lpad(CAST((x % 60000) // 1000 AS VARCHAR), 2, '0')
                   || '.' || lpad(CAST(x % 1000 AS VARCHAR), 3, '0')
              ELSE CAST(x // 1000 AS VARCHAR) || '.' || lpad(CAST(x % 1000 AS VARCHAR), 3, '0') END AS lap_text
  FROM x)
SELECT event_id, lap_text,
       x AS ms,
       CAST(trunc((CAST(CASE WHEN contains(lap_text, ':') THEN split_part(lap_text, ':', 1) ELSE '0' END AS DOUBLE) * 60
                   + CAST(CASE WHEN contains(lap_text, ':') THEN split_part(lap_text, ':', 2) ELSE lap_text END AS DOUBLE))
                  * 1000) AS BIGINT) AS legacy_ms,
       CAST(x AS DOUBLE) / CAST(1000 AS DOUBLE) AS seconds
FROM t
""")
def duration_ms(spark, d):
    """F7 + F8: ``M:SS.mmm`` / ``SS.mmm`` text -> exact ms, legacy float ms, seconds."""
    ev = tbl(spark, d, "events")
    lap = _lap_text(_lap_ms())
    return (ev.select("event_id", lap.alias("lap_text"))
              .select("event_id", "lap_text",
                      C.duration_ms("lap_text").alias("ms"),
                      C.duration_ms("lap_text", legacy_float=True).alias("legacy_ms"),
                      C.duration_seconds("lap_text").alias("seconds")))


@query("trunc_coord", """
WITH t AS (SELECT c_custkey, CAST(CAST(c_acctbal - 5000 AS DECIMAL(12,2)) AS VARCHAR) AS coord_text FROM customer)
SELECT c_custkey, coord_text, CAST(trunc(CAST(coord_text AS DOUBLE)) AS BIGINT) AS coord_int FROM t
""")
def trunc_coord(spark, d):
    """float text truncated toward zero."""
    c = tbl(spark, d, "customer")
    txt = (F.col("c_acctbal") - 5000).cast("decimal(12,2)").cast("string")
    return (c.select("c_custkey", txt.alias("coord_text"))
             .withColumn("coord_int", C.trunc_int("coord_text")))


@query("digit_guard", """
WITH p AS (SELECT split_part(o_orderpriority, '-', 1) AS p1, split_part(o_orderpriority, '-', 2) AS p2,
                  split_part(o_orderpriority, '-', 3) AS p3 FROM orders)
SELECT CASE WHEN regexp_full_match(p1, '[0-9]+') THEN TRY_CAST(p1 AS BIGINT) END AS guard_1,
       COUNT(*) AS n,
       COUNT(CASE WHEN regexp_full_match(p2, '[0-9]+') THEN TRY_CAST(p2 AS BIGINT) END) AS n_guard_2,
       COUNT(TRY_CAST(NULLIF(p3, '') AS BIGINT)) AS n_safe_3,
       CAST(SUM(TRY_CAST(NULLIF(p1, '') AS BIGINT)) AS BIGINT) AS sum_safe_1
FROM p GROUP BY 1
""")
def digit_guard(spark, d):
    """F11 + F12: all-digit guard and blank-safe int on the priority parts."""
    o = tbl(spark, d, "orders").select(prio(1).alias("p1"), prio(2).alias("p2"), prio(3).alias("p3"))
    return (o.select(C.digits_only("p1").alias("guard_1"), C.digits_only("p2").alias("g2"),
                     C.safe_int("p3").alias("s3"), C.safe_int("p1").alias("s1"))
             .groupBy("guard_1")
             .agg(F.count(F.lit(1)).alias("n"), F.count("g2").alias("n_guard_2"),
                  F.count("s3").alias("n_safe_3"), F.sum("s1").cast("bigint").alias("sum_safe_1")))


@query("compose_key", """
SELECT DISTINCT concat_ws('_', l_orderkey, l_linenumber) AS msg_key FROM lineitem
""")
def compose_key(spark, d):
    """``orderkey_linenumber`` message keys."""
    li = tbl(spark, d, "lineitem")
    # The separator keeps keys apart, so the numbers are made distinct and the text is composed after the shuffle.
    keys = li.select("l_orderkey", "l_linenumber").distinct()
    return keys.select(C.compose_key("l_orderkey", "l_linenumber").alias("msg_key"))


@query("default_field", """
SELECT event_id,
       json_extract_string(props, '$.k') AS k_text,
       COALESCE(json_extract_string(props, '$.z'), 'Unknown') AS z_default,
       COALESCE(json_extract_string(props, '$.z'), CAST(event_id AS VARCHAR)) AS z_or_key
FROM events
""")
def default_field(spark, d):
    """F16 + F17 + F21: present field, missing field with default, key fallback."""
    ev = tbl(spark, d, "events")
    z = F.get_json_object("props", "$.z")
    return ev.select("event_id",
                     F.get_json_object("props", "$.k").alias("k_text"),
                     C.field_or_default(z).alias("z_default"),
                     C.field_or_default(z, F.col("event_id").cast("string")).alias("z_or_key"))


@query("json_round_trip", """
SELECT event_type, COUNT(*) AS n, CAST(SUM(user_id) AS BIGINT) AS sum_user,
       ROUND(CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE), 2) AS sum_value
FROM events GROUP BY 1
""")
def json_round_trip(spark, d):
    """F21 + P4: rows -> JSON messages -> typed struct -> flat columns -> sums."""
    ev = tbl(spark, d, "events")
    msg = ev.select(F.to_json(F.struct("event_id", "user_id", "event_type", "value")).alias("value"))
    schema = "event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE"
    flat = msg.select(F.from_json("value", schema).alias("v")).select("v.*")
    return flat.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"),
                                          F.sum("user_id").cast("bigint").alias("sum_user"),
                                          C.exact_sum("value").alias("sum_value"))


@query("strict_parse", """
SELECT event_type, CAST(SUM(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS sum_k,
       MIN(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS min_k,
       MAX(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS max_k
FROM events GROUP BY 1
""")
def strict_parse(spark, d):
    """strict cast of the ``$.k`` text (raises on bad text under ANSI)."""
    ev = tbl(spark, d, "events").select("event_type", C.strict_int(F.get_json_object("props", "$.k")).alias("k"))
    return ev.groupBy("event_type").agg(F.sum("k").cast("bigint").alias("sum_k"),
                                        F.min("k").alias("min_k"), F.max("k").alias("max_k"))


@query("strip_suffix", """
SELECT substr(replace(strftime(ts, '%H:%M:%S') || 'Z', 'Z', ''), 1, 2) AS hour_text, COUNT(*) AS n
FROM events GROUP BY 1
""")
def strip_suffix(spark, d):
    """``HH:mm:ssZ`` -> strip ``Z`` -> count per hour text."""
    ev = tbl(spark, d, "events")
    txt = F.concat(C.time_of_day("ts"), F.lit("Z"))
    return (ev.select(F.substring(C.strip_z(txt), 1, 2).alias("hour_text"))
              .groupBy("hour_text").agg(F.count(F.lit(1)).alias("n")))


@query("conditional_value", """
SELECT CAST(CASE WHEN split_part(o_orderpriority, '-', 1) = '1' THEN 1 ELSE 0 END AS BIGINT) AS is_urgent,
       COALESCE(NULLIF(CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END, ''), 'PENDING') AS status_final,
       COUNT(*) AS n
FROM orders GROUP BY 1, 2
""")
def conditional_value(spark, d):
    """F18 + F19 + F20: text compare after str(), truthy fallback."""
    o = tbl(spark, d, "orders")
    urgent = F.when(C.text_equals(prio(1), "1"), F.lit(1)).otherwise(F.lit(0)).cast("bigint")
    status = F.when(F.col("o_orderstatus") == "P", F.lit("")).otherwise(F.col("o_orderstatus"))
    return (o.select(urgent.alias("is_urgent"), C.truthy_fallback(status, "PENDING").alias("status_final"))
             .groupBy("is_urgent", "status_final").agg(F.count(F.lit(1)).alias("n")))


@query("nested_presence", """
SELECT event_type,
       COUNT(*) FILTER (WHERE event_type = 'error') AS n_present,
       COUNT(*) FILTER (WHERE event_type <> 'error') AS n_absent
FROM events GROUP BY 1
""")
def nested_presence(spark, d):
    """P10: ``"X" in v and "time" in v["X"]`` as a NULL test on a parsed struct.

    ``error`` rows carry ``X.time``, ``click`` rows an empty ``X``, the rest no ``X``.
    """
    ev = tbl(spark, d, "events")
    k = F.get_json_object("props", "$.k")
    payload = (F.when(F.col("event_type") == "error",
                      F.concat(F.lit('{"k": '), k, F.lit(', "X": {"time": "'), C.time_of_day("ts"), F.lit('"}}')))
                .when(F.col("event_type") == "click", F.concat(F.lit('{"k": '), k, F.lit(', "X": {}}')))
                .otherwise(F.col("props")))
    parsed = F.from_json(payload, "k BIGINT, X STRUCT<time: STRING>")
    present = parsed.getField("X").getField("time").isNotNull()
    return (ev.select("event_type", present.alias("present"))
              .groupBy("event_type")
              .agg(F.count_if("present").alias("n_present"), F.count_if(~F.col("present")).alias("n_absent")))



@query("csv_stage", """
SELECT event_id, strftime(date_trunc('millisecond', ts), '%Y-%m-%d %H:%M:%S.%f') AS ts,
       event_type, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value,
       json_extract_string(props, '$.k') AS k
FROM events
""")
def csv_stage(spark, d):
    """S1 + F1 + F2 + F4 + K1: events go out as a CSV extract (``\\N`` for NULL,
    quoted JSON text), come back all-text with a declared schema, are cleaned
    and staged to Parquet with millisecond timestamps, as the batch load does."""
    root = work_path(spark, "csv_stage")
    ev = tbl(spark, d, "events")
    text = ev.select(F.col("event_id").cast("string").alias("event_id"),
                     F.date_format("ts", TS_FMT).alias("ts"), "event_type",
                     F.when(F.col("event_type") != "error", F.col("value")).cast("string").alias("value"),
                     "props")
    write_csv(text, f"{root}/extract")
    schema = StructType([StructField(c, StringType()) for c in text.columns])
    raw = read_wide_csv(spark, f"{root}/extract", schema)
    clean = raw.select(C.to_bigint("event_id").alias("event_id"),
                       C.to_timestamp_fmt(C.null_sentinel("ts"), TS_FMT).alias("ts"),
                       C.null_sentinel("event_type").alias("event_type"),
                       C.to_number(C.null_sentinel("value")).alias("value"),
                       F.get_json_object(C.null_sentinel("props"), "$.k").alias("k"))
    write_stage(clean, f"{root}/stage")
    staged = spark.read.schema(clean.schema).parquet(f"{root}/stage")
    return staged.select("event_id", ts_text("ts").alias("ts"), "event_type", "value", "k")
