"""Queries for the composed pipelines: CSV loads, landed pages, topics, stream processing.

Inputs are derived from the driver's tables at their full size; every query
runs the same helpers as the warehouse does (S1, S5, S6, K3, T3-T9, U2).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import clean as C
from ..functions.clean import compose_key
from ..operators import ranking
from ..session import work_path
from ..sources import pages, topics
from ..sources.csv import csv_rejects, read_wide_csv, split_table, with_arrival_number, write_csv
from ..sources.tables import write_stage
from . import processors, warehouse
from .registry import SQL_TS_FMT, query, tbl, ts_text

ARR = warehouse.ARR


def _text(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


# ---------------------------------------------------------------- CSV by header
@query("csv_shuffled_header", """
SELECT event_id, user_id, 'say "' || event_type || '", ok' || chr(10) || 'user ' || user_id AS note
FROM events
""")
def csv_shuffled_header(spark, d):
    """S1 + P2: a CSV whose columns come in another order than declared, with one extra and one absent,
    and text that holds quotes, commas and line ends."""
    root = work_path(spark, "csv_shuffled_header")
    ev = tbl(spark, d, "events")
    note = F.concat(F.lit('say "'), F.col("event_type"), F.lit('", ok\nuser '), _text("user_id"))
    write_csv(ev.select(note.alias("note"), F.lit("unused").alias("extra"), _text("user_id").alias("user_id"),
                        _text("event_id").alias("event_id")), f"{root}/extract")
    from pyspark.sql.types import LongType, StringType, StructField, StructType

    declared = StructType([StructField("event_id", LongType()), StructField("absent", StringType()),
                           StructField("user_id", LongType()), StructField("note", StringType())])
    return read_wide_csv(spark, f"{root}/extract", declared, arrival_col=None).select("event_id", "user_id", "note")


# ------------------------------------------------------------- entity loads (§2.13)
ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]    # the extract's row order


def _staged(spark: SparkSession, d: str, name: str, columns: dict[str, Column]) -> DataFrame:
    """The lineitem rows as a wide CSV extract in (order, line) order, staged as the batch load does.

    Columns that are not given are absent from the file."""
    root = work_path(spark, name)
    li = tbl(spark, d, "lineitem")
    ordered = li.repartitionByRange("l_orderkey").sortWithinPartitions(*ORDER)
    write_csv(ordered.select(*[_text(c).alias(n) for n, c in columns.items()]), f"{root}/extract")
    splits = split_table(spark, f"{root}/extract")
    write_stage(read_wide_csv(spark, f"{root}/extract", S.CSV_TEXT_SCHEMA, arrival_col=ARR, splits=splits), f"{root}/stage")
    write_stage(csv_rejects(spark, f"{root}/extract", splits=splits), f"{root}/rejects")
    return with_arrival_number(spark.read.parquet(f"{root}/stage"), ARR)


def _cents(c: str) -> Column:
    return F.round(F.col(c) * 100).cast("bigint")


@query("load_dimension", """
SELECT DISTINCT l_suppkey AS "driverId", 'sup' || l_suppkey AS "driverRef",
       CASE WHEN l_linenumber = 1 THEN 0 ELSE l_linenumber END::DOUBLE AS number_drivers,
       CASE WHEN l_suppkey % 3 = 0 THEN NULL ELSE 'S' || (l_suppkey % 3) END AS code,
       CASE WHEN l_suppkey % 5 = 0 THEN NULL ELSE '1990-01-0' || (l_suppkey % 5) END AS dob
FROM lineitem
""")
def load_dimension(spark, d):
    """A dimension of the batch load (A1, F1, F2, F4, F5): variants of one driver stay apart (Q16)."""
    k = F.col("l_suppkey")
    stage = _staged(spark, d, "load_dimension", {
        "driverId": k, "driverRef": F.concat(F.lit("sup"), _text(k)),
        "number_drivers": F.when(F.col("l_linenumber") == 1, F.lit("\\N")).otherwise(_text("l_linenumber")),
        "code": F.when(k % 3 == 0, F.lit("\\N")).otherwise(F.concat(F.lit("S"), _text(k % 3))),
        "forename": F.lit("F"), "surname": F.lit("S"),
        "dob": F.when(k % 5 == 0, F.lit("\\N")).otherwise(F.concat(F.lit("1990-01-0"), _text(k % 5))),
        "nationality": F.lit("N"), "url": F.lit("u")})
    return warehouse.driver(stage).drop(ARR).select(
        "driverId", "driverRef", "number_drivers", "code", _text("dob").alias("dob"))


@query("load_child_fact", """
SELECT l_suppkey % 40 AS race_id, l_partkey % 100 AS "driverId", l_linenumber::BIGINT AS lap,
       l_quantity::BIGINT AS position_laptimes, round(l_extendedprice * 100)::BIGINT AS milliseconds_laptimes
FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_suppkey % 40, l_partkey % 100, l_linenumber
                           ORDER BY l_orderkey, lineitem.l_linenumber, l_partkey, l_suppkey, l_extendedprice) = 1
""")
def load_child_fact(spark, d):
    """A child fact of the batch load (A2, W1, Q18): the first CSV row of each (race, driver, lap)."""
    stage = _staged(spark, d, "load_child_fact", {
        "raceId": F.col("l_suppkey") % 40, "driverId": F.col("l_partkey") % 100, "lap": F.col("l_linenumber"),
        "position_laptimes": F.col("l_quantity").cast("bigint"), "time_laptimes": F.lit("1:10.040"),
        "milliseconds_laptimes": _cents("l_extendedprice")})
    return warehouse.laptimes(stage).drop(ARR).select(
        "race_id", "driverId", "lap", "position_laptimes", "milliseconds_laptimes")


@query("load_fact", """
SELECT l_orderkey AS "resultId", l_suppkey AS "raceId", l_partkey AS "driverId",
       CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_quantity END::DOUBLE AS position,
       round(l_extendedprice * 100)::DOUBLE AS points, l_linenumber AS "conStandingsId"
FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) = 1
""")
def load_fact(spark, d):
    """The fact of the batch load (A2, P2, P3, F5): absent columns are left out, ``R`` positions become 0."""
    stage = _staged(spark, d, "load_fact", {
        "resultId": F.col("l_orderkey"), "raceId": F.col("l_suppkey"), "driverId": F.col("l_partkey"),
        "constructorStandingsId": F.col("l_linenumber"),
        "position": F.when(F.col("l_returnflag") == "R", F.lit("R")).otherwise(_text("l_quantity")),
        "points": _cents("l_extendedprice"), "positionText": F.col("l_returnflag")})
    return warehouse.formulaone(stage).drop(ARR).select(
        "resultId", "raceId", "driverId", "position", "points", "conStandingsId")


# ------------------------------------------------------------------ landed pages
PAGE = 30

_PAGES_SQL = f"""
SELECT event_id, user_id, (rn - 1) // {PAGE} * {PAGE} AS "offset" FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events)
WHERE user_id % 7 <> 0 OR rn <= {PAGE}
"""


@query("landed_pages", _PAGES_SQL)
def landed_pages(spark, d):
    """S5 + S6 + W4 + L2: events land as JSON pages, a file per page in the folder of its user, are read back
    with their path numbers, cut at the first empty page or at the total, and flattened.  Every seventh user's
    second page is empty; every fifth user states its total and has a page too many after it; two pages of
    another folder are malformed and stop nothing."""
    root = work_path(spark, "landed_pages")
    land_pages(spark, tbl(spark, d, "events").select("event_id", "user_id", "ts"), root)
    read = read_pages(spark, root)
    kept = pages.until_empty(read, F.size(pages.records_at("MRData.Items")) > 0, ["offset"], group=["folder"],
                             total=F.col("MRData.total").try_cast("bigint"))
    return pages.flatten(kept, "MRData.Items", keep=["offset"]).select("rec.event_id", "rec.user_id", "offset")


def land_pages(spark, ev, root):
    item = "array<struct<event_id: bigint, user_id: bigint>>"
    paged = pages.build_pages(ev, ["ts", "event_id"], PAGE, group=["user_id"], records="Records")
    recs = F.when((F.col("user_id") % 7 == 0) & (F.col("offset") == PAGE), F.array()).otherwise(
        F.transform("Records", lambda r: F.struct(r["event_id"].alias("event_id"), r["user_id"].alias("user_id"))))
    totals = ev.where(F.col("user_id") % 5 == 0).groupBy(F.col("user_id").alias("of_user")).agg(F.count(F.lit(1)).alias("total"))
    served = paged.join(totals, F.col("user_id") == F.col("of_user"), "left").select(
        "user_id", "offset", "total", recs.cast(item).alias("Items"))
    after = (F.ceil(F.col("total") / PAGE) * PAGE).cast("bigint")
    extra = F.array(F.struct(F.lit(-1).alias("event_id"), F.col("of_user").alias("user_id"))).cast(item)
    served = served.unionByName(totals.select(F.col("of_user").alias("user_id"), after.alias("offset"), "total", extra.alias("Items")))
    envelope = F.struct(F.col("total").cast("string").alias("total"), "Items")
    doc = served.select(F.col("user_id").alias("folder"), "offset", F.to_json(F.struct(envelope.alias("MRData"))).alias("value"))
    bad = "{\"MRData\": {\"Items\""
    bad = spark.createDataFrame([(-1, 0, bad), (-1, PAGE, bad)], "folder long, offset long, value string")
    pages.land(doc.unionByName(bad), f"{root}/pages", ["folder", "offset"], deal=["folder"])


def read_pages(spark, root):
    """MRData, folder, offset, _corrupt of every page."""
    return pages.read_landed_pages(
        spark, f"{root}/pages", "MRData STRUCT<total: STRING, Items: ARRAY<STRUCT<event_id: BIGINT, user_id: BIGINT>>>, "
                                "folder BIGINT, offset BIGINT")


# ------------------------------------------------------------------------ topics
def _order_messages(d: DataFrame, topic: str, value: Column, key: Column) -> DataFrame:
    return d.select(key.alias("key"), F.to_json(value).alias("value"), F.lit(topic).alias("topic"),
                    F.struct("o_orderkey").alias("seq"))


@query("topic_publish", """
SELECT o_orderkey, 0::BIGINT AS n_same_position,
       row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate >= TIMESTAMP '1995-01-01', o_orderkey) AS nth
FROM orders
""")
def topic_publish(spark, d):
    """K3: two publishes of keyed messages; positions stay unique and follow production order within a key."""
    root = work_path(spark, "topic_publish")
    o = tbl(spark, d, "orders")
    late = F.col("o_orderdate") >= F.lit("1995-01-01").cast("timestamp_ntz")
    for part in (~late, late):
        topics.publish(_order_messages(o.where(part), "orders", F.struct("o_orderkey"), compose_key("o_custkey")), root)
    m = topics.read_messages(spark, root)
    same = m.groupBy("topic", "partition", "offset").count().withColumnRenamed("count", "_n")
    m = m.join(same, ["topic", "partition", "offset"])
    from pyspark.sql import Window

    nth = F.row_number().over(Window.partitionBy("key").orderBy("partition", "offset"))
    return m.select(F.get_json_object("value", "$.o_orderkey").cast("bigint").alias("o_orderkey"),
                    (F.col("_n") - 1).alias("n_same_position"), nth.cast("bigint").alias("nth"))


def _warehouse(spark: SparkSession, root: str) -> warehouse.Warehouse:
    """A warehouse with empty tables of the load's own schemas."""
    wh = warehouse.Warehouse(spark, root)
    empty = spark.createDataFrame([], S.CSV_TEXT_SCHEMA).withColumn(ARR, F.lit(0).cast("bigint"))
    for name, df in warehouse.transform_all(empty).items():
        wh[name].create(df)
    return wh


SEASON = 2024
LAP_KEYS = "o_custkey % 200, o_orderkey % 30 + 1, o_orderkey % 50 + 1"
# One row per lap message, with the check it fails first.
_LAPS_SQL = """
WITH m AS (
  SELECT *, 'c' || (o_custkey % 200) AS driver, o_orderkey % 30 + 1 AS round, o_orderkey % 50 + 1 AS lap,
         CASE WHEN o_custkey % 200 >= 190 THEN 'unknown driver'
              WHEN o_orderkey % 13 = 0 THEN 'other season'
              WHEN o_orderkey % 30 + 1 > 25 THEN 'unknown race'
              WHEN o_orderkey % 11 = 0 THEN 'invalid lap' END AS bad
  FROM orders
), r AS (
  SELECT *, CASE WHEN bad IS NULL THEN row_number() OVER (PARTITION BY bad, driver, round, lap
            ORDER BY o_orderdate >= TIMESTAMP '1995-01-01', o_orderkey) END AS rn FROM m
)
"""


def _dimension_messages(spark: SparkSession, d: str) -> DataFrame:
    """Drivers c0..c189 (customers) and the races of 25 rounds (nations)."""
    cust = tbl(spark, d, "customer").select((F.col("c_custkey") % 200).alias("n")).where("n < 190").distinct()
    ref = F.concat(F.lit("c"), _text("n"))
    drv = cust.select(ref.alias("key"), F.to_json(F.struct(ref.alias("driverId"), ref.alias("familyName"))).alias("value"),
                      F.lit("driver_topic").alias("topic"), F.struct(F.col("n")).alias("seq"))
    rnd = _text(F.col("n_nationkey") + 1)
    race = tbl(spark, d, "nation").select(
        compose_key(F.lit(str(SEASON)), rnd).alias("key"),
        F.to_json(F.struct(F.lit(str(SEASON)).alias("season"), rnd.alias("round"), F.col("n_name").alias("raceName"),
                           F.struct(_text("n_regionkey").alias("circuitId")).alias("Circuit"))).alias("value"),
        F.lit("race_topic").alias("topic"), F.struct(F.col("n_nationkey").cast("bigint").alias("n")).alias("seq"))
    return drv.unionByName(race)


def _lap_messages(o: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    driver = F.concat(F.lit("c"), _text(F.col("o_custkey") % 200))
    season = F.when(k % 13 == 0, F.lit("2019")).otherwise(F.lit(str(SEASON)))
    lap = F.when(k % 11 == 0, F.lit("x")).otherwise(_text(k % 50 + 1))
    value = F.struct(season.alias("season"), _text(k % 30 + 1).alias("round"), lap.alias("lap"), driver.alias("driverId"),
                     _text(_cents("o_totalprice")).alias("time"))
    return _order_messages(o, "laptimes_topic", value, compose_key(driver, k % 30 + 1, k % 50 + 1))


def _run_laps(spark: SparkSession, d: str, name: str, dimensions_first: bool = True) -> warehouse.Warehouse:
    """Three scheduled runs of one stream: the dimensions and the lap messages in two publishes."""
    root = work_path(spark, name)
    wh = _warehouse(spark, f"{root}/wh")
    o = tbl(spark, d, "orders")
    late = F.col("o_orderdate") >= F.lit("1995-01-01").cast("timestamp_ntz")
    parts = [_dimension_messages(spark, d), _lap_messages(o.where(~late)), _lap_messages(o.where(late))]
    for part in parts if dimensions_first else [parts[1], parts[0], parts[2]]:
        topics.publish(part, f"{root}/topics")
        processors.ingest_topics(wh, topics.read_message_stream(spark, f"{root}/topics"), f"{root}/checkpoint", season=SEASON)
    return wh


@query("stream_rejects", _LAPS_SQL + """
SELECT 'laptimes_topic' AS topic, coalesce(bad, 'duplicate key') AS reason, count(*) AS n
FROM r WHERE bad IS NOT NULL OR rn > 1 GROUP BY ALL
""")
def stream_rejects(spark, d):
    """Every message that does not get in is counted under one reason, over three micro-batches; the laps of
    the first wait for the drivers and races of the second."""
    return (_run_laps(spark, d, "stream_rejects", dimensions_first=False).read("rejects").groupBy("topic", "reason")
            .agg(F.count(F.lit(1)).alias("n")))


@query("stream_warehouse", _LAPS_SQL + """
SELECT driver AS "driverRef", round::BIGINT AS round, lap::BIGINT AS lap,
       round(o_totalprice * 100)::BIGINT::VARCHAR AS time
FROM r WHERE bad IS NULL AND rn = 1
""")
def stream_warehouse(spark, d):
    """T3-T8 over three topics: dimensions with new ids, races with circuits, laps resolved and deduplicated."""
    wh = _run_laps(spark, d, "stream_warehouse")
    drv = wh.read("driver").select("driverId", "driverRef")
    races = wh.read("race").select("race_id", "round")
    return (wh.read("laptimes").join(drv, "driverId").join(races, "race_id")
            .select("driverRef", "round", "lap", F.col("time_laptimes").alias("time")))


@query("stream_fastest_laps", _LAPS_SQL + """
SELECT round::BIGINT AS round, lap::DOUBLE AS "fastestLap", time AS "fastestLapTime", NULL::DOUBLE AS "fastestLapSpeed" FROM (
  SELECT round, lap, round(o_totalprice * 100)::BIGINT::VARCHAR AS time,
         row_number() OVER (PARTITION BY round ORDER BY round(o_totalprice * 100), lap) AS nth
  FROM r WHERE bad IS NULL AND rn = 1)
WHERE nth = 1
""")
def stream_fastest_laps(spark, d):
    """U3 + W3 + T8: each race's fastest lap after three micro-batches, kept as one row per race that each
    batch merges with its own best."""
    race = _run_laps(spark, d, "stream_fastest_laps").read("race")
    return race.where(F.col("fastestLap").isNotNull()).select(
        F.col("round").cast("bigint").alias("round"), "fastestLap", "fastestLapTime", "fastestLapSpeed")


@query("stream_lists", """
SELECT 'status' AS tbl, n_name AS ref, NULL AS name, 1::BIGINT AS n FROM nation WHERE n_nationkey % 4 <> 3
UNION ALL SELECT 'constructor', 's' || s_suppkey, 'name ' || (s_suppkey % 7), 1 FROM supplier
UNION ALL SELECT 'constructor ids', NULL, NULL, count(*) FROM supplier
UNION ALL SELECT 'pitstops', 's' || (s_suppkey % 50), (s_suppkey // 50 % 8)::VARCHAR, max(s_suppkey)
          FROM supplier GROUP BY ALL
""")
def stream_lists(spark, d):
    """Processors of status, constructor and pit stops: ids that are no numbers are rejects, repeated keys get in
    once, new ids are dense, and of pit stops that share a key the first message counts."""
    root = work_path(spark, "stream_lists")
    wh = _warehouse(spark, f"{root}/wh")
    sup, nat = tbl(spark, d, "supplier"), tbl(spark, d, "nation")
    k = F.col("s_suppkey")

    def messages(rows, topic, key, value, seq):
        return rows.select(key.alias("key"), F.to_json(value).alias("value"), F.lit(topic).alias("topic"),
                           F.struct(seq.cast("bigint").alias("n")).alias("seq"))

    sid = F.when(F.col("n_nationkey") % 4 == 3, F.lit("x")).otherwise(_text("n_nationkey"))
    ref = F.concat(F.lit("s"), _text(k))
    lists = messages(nat, "status_topic", F.lit("status"), F.struct(sid.alias("statusId"), F.col("n_name").alias("status")), F.col("n_nationkey"))
    lists = lists.unionByName(messages(sup, "constructor_topic", ref, F.struct(
        ref.alias("constructorId"), F.concat(F.lit("name "), _text(k % 7)).alias("name")), k))
    drivers = sup.select((k % 50).alias("s_suppkey")).distinct()
    lists = lists.unionByName(messages(drivers, "driver_topic", ref, F.struct(ref.alias("driverId")), k))
    race = F.struct(F.lit(str(SEASON)).alias("season"), F.lit("1").alias("round"), F.struct(F.lit("c").alias("circuitId")).alias("Circuit"))
    lists = lists.unionByName(messages(nat.where("n_nationkey = 0"), "race_topic", F.lit("r"), race, F.col("n_nationkey")))
    pit = F.struct(F.lit(str(SEASON)).alias("season"), F.lit("1").alias("round"), _text(F.floor(k / 50) % 8).alias("stop"),
                   F.concat(F.lit("s"), _text(k % 50)).alias("driverId"), _text(k).alias("lap"), F.lit("1:02.500").alias("duration"))
    # One key a driver: its messages are in one partition, the largest number first.
    pits = messages(sup, "pitstops_topic", F.concat(F.lit("s"), _text(k % 50)), pit, -k)
    for part in (lists, lists, pits):
        topics.publish(part, f"{root}/topics")
        processors.ingest_topics(wh, topics.read_message_stream(spark, f"{root}/topics"), f"{root}/checkpoint", season=SEASON)
    one, none = F.lit(1).cast("bigint"), F.lit(None).cast("string")
    cons = wh.read("constructor")
    stops = wh.read("pitstops").where("milliseconds_pitstops = 62500").join(wh.read("driver"), "driverId")
    return (wh.read("status").select(F.lit("status").alias("tbl"), F.col("status_name").alias("ref"), none.alias("name"), one.alias("n"))
            .unionByName(cons.select(F.lit("constructor").alias("tbl"), F.col("constructorRef").alias("ref"), "name", one.alias("n")))
            .unionByName(cons.agg((F.max("constructorId") - F.min("constructorId") + 1).alias("n"))
                         .select(F.lit("constructor ids").alias("tbl"), none.alias("ref"), none.alias("name"), "n"))
            .unionByName(stops.select(F.lit("pitstops").alias("tbl"), F.col("driverRef").alias("ref"), _text("stop").alias("name"),
                                      F.col("lap_pitstops").alias("n"))))


@query("two_streams", """
WITH o AS (SELECT o_custkey % 200 AS k, o_orderkey % 25 + 1 AS round, round(o_totalprice * 100)::DOUBLE AS points, o_orderkey FROM orders),
d AS (SELECT k, round, points FROM o QUALIFY row_number() OVER (PARTITION BY k, round ORDER BY o_orderkey) = 1)
SELECT 'c' || k AS "driverRef", round::BIGINT AS round, points + 1 AS driver_points, points + 2 AS con_points FROM d WHERE k < 190
""")
def two_streams(spark, d):
    """Processors of both standings, two streams into one warehouse whose messages share their positions: each
    stream's standings are kept, and the later stream's are attached to the results (U2, Q3)."""
    root = work_path(spark, "two_streams")
    wh = _warehouse(spark, f"{root}/wh")
    o = tbl(spark, d, "orders")
    k, rnd = F.col("o_custkey") % 200, _text(F.col("o_orderkey") % 25 + 1)
    ref, season, cents = F.concat(F.lit("c"), _text(k)), F.lit(str(SEASON)), _cents("o_totalprice")
    key = compose_key(ref, rnd)
    refs = tbl(spark, d, "customer").select((F.col("c_custkey") % 200).alias("n")).where("n < 190").distinct()
    cons = F.concat(F.lit("c"), _text("n"))
    cons = refs.select(cons.alias("key"), F.to_json(F.struct(cons.alias("constructorId"))).alias("value"),
                       F.lit("constructor_topic").alias("topic"), F.struct(F.col("n").alias("n")).alias("seq"))
    result = F.struct(season.alias("season"), rnd.alias("round"), ref.alias("driverId"), ref.alias("constructorId"), _text(cents).alias("points"))

    def standing(topic, extra, more):
        value = F.struct(season.alias("season"), rnd.alias("round"), _text(k + 1).alias("position"), _text(cents + more).alias("points"), extra)
        return _order_messages(o, topic, value, key)

    def standings(plus):
        return (standing("driverstandings_topic", F.struct(ref.alias("driverId")).alias("Driver"), plus)
                .unionByName(standing("constandings_topic", F.struct(ref.alias("constructorId")).alias("Constructor"), plus * 2)))

    first = _order_messages(o, "results_topic", result, key).unionByName(standings(0))
    for name, part in (("a", _dimension_messages(spark, d).unionByName(cons)), ("a", first), ("b", standings(1))):
        topics.publish(part, f"{root}/topics-{name}")
        processors.ingest_topics(wh, topics.read_message_stream(spark, f"{root}/topics-{name}"), f"{root}/checkpoint-{name}", season=SEASON)
    fact = wh.read("formulaone").join(wh.read("driver").select("driverId", "driverRef"), "driverId")
    fact = fact.join(wh.read("race").select(F.col("race_id").alias("raceId"), F.col("round").cast("bigint").alias("round")), "raceId")
    drv = wh.read("driverstandings").select("driverStandingsId", F.col("points_driverstandings").alias("driver_points"))
    con = wh.read("constandings").select(F.col("constandingsId").alias("conStandingsId"), F.col("points_constructorstandings").alias("con_points"))
    return fact.join(drv, "driverStandingsId").join(con, "conStandingsId").select("driverRef", "round", "driver_points", "con_points")


@query("stream_standings", """
SELECT 'c' || k AS "driverRef", round::BIGINT AS round, points, points AS standing_points FROM (
  SELECT o_custkey % 200 AS k, o_orderkey % 25 + 1 AS round, round(o_totalprice * 100)::DOUBLE AS points,
         row_number() OVER (PARTITION BY o_custkey % 200, o_orderkey % 25 ORDER BY o_orderkey) AS rn FROM orders)
WHERE rn = 1 AND k < 190
""")
def stream_standings(spark, d):
    """U2 + U4: result rows get in once per (race, driver), and the standings of the same round are attached
    to them by the repoint."""
    root = work_path(spark, "stream_standings")
    wh = _warehouse(spark, f"{root}/wh")
    o = tbl(spark, d, "orders")
    k, rnd = F.col("o_custkey") % 200, _text(F.col("o_orderkey") % 25 + 1)
    driver, season, points = F.concat(F.lit("c"), _text(k)), F.lit(str(SEASON)), _text(_cents("o_totalprice"))
    result = F.struct(season.alias("season"), rnd.alias("round"), driver.alias("driverId"), points.alias("points"))
    standing = F.struct(season.alias("season"), rnd.alias("round"), _text(k + 1).alias("position"), points.alias("points"),
                        F.struct(driver.alias("driverId")).alias("Driver"))
    key = compose_key(driver, rnd)
    for part in (_dimension_messages(spark, d), _order_messages(o, "results_topic", result, key)
                 .unionByName(_order_messages(o, "driverstandings_topic", standing, key))):
        topics.publish(part, f"{root}/topics")
        processors.ingest_topics(wh, topics.read_message_stream(spark, f"{root}/topics"), f"{root}/checkpoint", season=SEASON)
    fact = wh.read("formulaone").join(wh.read("driver").select("driverId", "driverRef"), "driverId")
    fact = fact.join(wh.read("race").select(F.col("race_id").alias("raceId"), F.col("round")), "raceId")
    st = wh.read("driverstandings").select("driverStandingsId", F.col("points_driverstandings").alias("standing_points"))
    return fact.join(st, "driverStandingsId", "left").select("driverRef", "round", "points", "standing_points")


# ------------------------------------------------------------------------ smaller
@query("one_page", """
SELECT o_orderkey, strftime(o_orderdate, '{f}') AS o_orderdate FROM orders ORDER BY orders.o_orderdate, o_orderkey LIMIT 30 OFFSET 60
""".replace("{f}", SQL_TS_FMT))
def one_page(spark, d):
    """L2: one page of 30 rows at offset 60 (the page is the feature)."""
    o = tbl(spark, d, "orders")
    return ranking.one_page(o, ["o_orderdate", "o_orderkey"], 60, 30).select("o_orderkey", ts_text("o_orderdate").alias("o_orderdate"))


@query("nan_to_null", "SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE value END AS value FROM events")
def nan_to_null(spark, d):
    """NaN becomes NULL."""
    ev = tbl(spark, d, "events")
    return ev.select("event_id", C.nan_to_null(F.when(F.col("event_id") % 5 == 0, F.lit(float("nan")))
                                               .otherwise(F.col("value"))).alias("value"))


@query("field_exact", """
SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'Unknown' WHEN 1 THEN NULL ELSE event_type END AS name FROM events
""")
def field_exact(spark, d):
    """F16, exact form (Q19): the default stands for a missing field only, a JSON null stays NULL."""
    ev = tbl(spark, d, "events")
    doc = (F.when(F.col("event_id") % 3 == 0, F.lit("{}")).when(F.col("event_id") % 3 == 1, F.lit('{"name": null}'))
            .otherwise(F.concat(F.lit('{"name": "'), F.col("event_type"), F.lit('"}'))))
    return ev.select("event_id", C.json_field_or_default(doc, "$.name").alias("name"))
