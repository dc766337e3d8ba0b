"""Queries for the other entity loads and for the producers, several of a kind per query.

As in :mod:`q_pipelines`, the inputs are the driver's tables at their full size, written as the wide CSV
extract or as landed pages; the loads and producers themselves do all the rest.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_path
from ..sources import pages
from . import producers, warehouse
from .q_pipelines import ARR, ORDER, PAGE, _staged, _text
from .registry import query, tbl

_FIRST = "ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice"


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _row(df: DataFrame, tbl_name: str, **columns: str | Column) -> DataFrame:
    """Rows of one entity as (tbl, and the given columns as text)."""
    return df.select(F.lit(tbl_name).alias("tbl"), *[_text(c).alias(n) for n, c in columns.items()])


# ------------------------------------------------------------------ the other loads
@query("load_dimensions", f"""
WITH s AS (SELECT DISTINCT l_linenumber AS a, l_returnflag AS b FROM lineitem),
c AS (SELECT DISTINCT l_suppkey AS a, l_linestatus AS b, CASE WHEN l_suppkey % 9 = 0 THEN NULL ELSE l_suppkey % 9 END AS c FROM lineitem),
p AS (SELECT DISTINCT l_suppkey AS a, l_linenumber AS b, l_returnflag AS c FROM lineitem),
i AS (SELECT l_partkey % 500 AS a, l_linestatus AS b,
             CASE WHEN l_linenumber = 2 THEN 0 ELSE l_quantity::BIGINT END AS c
      FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_partkey % 500 {_FIRST}) = 1)
SELECT 'status' AS tbl, a::VARCHAR AS a, 'st' || b || a AS b, NULL AS c, NULL AS d FROM s
UNION ALL SELECT 'constructor', a::VARCHAR, 'con' || a, 'name' || b, 'nat' || c FROM c
UNION ALL SELECT 'driverstandings', a::VARCHAR, b::VARCHAR, c, (b * 10)::VARCHAR FROM p
UNION ALL SELECT 'constandings', a::VARCHAR, b::VARCHAR, CASE WHEN c = 'R' THEN NULL ELSE c END, (b * 10)::VARCHAR FROM p
UNION ALL SELECT 'circuit', a::VARCHAR, 'cir' || a, 'loc' || b, c::VARCHAR FROM i
""")
def load_dimensions(spark, d):
    """Loads of status, constructor, both standings and circuit: distinct rows, so variants stay apart (Q16);
    the first row of a circuit; null markers; numbers that are none become 0 (F5)."""
    sup, num = F.col("l_suppkey"), F.col("l_linenumber")
    no = F.lit("\\N")
    stage = _staged(spark, d, "load_dimensions", {
        "statusId": num, "status": F.concat(F.lit("st"), "l_returnflag", _text(num)),
        "constructorId": sup, "constructorRef": F.concat(F.lit("con"), _text(sup)), "name": F.concat(F.lit("name"), "l_linestatus"),
        "nationality_constructors": F.when(sup % 9 != 0, F.concat(F.lit("nat"), _text(sup % 9))), "url_constructors": F.lit("u"),
        "driverStandingsId": sup, "points_driverstandings": num * 10, "position_driverstandings": num,
        "positionText_driverstandings": F.col("l_returnflag"),
        "constructorStandingsId": sup, "points_constructorstandings": num * 10, "position_constructorstandings": num,
        "positionText_constructorstandings": F.when(F.col("l_returnflag") == "R", no).otherwise(F.col("l_returnflag")),
        "wins_constructorstandings": num,
        "circuitId": F.col("l_partkey") % 500, "circuitRef": F.concat(F.lit("cir"), _text(F.col("l_partkey") % 500)),
        "name_y": F.lit("n"), "location": F.concat(F.lit("loc"), "l_linestatus"), "country": F.lit("x"),
        "lat": F.when(num == 2, F.lit("unknown")).otherwise(_text("l_quantity")), "lng": F.lit("1.5"), "alt": no, "url_y": F.lit("u")})
    whole = lambda c: F.col(c).cast("bigint")
    null = F.lit(None)
    con = warehouse.constructor(stage)
    cir = warehouse.circuit(stage).where("alt = 0 AND lng = 1.5")
    nat = F.when(F.col("nationality_constructors") != "\\N", F.col("nationality_constructors"))
    return _union([
        _row(warehouse.status(stage), "status", a="statusid", b="status_name", c=null, d=null),
        _row(con, "constructor", a="constructorId", b="constructorRef", c="name", d=nat),
        _row(warehouse.driverstandings(stage), "driverstandings", a="driverStandingsId", b="position_driverstandings",
             c="positionText_driverstandings", d=whole("points_driverstandings")),
        _row(warehouse.constandings(stage), "constandings", a="constandingsId", b="wins_constructorstandings",
             c="positionText_constructorstandings", d=whole("points_constructorstandings")),
        _row(cir, "circuit", a="circuitId", b="circuitRef", c="location", d=whole("lat"))])


@query("load_races", f"""
WITH f AS (SELECT l_partkey AS a, l_linenumber AS n, l_suppkey AS s, l_returnflag AS r, l_orderkey AS o FROM lineitem
           QUALIFY row_number() OVER (PARTITION BY l_partkey {_FIRST}) = 1),
p AS (SELECT l_linenumber AS stop, l_suppkey % 40 AS race, l_partkey % 100 AS driver, l_orderkey AS o,
             CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_quantity::BIGINT END AS dur FROM lineitem
      QUALIFY row_number() OVER (PARTITION BY l_linenumber, l_suppkey % 40, l_partkey % 100 {_FIRST}) = 1)
SELECT 'race' AS tbl, a::VARCHAR AS a, s::VARCHAR AS b, (2000 + n)::VARCHAR AS c,
       CASE WHEN r = 'R' THEN NULL ELSE '2000-01-0' || n END AS d, o::VARCHAR AS e FROM f
UNION ALL SELECT 'qualifying', a::VARCHAR, 'q' || s, CASE WHEN r = 'A' THEN NULL ELSE '14:00:0' || n END, NULL, NULL FROM f
UNION ALL SELECT 'sprint', a::VARCHAR, 'p' || s, CASE WHEN n > 3 THEN NULL ELSE '12:00:0' || n END, NULL, NULL FROM f
UNION ALL SELECT 'freepractice', a::VARCHAR, 'q' || s, '10:00:0' || n, CASE WHEN r = 'N' THEN NULL ELSE r END, 'p' || s FROM f
UNION ALL SELECT 'pitstops', stop::VARCHAR, race::VARCHAR, driver::VARCHAR, dur::VARCHAR, o::VARCHAR FROM p
""")
def load_races(spark, d):
    """Loads of race, qualifying, sprint, practice and pit stops: the first CSV row of each key (A2, Q18), null
    markers, dates and times of day (F2, F3), numbers that are none become 0 (F5)."""
    num, sup, flag = F.col("l_linenumber"), F.col("l_suppkey"), F.col("l_returnflag")
    no = F.lit("\\N")
    time = lambda hour: F.concat(F.lit(hour), _text(num))
    common = {"fp1_date": F.concat(F.lit("q"), _text(sup)), "fp1_time": time("10:00:0"),
              "fp2_date": F.when(flag == "N", no).otherwise(flag), "fp2_time": no, "fp3_date": F.concat(F.lit("p"), _text(sup)), "fp3_time": no,
              "quali_date": F.concat(F.lit("q"), _text(sup)), "quali_time": F.when(flag == "A", no).otherwise(time("14:00:0")),
              "sprint_date": F.concat(F.lit("p"), _text(sup)), "sprint_time": F.when(num > 3, no).otherwise(time("12:00:0"))}
    stage = _staged(spark, d, "load_races", {
        "raceId": F.col("l_partkey"), "circuitId": sup, "year": num + 2000, "round": F.lit("1"), "laps": F.col("l_orderkey"),
        "fastestLap": no, "fastestLapTime": no, "fastestLapSpeed": F.lit("x"), "name_x": F.lit("n"),
        "date": F.when(flag == "R", no).otherwise(F.concat(F.lit("2000-01-0"), _text(num))), "time_races": time("15:00:0"),
        "url_x": F.lit("u"), **common})
    pits = _staged(spark, d, "load_pitstops", {
        "stop": num, "raceId": sup % 40, "driverId": F.col("l_partkey") % 100, "lap_pitstops": F.col("l_orderkey"),
        "time_pitstops": no, "duration": F.when(flag == "R", F.lit("R")).otherwise(_text("l_quantity")),
        "milliseconds_pitstops": F.lit("1")})
    race = warehouse.race(stage).where("fastestLap IS NULL AND fastestLapTime IS NULL AND fastestLapSpeed = 0 AND time_races LIKE '15:00:0_'")
    null = F.lit(None)
    return _union([
        _row(race, "race", a="race_id", b="circuitId", c="year", d="date", e="laps"),
        _row(warehouse.qualifying(stage), "qualifying", a="race_id", b="quali_date", c="quali_time", d=null, e=null),
        _row(warehouse.sprint(stage), "sprint", a="race_id", b="sprint_date", c="sprint_time", d=null, e=null),
        _row(warehouse.freepractice(stage).where("fp2_time IS NULL AND fp3_time IS NULL"), "freepractice",
             a="race_id", b="fp1_date", c="fp1_time", d="fp2_date", e="fp3_date"),
        _row(warehouse.pitstops(pits), "pitstops", a="stop", b="race_id", c="driverId", d=F.col("duration").cast("bigint"), e="lap_pitstops")])


# ------------------------------------------------------------------------ producers
def _land(paged: DataFrame, root: str, kind: str, by: list[str], envelope: Column) -> None:
    """One page per folder: {"MRData": envelope}."""
    docs = paged.select(*by, F.to_json(F.struct(envelope.alias("MRData"))).alias("value"))
    pages.land(docs, f"{root}/{kind}", by, mode="append")


def _listed(table: str, field: str, records: Column, total: Column | None = None) -> Column:
    """MRData of a list page: <table>.<field> = records."""
    parts = [F.struct(records.alias(field)).alias(table)]
    return F.struct(*([total.cast("string").alias("total")] if total is not None else []), *parts)


def _more(spark: SparkSession, offsets: list[tuple[int, int]]) -> DataFrame:
    """Pages after the last: (round, offset)."""
    return spark.createDataFrame(offsets, "round int, offset long")


def _said(messages: DataFrame, *fields: str) -> DataFrame:
    """(topic, key, said): what a message's value says of ``fields``."""
    text = F.concat_ws("/", *[F.get_json_object("value", f"$.{f}") for f in fields])
    return messages.select("topic", "key", text.alias("said"))


@query("produce_lists", """
SELECT 'status_topic' AS topic, n_nationkey::VARCHAR AS key, n_name AS said FROM nation
UNION ALL SELECT 'driver_topic', 'c' || c_custkey, c_mktsegment FROM customer
UNION ALL SELECT 'constructor_topic', 's' || s_suppkey, s_name FROM supplier
UNION ALL SELECT 'race_topic', (1990 + p_size) || '_' || p_partkey, p_brand FROM part WHERE 1990 + p_size <= 2023
UNION ALL SELECT 'race_topic', '2024_' || n_nationkey, n_name FROM nation
UNION ALL SELECT 'driverstandings_topic', 'c' || c_custkey || '_2024_3', c_custkey::VARCHAR || '/' || c_mktsegment FROM customer
UNION ALL SELECT 'constandings_topic', 's' || s_suppkey || '_2024_3', s_suppkey::VARCHAR || '/' || s_name FROM supplier
""")
def produce_lists(spark, d):
    """Producers of status, driver, constructor, race and both standings from landed pages: paging ends at the
    first empty page or at the total; seasons after 2023 come from the current document only (P6, O1)."""
    root = work_path(spark, "produce_lists")
    nat, cust, sup, part = (tbl(spark, d, t) for t in ("nation", "customer", "supplier", "part"))
    many = lambda df, order: pages.build_pages(df, [order], PAGE, records="recs")
    each = lambda fields: F.transform("recs", lambda r: F.struct(*[c.alias(n) for n, c in fields(r).items()]))
    gone = lambda kind, table, field, last: _land(  # noqa: E731  an empty page, then one that is never asked for
        spark.range(2).select(((last + F.col("id")) * PAGE).alias("offset"), "id"), root, kind, ["offset"],
        _listed(table, field, F.when(F.col("id") == 1, F.array(F.struct(F.lit("late").alias("driverId"), F.lit("2000").alias("season"),
                                                                     F.lit("0").alias("round"))))
                .otherwise(F.array().cast("array<struct<driverId: string, season: string, round: string>>"))))
    last = lambda df: -(-df.count() // PAGE)

    _land(many(nat, "n_nationkey"), root, "status", ["offset"], _listed(
        "StatusTable", "Status", each(lambda r: {"statusId": _text(r["n_nationkey"]), "status": r["n_name"]})))
    _land(many(cust, "c_custkey"), root, "driver", ["offset"], _listed("DriverTable", "Drivers", each(
        lambda r: {"driverId": F.concat(F.lit("c"), _text(r["c_custkey"])), "familyName": r["c_mktsegment"]})))
    gone("driver", "DriverTable", "Drivers", last(cust))
    total = F.lit(sup.count())
    supplied = many(sup, "s_suppkey")
    beyond = supplied.where("offset = 0").withColumn("offset", F.ceil(total / PAGE) * PAGE)      # a page after the total
    _land(supplied.unionByName(beyond), root, "constructor", ["offset"], _listed("ConstructorTable", "Constructors", each(
        lambda r: {"constructorId": F.concat(F.lit("s"), _text(r["s_suppkey"])), "name": r["s_name"]}), total))
    _land(many(part, "p_partkey"), root, "race", ["offset"], _listed("RaceTable", "Races", each(
        lambda r: {"season": _text(r["p_size"] + 1990), "round": _text(r["p_partkey"]), "raceName": r["p_brand"]})))
    gone("race", "RaceTable", "Races", last(part))
    _land(many(nat, "n_nationkey"), root, "race_current", ["offset"], _listed("RaceTable", "Races", each(
        lambda r: {"season": F.lit("2024"), "round": _text(r["n_nationkey"]), "raceName": r["n_name"]})))

    def standings(kind, df, order, field, entry):
        recs = F.transform("recs", lambda r: F.struct(*[c.alias(n) for n, c in entry(r).items()]))
        lists = F.array(F.struct(F.lit("2024").alias("season"), F.lit("3").alias("round"), recs.alias(field)))
        _land(many(df, order), root, kind, ["offset"], F.struct(F.struct(lists.alias("StandingsLists")).alias("StandingsTable")))

    standings("driverstandings", cust, "c_custkey", "DriverStandings", lambda r: {
        "position": _text(r["c_custkey"]), "points": r["c_mktsegment"],
        "Driver": F.struct(F.concat(F.lit("c"), _text(r["c_custkey"])).alias("driverId"))})
    standings("constandings", sup, "s_suppkey", "ConstructorStandings", lambda r: {
        "position": _text(r["s_suppkey"]), "points": r["s_name"],
        "Constructor": F.struct(F.concat(F.lit("s"), _text(r["s_suppkey"])).alias("constructorId"))})
    return _union([
        _said(producers.generic(spark, root, "status"), "status"), _said(producers.generic(spark, root, "driver"), "familyName"),
        _said(producers.generic(spark, root, "constructor"), "name"), _said(producers.races(spark, root, 2023), "raceName"),
        _said(producers.standings(spark, root, "driverstandings"), "position", "points"),
        _said(producers.standings(spark, root, "constandings"), "position", "points")])


@query("produce_rounds", """
WITH c AS (SELECT *, c_nationkey + 1 AS round, c_custkey % 13 AS stop FROM customer)
SELECT 'laptimes_topic' AS topic, 'c' || c_custkey || '_' || round || '_' || (c_custkey // 25 % 20 + 1) AS key,
       c_mktsegment AS said FROM c WHERE round % 2 = 1 OR c_custkey // 25 % 20 + 1 < 15
UNION ALL SELECT 'pitstops_topic', stop || '_' || round || '_c' || c_custkey, c_mktsegment FROM c WHERE stop <= 10
UNION ALL SELECT 'rejected', 'c' || c_custkey, c_mktsegment FROM c WHERE stop > 10
UNION ALL SELECT 'results_topic', 'c' || c_custkey || '_' || round, c_mktsegment || '/' || c_custkey FROM c WHERE round < 20
""")
def produce_rounds(spark, d):
    """Producers of laps, pit stops and results from landed pages of rounds: laps end at a round's first empty
    page, stops above the cap are rejected (P8), results end for good at the first round without any (Q20)."""
    root = work_path(spark, "produce_rounds")
    cust = tbl(spark, d, "customer").withColumn("round", F.col("c_nationkey") + 1)
    ref = lambda r: F.concat(F.lit("c"), _text(r["c_custkey"]))

    def race(rnd, **lists):
        return F.struct(F.struct(F.array(F.struct(F.lit("2024").alias("season"), _text(rnd).alias("round"),
                                                  *[c.alias(n) for n, c in lists.items()])).alias("Races")).alias("RaceTable"))

    laps = cust.withColumn("lap", (F.floor(F.col("c_custkey") / 25) % 20 + 1).cast("int"))
    timing = F.struct(ref(laps).alias("driverId"), F.lit("1").alias("position"), F.col("c_mktsegment").alias("time"))
    served = laps.groupBy("round", "lap").agg(F.collect_list(timing).alias("Timings"))       # the drivers of one lap
    told = F.when((F.col("round") % 2 == 1) | (F.col("lap") != 15), F.array(F.struct(_text("lap").alias("number"), F.col("Timings"))))
    none = F.array().cast("array<struct<number: string, Timings: array<struct<driverId: string, position: string, time: string>>>>")
    _land(served, root, "laptimes", ["round", "lap"], race(F.col("round"), Laps=F.coalesce(told, none)))
    paged = pages.build_pages(cust, ["c_custkey"], PAGE, group=["round"], records="recs")
    recs = lambda fields: F.transform("recs", lambda r: F.struct(*[c.alias(n) for n, c in fields(r).items()]))
    _land(paged, root, "pitstops", ["round", "offset"], race(F.col("round"), PitStops=recs(lambda r: {
        "driverId": ref(r), "stop": _text(r["c_custkey"] % 13), "lap": F.lit("1"), "duration": r["c_mktsegment"]})))
    result = recs(lambda r: {"Driver": F.struct(ref(r).alias("driverId")), "status": r["c_mktsegment"], "number": _text(r["c_custkey"])})
    empty = F.filter(result, lambda r: F.lit(False))
    _land(paged, root, "results", ["round", "offset"], race(F.col("round"), Results=F.when(F.col("round") != 20, result).otherwise(empty)))
    pits, rejected = producers.pitstops(spark, root)
    return _union([
        _said(producers.laptimes(spark, root), "time"), _said(pits, "duration"),
        rejected.select(F.lit("rejected").alias("topic"), F.col("ps.driverId").alias("key"), F.col("ps.duration").alias("said")),
        _said(producers.results(spark, root), "status", "number")])
