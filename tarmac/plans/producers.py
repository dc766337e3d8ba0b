"""Landed API pages -> keyed topic messages (the producer side).

The HTTP client of the source system is replaced by pages landed as files:

    <root>/<kind>/offset=<n>/page.json                  status, driver, constructor, race, standings
    <root>/<kind>/round=<r>/offset=<n>/page.json        pitstops, results (offset paging within a round)
    <root>/laptimes/round=<r>/lap=<n>/page.json         one lap per page

Partition discovery gives the path numbers as columns; the stop rules are
take-while (W4): lap and pit-stop paging stop at the first empty page of a
round, results stop at the first round without data for all later rounds
(Q20).  Records are flattened with ``explode`` (S5, F22), keyed with
``a_b_c`` keys (F15) and encoded as JSON (F21, K3).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clean import compose_key
from ..operators.filters import classify, split_kept
from ..sources import pages
from ..sources.tables import if_present

_TIMING = "STRUCT<driverId: STRING, position: STRING, time: STRING>"
_PIT = "STRUCT<driverId: STRING, lap: STRING, stop: STRING, time: STRING, duration: STRING>"
_FASTEST = ("STRUCT<rank: STRING, lap: STRING, Time: STRUCT<time: STRING>, "
            "AverageSpeed: STRUCT<units: STRING, speed: STRING>>")
_RESULT = (f"STRUCT<number: STRING, position: STRING, positionText: STRING, points: STRING, "
           f"Driver: STRUCT<driverId: STRING>, Constructor: STRUCT<constructorId: STRING>, grid: STRING, "
           f"laps: STRING, status: STRING, Time: STRUCT<millis: STRING, time: STRING>, FastestLap: {_FASTEST}>")
_SESSION = "STRUCT<date: STRING, time: STRING>"
_RACE = ("STRUCT<season: STRING, round: STRING, url: STRING, raceName: STRING, date: STRING, time: STRING, "
         "Circuit: STRUCT<circuitId: STRING, url: STRING, circuitName: STRING, "
         "Location: STRUCT<lat: STRING, long: STRING, locality: STRING, country: STRING>>, "
         f"FirstPractice: {_SESSION}, SecondPractice: {_SESSION}, ThirdPractice: {_SESSION}, "
         f"Qualifying: {_SESSION}, Sprint: {_SESSION}, "
         f"Laps: ARRAY<STRUCT<number: STRING, Timings: ARRAY<{_TIMING}>>>, PitStops: ARRAY<{_PIT}>, "
         f"Results: ARRAY<{_RESULT}>>")
_STANDINGS = ("STRUCT<season: STRING, round: STRING, DriverStandings: ARRAY<STRUCT<position: STRING, "
              "positionText: STRING, points: STRING, wins: STRING, Driver: STRUCT<driverId: STRING, "
              "code: STRING, url: STRING>, Constructors: ARRAY<STRUCT<constructorId: STRING, name: STRING>>>>, "
              "ConstructorStandings: ARRAY<STRUCT<position: STRING, positionText: STRING, points: STRING, "
              "wins: STRING, Constructor: STRUCT<constructorId: STRING, name: STRING>>>>")
PAGE_DDL = (
    "MRData STRUCT<total: STRING, limit: STRING, offset: STRING, "
    "StatusTable: STRUCT<Status: ARRAY<STRUCT<statusId: STRING, status: STRING>>>, "
    "DriverTable: STRUCT<Drivers: ARRAY<STRUCT<driverId: STRING, permanentNumber: STRING, code: STRING, "
    "url: STRING, givenName: STRING, familyName: STRING, dateOfBirth: STRING, nationality: STRING>>>, "
    "ConstructorTable: STRUCT<Constructors: ARRAY<STRUCT<constructorId: STRING, url: STRING, name: STRING, "
    "nationality: STRING>>>, "
    f"RaceTable: STRUCT<Races: ARRAY<{_RACE}>>, "
    f"StandingsTable: STRUCT<season: STRING, StandingsLists: ARRAY<{_STANDINGS}>>>")

# Source conventions (fixed values): the largest pit stop number, and the
# generic list paths and key fields per kind.
MAX_PIT_STOP = 10
GENERIC = {
    "status": ("MRData.StatusTable.Status", "statusId"),
    "driver": ("MRData.DriverTable.Drivers", "driverId"),
    "constructor": ("MRData.ConstructorTable.Constructors", "constructorId"),
}


def read_kind(spark: SparkSession, root: str, kind: str, paths: str) -> DataFrame:
    """The landed pages of one kind with their path columns."""
    return pages.read_landed_pages(spark, f"{root.rstrip('/')}/{kind}", f"{PAGE_DDL}, {paths}")


def page_rejects(spark: SparkSession, root: str, kind: str, paths: str) -> DataFrame:
    """The malformed pages of a kind, with their path columns and text."""
    df = pages.corrupt_pages(read_kind(spark, root, kind, paths))
    names = [p.split()[0] for p in paths.split(",")]
    return df.select(F.lit(kind).alias("kind"), *names, F.col(pages.CORRUPT).alias("record"))


def _messages(df: DataFrame, key: Column, value: Column, topic: str, seq: list[Column]) -> DataFrame:
    """``seq`` is the production order: path numbers, then places in the page."""
    return df.select(key.alias("key"), F.to_json(value).alias("value"), F.lit(topic).alias("topic"),
                     F.struct(*[c.cast("bigint").alias(f"s{i}") for i, c in enumerate(seq)]).alias("seq"))


def _total() -> Column:
    return F.col("MRData.total").try_cast("bigint")


def _until_empty(df: DataFrame, path: str) -> DataFrame:
    return pages.until_empty(df, F.size(pages.records_at(path)) > 0, ["offset"], total=_total())


def generic(spark: SparkSession, root: str, kind: str) -> DataFrame:
    """status / driver / constructor: records of the pages before the first
    empty page, keyed by their id field (``unknown`` when it is missing, F16)."""
    path, key_field = GENERIC[kind]
    df = _until_empty(read_kind(spark, root, kind, "offset INT"), path)
    recs = df.select("offset", F.posexplode(pages.records_at(path)).alias("at", "rec"))
    return _messages(recs, F.coalesce(F.col(f"rec.{key_field}"), F.lit("unknown")), F.col("rec"), f"{kind}_topic",
                     [F.col("offset"), F.col("at")])


def laptimes(spark: SparkSession, root: str) -> DataFrame:
    """Per round, laps 1, 2, ... until the first lap without data (W4 per round)."""
    df = read_kind(spark, root, "laptimes", "round INT, lap INT")
    has = F.size(F.coalesce(F.get(F.col("MRData.RaceTable.Races"), 0).getField("Laps"), F.array())) > 0
    kept = pages.until_empty(df, has, ["lap"], group=["round"])
    lap = F.get(F.get(F.col("MRData.RaceTable.Races"), 0).getField("Laps"), 0)
    t = kept.select("round", F.col("lap").alias("page"), lap.getField("number").alias("number"),
                    F.posexplode(lap.getField("Timings")).alias("at", "tm"))
    value = F.struct(F.col("round").alias("round"), F.col("number").cast("int").alias("lap"),
                     F.col("tm.driverId").alias("driverId"), F.col("tm.position").cast("int").alias("position"),
                     F.col("tm.time").alias("time"))
    return _messages(t, compose_key(F.col("tm.driverId"), "round", "number"), value, "laptimes_topic",
                     [F.col("round"), F.col("page"), F.col("at")])


def races(spark: SparkSession, root: str, history_until: int,
          current_kind: str | None = "race_current") -> DataFrame:
    """History pages (stop at the first empty page; seasons <= ``history_until``,
    P6) and the current season's document (all its races), unioned (O1);
    keyed season_round.  A current document that was not landed is no error."""
    path = "MRData.RaceTable.Races"
    races_of = lambda df: df.select("offset", F.posexplode(pages.records_at(path)).alias("at", "rec"))
    hist = races_of(_until_empty(read_kind(spark, root, "race", "offset INT"), path))
    allr = hist.where(F.col("rec.season").try_cast("int") <= history_until).withColumn("part", F.lit(0))
    current = if_present(lambda: read_kind(spark, root, current_kind, "offset INT")) if current_kind else None
    if current is not None:
        allr = allr.unionByName(races_of(current).withColumn("part", F.lit(1)))
    slim = F.col("rec").dropFields("Laps", "PitStops", "Results")
    return _messages(allr, compose_key(F.col("rec.season"), F.col("rec.round")), slim, "race_topic",
                     [F.col("part"), F.col("offset"), F.col("at")])


def standings(spark: SparkSession, root: str, kind: str) -> DataFrame:
    """driverstandings / constandings: records of the first standings list."""
    df = read_kind(spark, root, kind, "offset INT")
    lst = F.get(F.col("MRData.StandingsTable.StandingsLists"), 0)
    field, ref = (("DriverStandings", "Driver.driverId") if kind == "driverstandings"
                  else ("ConstructorStandings", "Constructor.constructorId"))
    s = df.select("offset", lst.getField("season").alias("season"), lst.getField("round").alias("round"),
                  F.posexplode(F.coalesce(lst.getField(field), F.array())).alias("at", "st"))
    value = F.struct(F.col("season").cast("int").alias("season"), F.col("round").cast("int").alias("round"),
                     *[F.col(f"st.{c}") for c in ("position", "positionText", "points", "wins")],
                     *([F.col("st.Driver"), F.col("st.Constructors")] if kind == "driverstandings"
                       else [F.col("st.Constructor")]))
    return _messages(s, compose_key(F.col(f"st.{ref}"), "season", "round"), value, f"{kind}_topic",
                     [F.col("offset"), F.col("at")])


def pitstops(spark: SparkSession, root: str, max_stop: int = MAX_PIT_STOP) -> tuple[DataFrame, DataFrame]:
    """Per round, pages until the first empty one; stops above the cap are
    rejected and counted (P8).  Returns ``(messages, rejects)``."""
    df = read_kind(spark, root, "pitstops", "round INT, offset INT")
    race = F.get(F.col("MRData.RaceTable.Races"), 0)
    has = F.size(F.coalesce(race.getField("PitStops"), F.array())) > 0
    kept = pages.until_empty(df, has, ["offset"], group=["round"], total=_total())
    p = kept.select("offset", race.getField("season").alias("season"), race.getField("round").alias("rnd"),
                    F.posexplode(race.getField("PitStops")).alias("at", "ps"))
    p = classify(p, [("stop above cap", F.col("ps.stop").try_cast("int") > max_stop)])
    ok, rejected = split_kept(p)
    value = F.struct(F.col("season").cast("int").alias("season"), F.col("rnd").cast("int").alias("round"),
                     F.col("ps.stop").cast("int").alias("stop"), F.col("ps.driverId").alias("driverId"),
                     F.col("ps.lap").cast("int").alias("lap"), F.col("ps.time").alias("time"),
                     F.col("ps.duration").alias("duration"))
    return _messages(ok, compose_key(F.col("ps.stop"), "rnd", F.col("ps.driverId")), value, "pitstops_topic",
                     [F.col("rnd").try_cast("bigint"), F.col("offset"), F.col("at")]), rejected


def results(spark: SparkSession, root: str) -> DataFrame:
    """Rounds 1, 2, ... until the first round without results; later rounds
    are dropped even if they have data (Q20).  A round's pages end at its first
    empty page or at its total."""
    df = read_kind(spark, root, "results", "round INT, offset INT")
    race = F.get(F.col("MRData.RaceTable.Races"), 0)
    has = F.size(F.coalesce(race.getField("Results"), F.array())) > 0
    kept = pages.until_empty_group(df, has, "round")
    kept = pages.until_empty(kept, has, ["offset"], group=["round"], total=_total())
    r = kept.select("round", "offset", race.getField("season").alias("season"), race.getField("round").alias("rnd"),
                    F.posexplode(race.getField("Results")).alias("at", "res"))
    value = F.struct(
        F.col("season").cast("int").alias("season"), F.col("rnd").cast("int").alias("round"),
        *[F.col(f"res.{c}") for c in ("number", "position", "positionText", "points")],
        F.col("res.Driver.driverId").alias("driverId"), F.col("res.Constructor.constructorId").alias("constructorId"),
        F.col("res.grid").alias("grid"), F.col("res.laps").alias("laps"), F.col("res.status").alias("status"),
        F.col("res.Time.time").alias("time"), F.col("res.Time.millis").alias("milliseconds"),
        F.col("res.FastestLap").alias("FastestLap"))                                 # Q1: one field name
    return _messages(r, compose_key(F.col("res.Driver.driverId"), "rnd"), value, "results_topic",
                     [F.col("round"), F.col("offset"), F.col("at")])
