"""Declared schemas of the motor-racing inputs (see FIXTURES.md).

The wide CSV is read all-text and coerced per entity (``plans.warehouse``);
topic values are parsed with ``from_json`` against these struct types.
"""

from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType

# The column names of the wide CSV extract, grouped by entity.
CSV_COLUMNS = [
    "statusId", "status",
    "constructorStandingsId", "points_constructorstandings", "position_constructorstandings",
    "positionText_constructorstandings", "wins_constructorstandings",
    "driverStandingsId", "points_driverstandings", "position_driverstandings", "positionText_driverstandings",
    "driverId", "driverRef", "number_drivers", "code", "forename", "surname", "dob", "nationality", "url",
    "constructorId", "constructorRef", "name", "nationality_constructors", "url_constructors",
    "stop", "raceId", "lap_pitstops", "time_pitstops", "duration", "milliseconds_pitstops",
    "lap", "position_laptimes", "time_laptimes", "milliseconds_laptimes",
    "quali_date", "quali_time", "fp1_date", "fp1_time", "fp2_date", "fp2_time", "fp3_date", "fp3_time",
    "sprint_date", "sprint_time",
    "circuitId", "circuitRef", "name_y", "location", "country", "lat", "lng", "alt", "url_y",
    "year", "round", "laps", "fastestLap", "fastestLapTime", "fastestLapSpeed", "name_x", "date",
    "time_races", "url_x",
    "resultId", "grid", "position", "rank", "time", "milliseconds", "points", "number", "positionOrder",
    "positionText", "wins",
]

CSV_TEXT_SCHEMA = StructType([StructField(c, StringType(), True) for c in CSV_COLUMNS])

# Topic value schemas (DDL).  Numbers arrive as JSON text or numbers; they
# are read as text and cast with try_cast so a bad value is a reject, not a
# failed batch.
STATUS_VALUE = "statusId STRING, status STRING"
DRIVER_VALUE = ("driverId STRING, permanentNumber STRING, code STRING, url STRING, givenName STRING, "
                "familyName STRING, dateOfBirth STRING, nationality STRING")
CONSTRUCTOR_VALUE = "constructorId STRING, url STRING, name STRING, nationality STRING"
_SESSION = "STRUCT<date: STRING, time: STRING>"
RACE_VALUE = (
    "season STRING, round STRING, url STRING, raceName STRING, date STRING, time STRING, "
    "Circuit STRUCT<circuitId: STRING, url: STRING, circuitName: STRING, "
    "Location: STRUCT<lat: STRING, long: STRING, locality: STRING, country: STRING>>, "
    f"FirstPractice {_SESSION}, SecondPractice {_SESSION}, ThirdPractice {_SESSION}, "
    f"Qualifying {_SESSION}, Sprint {_SESSION}")
LAPTIME_VALUE = "season STRING, round STRING, lap STRING, driverId STRING, position STRING, time STRING"
PITSTOP_VALUE = ("season STRING, round STRING, stop STRING, lap STRING, driverId STRING, time STRING, "
                 "duration STRING")
_FASTEST = ("STRUCT<rank: STRING, lap: STRING, Time: STRUCT<time: STRING>, "
            "AverageSpeed: STRUCT<units: STRING, speed: STRING>>")
RESULT_VALUE = (
    "season STRING, round STRING, number STRING, position STRING, positionText STRING, points STRING, "
    "driverId STRING, constructorId STRING, grid STRING, laps STRING, status STRING, time STRING, "
    f"milliseconds STRING, FastestLap {_FASTEST}")
_DRIVER_STANDING = ("position STRING, positionText STRING, points STRING, wins STRING, "
                    "Driver STRUCT<driverId: STRING>, Constructors ARRAY<STRUCT<constructorId: STRING>>")
_CON_STANDING = ("position STRING, positionText STRING, points STRING, wins STRING, "
                 "Constructor STRUCT<constructorId: STRING>")
DRIVER_STANDINGS_VALUE = (
    f"season STRING, round STRING, {_DRIVER_STANDING}, "
    "StandingsTable STRUCT<season: STRING, round: STRING, StandingsLists: ARRAY<STRUCT<season: STRING, "
    f"round: STRING, DriverStandings: ARRAY<STRUCT<{_DRIVER_STANDING}>>>>>")
CON_STANDINGS_VALUE = (
    f"season STRING, round STRING, {_CON_STANDING}, "
    "StandingsTable STRUCT<season: STRING, round: STRING, StandingsLists: ARRAY<STRUCT<season: STRING, "
    f"round: STRING, ConstructorStandings: ARRAY<STRUCT<{_CON_STANDING}>>>>>")

# Topic names of the source system (fixed values).
TOPICS = ["status_topic", "driver_topic", "race_topic", "constructor_topic", "laptimes_topic",
          "driverstandings_topic", "constandings_topic", "pitstops_topic", "results_topic"]

# Declared schemas of the driver's tables (TESTDATA.md / FIXTURES.md §5).
# Reading with a declared schema skips footer-based inference on every read.
DRIVER_TABLES = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": ("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
               "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"),
    "lineitem": ("l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                 "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, "
                 "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ"),
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}
