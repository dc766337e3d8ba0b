"""The snowflake-schema warehouse and its batch load from the wide CSV.

Batch flow (one lazy plan per entity, all reading one staged Parquet copy of
the CSV, so the CSV is parsed once and each entity scans only its columns):

    CSV --S1--> stage Parquet (text + arrival order)
        --P1/A1--> distinct projection (first arrival kept)
        --F1/F2/F4--> coercion / sentinel cleaning
        --A2/W1--> keep-first per natural key (file order)
        --F5/P3--> fills and renames --K2--> versioned table (overwrite per table, Q15)

"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clean as C
from ..operators.dedup import keep_first
from ..operators.filters import tolerant_select
from ..schemas import CSV_TEXT_SCHEMA
from ..sources.csv import csv_rejects, read_wide_csv, split_table, with_arrival_number
from ..sources.tables import PartitionedTable, VersionedTable, write_stage

ARR = "_arrival"

# Table names (lower case; the source system's names fold to these).
TABLES = ["formulaone", "race", "circuit", "driver", "constructor", "status", "driverstandings",
          "constandings", "laptimes", "pitstops", "qualifying", "sprint", "freepractice"]
#: Tables of the engine itself: final rejects, rejects that wait for a key, the largest ids whose keys
#: were offered to them, each race's fastest lap, ids of standings, counts per batch.
OWN_TABLES = ["rejects", "waiting", "seen", "race_best", "standing_ids", "batch_metrics"]

# Which standing got which id, by the position of its message and its place in it.
STANDING_IDS = "kind STRING, partition INT, offset BIGINT, stream STRING, _i INT, id BIGINT"
MESSAGE = "topic STRING, key STRING, value STRING, reason STRING, partition INT, offset BIGINT, stream STRING"
RACE_BEST = "race_id BIGINT, lap BIGINT, driverId BIGINT, time_laptimes STRING, milliseconds_laptimes BIGINT"
SEEN = "kind STRING, id BIGINT"
SCHEMAS = {"standing_ids": STANDING_IDS, "rejects": f"{MESSAGE}, batch BIGINT",
           "waiting": f"{MESSAGE}, ref STRING, kind STRING, bucket INT", "race_best": RACE_BEST, "seen": SEEN}
#: Folders per kind that waiting messages are dealt to by the key they miss.
WAIT_BUCKETS = 16

# Keys that a message may wait for: table, id and the key as text (SQL), by kind.
REFS = {"driver": ("driver", "driverId", "driverRef"), "constructor": ("constructor", "constructorId", "constructorRef"),
        "race": ("race", "race_id", "concat_ws('_', cast(year AS BIGINT), cast(round AS BIGINT))")}


def wait_bucket(ref: Column) -> Column:
    return F.pmod(F.hash(ref), F.lit(WAIT_BUCKETS)).cast("int")


class Warehouse:
    """The 13 tables (and the engine's own) under ``root``.

    Every table is a ``VersionedTable`` (updates write a new version), except
    the facts: ``formulaone``, ``laptimes`` and ``pitstops`` are
    ``PartitionedTable``s by race; a batch reads and rewrites only the races
    it touches.  ``fact_partition=None`` keeps them versioned too, for facts
    small enough to read and rewrite per batch."""

    def __init__(self, spark: SparkSession, root: str, fact_partition: str | None = "raceId"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.tables = {t: VersionedTable(spark, f"{self.root}/{t}") for t in TABLES + OWN_TABLES}
        if fact_partition:
            self._partition("formulaone", [fact_partition])
            for name in ("laptimes", "pitstops"):
                self._partition(name, ["race_id"])
        self._partition("rejects", ["stream", "batch"])
        self._partition("waiting", ["kind", "bucket"])

    def _partition(self, name: str, by: list[str]) -> None:
        self.tables[name] = PartitionedTable(self.spark, f"{self.root}/{name}", by)

    def partitioned(self, name: str) -> bool:
        return self.partitioned_table(self.tables[name])

    @staticmethod
    def partitioned_table(table) -> bool:
        return isinstance(table, PartitionedTable)

    def __getitem__(self, name: str) -> VersionedTable:
        return self.tables[name]

    def read(self, name: str) -> DataFrame:
        """A table's rows; ``rejects`` are the final ones and those that still wait."""
        if name == "rejects":
            return self.stored("rejects").select(*_names(MESSAGE)).unionByName(self.open_rejects())
        return self.stored(name)

    def stored(self, name: str) -> DataFrame:
        if name in SCHEMAS and not self.tables[name].exists():
            return self.spark.createDataFrame([], SCHEMAS[name])
        return self.tables[name].read()

    def open_rejects(self) -> DataFrame:
        """Messages whose missing key is in its dimension by now are offered again and gone from here."""
        rows = self.stored("waiting").distinct()
        for kind, (table, _, ref) in REFS.items():
            have = self.stored(table).select(F.lit(kind).alias("kind"), F.expr(ref).alias("ref")).distinct()
            rows = rows.join(have, ["kind", "ref"], "left_anti")
        return rows.select(*_names(MESSAGE)).distinct()

    def touched(self, name: str, keys: DataFrame) -> DataFrame:
        """The rows of the partitions that ``keys`` name; the whole table if it is not partitioned."""
        return self.tables[name].read_touched(keys) if self.partitioned(name) else self.read(name)

    def overwrite(self, name: str, df: DataFrame) -> None:
        self.tables[name].replace(df)

    def append(self, name: str, df: DataFrame) -> None:
        self.tables[name].append(df)


def _names(ddl: str) -> list[str]:
    return [c.split()[0] for c in ddl.split(", ")]


# --------------------------------------------------------------------- extract
def stage_csv(spark: SparkSession, csv_path: str, stage_path: str) -> DataFrame:
    """S1 + K1: parse the CSV once into a Parquet stage with file order kept."""
    splits = split_table(spark, csv_path)
    write_stage(read_wide_csv(spark, csv_path, CSV_TEXT_SCHEMA, arrival_col=ARR, splits=splits), stage_path)
    write_stage(csv_rejects(spark, csv_path, splits=splits), f"{stage_path}_rejects")
    return with_arrival_number(spark.read.parquet(stage_path), ARR)


def _distinct(df: DataFrame, cols: list[str]) -> DataFrame:
    """A1 on a projection, keeping each distinct row's first file position."""
    return df.select(*cols, ARR).groupBy(*cols).agg(F.min(ARR).alias(ARR))


def _rows(df: DataFrame, cols: list[str]) -> DataFrame:
    """A projection whose rows a keep-first takes next.  The first row of a key's distinct rows (A1) is the first
    of all its rows, as arrival numbers are unique, so the wide rows are not grouped and shuffled before it."""
    return df.select(*cols, ARR)


def _num(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({c: C.to_number(c) for c in cols})


def _ids(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).try_cast("bigint") for c in cols})


def _sentinels(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({c: C.null_sentinel(c) for c in cols})


# ------------------------------------------------------------------- entities
def status(stage: DataFrame) -> DataFrame:
    d = _distinct(stage, ["statusId", "status"])                                  # A1, Q16
    return d.select(F.col("statusId").try_cast("bigint").alias("statusid"),      # F10 -> try_cast (Q11)
                    F.col("status").alias("status_name"))


def constandings(stage: DataFrame) -> DataFrame:
    d = _distinct(stage, ["constructorStandingsId", "points_constructorstandings",
                          "position_constructorstandings", "positionText_constructorstandings",
                          "wins_constructorstandings"])
    return d.select(F.col("constructorStandingsId").try_cast("bigint").alias("constandingsId"),
                    C.to_number("points_constructorstandings").alias("points_constructorstandings"),
                    F.col("position_constructorstandings").try_cast("bigint").alias("position_constructorstandings"),
                    C.null_sentinel("positionText_constructorstandings").alias("positionText_constructorstandings"),
                    F.col("wins_constructorstandings").try_cast("bigint").alias("wins_constructorstandings"))


def driverstandings(stage: DataFrame) -> DataFrame:
    d = _distinct(stage, ["driverStandingsId", "points_driverstandings", "position_driverstandings",
                          "positionText_driverstandings"])
    return d.select(F.col("driverStandingsId").try_cast("bigint").alias("driverStandingsId"),
                    C.to_number("points_driverstandings").alias("points_driverstandings"),
                    F.col("position_driverstandings").try_cast("bigint").alias("position_driverstandings"),
                    C.null_sentinel("positionText_driverstandings").alias("positionText_driverstandings"))


def driver(stage: DataFrame) -> DataFrame:
    cols = ["driverId", "driverRef", "number_drivers", "code", "forename", "surname", "dob", "nationality", "url"]
    # The number is coerced before the distinct in the source system.
    d = _distinct(stage.withColumn("number_drivers", C.to_number("number_drivers")), cols)
    d = d.select(F.col("driverId").try_cast("bigint").alias("driverId"), "driverRef", "number_drivers",
                 C.null_sentinel("code").alias("code"), "forename", "surname",
                 F.to_date(C.to_timestamp_fmt(C.null_sentinel("dob"), "yyyy-MM-dd")).alias("dob"),
                 "nationality", "url")
    return C.fill_zero(d, ["number_drivers"])                                       # F5


def constructor(stage: DataFrame) -> DataFrame:
    d = _distinct(stage, ["constructorId", "constructorRef", "name", "nationality_constructors",
                          "url_constructors"])
    return _ids(d, ["constructorId"]).drop(ARR)


def pitstops(stage: DataFrame) -> DataFrame:
    cols = ["stop", "raceId", "driverId", "lap_pitstops", "time_pitstops", "duration", "milliseconds_pitstops"]
    d = _num(_rows(stage, cols), ["duration", "milliseconds_pitstops"])               # Q17
    d = _ids(d, ["stop", "raceId", "driverId", "lap_pitstops"])
    d = keep_first(d, ["stop", "raceId", "driverId"], [ARR])                        # A2 / W1
    d = d.select("stop", F.col("raceId").alias("race_id"), "driverId", "lap_pitstops",
                 C.null_sentinel("time_pitstops").alias("time_pitstops"), "duration", "milliseconds_pitstops")
    return C.fill_zero(d, ["lap_pitstops", "duration", "milliseconds_pitstops"])


def laptimes(stage: DataFrame) -> DataFrame:
    cols = ["raceId", "driverId", "lap", "position_laptimes", "time_laptimes", "milliseconds_laptimes"]
    d = _ids(_rows(stage, cols), ["raceId", "driverId", "lap", "position_laptimes", "milliseconds_laptimes"])
    d = keep_first(d, ["lap", "raceId", "driverId"], [ARR])
    d = d.select(F.col("raceId").alias("race_id"), "driverId", "lap", "position_laptimes",
                 C.null_sentinel("time_laptimes").alias("time_laptimes"), "milliseconds_laptimes")
    return C.fill_zero(d, ["lap", "position_laptimes", "time_laptimes", "milliseconds_laptimes"])


def _sessions(stage: DataFrame, cols: list[str]) -> DataFrame:
    d = _ids(_rows(stage, ["raceId", *cols]), ["raceId"])
    d = keep_first(d, ["raceId"], [ARR])
    return _sentinels(d, cols).select(F.col("raceId").alias("race_id"), *cols)     # F4


def qualifying(stage: DataFrame) -> DataFrame:
    return _sessions(stage, ["quali_date", "quali_time"])


def freepractice(stage: DataFrame) -> DataFrame:
    return _sessions(stage, ["fp1_date", "fp1_time", "fp2_date", "fp2_time", "fp3_date", "fp3_time"])


def sprint(stage: DataFrame) -> DataFrame:
    return _sessions(stage, ["sprint_date", "sprint_time"])


def circuit(stage: DataFrame) -> DataFrame:
    cols = ["circuitId", "circuitRef", "name_y", "location", "country", "lat", "lng", "alt", "url_y"]
    d = _num(_ids(_rows(stage, cols), ["circuitId"]), ["lat", "lng", "alt"])
    d = keep_first(d, ["circuitId"], [ARR]).select(*cols)
    return C.fill_zero(d, ["lat", "lng", "alt"])


def race(stage: DataFrame) -> DataFrame:
    cols = ["raceId", "circuitId", "year", "round", "laps", "fastestLap", "fastestLapTime", "fastestLapSpeed",
            "name_x", "date", "time_races", "url_x"]
    d = _rows(stage, cols)
    d = _ids(d, ["raceId", "circuitId", "year", "round", "laps"])
    d = _num(d, ["fastestLap", "fastestLapSpeed"])
    d = keep_first(d, ["raceId"], [ARR])                                            # Q18: first CSV row
    d = d.select(F.col("raceId").alias("race_id"), "circuitId", "year", "round", "laps", "fastestLap",
                 C.null_sentinel("fastestLapTime").alias("fastestLapTime"),     # Q10: kept as lap-time text
                 "fastestLapSpeed", "name_x",
                 F.to_date(C.to_timestamp_fmt(C.null_sentinel("date"), "yyyy-MM-dd")).alias("date"),
                 C.time_of_day(C.to_timestamp_fmt(C.null_sentinel("time_races"), "HH:mm:ss")).alias("time_races"),
                 "url_x")
    return C.fill_zero(d, ["year", "round", "laps", "fastestLapSpeed"])


# Columns of the fact in the extract.
FACT_COLUMNS = ["resultId", "raceId", "driverId", "constructorId", "statusId", "driverStandingsId",
                "constructorStandingsId", "grid", "stop", "position", "rank", "time", "milliseconds", "points",
                "number", "lap", "positionOrder", "positionText", "wins"]
FACT_IDS = ["resultId", "raceId", "driverId", "constructorId", "statusId", "driverStandingsId",
            "constructorStandingsId"]
FACT_NUMBERS = ["grid", "stop", "position", "rank", "milliseconds", "points", "number", "lap",
                "positionOrder", "positionText", "wins"]


def formulaone(stage: DataFrame) -> DataFrame:
    d = _rows(stage, [c for c in FACT_COLUMNS + ["number_drivers"] if c in stage.columns])
    d = _num(_ids(d, [c for c in FACT_IDS if c in d.columns]), [c for c in FACT_NUMBERS if c in d.columns])
    d = keep_first(d, ["resultId"], [ARR])
    d = tolerant_select(d, FACT_COLUMNS)                                             # P2
    d = d.withColumn("time", C.null_sentinel("time")) if "time" in d.columns else d
    d = C.fill_zero(d, ["position", "stop", "grid", "number", "rank", "milliseconds", "lap",
                        "positionOrder", "positionText"])                            # Q22
    return d.withColumnRenamed("constructorStandingsId", "conStandingsId")           # P3


ENTITIES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "status": status, "constandings": constandings, "driverstandings": driverstandings, "driver": driver,
    "constructor": constructor, "pitstops": pitstops, "laptimes": laptimes, "qualifying": qualifying,
    "freepractice": freepractice, "sprint": sprint, "circuit": circuit, "race": race, "formulaone": formulaone,
}


def transform_all(stage: DataFrame) -> dict[str, DataFrame]:
    """Every table's new contents from the staged extract (lazy plans)."""
    return {name: fn(stage).drop(ARR) for name, fn in ENTITIES.items()}


def load_csv(spark: SparkSession, csv_path: str, wh: Warehouse, parallel: int = 4) -> dict[str, int]:
    """The whole batch: stage the CSV once, then overwrite each table (Q15).

    The 13 table plans are independent, so up to ``parallel`` of them are
    submitted at once (Spark schedules their tasks side by side; dimension
    jobs are too small to fill a cluster on their own)."""
    stage = stage_csv(spark, csv_path, f"{wh.root}/stage/extract")
    plans = transform_all(stage)
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        futures = {name: pool.submit(wh[name].replace, df) for name, df in plans.items()}
        out = {name: f.result() for name, f in futures.items()}
    for state in ("seen", "race_best"):  # derived from the tables just replaced: made anew by the next batch
        if wh[state].exists():
            wh.overwrite(state, spark.createDataFrame([], SCHEMAS[state]))
    return out
