"""The reporting layer over the warehouse tables.

Facts are aggregated at their own grain before any join (so a join never
multiplies rows), and ranks use the distributed ``rank_within``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import ranking
from ..operators.dedup import keep_first
from .warehouse import Warehouse

DEC = "decimal(18,2)"


def driver_performance(wh: Warehouse) -> DataFrame:
    """Points, wins, starts and best finish per driver and season."""
    fact = wh.read("formulaone").select("raceId", "driverId", "points", "wins", "positionOrder")
    races = wh.read("race").select(F.col("race_id").alias("raceId"), F.col("year").alias("season"))
    per = (fact.join(races, "raceId")
               .groupBy("driverId", "season")
               .agg(F.round(F.sum(F.col("points").cast(DEC)).cast("double"), 2).alias("points"),
                    F.sum("wins").cast("bigint").alias("wins"), F.count(F.lit(1)).alias("starts"),
                    F.min(F.when(F.col("positionOrder") > 0, F.col("positionOrder"))).alias("best_finish")))
    # One name row per id (the dimension may hold full-row variants, Q16).
    drivers = keep_first(wh.read("driver"), ["driverId"], ["driverRef", "url"])
    return per.join(drivers.select("driverId", "driverRef", "forename", "surname"), "driverId", "left")


def constructor_standings(wh: Warehouse) -> DataFrame:
    """R2: constructor points per season, ranked within the season."""
    fact = wh.read("formulaone").select("raceId", "constructorId", "points")
    races = wh.read("race").select(F.col("race_id").alias("raceId"), F.col("year").alias("season"))
    per = (fact.join(races, "raceId").groupBy("constructorId", "season")
               .agg(F.sum(F.col("points").cast(DEC)).alias("pts")))
    ranked = ranking.rank_within(per.where(F.col("constructorId").isNotNull()), ["season"],
                                 [F.col("pts").desc()], ties=["pts"], unique=["constructorId"], name="rank")
    cons = keep_first(wh.read("constructor"), ["constructorId"], ["constructorRef", "url_constructors"])
    cons = cons.select("constructorId", "name")
    return (ranked.join(cons, "constructorId", "left")
                  .select("season", "rank", "constructorId", "name",
                          F.round(F.col("pts").cast("double"), 2).alias("points")))


def race_statistics(wh: Warehouse) -> DataFrame:
    """Lap-time and pit-stop statistics and finishers per race."""
    laps = (wh.read("laptimes").where(F.col("milliseconds_laptimes") > 0).groupBy("race_id")
              .agg(F.min("milliseconds_laptimes").alias("best_lap_ms"),
                   F.max("milliseconds_laptimes").alias("worst_lap_ms"),
                   (F.sum("milliseconds_laptimes") / F.count(F.lit(1))).alias("mean_lap_ms"),
                   F.count(F.lit(1)).alias("n_laps")))
    pits = (wh.read("pitstops").where(F.col("milliseconds_pitstops") > 0).groupBy("race_id")
              .agg((F.sum("milliseconds_pitstops") / F.count(F.lit(1))).alias("mean_pit_ms"),
                   F.count(F.lit(1)).alias("n_pitstops")))
    fin = (wh.read("formulaone").groupBy(F.col("raceId").alias("race_id"))
             .agg(F.count(F.lit(1)).alias("entries"),
                  F.count_if(F.col("positionOrder") > 0).alias("finishers")))
    races = wh.read("race").select("race_id", "year", "round", "name_x")
    return races.join(laps, "race_id", "left").join(pits, "race_id", "left").join(fin, "race_id", "left")
