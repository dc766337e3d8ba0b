"""Topic -> warehouse processors (the stream side of the warehouse).

Each processor takes the micro-batch of one topic (``key, value, topic,
partition, offset``) and updates the warehouse with set-based operations:
lookups with rejects (J1-J3), keep-first in arrival order (W1; arrival is
``(partition, offset)``), anti joins against the target (J5), ids from
``max + position`` (W2) and join-based updates (U1-U3).  ``process_batch``
runs them in a fixed order - dimensions, then facts, then standings, then
the fastest-lap update (Q14, T7, T8).

Every reject has a reason (T9).  Most are final and are appended to
``rejects``, in a folder of their batch.  A message that misses a driver, a
race or a constructor is stored in ``waiting`` under the key it misses, and
offered again, in its arrival order, by the batch in which that key arrives.
A key arrives once, so a waiting row needs no removal and no count of
attempts: it is open as long as its dimension does not have the key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import clean as C
from ..operators import keys, lookup, ranking, upsert
from ..operators.dedup import keep_first
from ..session import ensure_checkpoint_dir
from .warehouse import MESSAGE, RACE_BEST, REFS, Warehouse, wait_bucket

# Arrival: the position of a message in its stream; streams of one warehouse are told apart.
ORD = ["partition", "offset", "stream"]
#: Positions of inserted messages that are broadcast at most.
FEW = 100_000


def _decode(msgs: DataFrame, ddl: str) -> DataFrame:
    return msgs.withColumn("v", F.from_json(F.col("value").cast("string"), ddl))


def _reject(df: DataFrame, reason: str, topic: str, kind: str | None = None, ref: Column | None = None) -> DataFrame:
    """A reject row keeps the message and its arrival position, and the key it misses, if it may still arrive."""
    return df.select(F.lit(topic).alias("topic"), F.col("key").cast("string").alias("key"),
                     F.col("value").cast("string").alias("value"), F.lit(reason).alias("reason"),
                     F.col("partition").cast("int").alias("partition"), F.col("offset").cast("bigint").alias("offset"),
                     "stream", (F.lit(None) if ref is None else ref).cast("string").alias("ref"),
                     F.lit(kind).cast("string").alias("kind"))


def _rejects(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _split(df: DataFrame, bad: Column, reason: str, topic: str) -> tuple[DataFrame, DataFrame]:
    """Rows that pass, and the rejects of those where ``bad`` holds (NULL counts as holding)."""
    bad = F.coalesce(bad, F.lit(True))
    return df.where(~bad), _reject(df.where(bad), reason, topic)


def _duplicates(d: DataFrame, new: DataFrame, topic: str) -> DataFrame:
    """The messages of ``d`` that ``new`` (rows to insert) left out, and further copies of those it took:
    a message that comes twice is a duplicate in one batch as it is over two.

    Only a message that was taken can have further copies, so where few were taken, they are broadcast and the
    others, with their texts, are shuffled nowhere."""
    kept = new.select(*ORD, F.lit(True).alias("_kept"))
    few = kept.count() <= FEW
    if few:
        kept = F.broadcast(kept)
    taken = d.join(F.broadcast(new.select(*ORD).distinct()), ORD, "left_semi") if few else d
    copies = taken.withColumn("_copy", F.row_number().over(Window.partitionBy(*ORD).orderBy("key")))
    if few:
        return _reject(d.join(kept, ORD, "left_anti").unionByName(copies.join(kept, ORD).where(F.col("_copy") > 1).select(*d.columns)),
                       "duplicate key", topic)
    return _reject(copies.join(kept, ORD, "left").where(F.col("_kept").isNull() | (F.col("_copy") > 1)), "duplicate key", topic)


def _resolved(df: DataFrame, dim: DataFrame, on: list[str], take: list[str], kind: str, topic: str):
    """J1 / J2 in one join: the resolved rows, and the rejects of the others, which wait for the key."""
    tagged = lookup.resolve_tagged(df, dim, on, take)
    ref = F.when(C.all_present(*on), F.concat_ws("_", *[F.col(c) for c in on]))
    return (tagged.where(F.col(lookup.HIT)).drop(lookup.HIT),
            _reject(tagged.where(~F.col(lookup.HIT)), f"unknown {kind}", topic, kind, ref))


def _resolve_driver(df: DataFrame, wh: Warehouse, ref: Column, topic: str):
    # Full-row dedup keeps variants of one driver (Q16): look up distinct (ref, id).
    dim = wh.read("driver").select(F.col("driverRef").alias("_dref"), "driverId").distinct()
    ok, rej = _resolved(df.withColumn("_dref", ref), dim, ["_dref"], ["driverId"], "driver", topic)
    return ok.drop("_dref"), rej


def _resolve_race(df: DataFrame, wh: Warehouse, season: Column, rnd: Column, topic: str, only: int):
    """Race ids of season ``only``; another season is a final reject, an unknown round one that may resolve."""
    df = df.withColumn("season_n", season.try_cast("bigint")).withColumn("round_n", rnd.try_cast("bigint"))
    df, bad = _split(df, F.col("season_n").isNull() | F.col("round_n").isNull(), "invalid season or round", topic)
    df, other = _split(df, F.col("season_n") != only, "other season", topic)
    races = wh.read("race").where(F.col("year") == only).select(
        F.col("year").cast("bigint").alias("season_n"), F.col("round").cast("bigint").alias("round_n"), "race_id")
    ok, rej = _resolved(df, races, ["season_n", "round_n"], ["race_id"], "race", topic)
    return ok, _rejects(bad, other, rej)


def _resolve_driver_race(df: DataFrame, wh: Warehouse, ref: Column, season: Column, rnd: Column, topic: str, only: int):
    """:func:`_resolve_driver` and :func:`_resolve_race` in one pass: messages are decoded and joined once, kept with
    the reason to reject them, if any, and then split."""
    dim = wh.read("driver").select(F.col("driverRef").alias("_dref"), "driverId").distinct()
    df = lookup.resolve_tagged(df.withColumn("_dref", ref), dim, ["_dref"], ["driverId"]).withColumnRenamed(lookup.HIT, "_known")
    # Messages without a driver are rejected for that: they look up no race.
    df = (df.withColumn("season_n", F.when(F.col("_known"), season.try_cast("bigint")))
            .withColumn("round_n", F.when(F.col("_known"), rnd.try_cast("bigint"))))
    races = wh.read("race").where(F.col("year") == only).select(
        F.col("year").cast("bigint").alias("season_n"), F.col("round").cast("bigint").alias("round_n"), "race_id")
    df = lookup.resolve_tagged(df, races, ["season_n", "round_n"], ["race_id"])
    why = (F.when(~F.col("_known"), "unknown driver").when(F.col("season_n").isNull() | F.col("round_n").isNull(), "invalid season or round")
            .when(F.col("season_n") != only, "other season").when(~F.col(lookup.HIT), "unknown race"))
    df = df.withColumn("_why", why).drop("_known", lookup.HIT).checkpoint()
    bad = lambda reason, *waits: _reject(df.where(F.col("_why") == reason), reason, topic, *waits)
    return df.where(F.col("_why").isNull()).drop("_dref", "_why"), _rejects(
        bad("unknown driver", "driver", F.col("_dref")), bad("invalid season or round"), bad("other season"),
        bad("unknown race", "race", F.concat_ws("_", "season_n", "round_n")))


# ----------------------------------------------------------------- dimensions
def process_status(wh: Warehouse, msgs: DataFrame) -> DataFrame:
    t = "status_topic"
    d = _decode(msgs, S.STATUS_VALUE)
    d = d.withColumn("sid", F.coalesce(F.col("v.statusId"), F.col("key")))                # F16 key fallback
    bad = d.where(F.col("sid").try_cast("bigint").isNull())                              # P9
    d = d.where(F.col("sid").try_cast("bigint").isNotNull())
    d = d.withColumn("status_name", C.field_or_default(F.col("v.status")))
    current = wh.read("status")
    new = upsert.insert_new(current, d, "status_name", ORD, small_batch=True)                             # W1 + J5
    new = keys.assign_ids(new.select("status_name", *ORD), ORD, "statusid",
                          start=keys.max_id(current, "statusid"))
    dup = _duplicates(d, new, t)
    wh.append("status", new.select("statusid", "status_name"))
    return _rejects(_reject(bad, "invalid status id", t), dup)


def process_driver(wh: Warehouse, msgs: DataFrame) -> DataFrame:
    d = _decode(msgs, S.DRIVER_VALUE).withColumn("driverRef", F.coalesce(F.col("v.driverId"), F.col("key")))
    current = wh.read("driver")
    new = upsert.insert_new(current, d, "driverRef", ORD, small_batch=True)
    new = new.select("driverRef", *ORD,
                     C.safe_int("v.permanentNumber").cast("double").alias("number_drivers"),   # F12
                     F.col("v.code").alias("code"),
                     C.field_or_default(F.col("v.givenName")).alias("forename"),
                     C.field_or_default(F.col("v.familyName")).alias("surname"),
                     F.to_date(C.to_timestamp_fmt(C.date_to_ts_text(F.col("v.dateOfBirth")),
                                                  "yyyy-MM-dd'T'HH:mm:ss")).alias("dob"),   # F14
                     F.col("v.nationality").alias("nationality"), F.col("v.url").alias("url"))
    new = keys.assign_ids(new, ORD, "driverId", start=keys.max_id(current, "driverId"))
    wh.append("driver", new)
    return _duplicates(d, new, "driver_topic")


def process_constructor(wh: Warehouse, msgs: DataFrame) -> DataFrame:
    d = _decode(msgs, S.CONSTRUCTOR_VALUE).withColumn("constructorRef",
                                                       F.coalesce(F.col("v.constructorId"), F.col("key")))
    current = wh.read("constructor")
    new = upsert.insert_new(current, d, "constructorRef", ORD, small_batch=True)
    new = new.select("constructorRef", *ORD, C.field_or_default(F.col("v.name")).alias("name"),
                     F.col("v.nationality").alias("nationality_constructors"),
                     F.col("v.url").alias("url_constructors"))
    new = keys.assign_ids(new, ORD, "constructorId", start=keys.max_id(current, "constructorId"))
    wh.append("constructor", new)
    return _duplicates(d, new, "constructor_topic")


def process_race(wh: Warehouse, msgs: DataFrame, legacy_int_coords: bool = False) -> DataFrame:
    """Races with their circuit (lookup-or-create), practice, qualifying and
    sprint rows: one batch fanned out to five tables (K5).

    The race row is written last.  A batch that is replayed after a crash in
    between finds the race missing, gives it the same id (same batch, same
    maximum), and each child table takes only the ids it does not have."""
    t = "race_topic"
    d = _decode(msgs, S.RACE_VALUE)
    d = d.withColumn("year", F.col("v.season").try_cast("bigint")).withColumn("round", F.col("v.round").try_cast("bigint"))
    bad = d.where(F.col("year").isNull() | F.col("round").isNull())
    d = d.where(F.col("year").isNotNull() & F.col("round").isNotNull())
    races = wh.read("race")
    new = upsert.insert_new(races, d, ["year", "round"], ORD, small_batch=True)                            # W1 + J5
    # Checkpointed, not cached: a write to a folder that a cached plan reads makes Spark read it again.
    new = new.withColumn("circuitRef", F.col("v.Circuit.circuitId")).checkpoint()
    circuits = wh.read("circuit")
    first = keep_first(new, ["circuitRef"], ORD)                                      # one id per new ref
    coord = C.trunc_int if legacy_int_coords else C.to_number                        # Q9
    created = (upsert.insert_new(circuits, first, "circuitRef", small_batch=True)
               .select("circuitRef", *ORD, F.col("v.Circuit.circuitName").alias("name_y"),
                       F.col("v.Circuit.Location.locality").alias("location"),
                       F.col("v.Circuit.Location.country").alias("country"),
                       coord(F.col("v.Circuit.Location.lat")).cast("double").alias("lat"),
                       coord(F.col("v.Circuit.Location.long")).cast("double").alias("lng"),
                       F.lit(None).cast("double").alias("alt"), F.col("v.Circuit.url").alias("url_y")))
    created = keys.assign_ids(created, ORD, "circuitId", start=keys.max_id(circuits, "circuitId"))
    cmap = circuits.select("circuitRef", "circuitId").unionByName(created.select("circuitRef", "circuitId"))
    rows = keys.assign_ids(new.join(cmap, "circuitRef", "left"), ORD, "race_id",
                           start=keys.max_id(races, "race_id")).checkpoint()
    wh.append("circuit", created)

    def sess(name):
        return F.col(f"v.{name}.time").isNotNull()                                   # P10

    def sess_cols(name, prefix):
        have = sess(name)
        return [F.when(have, F.col(f"v.{name}.date")).alias(f"{prefix}_date"),
                F.when(have, C.strip_z(F.col(f"v.{name}.time"))).alias(f"{prefix}_time")]

    fp = rows.where(sess("FirstPractice") | sess("SecondPractice") | sess("ThirdPractice"))  # Q12
    children = {
        "freepractice": fp.select("race_id", *sess_cols("FirstPractice", "fp1"), *sess_cols("SecondPractice", "fp2"),
                                  *sess_cols("ThirdPractice", "fp3")),
        "qualifying": rows.where(sess("Qualifying")).select("race_id", *sess_cols("Qualifying", "quali")),
        "sprint": rows.select("race_id", *sess_cols("Sprint", "sprint"))}                  # Q13: always
    for table, child in children.items():
        wh.append(table, upsert.insert_new(wh.read(table), child, "race_id", small_batch=True))
    wh.append("race", rows.select(
        "race_id", "circuitId", "year", "round", F.lit(None).cast("bigint").alias("laps"),
        F.lit(None).cast("double").alias("fastestLap"), F.lit(None).cast("string").alias("fastestLapTime"),
        F.lit(None).cast("double").alias("fastestLapSpeed"), F.col("v.raceName").alias("name_x"),
        F.to_date(C.to_timestamp_fmt(F.col("v.date"), "yyyy-MM-dd")).alias("date"),
        C.strip_z(F.col("v.time")).alias("time_races"), F.col("v.url").alias("url_x")))      # F13
    return _reject(bad, "invalid season or round", t)


# ---------------------------------------------------------------------- facts
def process_laptimes(wh: Warehouse, msgs: DataFrame, season: int,
                     legacy_float: bool = False) -> DataFrame:
    t = "laptimes_topic"
    d = _decode(msgs, S.LAPTIME_VALUE)
    d, rej1 = _resolve_driver(d, wh, F.col("v.driverId"), t)
    d, rej2 = _resolve_race(d, wh, F.coalesce(F.col("v.season"), F.lit(str(season))), F.col("v.round"), t, season)
    d, rej3 = _split(d.withColumn("lap", F.col("v.lap").try_cast("bigint")), F.col("lap").isNull(), "invalid lap", t)
    d = d.checkpoint()
    new = upsert.insert_new(wh.touched("laptimes", d), d, ["driverId", "race_id", "lap"], ORD, small_batch=True)   # W1 + J5 (Q5)
    new = new.select(
        *ORD, "race_id", "driverId", "lap", F.col("v.position").try_cast("bigint").alias("position_laptimes"),
        F.col("v.time").alias("time_laptimes"),
        C.duration_ms(F.col("v.time"), legacy_float=legacy_float).alias("milliseconds_laptimes")).checkpoint()  # F7
    dup = _duplicates(d, new, t)
    _note_best(wh, new)     # before the laps: a batch that stops in between finds its laps missing and notes them again
    wh.append("laptimes", new)
    return _rejects(rej1, rej2, rej3, dup)


def process_pitstops(wh: Warehouse, msgs: DataFrame, season: int) -> DataFrame:
    t = "pitstops_topic"
    d = _decode(msgs, S.PITSTOP_VALUE)
    d, rej1 = _resolve_driver(d, wh, F.col("v.driverId"), t)
    d, rej2 = _resolve_race(d, wh, F.col("v.season"), F.col("v.round"), t, season)
    d, rej3 = _split(d.withColumn("stop", F.col("v.stop").try_cast("bigint")), F.col("stop").isNull(), "invalid stop", t)
    d = d.checkpoint()
    new = upsert.insert_new(wh.touched("pitstops", d), d, ["stop", "race_id", "driverId"], ORD, small_batch=True).checkpoint()  # Q5: batch and table
    ms = C.duration_ms(F.col("v.duration"))                                                # F8
    dup = _duplicates(d, new, t)
    wh.append("pitstops", new.select(
        "stop", "race_id", "driverId", F.col("v.lap").try_cast("bigint").alias("lap_pitstops"),
        F.col("v.time").alias("time_pitstops"), F.floor(ms / 1000).cast("double").alias("duration"),
        ms.cast("double").alias("milliseconds_pitstops")))
    return _rejects(rej1, rej2, rej3, dup)


def process_results(wh: Warehouse, msgs: DataFrame, season: int,
                    dedup_on: list[str] | None = ("raceId", "driverId")) -> DataFrame:
    """Fact rows (FormulaOne) and the guarded race update from rank-1 rows."""
    t = "results_topic"
    d = _decode(msgs, S.RESULT_VALUE).withColumn("laps_n", F.col("v.laps").try_cast("bigint"))
    d, rej = _resolve_driver_race(d, wh, F.col("v.driverId"), F.col("v.season"), F.col("v.round"), t, season)
    d = d.withColumnRenamed("race_id", "raceId")
    fact = wh.read("formulaone")
    new = upsert.insert_new(wh.touched("formulaone", d), d, list(dedup_on), ORD, small_batch=True) if dedup_on else d    # Q2
    # Only the rows to insert are looked up further; each lookup finds one row at most, so it takes none away.
    new = new.checkpoint()
    dup = _duplicates(d, new, t)
    cons = wh.read("constructor").select(F.col("constructorRef").alias("_cref"), "constructorId").distinct()
    new, _ = lookup.resolve(new.withColumn("_cref", F.col("v.constructorId")), cons, "_cref", ["constructorId"], how="left")
    sts = (wh.read("status").select(F.col("status_name").alias("_sname"), F.col("statusid").alias("statusId"))
              .groupBy("_sname").agg(F.min("statusId").alias("statusId")))
    new, _ = lookup.resolve(new.withColumn("_sname", F.col("v.status")), sts, "_sname", ["statusId"], how="left")  # J3
    # Only the batch's keys are looked up: the large tables are filtered before they are grouped.
    batch_keys = new.select("driverId", "raceId").distinct()
    races = batch_keys.select(F.col("raceId").alias("race_id"))
    pit = wh.touched("pitstops", races).withColumnRenamed("race_id", "raceId").join(batch_keys, ["driverId", "raceId"], "left_semi")
    new = lookup.first_of_many(new, pit, ["driverId", "raceId"], "stop", "stop")           # J6, Q7
    laps = wh.touched("laptimes", races).select("driverId", F.col("race_id").alias("raceId"), F.col("lap").alias("laps_n"))
    laps = laps.join(batch_keys, ["driverId", "raceId"], "left_semi")
    new = lookup.exists_flag(new, laps, ["driverId", "raceId", "laps_n"], "laps_n", "lap")    # J4
    pos = F.col("v.position")
    rows = new.select(
        *ORD, "raceId", "driverId", "constructorId", "statusId",
        F.lit(None).cast("bigint").alias("driverStandingsId"), F.lit(None).cast("bigint").alias("conStandingsId"),
        F.col("v.grid").try_cast("double").alias("grid"), F.col("stop").cast("double").alias("stop"),
        pos.try_cast("double").alias("position"),
        F.col("v.FastestLap.rank").try_cast("double").alias("rank"),                     # Q1: one field name
        F.col("v.time").alias("time"),
        F.when(F.col("v.milliseconds").isNotNull() & F.col("v.time").isNotNull(),
               F.col("v.milliseconds").try_cast("double")).alias("milliseconds"),
        F.col("v.points").try_cast("double").alias("points"),                            # Q11: 12.5 allowed
        F.col("v.number").try_cast("double").alias("number"), F.col("lap").cast("double").alias("lap"),
        C.digits_only(pos).cast("double").alias("positionOrder"),                         # F11
        C.digits_only(F.col("v.positionText")).cast("double").alias("positionText"),
        F.when(pos == "1", 1).otherwise(0).cast("double").alias("wins"))                 # F18
    rows = keys.assign_ids(rows, ORD, "resultId", start=keys.max_id(fact, "resultId"))
    wh.append("formulaone", rows)

    # A4 -> U1: laps of the first message per race; lap, time, speed of the rank-1 row.  From all
    # resolved messages, not the inserted ones, so a replay after the insert still updates.
    is_top = C.text_equals(F.col("v.FastestLap.rank"), "1")                               # F20
    o = F.struct(*[F.col(c) for c in ORD])
    upd = d.groupBy(F.col("raceId").alias("race_id")).agg(
        F.min_by(F.col("laps_n"), o).alias("u_laps"),
        F.min_by(F.when(is_top, F.col("v.FastestLap.lap").try_cast("double")), F.when(is_top, o)).alias("u_lap"),
        F.min_by(F.when(is_top, F.col("v.FastestLap.Time.time")), F.when(is_top, o)).alias("u_time"),
        F.min_by(F.when(is_top, F.col("v.FastestLap.AverageSpeed.speed").try_cast("double")),
                 F.when(is_top, o)).alias("u_speed"))
    sets = {"laps": "u_laps", "fastestLap": "u_lap", "fastestLapTime": "u_time", "fastestLapSpeed": "u_speed"}
    full = upd.where(C.all_present(*sets.values()))
    open_races = wh.read("race").where(C.any_missing(*sets)).join(full, "race_id", "left_semi")
    if not open_races.isEmpty():
        wh.overwrite("race", upsert.update_guarded(wh.read("race"), upd, "race_id", sets))
    return _rejects(rej, dup)


def _standings_rows(msgs: DataFrame, ddl: str, list_name: str) -> DataFrame:
    """A message is a whole standings document or one standing."""
    d = _decode(msgs, ddl)
    lst = F.get(F.col("v.StandingsTable.StandingsLists"), 0)
    single = F.struct(*[F.col(f"v.{f}") for f in ("position", "positionText", "points", "wins")],
                      *([F.col("v.Driver"), F.col("v.Constructors")] if list_name == "DriverStandings"
                        else [F.col("v.Constructor")]))
    recs = F.coalesce(lst.getField(list_name), F.when(F.col("v.position").isNotNull(), F.array(single)), F.array())
    season = F.coalesce(lst.getField("season"), F.col("v.season"), F.col("v.StandingsTable.season"))
    rnd = F.coalesce(lst.getField("round"), F.col("v.round"), F.col("v.StandingsTable.round"))
    return d.select("key", "value", *ORD, season.alias("season"), rnd.alias("round"),
                    F.posexplode(recs).alias("_i", "s"))


def _process_standings(wh: Warehouse, msgs: DataFrame, season: int, kind: str,
                       dedup_keys: list[str]) -> DataFrame:
    con = kind == "con"
    t = "constandings_topic" if con else "driverstandings_topic"
    rows = _standings_rows(msgs, S.CON_STANDINGS_VALUE if con else S.DRIVER_STANDINGS_VALUE,
                           "ConstructorStandings" if con else "DriverStandings")
    rows = rows.withColumn("position_n", F.col("s.position").try_cast("bigint")).withColumn("_bad", F.col("position_n").isNull())
    order = [*ORD, "_i"]
    # Kept before it is used again, so messages are decoded once; only if some first has no position, once more.
    first = keep_first(rows, [*["position_n" if k == "position" else k for k in dedup_keys], "_bad"], order).checkpoint()   # Q4
    rej3 = _reject((first if first.where("_bad").isEmpty() else rows).where("_bad"), "invalid position", t)
    rows = first.where("NOT _bad").drop("_bad")
    if con:
        dim = wh.read("constructor").select(F.col("constructorRef").alias("_ref"), "constructorId").distinct()
        ok, rej1 = _resolved(rows.withColumn("_ref", F.col("s.Constructor.constructorId")), dim, ["_ref"],
                             ["constructorId"], "constructor", t)
        ent = "constructorId"
    else:
        ok, rej1 = _resolve_driver(rows, wh, F.col("s.Driver.driverId"), t)
        ent = "driverId"
    ok, rej2 = _resolve_race(ok, wh, F.col("season"), F.col("round"), t, season)
    table = "constandings" if con else "driverstandings"
    id_col = "constandingsId" if con else "driverStandingsId"
    sfx = "constructorstandings" if con else "driverstandings"
    # Q3: every standing is a snapshot with a new id.  Ids are noted by message position before they
    # are used, so a replayed batch finds its own and adds nothing.
    noted = wh.read("standing_ids").where(F.col("kind") == kind)
    ids = noted.select(*order, F.col("id").alias(id_col))
    known = ok.join(ids, order)
    current = wh.read(table)
    last = current.select(F.col(id_col).alias("id")).unionByName(noted.select("id"))
    fresh = keys.assign_ids(ok.join(ids, order, "left_anti"), order, id_col, start=keys.max_id(last, "id"))
    # Checkpointed, not cached: a write to a folder that a cached plan reads makes Spark read it again.
    new = known.unionByName(fresh.select(*known.columns)).checkpoint()
    unnoted = new.join(ids.select(*order), order, "left_anti")
    wh.append("standing_ids", unnoted.select(F.lit(kind).alias("kind"), *order, F.col(id_col).alias("id")))
    cols = [id_col, F.col("s.points").try_cast("double").alias(f"points_{sfx}"),
            F.col("position_n").alias(f"position_{sfx}"), F.col("s.positionText").alias(f"positionText_{sfx}")]
    if con:
        cols.append(F.col("s.wins").try_cast("bigint").alias(f"wins_{sfx}"))
    wh.append(table, upsert.insert_new(current, new.select(*cols), id_col, small_batch=True))
    # Repoint fact rows of that race and entity where the id differs; last wins.
    upd = new.select(F.col("race_id").alias("raceId"), ent, F.col(id_col).alias("new_id"), *order)
    fact_col = "conStandingsId" if con else "driverStandingsId"
    fact = wh.read("formulaone")
    if new.isEmpty():
        pass
    elif wh.partitioned("formulaone"):
        # Only the races this batch touches are read, updated and rewritten.
        touched = wh["formulaone"].read_touched(upd)
        changed, _ = upsert.update_from(touched, upd, ["raceId", ent], fact_col, "new_id", order=order)
        wh["formulaone"].overwrite_partitions(changed.drop("_changed"))
    else:
        changed, _ = upsert.update_from(fact, upd, ["raceId", ent], fact_col, "new_id", order=order)
        wh.overwrite("formulaone", changed.drop("_changed"))
    return _rejects(rej1, rej2, rej3)


def process_constandings(wh: Warehouse, msgs: DataFrame, season: int,
                         dedup_keys: list[str] = ("season", "round", "position")) -> DataFrame:
    return _process_standings(wh, msgs, season, "con", list(dedup_keys))


def process_driverstandings(wh: Warehouse, msgs: DataFrame, season: int,
                            dedup_keys: list[str] = ("season", "round", "position")) -> DataFrame:
    return _process_standings(wh, msgs, season, "driver", list(dedup_keys))


BEST_ORDER = ["milliseconds_laptimes", "lap", "driverId"]


def _note_best(wh: Warehouse, laps: DataFrame) -> None:
    """U3 / W3, kept up: one row per race, its fastest lap (NULL times last, ties to the lower lap), merged
    with the batch's own.  Only the first batch after a load reads all laps."""
    columns = [f.split()[0] for f in RACE_BEST.split(", ")]
    known = wh.read("race_best").select(*columns)
    if not wh["race_best"].exists() or known.isEmpty():
        known = ranking.top1(wh.read("laptimes"), ["race_id"], BEST_ORDER).select(*columns)
        wh.overwrite("race_best", known)
        known = wh.read("race_best").select(*columns)
    batch = ranking.top1(laps, ["race_id"], BEST_ORDER).select(*columns)
    best = ranking.top1(known.unionByName(batch), ["race_id"], BEST_ORDER).checkpoint()
    if not best.exceptAll(known).isEmpty():
        wh.overwrite("race_best", best)


def update_fastest_laps(wh: Warehouse, season: int) -> None:
    """Races of the season whose columns are not those of their fastest lap get them; the speed is
    cleared (Q23).  Reads one row per race, no laps; ``race`` is rewritten only if one of them differs."""
    races = wh.read("race")
    best = wh.read("race_best").select("race_id", F.col("lap").cast("double").alias("b_lap"), F.col("time_laptimes").alias("b_time"))
    same = (F.col("fastestLap").eqNullSafe(F.col("b_lap")) & F.col("fastestLapTime").eqNullSafe(F.col("b_time"))
            & F.col("fastestLapSpeed").isNull())
    stale = races.where(F.col("year") == season).join(best, "race_id").where(~same).select("race_id", "b_lap", "b_time").checkpoint()
    if stale.isEmpty():
        return
    wh.overwrite("race", upsert.update_from_top1(
        races, stale, "race_id", {"fastestLap": "b_lap", "fastestLapTime": "b_time", "fastestLapSpeed": F.lit(None)}))


DIMENSIONS = [("status_topic", process_status), ("driver_topic", process_driver),
              ("constructor_topic", process_constructor), ("race_topic", process_race)]
FACTS = [("laptimes_topic", process_laptimes), ("pitstops_topic", process_pitstops),
         ("results_topic", process_results), ("constandings_topic", process_constandings),
         ("driverstandings_topic", process_driverstandings)]
PROCESSORS = DIMENSIONS + FACTS
FIELDS = ["key", "value", "topic", "partition", "offset", "stream"]


def process_batch(wh: Warehouse, batch: DataFrame, season: int, batch_id: int | None = None, stream: str = "") -> None:
    """One micro-batch of all topics (T7), in dependency order.

    Every step adds only what its table does not have, so the batch can be
    applied again after a crash at any point.  Messages that waited for a key
    of this batch are offered again with its own, in their arrival order.
    Messages of another season are final rejects at once."""
    ensure_checkpoint_dir(wh.spark)
    known = F.col("topic").isin([t for t, _ in PROCESSORS])
    cached = batch.where(known).select(*FIELDS[:-1], F.lit(stream).alias("stream")).persist()
    try:
        # One job finds the topics present (of the nine known ones).
        present = {r[0] for r in cached.select("topic").distinct().collect()}
        rejects = []

        def run(fn, msgs: DataFrame, **kw) -> None:
            # Kept at once: a later step may replace files that a lazy reject would still read.
            rejects.append(fn(wh, msgs, **kw).checkpoint())

        for topic, fn in DIMENSIONS:
            if topic in present:
                run(fn, cached.where(F.col("topic") == topic))
        released, seen = _released(wh)
        if released is not None:
            present |= {r[0] for r in released.select("topic").distinct().collect()}
        for topic, fn in FACTS:
            if topic in present:
                msgs = cached.where(F.col("topic") == topic)
                if released is not None:
                    # A batch that is applied again may have its own messages among those that wait.
                    again = released.where(F.col("topic") == topic).join(msgs.select(*ORD), ORD, "left_anti")
                    msgs = msgs.unionByName(again.select(*FIELDS))
                run(fn, msgs, season=season)
        if "laptimes_topic" in present:
            update_fastest_laps(wh, season)
        if rejects:
            now = _rejects(*rejects)
            if batch_id is not None:
                _record_metrics(wh, cached, now, batch_id, stream)
            _record_rejects(wh, now, batch_id, stream)
        if seen is not None:
            wh.overwrite("seen", seen)      # last: a batch that is applied again offers the same messages again
    finally:
        cached.unpersist()


def _released(wh: Warehouse) -> tuple[DataFrame | None, DataFrame | None]:
    """The messages that waited for keys that their dimension has gained, and the ids seen now (None: as before).

    Keys gained are the rows above the largest id that an earlier batch saw.  Only their folders of
    ``waiting`` are read (at most ``WAIT_BUCKETS`` of a kind are named)."""
    before = {r["kind"]: r["id"] for r in wh.read("seen").collect()}            # one row a kind
    ends = None
    for kind, (table, id_col, _) in REFS.items():
        end = wh.read(table).agg(F.max(id_col).cast("bigint").alias("id")).select(F.lit(kind).alias("kind"), "id")
        ends = end if ends is None else ends.unionByName(end)
    now = {r["kind"]: r["id"] for r in ends.collect()}
    if now == before:
        return None, None
    seen = wh.spark.createDataFrame([(k, v) for k, v in now.items()], "kind STRING, id BIGINT")
    if not wh["waiting"].exists():
        return None, seen
    gained = None
    for kind, (table, id_col, ref) in REFS.items():
        if now[kind] is not None and now[kind] != before.get(kind):
            rows = wh.read(table)
            rows = rows.where(F.col(id_col) > before[kind]) if before.get(kind) is not None else rows
            rows = rows.select(F.lit(kind).alias("kind"), wait_bucket(F.expr(ref)).alias("bucket"), F.expr(ref).alias("ref")).distinct()
            gained = rows if gained is None else gained.unionByName(rows)
    if gained is None:
        return None, seen
    buckets: dict[str, list[int]] = {}
    for r in gained.select("kind", "bucket").distinct().collect():
        buckets.setdefault(r["kind"], []).append(r["bucket"])
    folders = F.lit(False)
    for kind, some in buckets.items():
        folders = folders | ((F.col("kind") == kind) & F.col("bucket").isin(some))
    waiting = wh.read("waiting").where(folders).join(gained, ["kind", "bucket", "ref"], "left_semi")
    return waiting.select(*FIELDS).distinct().checkpoint(), seen


def _record_rejects(wh: Warehouse, now: DataFrame, batch_id: int | None, stream: str) -> None:
    """Final rejects go to the folder of their batch (an applied-again batch replaces its own), the others to
    the folder of the key they wait for.  Nothing stored before is read or rewritten."""
    waits = F.col("ref").isNotNull()
    finals = now.where(~waits).select(*[c.split()[0] for c in MESSAGE.split(", ")]).withColumn(
        "batch", F.lit(-1 if batch_id is None else batch_id).cast("bigint"))
    finals = finals.withColumn("stream", F.lit(stream or "-"))
    if batch_id is None:
        wh.append("rejects", finals)
    else:
        wh["rejects"].put(finals)
    waiting = now.where(waits).withColumn("bucket", wait_bucket(F.col("ref")))
    if not waiting.isEmpty():
        wh.append("waiting", waiting)


def _record_metrics(wh: Warehouse, batch: DataFrame, rejects: DataFrame, batch_id: int, stream: str) -> None:
    """A5 for the stream: messages read and rejected per topic in this batch
    (messages offered again count again), one row per (stream, batch, topic)."""
    read = batch.groupBy("topic").agg(F.count(F.lit(1)).alias("n_read"))
    read = read.join(rejects.groupBy("topic").agg(F.count(F.lit(1)).alias("n_rejected")), "topic", "left")
    rows = read.select(F.lit(batch_id).cast("bigint").alias("batch_id"), "topic", "n_read",
                       F.coalesce("n_rejected", F.lit(0)).cast("bigint").alias("n_rejected"), F.lit(stream).alias("stream"))
    if wh["batch_metrics"].exists():
        rows = rows.join(wh.read("batch_metrics").select("stream", "batch_id", "topic"), ["stream", "batch_id", "topic"], "left_anti")
    wh.append("batch_metrics", rows)


def ingest_topics(wh: Warehouse, stream: DataFrame, checkpoint: str, season: int, available_now: bool = True,
                  interval: str = "5 minutes", compact_every: int | None = None, keep_versions: int = 2):
    """Run ``process_batch`` over a topic stream.

    ``available_now`` drains what is there and stops (one scheduled run);
    otherwise the query triggers every ``interval``.  Batch ids are recorded in
    the warehouse ledger under the stream's own id, so a batch replayed after a
    failure is skipped, and a second stream into the same warehouse is not.
    ``compact_every`` rewrites every table as one version each N batches, so a
    long-running stream does not leave a growing number of small files; all
    but ``keep_versions`` old versions are deleted after each batch."""
    from ..streaming.ingest import Ledger, once, run_available_now, stream_id

    def step(batch: DataFrame, batch_id: int) -> None:
        process_batch(wh, batch, season, batch_id=batch_id, stream=stream_id(wh.spark, checkpoint))
        for table in wh.tables.values():
            if compact_every and batch_id > 0 and batch_id % compact_every == 0 and table.exists():
                table.compact()
            if not wh.partitioned_table(table):
                table.vacuum(keep_versions)

    fn = once(Ledger(wh.spark, wh.root), step, scope="topics", checkpoint=checkpoint)
    if available_now:
        run_available_now(stream, fn, checkpoint, name=None)
        return None
    return (stream.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
                  .trigger(processingTime=interval).start())
