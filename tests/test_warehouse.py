"""The warehouse end to end on the hostile fixture: batch load from the wide
CSV, one micro-batch of all topics, replay, reports."""

import pytest
from pyspark.sql import functions as F

import f1_fixture as FX
from tarmac.plans import processors as P
from tarmac.plans import report as R
from tarmac.plans.warehouse import Warehouse, load_csv
from tarmac.schemas import CSV_TEXT_SCHEMA
from tarmac.sources.csv import write_csv
from tarmac.sources.topics import TOPIC_SCHEMA, read_message_stream, write_messages
from tarmac.streaming.ingest import Ledger, once, stream_id


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


@pytest.fixture(scope="module", params=[None, "raceId"], ids=["versioned_fact", "partitioned_fact"])
def loaded(spark, request):
    from tarmac.session import work_path

    root = work_path(spark, "wh")
    write_csv(spark.createDataFrame(FX.csv_rows(), CSV_TEXT_SCHEMA).coalesce(1), f"{root}/csv")
    wh = Warehouse(spark, f"{root}/wh", fact_partition=request.param)
    load_csv(spark, f"{root}/csv", wh)
    batch = {name: wh.read(name).collect() for name in ["race", "formulaone", "laptimes", "driver", "status"]}
    msgs = spark.createDataFrame([m + (None,) for m in FX.stream_messages()], TOPIC_SCHEMA)
    write_messages(msgs, f"{root}/topics")
    P.ingest_topics(wh, read_message_stream(spark, f"{root}/topics"), f"{root}/ckpt", season=2024)   # epoch 0
    own = stream_id(spark, f"{root}/ckpt")
    step = once(Ledger(spark, wh.root), lambda b, i: P.process_batch(wh, b, season=2024, stream=own), scope="topics")
    return wh, batch, msgs, step


def test_batch_semantics(loaded):
    wh, batch, _, _ = loaded
    race = {r.race_id: r for r in batch["race"]}
    assert race[0].laps == 53 and race[0].fastestLapTime == "1:21.046"        # first CSV row (Q18), text (Q10)
    assert race[1].time_races is None
    fact = {r.resultId: r for r in batch["formulaone"]}
    assert fact[1].positionText == 0.0 and fact[1].points == 12.5            # 'R' -> 0 (Q22), 12.5 kept
    assert "conStandingsId" in wh.read("formulaone").columns
    laps = {(r.race_id, r.driverId, r.lap): r.time_laptimes for r in batch["laptimes"]}
    assert laps[(0, 0, 1)] == "1:10.040" and len(laps) == 4                  # keep-first per key
    assert len([r for r in batch["driver"] if r.driverRef == "lewis"]) == 2  # full-row dedup (Q16)
    assert sorted((r.statusid, r.status_name) for r in batch["status"]) == [(1, "Finished"), (2, "+1 Lap")]
    q = {r.race_id: r.quali_time for r in wh.read("qualifying").collect()}
    assert q == {0: None, 1: "14:00:00"}                                     # \N -> NULL


def test_stream_dimensions(loaded):
    wh, _, _, _ = loaded
    assert rows(wh.read("status"), "statusid", "status_name")[-1] == (3, "Collision")
    drv = {r.driverRef: r for r in wh.read("driver").collect()}
    assert drv["norris"].driverId == 2 and drv["norris"].surname == "Unknown"
    assert drv["norris"].number_drivers is None                              # blank -> NULL (F12)
    circ = rows(wh.read("circuit"), "circuitId", "circuitRef", "lat")
    assert circ[-1] == (1, "suzuka", -34.84)                                 # one id (Q9: full precision)
    race = {r.round: r for r in wh.read("race").collect()}
    assert race[3].circuitId == race[4].circuitId == 1 and race[3].time_races == "05:00:00"
    fp = {r.race_id: r.fp2_time for r in wh.read("freepractice").collect()}
    assert fp[race[3].race_id] == "06:00:00" and race[4].race_id not in fp   # Q12
    sprint = {r.race_id: r.sprint_time for r in wh.read("sprint").collect()}
    assert sprint[race[3].race_id] is None and sprint[race[4].race_id] == "03:00:00"  # Q13


def test_stream_facts_updates_and_rejects(loaded):
    wh, _, _, _ = loaded
    laps = {(r.race_id, r.driverId, r.lap): r.milliseconds_laptimes for r in wh.read("laptimes").collect()}
    assert laps[(0, 0, 3)] == 70040 and laps[(0, 1, 4)] == 68100            # exact ms (Q8)
    pit = {(r.stop, r.driverId): (r.duration, r.milliseconds_pitstops) for r in wh.read("pitstops").collect()
           if r.race_id == 0}
    assert pit[(2, 0)] == (62.0, 62500.0)
    fact = wh.read("formulaone")
    assert fact.where((F.col("raceId") == 1) & (F.col("driverId") == 0)).count() == 1   # no replay dup (Q2)
    lewis = fact.where((F.col("raceId") == 1) & (F.col("driverId") == 1)).first()
    assert lewis.points == 12.5 and lewis.positionText is None and lewis.wins == 0.0
    f0 = {r.resultId: (r.conStandingsId, r.driverStandingsId) for r in fact.collect()}
    assert f0[0] == (11, 22) and f0[1][0] == 12                              # repointed (U2)
    race = {r.race_id: r for r in wh.read("race").collect()}
    assert race[0].fastestLap == 4.0 and race[0].fastestLapTime == "1:08.100" and race[0].fastestLapSpeed is None
    rej = rows(wh.read("rejects"), "topic", "reason")
    assert ("results_topic", "unknown driver") in rej and ("status_topic", "invalid status id") in rej
    m = {r.topic: (r.n_read, r.n_rejected) for r in wh.read("batch_metrics").where("batch_id = 0").collect()}
    # two known results, one unknown driver; one bad and one known status; one known driver
    assert m["results_topic"] == (4, 3) and m["status_topic"] == (3, 2) and m["driver_topic"] == (2, 1)


def test_replay_is_a_no_op(loaded):
    wh, _, msgs, step = loaded
    before = {t: wh.read(t).count() for t in ["formulaone", "laptimes", "constandings", "race"]}
    step(msgs, 0)                                  # the stream's epoch 0 delivered again
    assert {t: wh.read(t).count() for t in before} == before


def test_reports(loaded):
    wh, _, _, _ = loaded
    perf = {r.driverRef: r for r in R.driver_performance(wh).collect()}
    assert perf["max"].points == 50.0 and perf["max"].starts == 2 and len(perf) == 2
    st = rows(R.constructor_standings(wh), "season", "rank", "name")
    assert st[0] == (2024, 1, "Red Bull")
    stats = {r.race_id: r for r in R.race_statistics(wh).collect()}
    assert stats[0].best_lap_ms == 68100


def test_rejects_are_offered_again(loaded, spark):
    wh, _, _, step = loaded
    ghost = spark.createDataFrame(
        [FX.msg("driver_topic", "ghost", {"driverId": "ghost", "givenName": "G"}, 0, 900) + (None,)], TOPIC_SCHEMA)
    step(ghost, 1)                                   # the missing driver arrives in a later batch
    gid = [r.driverId for r in wh.read("driver").collect() if r.driverRef == "ghost"][0]
    laps = {(r.race_id, r.driverId, r.lap) for r in wh.read("laptimes").collect()}
    assert (0, gid, 5) in laps                       # the rejected lap time got in on retry
    fact = wh.read("formulaone").where(F.col("driverId") == gid).count()
    assert fact == 1                                 # so did the rejected result
    rej = rows(wh.read("rejects"), "topic", "reason")
    assert ("results_topic", "unknown driver") not in rej
    assert ("status_topic", "invalid status id") in rej  # not retryable: kept


def test_replay_after_crashes_equals_one_run(spark, scratch):
    """The batch stops after a table write, again and again at later tables, and is replayed to its end:
    the tables are those of an undisturbed run."""
    write_csv(spark.createDataFrame(FX.csv_rows(), CSV_TEXT_SCHEMA).coalesce(1), f"{scratch}/csv")
    msgs = spark.createDataFrame([m + (None,) for m in FX.stream_messages()], TOPIC_SCHEMA)
    whole, broken = Warehouse(spark, f"{scratch}/whole"), Warehouse(spark, f"{scratch}/broken")
    for wh in (whole, broken):
        load_csv(spark, f"{scratch}/csv", wh)
    P.process_batch(whole, msgs, season=2024)

    append = broken.append
    for stop in ("circuit", "qualifying", "laptimes", "formulaone", "standing_ids", "driverstandings"):
        def crashing(name, df, stop=stop):
            append(name, df)
            if name == stop:
                raise InterruptedError(name)

        broken.append = crashing
        with pytest.raises(InterruptedError):
            P.process_batch(broken, msgs, season=2024)
    broken.append = append
    P.process_batch(broken, msgs, season=2024)
    for table in set(whole.tables) - {"rejects", "batch_metrics"}:
        a = sorted(map(tuple, whole.read(table).collect()), key=repr)
        b = sorted(map(tuple, broken.read(table).collect()), key=repr)
        assert a == b, table


def test_other_seasons_and_bad_values_are_final(loaded, spark):
    wh, _, _, _ = loaded
    n = 2000
    bad = [FX.msg("laptimes_topic", "a", {"season": "2019", "round": 1, "lap": 1, "driverId": "max"}, 9, n),
           FX.msg("laptimes_topic", "b", {"round": 1, "lap": "x", "driverId": "max"}, 9, n + 1),
           FX.msg("laptimes_topic", "c", {"round": 1, "lap": 9, "driverId": "nobody"}, 9, n + 2),
           FX.msg("unheard_topic", "d", {}, 9, n + 3)]
    df = spark.createDataFrame([m + (None,) for m in bad], TOPIC_SCHEMA)
    for i in range(15):                              # however often other batches come, it waits
        P.process_batch(wh, df if i == 0 else df.limit(0), season=2024)
    got = {r.key: r.reason for r in wh.read("rejects").where("partition = 9").collect()}
    assert got == {"a": "other season", "b": "invalid lap", "c": "unknown driver"}
    late = [FX.msg("driver_topic", "nobody", {"driverId": "nobody"}, 9, n + 4)]
    P.process_batch(wh, spark.createDataFrame([m + (None,) for m in late], TOPIC_SCHEMA), season=2024)
    got = {r.key: r.reason for r in wh.read("rejects").where("partition = 9").collect()}
    assert got == {"a": "other season", "b": "invalid lap"}
    nobody = wh.read("driver").where("driverRef = 'nobody'").first().driverId
    assert wh.read("laptimes").where(F.col("driverId") == nobody).count() == 1


def test_a_message_may_wait_for_one_key_after_another(spark, scratch):
    """A lap misses its driver, then its race; the fastest lap follows when both have come, and a batch without
    new keys reads no waiting message."""
    write_csv(spark.createDataFrame(FX.csv_rows(), CSV_TEXT_SCHEMA).coalesce(1), f"{scratch}/csv")
    wh = Warehouse(spark, f"{scratch}/wh")
    load_csv(spark, f"{scratch}/csv", wh)

    def step(i, *msgs):
        rows = [m + (None,) for m in msgs]
        P.process_batch(wh, spark.createDataFrame(rows, TOPIC_SCHEMA), season=2024, batch_id=i, stream="s")

    lap = FX.msg("laptimes_topic", "l", {"season": "2024", "round": 9, "lap": 2, "driverId": "new", "time": "1:00.000"}, 0, 1)
    step(0, lap)
    reasons = lambda: [r.reason for r in wh.read("rejects").collect()]
    assert reasons() == ["unknown driver"]
    step(1, FX.msg("driver_topic", "new", {"driverId": "new"}, 0, 2))
    assert reasons() == ["unknown race"]
    step(2, FX.msg("status_topic", "7", {"statusId": "7", "status": "Other"}, 0, 3))
    assert P._released(wh) == (None, None) and reasons() == ["unknown race"]
    step(3, FX.msg("race_topic", "r", {"season": "2024", "round": "9", "raceName": "Nine"}, 0, 4))
    assert reasons() == []
    race = wh.read("race").where("round = 9").first()
    assert (race.fastestLap, race.fastestLapTime) == (2.0, "1:00.000")
    step(3, FX.msg("race_topic", "r", {"season": "2024", "round": "9", "raceName": "Nine"}, 0, 4))   # applied again
    assert reasons() == [] and wh.read("laptimes").where(F.col("race_id") == race.race_id).count() == 1


def test_two_streams_keep_their_standings(spark, scratch):
    """Messages of two streams that share a position are two standings, in both standings tables."""
    write_csv(spark.createDataFrame(FX.csv_rows(), CSV_TEXT_SCHEMA).coalesce(1), f"{scratch}/csv")
    wh = Warehouse(spark, f"{scratch}/wh")
    load_csv(spark, f"{scratch}/csv", wh)
    before = {t: wh.read(t).count() for t in ("driverstandings", "constandings")}
    for stream, (drv, con) in {"a": ("max", "rb"), "b": ("lewis", "merc")}.items():
        one = {"season": "2024", "round": "1", "position": "1", "positionText": "1", "points": "5"}
        rows = [FX.msg("driverstandings_topic", "k", one | {"Driver": {"driverId": drv}}, 0, 0) + (None,),
                FX.msg("constandings_topic", "k", one | {"Constructor": {"constructorId": con}}, 0, 0) + (None,)]
        for _ in range(2):                                                   # each batch is applied twice
            P.process_batch(wh, spark.createDataFrame(rows, TOPIC_SCHEMA), season=2024, batch_id=0, stream=stream)
    assert {t: wh.read(t).count() - n for t, n in before.items()} == {"driverstandings": 2, "constandings": 2}
    fact = {r.driverId: (r.driverStandingsId, r.conStandingsId) for r in wh.read("formulaone").where("raceId = 0").collect()}
    assert fact[0] != fact[1] and None not in (*fact[0], *fact[1])


def test_rejects_do_not_depend_on_the_split(spark, scratch):
    """The same messages in one batch, or one by one, leave the same tables and the same rejects."""
    write_csv(spark.createDataFrame(FX.csv_rows(), CSV_TEXT_SCHEMA).coalesce(1), f"{scratch}/csv")
    lap = lambda n, drv, rnd: FX.msg("laptimes_topic", f"l{n}", {"season": "2024", "round": rnd, "lap": n, "driverId": drv,
                                                                 "time": f"1:0{n}.000"}, 0, n)
    race = FX.msg("race_topic", "r", {"season": "2024", "round": "9", "raceName": "Nine"}, 0, 8)
    rows = [lap(1, "new", 9), lap(2, "max", 9), lap(3, "nobody", 1), FX.msg("driver_topic", "new", {"driverId": "new"}, 0, 5),
            lap(4, "new", 1), lap(4, "new", 1), race, lap(5, "new", 77)]
    seen = []
    for name, size in (("whole", len(rows)), ("single", 1)):
        wh = Warehouse(spark, f"{scratch}/{name}")
        load_csv(spark, f"{scratch}/csv", wh)
        for i in range(0, len(rows), size):
            part = [m + (None,) for m in rows[i:i + size]]
            P.process_batch(wh, spark.createDataFrame(part, TOPIC_SCHEMA), season=2024, batch_id=i, stream="s")
        names = wh.read("driver").select("driverId", "driverRef")
        laps = wh.read("laptimes").join(names, "driverId").select("driverRef", "race_id", "lap", "time_laptimes").distinct()
        seen.append((sorted(map(tuple, laps.collect())), rows_of(wh.read("rejects").select("key", "reason")),
                     rows_of(wh.read("race").select("round", "fastestLap", "fastestLapTime"))))
    assert seen[0] == seen[1]
    assert [r for r in seen[0][1] if r[1] != "duplicate key"] == [("l3", "unknown driver"), ("l5", "unknown race")]


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)
