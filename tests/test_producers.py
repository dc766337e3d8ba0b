"""Landed pages -> keyed messages, with the paging stop rules."""

import json
import os

from pyspark.sql import functions as F

from tarmac import schemas as S
from tarmac.plans import producers as PR


def land(root, kind, parts, doc):
    p = os.path.join(root, kind, *[f"{k}={v}" for k, v in parts])
    os.makedirs(p, exist_ok=True)
    with open(os.path.join(p, "page.json"), "w") as fh:
        json.dump({"MRData": doc}, fh)


def races(**race):
    return {"total": "1", "RaceTable": {"Races": [dict({"season": "2024", "round": "1"}, **race)]}}


def test_producers(spark, scratch):
    root = scratch
    land(root, "status", [("offset", 0)], {"StatusTable": {"Status": [{"statusId": "1", "status": "Finished"}]}})
    land(root, "laptimes", [("round", 1), ("lap", 1)], races(Laps=[{"number": "1", "Timings": [
        {"driverId": "max", "position": "1", "time": "1:10.040"}]}]))
    land(root, "laptimes", [("round", 1), ("lap", 2)], races(Laps=[]))                       # empty: stop
    land(root, "laptimes", [("round", 1), ("lap", 3)], races(Laps=[{"number": "3", "Timings": [
        {"driverId": "max", "position": "1", "time": "1:09.000"}]}]))
    land(root, "pitstops", [("round", 1), ("offset", 0)], races(PitStops=[
        {"driverId": "max", "lap": "12", "stop": "1", "time": "14:00:00", "duration": "23.004"},
        {"driverId": "max", "lap": "50", "stop": "11", "time": "15:00:00", "duration": "1:02.1"}]))
    land(root, "results", [("round", 1), ("offset", 0)], races(Results=[
        {"number": "33", "position": "1", "positionText": "1", "points": "25", "Driver": {"driverId": "max"},
         "Constructor": {"constructorId": "rb"}, "grid": "1", "laps": "53", "status": "Finished",
         "Time": {"millis": "5400000", "time": "1:30:00.000"},
         "FastestLap": {"rank": "1", "lap": "44", "Time": {"time": "1:20.000"}}}]))
    land(root, "results", [("round", 2), ("offset", 0)], races(round="2", Results=[]))       # stops all later
    land(root, "results", [("round", 3), ("offset", 0)], races(round="3", Results=[
        {"number": "1", "position": "1", "Driver": {"driverId": "x"}}]))
    land(root, "race", [("offset", 0)], {"RaceTable": {"Races": [
        {"season": "2023", "round": "5", "raceName": "Old"}, {"season": "2024", "round": "1", "raceName": "New"}]}})
    land(root, "race", [("offset", 30)], {"RaceTable": {"Races": []}})                         # empty: stop
    land(root, "race", [("offset", 60)], {"RaceTable": {"Races": [{"season": "2001", "round": "1"}]}})
    land(root, "race_current", [("offset", 0)], {"RaceTable": {"Races": [{"season": "2024", "round": "2"}]}})
    land(root, "status", [("offset", 30)], {"StatusTable": {"Status": []}})
    land(root, "status", [("offset", 60)], {"StatusTable": {"Status": [{"statusId": "9", "status": "Late"}]}})
    land(root, "constandings", [("offset", 0)], {"StandingsTable": {"StandingsLists": [
        {"season": "2024", "round": "1", "ConstructorStandings": [
            {"position": "1", "positionText": "1", "points": "43", "wins": "1",
             "Constructor": {"constructorId": "rb"}}]}]}})

    assert [r.key for r in PR.generic(spark, root, "status").collect()] == ["1"]
    laps = PR.laptimes(spark, root).collect()
    assert [r.key for r in laps] == ["max_1_1"]                                              # lap 3 dropped
    msgs, rejected = PR.pitstops(spark, root)
    assert [r.key for r in msgs.collect()] == ["1_1_max"] and rejected.count() == 1          # P8
    res = PR.results(spark, root)
    assert [r.key for r in res.collect()] == ["max_1"]                                       # Q20
    v = res.select(F.from_json("value", S.RESULT_VALUE).alias("v")).first().v
    assert v.FastestLap.rank == "1" and v.milliseconds == "5400000" and v.season == "2024"
    assert sorted(r.key for r in PR.races(spark, root, history_until=2023).collect()) == ["2023_5", "2024_2"]   # P6 + O1
    cs = PR.standings(spark, root, "constandings").collect()
    assert [r.key for r in cs] == ["rb_2024_1"]


def test_results_pages_end_within_a_round_and_at_the_total(spark, scratch):
    """An empty end page of a round does not end the rounds; a total does end its pages."""
    def res(d):
        return [{"number": "1", "position": "1", "Driver": {"driverId": d}}]

    def page(rnd, off, recs, total="1"):
        doc = races(round=str(rnd), Results=recs)
        land(scratch, "results", [("round", rnd), ("offset", off)], dict(doc, total=total))

    page(1, 0, res("a"), "60")
    page(1, 30, [], "60")                                # end page of round 1
    page(2, 0, res("b"), "31")
    page(2, 30, res("c"), "31")
    page(2, 60, res("beyond"), "31")                     # at an offset past the total
    page(3, 0, [])                                       # a round without data: no later rounds
    page(4, 0, res("late"))
    assert sorted(r.key for r in PR.results(spark, scratch).collect()) == ["a_1", "b_2", "c_2"]
    assert PR.page_rejects(spark, scratch, "results", "round INT, offset INT").count() == 0


def test_published_messages_reach_the_stream(spark, scratch):
    from tarmac.sources.topics import publish, read_messages

    root = f"{scratch}/pages"
    land(root, "status", [("offset", 0)], {"StatusTable": {"Status": [{"statusId": "1", "status": "Finished"},
                                                                      {"statusId": "2", "status": "+1 Lap"}]}})
    publish(PR.generic(spark, root, "status"), f"{scratch}/topics", partitions=2)
    got = read_messages(spark, f"{scratch}/topics", "status_topic").collect()
    assert sorted(r.key for r in got) == ["1", "2"]
    offsets = sorted((r.partition, r.offset) for r in got)
    assert all(o >= 0 for _, o in offsets) and len(set(offsets)) == 2


def test_pages_are_landed_by_many_tasks(spark, scratch):
    """A page costs a file however small it is, so the bytes of the pages do not set the number of writing tasks."""
    import glob
    import os

    from tarmac.sources import pages

    docs = spark.range(60).selectExpr("id AS folder", "id % 2 * 30 AS offset", "'{}' AS value")
    pages.land(docs, f"{scratch}/landed", ["folder", "offset"], deal=["folder"])
    files = glob.glob(f"{scratch}/landed/folder=*/offset=*/part-*")
    assert len(files) == 60 and len({os.path.basename(f).split("-")[1] for f in files}) > 4
