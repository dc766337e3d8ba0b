"""The documented flow: landed pages -> producers -> topic folder -> stream
ingest -> warehouse tables, on top of the hostile fixture's batch load."""

import f1_fixture as FX
from test_producers import land, races

from tarmac.plans import processors as P
from tarmac.plans import producers as PR
from tarmac.plans.warehouse import Warehouse, load_csv
from tarmac.schemas import CSV_TEXT_SCHEMA
from tarmac.sources.csv import write_csv
from tarmac.sources.topics import publish, read_message_stream


def test_pages_to_tables(spark, scratch):
    write_csv(spark.createDataFrame(FX.csv_rows(), CSV_TEXT_SCHEMA).coalesce(1), f"{scratch}/csv")
    wh = Warehouse(spark, f"{scratch}/wh")
    load_csv(spark, f"{scratch}/csv", wh)

    pages = f"{scratch}/pages"
    land(pages, "status", [("offset", 0)], {"StatusTable": {"Status": [{"statusId": "7", "status": "Engine"}]}})
    land(pages, "race_current", [("offset", 0)], {"RaceTable": {"Races": [
        {"season": "2024", "round": "3", "raceName": "GP Three", "date": "2024-04-01", "time": "05:00:00Z",
         "Circuit": {"circuitId": "monza", "circuitName": "Monza", "Location": {"lat": "45.6", "long": "9.2"}}}]}})
    land(pages, "race", [("offset", 0)], {"RaceTable": {"Races": []}})
    land(pages, "laptimes", [("round", 1), ("lap", 7)], races(Laps=[{"number": "7", "Timings": [
        {"driverId": "max", "position": "1", "time": "1:10.040"}]}]))
    topics = f"{scratch}/topics"
    publish(PR.generic(spark, pages, "status"), topics)
    publish(PR.races(spark, pages, history_until=2023), topics)
    publish(PR.laptimes(spark, pages), topics)

    P.ingest_topics(wh, read_message_stream(spark, topics), f"{scratch}/ckpt", season=2024)

    assert ("Engine",) in [(r.status_name,) for r in wh.read("status").collect()]
    race = {r.round: r for r in wh.read("race").collect()}
    assert race[3].circuitId == 0 and race[3].time_races == "05:00:00"        # known circuit reused
    laps = {(r.race_id, r.driverId, r.lap): r.milliseconds_laptimes for r in wh.read("laptimes").collect()}
    assert laps[(0, 0, 7)] == 70040


def test_split_batches_equal_one_batch(spark, scratch):
    """SURVEY §5.4: any split into micro-batches gives the batch answer."""
    from pyspark.sql import functions as F

    from tarmac.sources.topics import TOPIC_SCHEMA

    write_csv(spark.createDataFrame(FX.csv_rows(), CSV_TEXT_SCHEMA).coalesce(1), f"{scratch}/csv")
    msgs = spark.createDataFrame([m + (None,) for m in FX.stream_messages()], TOPIC_SCHEMA)
    dims = ["status_topic", "driver_topic", "constructor_topic", "race_topic"]
    one, two = Warehouse(spark, f"{scratch}/one"), Warehouse(spark, f"{scratch}/two")
    for wh in (one, two):
        load_csv(spark, f"{scratch}/csv", wh)
    P.process_batch(one, msgs, season=2024)
    P.process_batch(two, msgs.where(F.col("topic").isin(dims)), season=2024)
    P.process_batch(two, msgs.where(~F.col("topic").isin(dims)), season=2024)
    for table in ["status", "driver", "constructor", "race", "circuit", "laptimes", "pitstops", "formulaone",
                  "constandings", "driverstandings", "sprint", "freepractice"]:
        a = sorted(map(tuple, one.read(table).collect()), key=repr)
        b = sorted(map(tuple, two.read(table).collect()), key=repr)
        assert a == b, table
