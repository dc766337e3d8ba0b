"""Results and standings of a batch: how often messages are decoded, and the reasons of rejects."""

import pytest
from plan_log import PlanLog
from pyspark.sql import functions as F

import f1_fixture as FX
from tarmac.plans import processors as P
from tarmac.plans.q_pipelines import _warehouse
from tarmac.sources.topics import TOPIC_SCHEMA

ONE = {"season": "2024", "round": "1", "position": "1", "points": "5"}


def batch(spark, rows):
    return spark.createDataFrame([m + (None,) for m in rows], TOPIC_SCHEMA).withColumn("stream", F.lit("s"))


@pytest.fixture()
def wh(spark, scratch):
    """A driver, a constructor and a race."""
    out = _warehouse(spark, f"{scratch}/wh")
    P.process_batch(out, batch(spark, [
        FX.msg("driver_topic", "max", {"driverId": "max"}, 0, 0), FX.msg("constructor_topic", "rb", {"constructorId": "rb"}, 0, 0),
        FX.msg("race_topic", "r", {"season": "2024", "round": "1", "raceName": "One"}, 0, 0)]).drop("stream"), season=2024, stream="s")
    return out


def test_messages_are_decoded_once(spark, wh):
    log = PlanLog(spark)
    for name, value in {"results": {"driverId": "max"}, "driverstandings": {"Driver": {"driverId": "max"}},
                        "constandings": {"Constructor": {"constructorId": "rb"}}}.items():
        msgs = batch(spark, [FX.msg(f"{name}_topic", f"k{i}", ONE | {"position": str(i % 3)} | value, 0, i) for i in range(9)])
        log.new_plans()
        getattr(P, f"process_{name}")(wh, msgs, season=2024).checkpoint()
        assert sum("from_json(" in p for p in log.new_plans()) == 1, name


@pytest.mark.parametrize("few", [P.FEW, 0])
def test_reasons_of_rejected_results(spark, wh, monkeypatch, few):
    """Each message has one reason, the first that holds; copies of one message are duplicates."""
    monkeypatch.setattr(P, "FEW", few)
    result = lambda n, **v: FX.msg("results_topic", f"k{n}", ONE | {"driverId": "max"} | v, 0, n)
    rows = [result(0), result(0), result(1), result(2, driverId="nobody", season="x"), result(3, season="x", round="9"),
            result(4, season="2019", round="9"), result(5, round="9"), result(6, driverId=None)]
    got = P.process_results(wh, batch(spark, rows), season=2024).select("key", "reason", "kind", "ref").collect()
    assert sorted(map(tuple, got), key=str) == [
        ("k0", "duplicate key", None, None), ("k1", "duplicate key", None, None), ("k2", "unknown driver", "driver", "nobody"),
        ("k3", "invalid season or round", None, None), ("k4", "other season", None, None),
        ("k5", "unknown race", "race", "2024_9"), ("k6", "unknown driver", "driver", None)]
    assert [r.points for r in wh.read("formulaone").collect()] == [5.0]


def test_standings_without_a_position(spark, wh):
    """All of them are rejects, however many share a race."""
    rows = [FX.msg("driverstandings_topic", f"k{i}", ONE | {"position": "x" if i else "1", "Driver": {"driverId": "max"}}, 0, i) for i in range(4)]
    got = P.process_driverstandings(wh, batch(spark, rows), season=2024).select("key", "reason").collect()
    assert sorted(map(tuple, got)) == [(f"k{i}", "invalid position") for i in (1, 2, 3)]
    assert wh.read("driverstandings").count() == 1
