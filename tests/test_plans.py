"""Plan-shape checks over all executions of every query of ``tarmac.plans``, from the event log:
writes, checkpoints and micro-batches included."""

import re

import pytest

from paths import SF_SMALL
from plan_log import PlanLog
from tarmac.plans import QUERIES

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow"]


@pytest.fixture(scope="module")
def plans(spark):
    log, out = PlanLog(spark), {}
    for name, fn in QUERIES.items():
        log.new_plans()
        fn(spark, SF_SMALL).write.format("noop").mode("overwrite").save()
        out[name] = log.new_plans()
        assert out[name], name
    return out


def test_no_cross_join_or_python(plans):
    bad = {n: [f for f in FORBIDDEN for p in ps if f in p] for n, ps in plans.items()}
    assert not {n: f for n, f in bad.items() if f}


def test_no_unpartitioned_window_over_data(plans):
    # The only unpartitioned window allowed is over per-partition block counts.
    for name, ps in plans.items():
        for p in ps:
            for m in re.finditer(r"Window \[(.*?)\], \[\],", p):
                assert "_n" in m.group(1), (name, m.group(0)[:200])


def test_top1_has_partial_group_limit_before_shuffle(plans):
    p = "\n".join(plans["top1_per_group"])
    assert "WindowGroupLimit" in p and "Partial" in p


def test_loads_aggregate_by_hash(plans):
    for name in ("load_dimension", "load_child_fact", "load_fact"):
        assert "SortAggregate" not in "\n".join(plans[name]), name


def test_micro_batches_are_in_the_log(plans):
    assert len(plans["stream_drain"]) > 4 and len(plans["stream_warehouse"]) > 20
