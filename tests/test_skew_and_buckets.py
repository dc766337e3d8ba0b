"""Heavy keys are spread over tasks; a bucketed target is neither shuffled nor fully read by a batch."""

import json
import statistics

from plan_log import PlanLog
import pytest
from pyspark.sql import functions as F

from tarmac.operators import lookup
from tarmac.sources.bucketed import BucketedTable


def test_heavy_keys_are_named(spark):
    df = spark.range(30_000).selectExpr("if(id % 3 = 0, 0, id) AS a", "cast(if(id % 5 = 0, 1, id) AS int) AS b")
    top = {r[0] for r in df.groupBy(F.xxhash64("a").alias("h")).count().where("count >= 300").select("h").collect()}
    assert set(lookup.heavy_keys(df, ["a"], 0.01)) == top
    assert lookup.heavy_keys(df.limit(0), ["a"], 0.01) == []
    assert lookup.heavy_keys(spark.range(1000).toDF("a"), ["a"], 0.01) == []


def test_no_task_gets_a_third_of_the_rows(spark):
    """A key of a third of the rows: the rows of a join task are at most three times the median's."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.range(90_000).selectExpr("id", "if(id % 3 = 0, 0, id) AS a", "if(id % 3 = 0, 0, 1) AS b").repartition(16)
        dim = spark.range(90_000).selectExpr("cast(id AS int) AS a", "if(id = 0, 0, 1) AS b", "id * 10 AS x")
        got = lookup.resolve_spread(df, dim, ["a", "b"], ["x"], parts=64)
        tasks = [r[0] for r in got.groupBy(F.spark_partition_id()).count().select("count").collect()]
        assert max(tasks) <= 3 * statistics.median(tasks)
        plain = [r[0] for r in df.join(dim.hint("merge"), ["a", "b"]).groupBy(F.spark_partition_id()).count().select("count").collect()]
        assert max(plain) > 3 * statistics.median(plain)
        assert got.count() == 90_000 and got.where("x <> a * 10").count() == 0 and got.columns == ["a", "b", "id", "x"]
        left = lookup.resolve_spread(df, dim.where("a > 5"), ["a", "b"], ["x"], how="left", parts=64)
        assert left.count() == 90_000 and left.where("x IS NULL").count() == 30_000 + 4
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def bytes_read(log, at):
    log.sc._jsc.sc().listenerBus().waitUntilEmpty(60_000)
    with open(log.path, errors="replace") as f:
        f.seek(at)
        tasks = [json.loads(x) for x in f if '"SparkListenerTaskEnd"' in x]
    return sum(t["Task Metrics"]["Input Metrics"]["Bytes Read"] for t in tasks if t.get("Task Metrics"))


def end_of(log):
    log.sc._jsc.sc().listenerBus().waitUntilEmpty(60_000)
    with open(log.path, errors="replace") as f:
        return f.seek(0, 2)


def test_a_batch_does_not_shuffle_or_read_the_whole_target(spark, scratch):
    table = BucketedTable(spark, f"{scratch}/t", ["k", "g"])
    rows = spark.range(400_000).selectExpr("id AS k", "xxhash64(id) AS g", "sha2(cast(id AS string), 256) AS pay")
    table.create(rows.where("k < 100000"))
    for i in (1, 2, 3):
        table.append(rows.where(f"k >= {i * 100000} AND k < {(i + 1) * 100000}"))
    batch = rows.where("k >= 390000").unionByName(spark.range(400_000, 400_500).selectExpr("id AS k", "xxhash64(id) AS g", "'new' AS pay"))
    batch = batch.unionByName(batch).unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) AS k, 1L AS g, 'no key' AS pay")).checkpoint()
    log = PlanLog(spark)
    spark.conf.set("parquet.hadoop.vectored.io.enabled", "false")      # its bytes are not in the task's metrics
    table.read().select("k", "g").write.format("noop").mode("overwrite").save()
    start = end_of(log)
    table.read().select("k", "g").write.format("noop").mode("overwrite").save()
    whole = bytes_read(log, start)
    near = table.near(batch)
    start = end_of(log)
    near.write.format("noop").mode("overwrite").save()
    assert bytes_read(log, start) < whole / 2
    spark.conf.unset("parquet.hadoop.vectored.io.enabled")
    log.new_plans()
    new = table.new_rows(batch, ["pay"])
    assert sorted((r.k, r.pay) for r in new.collect()) == [(k, "new") for k in range(400_000, 400_500)]
    (plan,) = [p for p in log.new_plans() if "LeftAnti" in p]
    target = plan[plan.index("LeftAnti"):]
    scan = target[target.index("FileScan parquet spark_catalog"):].splitlines()[0] if "FileScan parquet spark_catalog" in target else target
    # on the way from the join to the target's scan there is no exchange; the batch's side has the only one
    side = plan[:plan.index("tarmac_")].splitlines()
    depth = len(side[-1]) - len(side[-1].lstrip(" :+-*()0123456789"))
    assert "Bucketed: true" in scan
    path = [x for x in side if "Exchange" in x and len(x) - len(x.lstrip(" :+-*()0123456789")) > depth]
    assert not path and plan.count("Exchange hashpartitioning") == 1
    table.insert(batch, ["pay"])
    table.insert(batch, ["pay"])
    assert table.read().count() == 400_500
    spark.sql(f"DROP TABLE {table.name}")                                  # another session finds the folder again
    assert BucketedTable(spark, f"{scratch}/t", ["k", "g"]).read().count() == 400_500


@pytest.mark.parametrize("write", ["append", "put"])
def test_one_partition_value_is_written_by_many_tasks(spark, scratch, monkeypatch, write):
    """Beyond the rows of a task a partition is dealt over several, also where adaptive plans are off (streams)."""
    import glob

    from tarmac.sources import tables

    monkeypatch.setattr(tables, "ROWS_A_TASK", 100)
    rows = spark.range(1_000).selectExpr("id", "'x' AS part").unionByName(spark.range(5).selectExpr("id", "'y' AS part"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        table = tables.PartitionedTable(spark, f"{scratch}/t", ["part"])
        getattr(table, write)(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sorted(map(tuple, table.read().select("id", "part").collect())) == sorted([(i, "x") for i in range(1_000)] + [(i, "y") for i in range(5)])
    assert len(glob.glob(f"{scratch}/t/part=x/*.parquet")) >= 5 and len(glob.glob(f"{scratch}/t/part=y/*.parquet")) <= 2
