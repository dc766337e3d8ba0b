"""Sources and sinks: write, then read back."""

import json
import os
import re

import pytest
from pyspark.sql.types import StringType, StructField, StructType

from pyspark.sql import functions as F

from tarmac.sources import pages, sinks, tables, topics
from tarmac.sources.csv import csv_rejects, read_wide_csv, with_arrival_number, write_csv
from tarmac.streaming.ingest import Ledger, keep_first_into, once, run_available_now


def test_versioned_table_replace_append_align(spark, scratch):
    t = tables.VersionedTable(spark, f"{scratch}/t")
    assert not t.exists()
    t.create(spark.createDataFrame([(1, 1.5)], "k long, v double"))
    t.append(spark.createDataFrame([(2, 2)], "k int, v int"))          # aligned to the table's types
    assert sorted(tuple(r) for r in t.read().collect()) == [(1, 1.5), (2, 2.0)]
    assert t.replace(t.read().where("k = 2")) == 2
    fresh = tables.VersionedTable(spark, f"{scratch}/t")                   # another reader
    assert fresh.version() == 2 and fresh.read().count() == 1
    t.append(spark.createDataFrame([(3, 3.0)], "k long, v double"))
    assert t.compact() == 3 and sorted(r.k for r in t.read().collect()) == [2, 3]


def test_stage_file_is_millisecond(spark, scratch):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 00:00:07.179575' AS ts")
    tables.write_stage(df, f"{scratch}/s")
    assert str(spark.read.parquet(f"{scratch}/s").first().ts) == "2024-01-01 00:00:07.179000"


def test_csv_sentinel_and_na_tokens(spark, scratch):
    schema = StructType([StructField("a", StringType()), StructField("b", StringType())])
    write_csv(spark.createDataFrame([("1", None), ("NA", "x")], schema).coalesce(1), f"{scratch}/c")
    got = read_wide_csv(spark, f"{scratch}/c", schema).orderBy("_arrival").collect()
    assert got[0]._arrival.file.endswith(".csv")
    assert [(r.a, r.b) for r in got] == [("1", "\\N"), (None, "x")]       # \N stays text, NA is null


def test_topic_messages_round_trip(spark, scratch):
    df = spark.createDataFrame([(1, "a", 2.5), (2, None, 1.0)], "id long, name string, v double")
    msgs = topics.to_messages(df, "t_topic", ["id", "name"], partitions=2)
    topics.write_messages(msgs, f"{scratch}/topic")
    back = topics.decode(topics.read_messages(spark, f"{scratch}/topic", "t_topic"),
                         "id BIGINT, name STRING, v DOUBLE")
    got = sorted((r.key, r.v.id, r.v.v) for r in back.collect())
    assert got == [("1_a", 1, 2.5), ("2", 2, 1.0)]                         # NULL part skipped in key
    offs = sorted((r.partition, r.offset) for r in back.collect())
    assert all(o >= 0 for _, o in offs)


def test_landed_pages_stop_at_first_empty_page(spark, scratch):
    root = f"{scratch}/pages"
    layout = {(1, 0): [1, 2], (1, 2): [3], (1, 4): [], (1, 6): [9], (2, 0): [], (2, 2): [5]}
    for (rnd, off), recs in layout.items():
        p = f"{root}/round={rnd}/offset={off}"
        os.makedirs(p, exist_ok=True)
        with open(f"{p}/page.json", "w") as fh:
            json.dump({"MRData": {"total": "9", "Items": [{"n": n} for n in recs]}}, fh)
    df = pages.read_landed_pages(spark, root, "MRData STRUCT<total: STRING, Items: ARRAY<STRUCT<n: BIGINT>>>, "
                                              "round INT, offset INT")
    kept = pages.until_empty(df, F.size(pages.records_at("MRData.Items")) > 0, ["offset"], group=["round"])
    flat = pages.flatten(kept, "MRData.Items", keep=["round"])
    assert sorted((r.round, r.rec.n) for r in flat.collect()) == [(1, 1), (1, 2), (1, 3)]


def test_landed_pages_query_reads_page_files_and_stops_at_the_total(spark, tmp_path):
    from tarmac.plans import q_pipelines as q

    ev = spark.range(400).selectExpr("id AS event_id", "CASE WHEN id < 95 THEN 5 WHEN id < 155 THEN 10 WHEN id < 230 THEN 7 "
                                     "WHEN id < 330 THEN 1005 ELSE 1007 END AS user_id",
                                     "timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, id) AS ts")
    root = f"{tmp_path}/landed"
    q.land_pages(spark, ev, root)
    assert sorted(os.listdir(f"{root}/pages/folder=5")) == [f"offset={o}" for o in (0, 120, 30, 60, 90)]
    assert sum(f.endswith(".txt") for f in os.listdir(f"{root}/pages/folder=10/offset=60")) == 1
    read = q.read_pages(spark, root)
    assert [r.folder for r in pages.corrupt_pages(read).select("folder", "MRData", "_corrupt").collect()] == [-1, -1]
    past = read.where("offset >= CAST(MRData.total AS BIGINT)").select("folder", "offset", "MRData.Items.event_id").collect()
    assert sorted(map(tuple, past)) == [(5, 120, [-1]), (10, 60, [-1]), (1005, 120, [-1])]
    ev.write.parquet(f"{tmp_path}/d/events.parquet")
    got = sorted((r.event_id, r.user_id, r.offset) for r in q.landed_pages(spark, f"{tmp_path}/d").collect())
    want, at = [], {}
    for r in ev.orderBy("event_id").collect():
        n = at[r.user_id] = at.get(r.user_id, -1) + 1
        if r.user_id % 7 or n < 30:
            want.append((r.event_id, r.user_id, n // 30 * 30))
    assert got == want


def test_fan_out_by_column(spark, scratch):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3)], "target string, v long")
    sinks.fan_out_by(df, "target", f"{scratch}/fan")
    assert spark.read.parquet(f"{scratch}/fan/target=a").count() == 2


def test_truncate_catalog_tables(spark):
    spark.sql("CREATE TABLE IF NOT EXISTS tarmac_trunc (k BIGINT) USING parquet")
    spark.sql("INSERT INTO tarmac_trunc VALUES (1), (2)")
    assert "tarmac_trunc" in tables.list_tables(spark)
    tables.truncate_all(spark)
    assert spark.table("tarmac_trunc").count() == 0
    spark.sql("DROP TABLE tarmac_trunc")


def test_stream_equals_batch_for_any_split(spark, scratch):
    """Keep-first over micro-batches equals keep-first over the whole input
    when each key lives in one source file (a keyed partition)."""
    rows = [(i % 5, i, f"v{i}") for i in range(40)]
    df = spark.createDataFrame(rows, "k long, t long, v string")
    src = f"{scratch}/src"
    df.repartition(4, "k").write.parquet(src)
    target = tables.VersionedTable(spark, f"{scratch}/target")
    target.create(df.limit(0))
    fn = once(Ledger(spark, target.root), keep_first_into(target, ["k"], ["t"]))
    run_available_now(spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(src),
                      fn, f"{scratch}/ckpt")
    got = sorted(tuple(r) for r in target.read().collect())
    assert got == sorted((k, k, f"v{k}") for k in range(5))
    run_available_now(spark.readStream.schema(df.schema).parquet(src), fn, f"{scratch}/ckpt")  # resume: no-op
    assert target.read().count() == 5


def test_dedup_within_watermark_stream(spark, scratch):
    from tarmac.streaming.ingest import dedup_within_watermark

    rows = [(1, "a", "2024-01-01 00:00:00"), (1, "a", "2024-01-01 00:00:05"), (2, "b", "2024-01-01 00:00:01")]
    df = spark.createDataFrame(rows, "k long, v string, t string").selectExpr("k", "v", "CAST(t AS TIMESTAMP) AS ts")
    df.write.parquet(f"{scratch}/src")
    stream = dedup_within_watermark(spark.readStream.schema(df.schema).parquet(f"{scratch}/src"), ["k"], "ts")
    got = []
    run_available_now(stream, lambda b, i: got.extend(tuple(r) for r in b.select("k", "v").collect()),
                      f"{scratch}/ckpt")
    assert sorted(got) == [(1, "a"), (2, "b")]


def test_partitioned_table_overwrites_only_touched_partitions(spark, scratch):
    t = tables.PartitionedTable(spark, f"{scratch}/p", ["part"])
    t.create(spark.createDataFrame([(1, 1, "a"), (2, 1, "b"), (3, 2, "c")], "k long, part int, v string"))
    t.append(spark.createDataFrame([(4, 3, "d")], "k long, part int, v string"))
    cur = t.read()
    changed = cur.where("part = 1").withColumn("v", F.upper("v"))          # reads the table it replaces
    t.overwrite_partitions(changed)
    assert sorted((r.k, r.part, r.v) for r in t.read().collect()) == [(1, 1, "A"), (2, 1, "B"), (3, 2, "c"),
                                                                      (4, 3, "d")]
    touched = t.read_touched(spark.createDataFrame([(3,)], "part int"))
    assert [r.k for r in touched.collect()] == [4]
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    try:
        again = t.read_touched(spark.createDataFrame([(3,)], "part int"))
        again.collect()
        plan = again._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert re.search(r"PartitionFilters: \[[^\]]*part#\d+ >= 3", plan)              # static pruning by range


def test_empty_partitioned_table_has_a_schema(spark, scratch):
    t = tables.PartitionedTable(spark, f"{scratch}/p", ["part"])
    t.create(spark.createDataFrame([], "part int, k long"))
    fresh = tables.PartitionedTable(spark, f"{scratch}/p", ["part"])
    assert fresh.read().columns == ["k", "part"] and fresh.read().count() == 0
    fresh.append(spark.createDataFrame([(1, 2)], "part int, k long"))
    assert fresh.read().collect()[0].k == 2


def test_a_failing_read_never_replaces_a_table(spark, scratch):
    """Only a missing path means "no table"; any other error is raised and the rows stay."""
    rows = spark.range(30).selectExpr("id AS k", "id % 3 AS part")
    for t in (tables.VersionedTable(spark, f"{scratch}/v"), tables.PartitionedTable(spark, f"{scratch}/p", ["part"])):
        t.create(rows)
        broken = type(t)(spark, t.root, ["part"]) if hasattr(t, "by") else type(t)(spark, t.root)

        class Failing:
            """Stands in for a session whose reads fail."""
            def __getattr__(self, name):
                raise OSError("storage is away")

        broken.spark = Failing()
        with pytest.raises(OSError):
            broken.append(spark.range(1).selectExpr("id AS k", "id AS part"))
        assert t.read().count() == 30
    ledger = Ledger(spark, f"{scratch}/l")
    ledger.record(0, "s")
    ledger.spark, ledger._known = Failing(), set()
    with pytest.raises(OSError):
        ledger.applied(0, "s")


def test_vacuum_keeps_the_latest_versions(spark, scratch):
    t = tables.VersionedTable(spark, f"{scratch}/v")
    for i in range(4):
        t.replace(spark.range(i + 1))
    assert t.vacuum(keep=2) == [1, 2]
    assert tables.VersionedTable(spark, f"{scratch}/v").read().count() == 4


def test_csv_follows_the_header(spark, scratch):
    os.makedirs(f"{scratch}/c")
    with open(f"{scratch}/c/a.csv", "w") as fh:
        fh.write('extra,b,a\nx,B1,A1\ny,"say ""hi"", ok\nnext line",A2\nz,B3,A3,too many\n')
    schema = StructType([StructField("a", StringType()), StructField("absent", StringType()), StructField("b", StringType())])
    got = read_wide_csv(spark, f"{scratch}/c", schema, arrival_col=None)
    assert got.columns == ["a", "b"]
    assert sorted(map(tuple, got.collect())) == [("A1", "B1"), ("A2", 'say "hi", ok\nnext line')]
    assert [r.record.strip() for r in csv_rejects(spark, f"{scratch}/c").collect()] == ["z,B3,A3,too many"]


def test_arrival_numbers_follow_files_and_rows(spark, scratch):
    schema = StructType([StructField("a", StringType())])
    rows = spark.range(1000).selectExpr("cast(id AS string) AS a", "id").repartitionByRange(5, "id").sortWithinPartitions("id")
    write_csv(rows.select("a"), f"{scratch}/c")
    got = with_arrival_number(read_wide_csv(spark, f"{scratch}/c", schema)).orderBy("_arrival").collect()
    assert [int(r.a) for r in got] == list(range(1000)) and isinstance(got[0]._arrival, int)


def test_a_second_stream_into_the_same_tables_is_not_skipped(spark, scratch):
    seen = []
    ledger = Ledger(spark, f"{scratch}/wh")
    for name in ("one", "two"):
        spark.createDataFrame([(name,)], "v string").write.parquet(f"{scratch}/{name}")
        ckpt = f"{scratch}/ckpt-{name}"
        fn = once(ledger, lambda b, i: seen.extend(r.v for r in b.collect()), "s", checkpoint=ckpt)
        run_available_now(spark.readStream.schema("v string").parquet(f"{scratch}/{name}"), fn, ckpt)
    assert seen == ["one", "two"]


def test_publishes_continue_offsets_in_production_order(spark, scratch):
    for a, b in ((0, 50), (50, 80)):
        m = spark.range(a, b).selectExpr("cast(id % 7 AS string) AS key", "cast(id AS string) AS value", "'t' AS topic",
                                         "struct(id AS s0) AS seq")
        topics.publish(m, f"{scratch}/t")
    got = topics.read_messages(spark, f"{scratch}/t").orderBy("partition", "offset").collect()
    at = [(r.partition, r.offset) for r in got]
    assert len(set(at)) == 80
    for p in {x for x, _ in at}:
        assert [o for q, o in at if q == p] == list(range(sum(q == p for q, _ in at)))
        assert [int(r.value) for r in got if r.partition == p] == sorted(int(r.value) for r in got if r.partition == p)


def test_a_malformed_page_stops_nothing(spark, scratch):
    for off, text in ((0, '{"Items": [1]}'), (30, '{"Items": ['), (60, '{"Items": [2]}'), (90, '{"Items": []}'), (120, '{"Items": [3]}')):
        os.makedirs(f"{scratch}/p/offset={off}")
        with open(f"{scratch}/p/offset={off}/page.json", "w") as fh:
            fh.write(text)
    df = pages.read_landed_pages(spark, f"{scratch}/p", "Items ARRAY<BIGINT>, offset INT")
    kept = pages.until_empty(df, F.size(pages.records_at("Items")) > 0, ["offset"])
    assert sorted(r.rec for r in pages.flatten(kept, "Items").collect()) == [1, 2]
    assert [r.offset for r in pages.corrupt_pages(df).collect()] == [30]
