"""Queries for streams (T1-T9), paged documents (S5/S6/P14/F22) and fan-out (K5).

Each writes its intermediate data under the shared checkpoint folder and
returns a DataFrame over what the stream produced.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..functions import clean as C
from ..session import work_path
from ..sources import pages, sinks
from ..sources.bucketed import BucketedTable
from ..sources.tables import VersionedTable
from ..streaming.ingest import Ledger, ids_into, keep_first_into, once, run_available_now
from .registry import SQL_TS_FMT, query, tbl, ts_lit, ts_text

EVENT_COLS = ["event_id", "user_id", "event_type", "ts", "value"]
RECORD_DDL = "event_id BIGINT, user_id BIGINT, event_type STRING, ts TIMESTAMP_NTZ, value DOUBLE"


@query("stream_drain", f"""
SELECT event_id, user_id, event_type, strftime(ts, '{SQL_TS_FMT}') AS ts, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY events.ts, event_id) = 1
""")
def stream_drain(spark, d, files: int = 4):
    """Events land as ``files`` files partitioned by key (as a keyed
    producer would), one micro-batch per file via ``availableNow``; each batch
    keeps its first row per (user, type) and skips keys already stored."""
    root = work_path(spark, "stream_drain")
    ev = tbl(spark, d, "events").select(*EVENT_COLS)
    ev.repartition(files, "user_id").write.parquet(f"{root}/source")
    target = VersionedTable(spark, f"{root}/target")
    target.create(ev.limit(0))
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/source")
    fn = once(Ledger(spark, target.root), keep_first_into(target, ["user_id", "event_type"], ["ts", "event_id"]),
              checkpoint=f"{root}/checkpoint")
    run_available_now(stream, fn, f"{root}/checkpoint")
    return target.read().select("event_id", "user_id", "event_type", ts_text("ts").alias("ts"), "value")


BATCH1_END = "2024-01-02"


@query("stream_ids", f"""
WITH b1 AS (SELECT user_id, MIN(ts) AS f FROM events WHERE ts < TIMESTAMP '{BATCH1_END}' GROUP BY user_id),
i1 AS (SELECT user_id, row_number() OVER (ORDER BY f, user_id) AS uid FROM b1),
b2 AS (SELECT user_id, MIN(ts) AS f FROM events WHERE ts >= TIMESTAMP '{BATCH1_END}' GROUP BY user_id),
n2 AS (SELECT * FROM b2 WHERE NOT EXISTS (SELECT 1 FROM i1 WHERE i1.user_id = b2.user_id)),
i2 AS (SELECT user_id, (SELECT COALESCE(MAX(uid), 0) FROM i1) + row_number() OVER (ORDER BY f, user_id) AS uid FROM n2)
SELECT user_id, CAST(uid AS BIGINT) AS uid FROM i1
UNION ALL SELECT user_id, CAST(uid AS BIGINT) AS uid FROM i2
""")
def stream_ids(spark, d):
    """T5 + T6: two scheduled runs of one stream (checkpoint resumes); users new
    in the second run get ids after the first run's max, known users keep theirs."""
    root = work_path(spark, "stream_ids")
    ev = tbl(spark, d, "events").select("user_id", "ts", "event_id")
    src, ckpt = f"{root}/source", f"{root}/checkpoint"
    schema = StructType([StructField("user_id", LongType()), StructField("uid", LongType())])
    dim = VersionedTable(spark, f"{root}/users")
    dim.create(spark.createDataFrame([], schema))
    prepare = lambda b: b.groupBy("user_id").agg(F.min("ts").alias("first_ts"))
    fn = once(Ledger(spark, dim.root), ids_into(dim, "user_id", "uid", ["first_ts", "user_id"], prepare), checkpoint=ckpt)
    for part in (F.col("ts") < ts_lit(BATCH1_END), F.col("ts") >= ts_lit(BATCH1_END)):
        ev.where(part).write.mode("append").parquet(src)
        run_available_now(spark.readStream.schema(ev.schema).parquet(src), fn, ckpt)
    return dim.read()


@query("variant_payload", """
WITH e AS (SELECT event_id, event_id % 5 AS kind, event_type FROM events)
SELECT event_id AS id, 'document' AS shape, 'value' AS state, event_type AS name FROM e WHERE kind = 0
UNION ALL SELECT -event_id - 1, 'document', 'missing', NULL FROM e WHERE kind = 0
UNION ALL SELECT event_id, 'record', 'value', event_type FROM e WHERE kind = 1
UNION ALL SELECT event_id, 'record', 'missing', NULL FROM e WHERE kind = 2
UNION ALL SELECT event_id, 'record', 'null', NULL FROM e WHERE kind = 3
""")
def variant_payload(spark, d):
    """Payloads of unknown shape parsed once, as VARIANT.  A whole document (with two records),
    a single record, a missing field and a JSON null are told apart; every fifth payload is no JSON and has no record."""
    ev, kind = tbl(spark, d, "events"), F.col("event_id") % 5
    eid, name = F.col("event_id").cast("string"), F.col("event_type")
    record = F.concat(F.lit('{"id": '), eid, F.lit(', "name": "'), name, F.lit('"}'))
    other = F.concat(F.lit('{"id": '), (-F.col("event_id") - 1).cast("string"), F.lit("}"))
    text = (F.when(kind == 0, F.concat(F.lit('{"Table": {"Lists": [{"Items": ['), record, F.lit(", "), other, F.lit("]}]}}")))
            .when(kind == 1, record).when(kind == 2, F.concat(F.lit('{"id": '), eid, F.lit("}")))
            .when(kind == 3, F.concat(F.lit('{"id": '), eid, F.lit(', "name": null}'))).otherwise(F.lit('{"id": ')))
    parsed = ev.select(F.try_parse_json(text).alias("v"))
    path = "$.Table.Lists[0].Items"
    shape = F.when(F.try_variant_get("v", path, "array<variant>").isNotNull(), "document").otherwise("record")
    recs = parsed.select(shape.alias("shape"), F.explode(C.payload_records(F.col("v"), path)).alias("r"))
    return recs.select(F.try_variant_get("r", "$.id", "bigint").alias("id"), "shape", C.field_state(F.col("r"), "$.name").alias("state"),
                       F.try_variant_get("r", "$.name", "string").alias("name"))


@query("bucketed_insert", """
SELECT o_orderkey, o_custkey, round(o_totalprice * 100)::BIGINT AS cents FROM orders
""")
def bucketed_insert(spark, d):
    """T5 J5 U4 on a bucketed target: four batches of a key range each, each with rows of the range before it at
    another price; what the target has by key is not inserted again, and no batch shuffles the target."""
    o = tbl(spark, d, "orders").select("o_orderkey", "o_custkey", F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"))
    table = BucketedTable(spark, f"{work_path(spark, 'bucketed_insert')}/orders", ["o_orderkey"])
    lo, hi = o.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    part = F.floor((F.col("o_orderkey") - lo) * 4 / (hi - lo + 1))
    table.create(o.where(part == 0))
    for i in (1, 2, 3):
        again = o.where((part == i - 1) & (F.col("o_orderkey") % 3 == 0)).withColumn("cents", F.lit(-1).cast("bigint"))
        table.insert(o.where(part == i).unionByName(again), ["cents"])
    return table.read()


@query("page_flatten", """
SELECT event_id, user_id,
       CAST((row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1) // 30 AS BIGINT) AS page
FROM events
""")
def page_flatten(spark, d, page_size: int = 30):
    """Events served as pages of ``page_size`` per user (a
    one-record page is sent as the bare record), parsed back and flattened."""
    ev = tbl(spark, d, "events").select(*EVENT_COLS)
    paged = pages.build_pages(ev, ["ts", "event_id"], page_size, group=["user_id"], records="Records")
    doc = F.to_json(F.struct("user_id", "page", "offset", F.col("n").alias("total"), "Records"))
    single = F.to_json(F.element_at("Records", 1))
    msgs = paged.select("user_id", "page", F.when(F.col("n") > 1, doc).otherwise(single).alias("value"))
    as_doc = F.from_json("value", f"total BIGINT, Records ARRAY<STRUCT<{RECORD_DDL}>>")
    as_rec = F.from_json("value", RECORD_DDL)
    records = pages.record_or_document(F.col("value"), as_doc.getField("Records"), as_rec)
    flat = msgs.select("page", F.explode(records).alias("r"))
    return flat.select(F.col("r.event_id").alias("event_id"), F.col("r.user_id").alias("user_id"), "page")


@query("fan_out", "SELECT 'events_' || event_type AS target, event_id, value FROM events")
def fan_out(spark, d):
    """K5: one batch routed to one table per type in a single pass, read back by name."""
    root = work_path(spark, "fan_out")
    ev = tbl(spark, d, "events")
    routed = ev.select(F.concat(F.lit("events_"), F.col("event_type")).alias("target"), "event_id", "value")
    sinks.fan_out_by(routed, "target", root)
    back = spark.read.schema("event_id BIGINT, value DOUBLE, target STRING").parquet(root)
    return back.select("target", "event_id", "value")
