"""Keyed JSON topics, file-backed.

No Kafka connector ships with this Spark, so a topic is a folder of Parquet
files with Kafka's record columns.  Switching to a real broker changes only
the format name and options (``format('kafka')``, ``kafka.acks=all``); the
processing code reads the same columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (LongType, IntegerType, StringType, StructField,
                               StructType, TimestampType)

from ..functions.clean import compose_key
from ..operators.keys import positions
from .tables import if_present

TOPIC_SCHEMA = StructType([
    StructField("key", StringType()),
    StructField("value", StringType()),
    StructField("topic", StringType()),
    StructField("partition", IntegerType()),
    StructField("offset", LongType()),
    StructField("timestamp", TimestampType()),
])


def to_messages(df: DataFrame, topic: str, key_cols: Sequence[str],
                value_cols: Sequence[str] | None = None, partitions: int = 3) -> DataFrame:
    """Rows -> ``(key, value)`` messages.

    ``key`` is ``a_b_c`` of ``key_cols``; ``value`` is the JSON of
    ``value_cols`` (all columns by default).  As with a keyed producer, a key
    always lands in the same partition, and offsets number the messages of a
    partition in key order.
    """
    value_cols = list(value_cols or df.columns)
    msgs = df.select(compose_key(*key_cols).alias("key"),
                     F.to_json(F.struct(*[F.col(c) for c in value_cols])).alias("value"),
                     F.lit(topic).alias("topic"))
    return with_offsets(msgs, partitions)


def with_offsets(msgs: DataFrame, partitions: int = 3, after: DataFrame | None = None) -> DataFrame:
    """``(key, value, topic)`` -> Kafka's record columns: the partition is a hash of the key (one
    key, one partition); offsets number each topic partition's messages in production order (a
    ``seq`` column, then key and value) and go on from ``after`` (topic, partition, last)."""
    order = [c for c in ("seq",) if c in msgs.columns] + ["key", "value"]
    msgs = msgs.withColumn("partition", F.pmod(F.hash("key"), F.lit(partitions)).cast("int"))
    msgs = positions(msgs, order, name="offset", group=["topic", "partition"])
    if after is not None:
        last = after.select(F.col("topic").alias("_t"), F.col("partition").alias("_p"), F.col("last").alias("_last"))
        msgs = msgs.join(last, (F.col("topic") == F.col("_t")) & (F.col("partition") == F.col("_p")), "left")
        msgs = msgs.withColumn("offset", F.col("offset") + F.coalesce("_last", F.lit(-1)) + 1)
    return (msgs.withColumn("offset", F.col("offset") - 1).withColumn("timestamp", F.current_timestamp())
                .select(*[f.name for f in TOPIC_SCHEMA.fields]))


def publish(msgs: DataFrame, root: str, partitions: int = 3) -> None:
    """K3: append producer output ``(key, value, topic[, seq])`` to the topic folder.

    Offsets continue from the largest ones stored, so (topic, partition, offset)
    stays unique over any number of runs.  One publisher at a time."""
    spark = msgs.sparkSession
    stored = if_present(lambda: spark.read.schema(TOPIC_SCHEMA).parquet(root))
    after = None if stored is None else stored.groupBy("topic", "partition").agg(F.max("offset").alias("last"))
    write_messages(with_offsets(msgs, partitions, after), root)


def write_messages(msgs: DataFrame, root: str) -> None:
    """K3: append messages to the topic folder (one commit per call)."""
    msgs.select(*[f.name for f in TOPIC_SCHEMA.fields]).write.mode("append").parquet(root)


def read_messages(spark: SparkSession, root: str, topic: str | None = None) -> DataFrame:
    """S3 batch form: every message so far."""
    df = spark.read.schema(TOPIC_SCHEMA).parquet(root)
    return df.where(F.col("topic") == topic) if topic else df


def read_message_stream(spark: SparkSession, root: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """S3 stream form: new message files since the query's checkpoint."""
    r = spark.readStream.schema(TOPIC_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(root)


def decode(df: DataFrame, schema: StructType, name: str = "v") -> DataFrame:
    """parse the JSON value with a declared schema."""
    return df.withColumn(name, F.from_json(F.col("value").cast("string"), schema))


def read_kafka_stream(spark: SparkSession, servers: str, topics: Sequence[str],
                      starting: str = "earliest", max_offsets_per_trigger: int | None = None) -> DataFrame:
    """S3 with a broker: the same columns as the file-backed topic (needs the
    Kafka connector on the classpath).  ``maxOffsetsPerTrigger`` bounds a
    micro-batch, which bounds the keys broadcast per batch."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
              .option("subscribe", ",".join(topics)).option("startingOffsets", starting))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return r.load().select(F.col("key").cast("string"), F.col("value").cast("string"), "topic",
                           "partition", "offset", "timestamp")


def write_kafka(msgs: DataFrame, servers: str) -> None:
    """K3 with a broker: ``acks=all`` as the source system's producer; the
    ``topic`` column routes each message."""
    (msgs.select("key", "value", "topic").write.format("kafka")
         .option("kafka.bootstrap.servers", servers).option("kafka.acks", "all").save())
