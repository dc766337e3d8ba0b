"""S4 / K2 against a relational database through Spark's JDBC source.

These are the forms a deployment writing to PostgreSQL uses; the driver jar
must be on the classpath.  Reads push the column list and filters down to
the database; appends map columns by name.  (Not exercised by the tests: a
database would have to be started for that.)
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def read_columns(spark: SparkSession, url: str, table: str, columns: Sequence[str],
                 where: str | None = None, properties: dict | None = None,
                 partition_column: str | None = None, lower: int = 0, upper: int = 0,
                 partitions: int = 1) -> DataFrame:
    """``SELECT columns FROM table [WHERE ..]`` as a DataFrame.  With a
    numeric ``partition_column`` the read is split into ``partitions``
    parallel range queries."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if partition_column:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
              .option("upperBound", upper).option("numPartitions", partitions))
    df = r.load().select(*columns)
    return df.where(where) if where else df


def append(df: DataFrame, url: str, table: str, properties: dict | None = None,
           batch_size: int = 10000) -> None:
    """K2: append rows; each task inserts its partition in batches."""
    w = df.write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", batch_size)
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.mode("append").save()
