"""T5 / J5 / U4 on a large target: a table bucketed and sorted by its natural key.

The files of a ``BucketedTable`` are dealt by hash of the key when they are written, so a batch's anti
join shuffles the batch alone: the target is scanned bucket by bucket, with no exchange.  The scan
itself is narrowed by the batch: the range of its first key column (two scalars), and the values
themselves if they are few, are pushed to the files, whose rows are sorted by the key, so files and row
groups that cannot hold a key of the batch are not read.

The layout is Spark's own (``bucketBy`` and ``sortBy``); the session's catalog only names it, and a new
session registers the folder again from the schema noted beside it.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.clean import all_present
from ..operators.dedup import keep_first
from .tables import if_present

#: Values of the first key column that are pushed one by one at most; beyond that their range is.
FEW = 64


class BucketedTable:
    """A Parquet table bucketed by ``keys``; ``buckets`` should be the session's shuffle partitions or more."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], buckets: int | None = None):
        self.spark, self.root, self.keys = spark, root.rstrip("/"), list(keys)
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.name = "tarmac_" + hashlib.sha256(self.root.encode()).hexdigest()[:24]

    def _write(self, df: DataFrame, mode: str) -> None:
        dealt = df.repartition(self.buckets, *self.keys)            # one file a bucket and write
        (dealt.write.mode(mode).format("parquet").option("path", f"{self.root}/data")
              .bucketBy(self.buckets, *self.keys).sortBy(*self.keys).saveAsTable(self.name))

    def create(self, df: DataFrame) -> None:
        note = json.dumps({"schema": df.schema.json(), "buckets": self.buckets})
        self.spark.createDataFrame([(note,)], "value STRING").coalesce(1).write.mode("overwrite").text(f"{self.root}/schema")
        self._write(df, "overwrite")

    def _register(self) -> None:
        if self.spark.catalog.tableExists(self.name):
            return
        noted = if_present(lambda: self.spark.read.text(f"{self.root}/schema"))
        if noted is None:
            raise FileNotFoundError(f"there is no table at {self.root}")
        note = json.loads(noted.first()[0])
        self.buckets = note["buckets"]
        quoted = lambda n: "`" + n.replace("`", "``") + "`"
        columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in StructType.fromJson(json.loads(note["schema"])).fields)
        by = ", ".join(map(quoted, self.keys))
        self.spark.sql(f"CREATE TABLE {self.name} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) "
                       f"INTO {self.buckets} BUCKETS LOCATION '{self.root}/data'")

    def read(self) -> DataFrame:
        self._register()
        return self.spark.table(self.name)

    def append(self, df: DataFrame) -> None:
        current = self.read()
        self._write(df.select(*[F.col(f.name).cast(f.dataType) for f in current.schema.fields]), "append")

    def near(self, batch: DataFrame) -> DataFrame:
        """The target's keys that the batch's first key column allows."""
        first = self.keys[0]
        lo, hi, n = batch.agg(F.min(first), F.max(first), F.approx_count_distinct(first)).first()
        within: Column = F.col(first).between(F.lit(lo), F.lit(hi))
        if n <= FEW:
            values = [r[0] for r in batch.select(first).distinct().limit(2 * FEW + 1).collect()]
            within = within & F.col(first).isin(values) if len(values) <= 2 * FEW else within
        return self.read().where(within).select(*self.keys)

    def new_rows(self, batch: DataFrame, order: Sequence) -> DataFrame:
        """U4: the first row per key of the batch (T4) whose key the target does not have (T5); no null keys."""
        rows = keep_first(batch.where(all_present(*self.keys)), self.keys, order).checkpoint()
        # A merge join: it keeps to the target's buckets, and sorts the files of a bucket where there are several.
        return rows.join(self.near(rows).hint("merge"), self.keys, "left_anti")

    def insert(self, batch: DataFrame, order: Sequence) -> None:
        self.append(self.new_rows(batch, order).checkpoint())
