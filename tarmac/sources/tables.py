"""S2 / S4 / S7 / K1 / K2 / K4 and the versioned table used for updates.

A ``VersionedTable`` is a folder of Parquet versions plus an append-only
pointer log::

    root/v=00000001/part-*.parquet      contents of version 1
    root/_pointer/part-*.parquet        one row (version) per commit

Readers resolve the highest committed version.  Inserts append files to the
current version (a scan's file list is fixed at planning, so appending while
the same plan reads is safe); updates write ``v+1`` in full and then commit a
pointer row, so a path being read is never overwritten and a failed write
leaves the previous version current.  Every folder lives under the shared
``spark.checkpoint.dir`` or another shared path, never on a local disk.
"""

from __future__ import annotations

import json
import math

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType


def if_present(read):
    """``read()``, or None if its path does not exist.  Any other error is raised: a
    failing read must never pass for an empty table."""
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of the driver's data set, with its declared
    schema (no per-read schema inference); unknown tables are inferred."""
    from ..schemas import DRIVER_TABLES

    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    ddl = DRIVER_TABLES.get(name)
    return spark.read.schema(ddl).parquet(path) if ddl else spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: list[str] | None = None, millis: bool = False) -> None:
    """K1 / K2: Parquet sink.  ``millis=True`` is the stage-file form: every
    timestamp column (LTZ and NTZ) is truncated to milliseconds, as the
    source system's extract files are; tables keep full precision."""
    if millis:
        for name, typ in df.dtypes:
            if typ in ("timestamp", "timestamp_ntz"):
                df = df.withColumn(name, F.date_trunc("MILLISECOND", F.col(name)).cast(typ))
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_stage(df: DataFrame, path: str) -> None:
    """K1: an extract / transform stage file (millisecond timestamps)."""
    write_parquet(df, path, millis=True)


def list_tables(spark: SparkSession, db: str | None = None) -> list[str]:
    """The catalogue's table names (metadata only)."""
    return [t.name for t in spark.catalog.listTables(db)]


def truncate_all(spark: SparkSession, db: str | None = None) -> list[str]:
    """K4: ``TRUNCATE TABLE`` every catalogue table of ``db``.  Prefer
    overwriting per table on load (quirk Q15)."""
    quoted = lambda n: "`" + n.replace("`", "``") + "`"
    names = [t.name for t in spark.catalog.listTables(db) if not t.isTemporary and t.tableType != "VIEW"]
    for n in names:
        spark.sql(f"TRUNCATE TABLE {quoted(db) + '.' if db else ''}{quoted(n)}")
    return names


class VersionedTable:
    """A Parquet table with versioned replace and append (see module doc).

    One writer per table: the committed version is read from the pointer log
    once and then tracked in this object; ``refresh()`` re-reads it.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._version: int | None = None
        self._schema = None          # known after the first write or read: no re-inference

    def _vpath(self, v: int) -> str:
        return f"{self.root}/v={v:08d}"

    def refresh(self) -> int:
        log = if_present(lambda: self.spark.read.schema("version BIGINT").parquet(f"{self.root}/_pointer"))
        self._version = 0 if log is None else int(log.agg(F.max("version")).first()[0] or 0)
        return self._version

    def version(self) -> int:
        """Highest committed version (0 if none)."""
        return self.refresh() if self._version is None else self._version

    def exists(self) -> bool:
        return self.version() > 0

    def read(self) -> DataFrame:
        v = self.version()
        if v == 0:
            raise FileNotFoundError(f"table {self.root} has no committed version")
        if self._schema is not None:
            return self.spark.read.schema(self._schema).parquet(self._vpath(v))
        df = self.spark.read.parquet(self._vpath(v))
        self._schema = df.schema
        return df

    def _commit(self, v: int) -> None:
        (self.spark.range(1).select(F.lit(v).cast("bigint").alias("version"))
             .coalesce(1).write.mode("append").parquet(f"{self.root}/_pointer"))
        self._version = v

    def create(self, df: DataFrame) -> None:
        """Write version 1 (or a new version if the table exists)."""
        self.replace(df)

    def replace(self, df: DataFrame) -> int:
        """Write new contents as the next version, then commit it."""
        v = self.version() + 1
        write_parquet(df, self._vpath(v))
        self._commit(v)
        self._schema = None          # re-read once: Parquet makes every column nullable
        return v

    def compact(self) -> int:
        """Rewrite the current contents as one new version (appends leave many
        small files behind in a long-running stream)."""
        return self.replace(self.read())

    def vacuum(self, keep: int = 2) -> list[int]:
        """Delete all but the ``keep`` latest committed versions (folder names only are listed on the driver)."""
        jvm = self.spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.root)
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [f.getPath().getName() for f in fs.listStatus(root)] if fs.exists(root) else []
        old = [v for v in (int(n[2:]) for n in names if n.startswith("v=")) if v <= self.version() - keep]
        for v in old:
            fs.delete(jvm.org.apache.hadoop.fs.Path(self._vpath(v)), True)
        return sorted(old)

    def append(self, df: DataFrame) -> None:
        """K2: append rows (by name) to the current version."""
        v = self.version()
        if v == 0:
            self.replace(df)
            return
        current = self.read()
        # Align by name and to the table's types so every file of a version
        # has one schema.
        aligned = df.select(*[F.col(f.name).cast(f.dataType) for f in current.schema.fields])
        write_parquet(aligned, self._vpath(v), mode="append")


#: Rows that one task writes of a partitioned table, more or less.
ROWS_A_TASK = 500_000


class PartitionedTable:
    """A Parquet table partitioned by ``by``, for facts too large to rewrite.

    Appends add files to their partitions.  ``overwrite_partitions`` replaces
    only the partitions present in the new data (``partitionOverwriteMode =
    dynamic``); the new data is checkpointed first, which cuts its lineage to
    the files being replaced and keeps it under executor loss.  Same interface
    as ``VersionedTable`` otherwise; one writer per table.
    """

    def __init__(self, spark: SparkSession, root: str, by: list[str]):
        self.spark = spark
        self.root = root.rstrip("/")
        self.by = list(by)
        self._schema = None

    def exists(self) -> bool:
        return if_present(self.read) is not None

    def version(self) -> int:
        return 1 if self.exists() else 0

    def _note_schema(self, df: DataFrame) -> None:
        """Keep the schema beside the data (``_schema``, which scans skip): a partitioned table without
        rows has no file to infer it from."""
        fields = sorted(df.schema.fields, key=lambda f: f.name in self.by)     # partition columns last
        self._schema = StructType([StructField(f.name, f.dataType) for f in fields])
        (self.spark.createDataFrame([(self._schema.json(),)], "value STRING")
             .coalesce(1).write.mode("overwrite").text(f"{self.root}/_schema"))

    def read(self) -> DataFrame:
        if self._schema is None:
            noted = if_present(lambda: self.spark.read.text(f"{self.root}/_schema"))
            self._schema = (StructType.fromJson(json.loads(noted.first()[0])) if noted is not None
                            else self.spark.read.parquet(self.root).schema)
        return self.spark.read.schema(self._schema).parquet(self.root)

    def _dealt(self, df: DataFrame) -> DataFrame:
        """``df`` dealt to its writers: a task per partition value while the rows are few (one file a partition and
        write); beyond ``ROWS_A_TASK`` a range of values and row hashes per task, so that no value is one task's
        whatever share of the rows it holds.  Adaptive plans, which would split such a task, are off in a stream.
        ``df`` is counted first, so it should be cheap to read."""
        n = df.count()
        if n <= ROWS_A_TASK:
            return df.repartition(*self.by)
        return df.repartitionByRange(math.ceil(n / ROWS_A_TASK), *self.by, F.xxhash64(*df.columns))

    def _materialize(self, df: DataFrame) -> DataFrame:
        from ..session import ensure_checkpoint_dir

        ensure_checkpoint_dir(self.spark)
        return df.checkpoint(eager=True)

    def replace(self, df: DataFrame, materialize: bool = False) -> int:
        """Overwrite the whole table (``materialize`` when ``df`` reads it)."""
        src = self._materialize(df) if materialize else df
        # One writer task per partition value: not tasks x partitions small files.
        src.repartition(*self.by).write.mode("overwrite").partitionBy(*self.by).parquet(self.root)
        self._note_schema(src)
        return 1

    def create(self, df: DataFrame) -> None:
        self.replace(df)

    def append(self, df: DataFrame) -> None:
        """K2: add files to the partitions; creates the table if there is none, never replaces one."""
        current = if_present(self.read)
        if current is None:
            self._note_schema(df)
        else:
            df = df.select(*[F.col(f.name).cast(f.dataType) for f in current.schema.fields])
        self._dealt(df).write.mode("append").partitionBy(*self.by).parquet(self.root)

    def put(self, df: DataFrame) -> None:
        """Replace the partitions that ``df`` has rows for; ``df`` must not read the table."""
        current = if_present(self.read)
        if current is None:
            self._note_schema(df)
        else:
            df = df.select(*[F.col(f.name).cast(f.dataType) for f in current.schema.fields])
        (self._dealt(df).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy(*self.by).parquet(self.root))

    def read_touched(self, keys: DataFrame) -> DataFrame:
        """The rows of the partitions named by ``keys`` (a frame with the partition column).

        One plan at any size: a semi join on the partition column.  The range of
        the touched values (two scalars) is pushed to the scan as a static
        partition filter, and as a selective predicate on ``keys`` it lets
        Spark prune the partitions in between dynamically."""
        col = self.by[0]
        lo, hi = keys.agg(F.min(col), F.max(col)).first()
        within = F.col(col).between(F.lit(lo), F.lit(hi))
        return self.read().where(within).join(keys.where(within).select(col).distinct(), col, "left_semi")

    def overwrite_partitions(self, df: DataFrame) -> None:
        """Replace exactly the partitions that ``df`` has rows for."""
        current = self.read()
        aligned = df.select(*[F.col(f.name).cast(f.dataType) for f in current.schema.fields])
        (self._dealt(self._materialize(aligned)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(*self.by).parquet(self.root))

    def compact(self) -> int:
        return self.replace(self.read(), materialize=True)
