"""Paged JSON documents.

The API client of the source system is replaced by *landed pages*: one JSON
document per page, stored as ``<root>/round=<n>/offset=<n>/page.json``.
Partition discovery turns the folder names into columns, the take-while rule
(stop at the first empty page) is ``ranking.take_while`` and the records are
flattened with ``explode``.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.keys import positions
from ..operators.ranking import take_while
from ..session import ensure_checkpoint_dir

CORRUPT = "_corrupt"
#: A folder's value for a NULL.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def read_landed_pages(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """Every landed page with its ``round`` / ``offset`` path columns, and a malformed page's text
    in ``_corrupt`` (its other columns are NULL, so it must not pass for an empty page).

    The folders are listed here, by as many tasks as a shuffle has: Spark's default is one for each folder, up
    to 10,000, and starting one costs ten times as much as listing a folder of a few pages.  Path columns come
    from each page's own path: partition discovery takes time by the square of the number of folders."""
    full = schema if isinstance(schema, str) else schema.simpleString()[len("struct<"):-1]
    fields = {f.name: f for f in StructType.fromDDL(f"{full}, {CORRUPT} STRING").fields}
    by = [c for c in _path_columns(spark, root) if c in fields]
    data = StructType([f for f in fields.values() if f.name not in by])
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(name)
    spark.conf.set(name, min(int(before), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    try:
        read = (spark.read.schema(data).option("columnNameOfCorruptRecord", CORRUPT).option("recursiveFileLookup", True)
                     .option("multiLine", True).json(root))
    finally:
        spark.conf.set(name, before)
    return read.select(*data.names, *[_path_value(c).cast(fields[c].dataType).alias(c) for c in by])


def _path_columns(spark: SparkSession, root: str) -> list[str]:
    """The columns that the folders under ``root`` name, by its first folder of each level."""
    jvm = spark._jvm
    at, names = jvm.org.apache.hadoop.fs.Path(root), []
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    while at is not None and fs.exists(at):
        inner, at = fs.listStatusIterator(at), None
        while at is None and inner.hasNext():
            found = inner.next()
            folder = found.getPath().getName()
            if found.isDirectory() and "=" in folder and folder[0] not in "._":
                at = found.getPath()
                names.append(_unescaped(folder.split("=")[0]))
    return names


def _path_value(name: str) -> Column:
    """The text of a path column: the folder's name, out of the path's own escapes and the folder's."""
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    folder = F.regexp_extract(path, f"/{re.escape(_escaped(name))}=([^/]*)/", 1)
    unescaped = F.try_url_decode(F.replace(folder, F.lit("+"), F.lit("%2B")))
    return F.when(folder != NO_VALUE, F.coalesce(unescaped, folder))


def land(docs: DataFrame, path: str, by: Sequence[str], deal: Sequence[str] | None = None, mode: str = "errorifexists") -> None:
    """One file per page, in the folder that the ``by`` columns name; ``value`` is its text.

    A page costs a file, not bytes, so the number of tasks is set: by bytes an adaptive plan would let one task
    write thousands of files.  On a mounted folder (``file:``) tasks write the files themselves: Hadoop's local
    file system starts a ``chmod`` process for every file, its checksum and each of its folders, which takes a
    hundred times as long as the page.  Elsewhere Spark's writer is used, whose tasks move their own files to the
    folders (commit algorithm 2); with the default the driver alone renames the folders after the last task."""
    spark = docs.sparkSession
    dealt = docs.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *(deal or by))
    mounted = _mounted(spark, path)
    if mounted is None or mode not in ("errorifexists", "error", "append"):
        (dealt.write.mode(mode).partitionBy(*by)
              .option("mapreduce.fileoutputcommitter.algorithm.version", "2").text(path))
        return
    docs.limit(0).write.mode(mode).partitionBy(*by).text(path)      # the writer's own checks, and the folder
    text = [c for c in docs.columns if c not in by]
    rows = dealt.sortWithinPartitions(*by).select(*[F.col(c).cast("string") for c in by], *text)
    names, run = [_escaped(c) for c in by], uuid.uuid4().hex
    rows.mapInArrow(lambda it: _write_pages(it, mounted, names, run), "pages long").write.format("noop").mode("overwrite").save()


def _mounted(spark: SparkSession, path: str) -> str | None:
    """The path as tasks can open it; None if it is not in a mounted file system."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    uri = where.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(where).toUri()
    return uri.getPath() if uri.getScheme() == "file" else None


def _escaped(text: str | None) -> str:
    """A name or value in a folder's name, as Spark writes and reads it."""
    if not text:
        return NO_VALUE
    return "".join(f"%{ord(c):02X}" if c < " " or c in "\x7f\"#%'*/:=?\\{[]^" else c for c in text)


def _unescaped(text: str) -> str:
    return re.sub("%([0-9A-Fa-f]{2})", lambda m: chr(int(m[1], 16)), text)


def _write_pages(batches: Iterator[pa.RecordBatch], root: str, names: Sequence[str], run: str) -> Iterator[pa.RecordBatch]:
    """Files of the pages of one task, which come sorted by folder; a file gets its name once it is whole, so a
    task that runs twice leaves one."""
    context = TaskContext.get()
    name = f"part-{context.partitionId():05d}-{run}.c000.txt"
    at, out, folder, pages = None, None, "", 0

    def close() -> None:
        if out is not None:
            out.close()
            os.replace(out.name, f"{folder}/{name}")

    for batch in batches:
        for *key, value in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if key != at:
                close()
                at, folder = key, "/".join([root, *[f"{n}={_escaped(k)}" for n, k in zip(names, key, strict=True)]])
                os.makedirs(folder, exist_ok=True)
                out = open(f"{folder}/.{name}.{context.taskAttemptId()}", "wb")  # noqa: SIM115
                pages += 1
            out.write((value or "").encode() + b"\n")
    close()
    yield pa.RecordBatch.from_pydict({"pages": [pages]})


def corrupt_pages(pages: DataFrame) -> DataFrame:
    """T9 for pages: the malformed ones, with their path columns and text."""
    # Spark refuses to read the corrupt column alone, so the document is looked at too.
    any_value = F.coalesce(F.to_json(F.struct(pages.columns[0])), F.lit("")) >= ""
    return pages.where(F.col(CORRUPT).isNotNull() & any_value)


def records_at(path: str) -> Column:
    """The record list at a dotted path (``MRData.RaceTable.Races``);
    a missing or non-list value yields an empty array."""
    return F.coalesce(F.col(path), F.array())


def flatten(df: DataFrame, path: str, keep: Sequence[str] = (), alias: str = "rec") -> DataFrame:
    """one row per element of the array at ``path``, with ``keep`` columns."""
    return df.select(*keep, F.explode(records_at(path)).alias(alias))


def until_empty(df: DataFrame, has_records: Column, order: Sequence[str], group: Sequence[str] | None = None,
                total: Column | None = None) -> DataFrame:
    """W4 on pages: the pages before the first one without records, or from ``total`` on, per ``group``.

    A malformed page stops nothing; it yields no records and is listed by :func:`corrupt_pages`.  The pages are
    read once and checkpointed, as each is a file to open and both sides of the rule need them.  As many tasks as
    a shuffle has read them at most: a scan counts a page as 4 MB, so it would take a task for 32 of them."""
    ensure_checkpoint_dir(df.sparkSession)
    df = df.coalesce(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))).checkpoint()
    stop = F.col(CORRUPT).isNull() & ~has_records
    if total is not None:
        stop = stop | F.coalesce(F.col(order[-1]) >= total, F.lit(False))
    return take_while(df, list(order), stop, group=group)


def until_empty_group(df: DataFrame, has_records: Column, group: str) -> DataFrame:
    """W4 on groups of pages (Q20): all pages of the groups before the first group without any record."""
    live = df.groupBy(group).agg(F.max(has_records | F.col(CORRUPT).isNotNull()).alias("_live"))
    first = live.where(~F.col("_live")).agg(F.min(group)).scalar()
    return df.where(first.isNull() | (F.col(group) < first))


def record_or_document(value: Column, doc_records: Column, record: Column) -> Column:
    """A payload is either a whole document (use its record list) or a
    single record (wrap it in a one-element list)."""
    return F.coalesce(doc_records, F.when(record.isNotNull(), F.array(record)), F.array())


def build_pages(df: DataFrame, order: Sequence[str], page_size: int,
                group: Sequence[str] | None = None, records: str = "records") -> DataFrame:
    """Cut rows into pages of ``page_size`` records (the shape an API serves).

    A page holds at most ``page_size`` rows, so ``collect_list`` is bounded;
    a hot group spreads over many pages and the positions that number them
    are computed without a per-group sort in one task.
    """
    group = list(group or [])
    ranked = positions(df, order, name="_pos", group=group)
    ranked = (ranked.withColumn("page", F.floor((F.col("_pos") - 1) / F.lit(page_size)).cast("bigint"))
                    .withColumn("offset", (F.col("page") * F.lit(page_size)).cast("bigint")))
    rec = F.struct(F.col("_pos").alias("_pos"), *[F.col(c) for c in df.columns])
    pages = (ranked.groupBy(*group, "page", "offset")
                   .agg(F.sort_array(F.collect_list(rec)).alias("_recs"),
                        F.count(F.lit(1)).alias("n")))
    return pages.withColumn(records, F.transform("_recs", lambda r: r.dropFields("_pos"))).drop("_recs")
