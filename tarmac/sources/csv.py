"""Wide CSV scan by header name, with declared types and pandas-style null tokens."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.clean import csv_nulls
from ..operators.keys import positions
from ..session import ensure_checkpoint_dir


CORRUPT = "_corrupt"
#: Low bits of an arrival number: the row's place in its split.
ROW_BITS = 33


def scan_csv(spark: SparkSession, path: str) -> DataFrame:
    """Every column of a headered CSV as text, named by the header, plus ``_corrupt``.

    RFC 4180 quoting: a quote in a quoted field is doubled, and fields may hold
    line ends; each file is read by one task (:func:`scan_split_csv` by many).  A file whose header differs from the first one's raises,
    rather than being read by position.  A missing path raises.
    """
    r = (spark.read.option("header", True).option("quote", '"').option("escape", '"')
              .option("multiLine", True).option("mode", "PERMISSIVE"))
    found = r.csv(path).schema
    schema = StructType([StructField(f.name, StringType()) for f in found.fields] + [StructField(CORRUPT, StringType())])
    return r.schema(schema).option("columnNameOfCorruptRecord", CORRUPT).option("enforceSchema", False).csv(path)


def _split_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, row, value, odd): the physical lines, read by a task per split; ``odd`` is 1 if a line
    holds an odd number of quotes (a doubled quote counts two)."""
    raw = spark.read.option("lineSep", "\n").text(path)
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
                      row.alias("row"), "value", (quotes % 2).cast("bigint").alias("odd"))


def split_table(spark: SparkSession, path: str) -> DataFrame:
    """(_file, _start, state, quoted, open, first): one row per split of the files at ``path``, checkpointed.

    ``state`` is 1 if the split starts inside a quoted field: the parity of all quotes before it in its file.
    ``open`` is the line that opened that field, which is the last odd one before the split.  A split is
    ``quoted`` if it starts inside a field or holds an odd line; in all others every line is a record.
    ``first`` is the first line of a file's first split that is not blank, its header."""
    ensure_checkpoint_dir(spark)
    blank = F.rtrim(F.col("value"), F.lit("\r")) == ""
    splits = _split_lines(spark, path).groupBy("file", "start").agg(
        F.sum("odd").alias("n_odd"), F.max(F.when(F.col("odd") == 1, F.col("row"))).alias("last_odd"),
        F.min(F.when((F.col("start") == 0) & ~blank, F.col("row"))).alias("first"))
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    state = F.coalesce(F.sum("n_odd").over(earlier), F.lit(0)) % 2
    opener = F.when(F.col("last_odd").isNotNull(), F.struct(F.col("start").alias("start"), F.col("last_odd").alias("row")))
    splits = splits.withColumn("state", state).withColumn("open", F.last(opener, ignorenulls=True).over(earlier))
    return splits.select(F.col("file").alias("_file"), F.col("start").alias("_start"), "state",
                         ((F.col("n_odd") > 0) | (F.col("state") == 1)).alias("quoted"), "open", "first").checkpoint()


def records(spark: SparkSession, path: str, splits: DataFrame | None = None) -> DataFrame:
    """(file, start, row, record): the records of CSV files, each at the place of its first line.

    A line end inside a quoted field does not end a record.  Whether a line starts inside a field is
    the parity of all quotes before it in its file: that of its split (:func:`split_table`, one row per
    split, broadcast), and in a quoted split a prefix sum over its lines.  Lines of other splits are records
    as they are read and move nowhere; only records of several lines are put together, wherever their
    lines were read.
    """
    splits = split_table(spark, path) if splits is None else splits
    lines = _split_lines(spark, path).join(F.broadcast(splits.drop("first")),
                                           (F.col("file") == F.col("_file")) & (F.col("start") == F.col("_start")), "left")
    # A split that the table does not name would be lost without a word.
    quoted = F.coalesce(F.col("quoted"), F.raise_error(F.concat(F.lit("read with other splits: "), F.col("file"))).cast("boolean"))
    kinds = {r[0] for r in splits.select("quoted").distinct().collect()}                # at most two flags
    parts = []
    if kinds != {True}:
        parts.append(lines.where(~quoted).select("file", "start", "row", F.col("value").alias("record")))
    if True in kinds:
        inside = Window.partitionBy("file", "start").orderBy("row")
        before = F.coalesce(F.sum("odd").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        some = lines.where(quoted).withColumn("starts", (before + F.col("state")) % 2 == 0)
        own = F.last(F.when(F.col("starts"), F.struct("start", "row")), ignorenulls=True).over(inside)
        some = some.withColumn("of", F.coalesce(own, F.col("open")))
        alone = F.col("starts") & (F.col("odd") == 0)
        several = some.where(~alone).groupBy("file", "of").agg(
            F.sort_array(F.collect_list(F.struct("start", "row", "value"))).alias("parts"))
        text = F.array_join(F.transform("parts", lambda x: x["value"]), "\n")
        parts += [some.where(alone).select("file", "start", "row", F.col("value").alias("record")),
                  several.select("file", "of.start", "of.row", text.alias("record"))]
    whole = reduce(DataFrame.unionByName, parts)
    end = F.col("record").endswith("\r")
    return whole.withColumn("record", F.when(end, F.regexp_replace("record", "\r$", "")).otherwise(F.col("record")))


def scan_split_csv(spark: SparkSession, path: str, splits: DataFrame | None = None) -> DataFrame:
    """:func:`scan_csv` for large files: many tasks read a file, whatever its fields hold; in addition the
    columns ``_file``, ``_start`` and ``_row``, the place of the record."""
    options = {"quote": '"', "escape": '"', "multiLine": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    names = scan_csv(spark, path).columns[:-1]
    ddl = ", ".join("`" + n.replace("`", "``") + "` STRING" for n in [*names, CORRUPT])
    splits = split_table(spark, path) if splits is None else splits
    rows = records(spark, path, splits).where(F.col("record") != "").select("*", F.from_csv("record", ddl, options).alias("_r"))
    heads = splits.where((F.col("_start") == 0) & F.col("first").isNotNull()).select(F.col("_file").alias("_of"), F.col("first").alias("_first"))
    rows = rows.join(F.broadcast(heads), (F.col("file") == F.col("_of")) & (F.col("start") == 0), "left")
    first = F.coalesce(F.col("row") == F.col("_first"), F.lit(False))
    same = [F.col("_r").getField(n) == F.lit(n) for n in names]
    as_told = F.coalesce(reduce(lambda a, b: a & b, same) & F.col("_r").getField(CORRUPT).isNull(), F.lit(False))
    checked = F.when(~first, True).when(as_told, False).otherwise(
        F.raise_error(F.concat(F.lit("the header differs in "), F.col("file"))).cast("boolean"))
    return rows.where(checked).select(*[F.col("_r").getField(n).alias(n) for n in [*names, CORRUPT]],
                                      F.col("file").alias("_file"), F.col("start").alias("_start"), F.col("row").alias("_row"))


def _any_value(df: DataFrame) -> Column:
    """Always true; Spark refuses to read the corrupt column alone, so the first one is looked at too."""
    return F.coalesce(F.col(df.columns[0]), F.lit("")) >= ""


def read_wide_csv(spark: SparkSession, path: str, schema: StructType,
                  arrival_col: str | None = "_arrival", split: bool = True,
                  splits: DataFrame | None = None) -> DataFrame:
    """The columns of ``schema`` that the file has, by name (P2), typed as declared.

    Text columns are read as text and the pandas default NA tokens become NULL
    while ``\\N`` stays text (it is cleaned per entity, as the reference
    does).  Rows that do not fit the header are left to :func:`csv_rejects`.
    ``arrival_col`` carries file order for keep-first dedup (quirk Q18) as the
    struct (file, split start, row); :func:`with_arrival_number` turns it into
    one BIGINT.  ``split=False`` reads each file in one task, by the multi-line reader.
    ``splits`` is the path's :func:`split_table`, if it is at hand.
    """
    if split:
        df = scan_split_csv(spark, path, splits)
        place = [F.col("_file"), F.col("_start"), F.col("_row")]
    else:
        df = scan_csv(spark, path)
        row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << ROW_BITS) - 1))
        place = [F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), row]
    cols = []
    for f in schema.fields:
        if f.name not in df.columns:
            continue
        c = csv_nulls(F.col(f.name))
        if not isinstance(f.dataType, StringType):
            c = c.try_cast(f.dataType)
        cols.append(c.alias(f.name))
    if arrival_col:
        cols.append(F.struct(*[c.alias(n) for c, n in zip(place, ("file", "start", "row"), strict=True)]).alias(arrival_col))
    return df.where(F.col(CORRUPT).isNull() & _any_value(df)).select(*cols)


def csv_rejects(spark: SparkSession, path: str, split: bool = True, splits: DataFrame | None = None) -> DataFrame:
    """(file, record): the rows that do not fit the header."""
    df = scan_split_csv(spark, path, splits) if split else scan_csv(spark, path).select("*", F.col("_metadata.file_path").alias("_file"))
    return df.where(F.col(CORRUPT).isNotNull() & _any_value(df)) \
             .select(F.col("_file").alias("file"), F.col(CORRUPT).alias("record"))


def with_arrival_number(staged: DataFrame, arrival_col: str = "_arrival") -> DataFrame:
    """The arrival struct of a staged extract as one BIGINT, in order of file, split and row.

    Splits are ranked among themselves (one row per split, of the size of a
    file block), so no row is moved, and a plain BIGINT keeps minimum
    aggregates of the loads in hash aggregation.
    """
    at = F.col(arrival_col)
    splits = staged.select(at["file"].alias("_file"), at["start"].alias("_start")).distinct()
    ranked = positions(splits, ["_file", "_start"], name="_split")
    number = F.shiftleft(F.col("_split"), ROW_BITS) + at["row"]
    joined = staged.join(F.broadcast(ranked), (at["file"] == F.col("_file")) & (at["start"] == F.col("_start")))
    return joined.withColumn(arrival_col, number).drop("_file", "_start", "_split")


def write_csv(df: DataFrame, path: str, null_text: str = "\\N") -> None:
    """Write a headered RFC 4180 CSV with ``\\N`` for NULL, as the source extract has."""
    (df.write.mode("overwrite").option("header", True).option("nullValue", null_text)
       .option("quote", '"').option("escape", '"').csv(path))
