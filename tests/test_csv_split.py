"""The splittable CSV reader against the multi-line reader, row by row and in file order."""

import random

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tarmac.sources.csv import csv_rejects, read_wide_csv, scan_csv, scan_split_csv, with_arrival_number

SCHEMA = StructType([StructField("id", LongType()), StructField("note", StringType()), StructField("b", StringType())])


@pytest.fixture()
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def quoted(x):
    return '"' + x.replace('"', '""') + '"'


def write(tmp_path, name, records, end):
    with open(tmp_path / name, "w", newline="") as f:
        f.write(end.join(['id,note,b', *records]) + end)


def some_records(n, seed):
    rng = random.Random(seed)
    parts = ["a", "b c", '"', '""', ",", "\n", "\n\n", "é", "x" * 60, "\\N", "NA", "'", "\n\",\n"]
    out = []
    for i in range(n):
        note = "".join(rng.choice(parts) for _ in range(rng.randint(0, 6)))
        out.append(f"{i},{quoted(note) if note and set(note) & set(chr(34) + ',' + chr(10)) else note},{rng.choice(['t', quoted('u v'), ''])}")
    out[n // 2] = f"{n // 2},{quoted('long' + chr(10) * 3000 + 'field')},t"          # a field over several splits
    out[n // 3] = f"{n // 3},a,b,too many"
    return out


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_equals_the_multi_line_reader(spark, tmp_path, small_splits, end):
    write(tmp_path, "one.csv", some_records(4_000, 1), end)
    write(tmp_path, "two.csv", some_records(500, 2), end)
    path = str(tmp_path)
    rows = lambda df: [(r.id, r.note, r.b) for r in df.orderBy("_arrival").collect()]
    want = rows(read_wide_csv(spark, path, SCHEMA, split=False))
    split = read_wide_csv(spark, path, SCHEMA)
    assert rows(split) == want and len(want) == 4_498
    assert [(r.id, r.note, r.b) for r in with_arrival_number(split).orderBy("_arrival").collect()] == want
    assert scan_split_csv(spark, path).select("_file", "_start").distinct().count() > 20
    bad = [sorted(r.record for r in csv_rejects(spark, path, split=s).collect()) for s in (True, False)]
    assert [b.strip() for b in bad[0]] == [b.strip() for b in bad[1]] and len(bad[0]) == 2


def test_header_of_another_file_and_empty_files(spark, tmp_path, small_splits):
    write(tmp_path, "one.csv", ["1,a,b"], "\n")
    write(tmp_path, "two.csv", [], "\n")
    assert scan_split_csv(spark, str(tmp_path)).count() == 1 == scan_csv(spark, str(tmp_path)).count()
    (tmp_path / "zz.csv").write_text("id,b,note\n1,2,3\n")
    with pytest.raises(SparkRuntimeException, match="header differs"):
        read_wide_csv(spark, str(tmp_path), SCHEMA).select(F.max("id")).collect()


def test_lines_without_quotes_move_nowhere(spark, tmp_path, small_splits):
    """A split without a quoted line end is read as it is: neither its lines nor its records are shuffled or sorted."""
    write(tmp_path, "one.csv", [f"{i},a{i},b" for i in range(3_000)], "\n")
    df = read_wide_csv(spark, str(tmp_path), SCHEMA)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "hashpartitioning" not in plan
    assert sorted(r.id for r in df.collect()) == list(range(3_000))


def test_quotes_in_some_splits_only(spark, tmp_path, small_splits):
    """Plain splits before, between and after those of a quoted field, and a file without quotes beside it."""
    long = quoted("x\n" * 6_000)
    write(tmp_path, "one.csv", [*(f"{i},a,b" for i in range(2_000)), f"2000,{long},b", *(f"{i},a,b" for i in range(2_001, 4_000))], "\n")
    write(tmp_path, "two.csv", [f"{i},c,d" for i in range(4_000, 6_000)], "\n")
    rows = lambda df: [(r.id, r.note, r.b) for r in with_arrival_number(df).orderBy("_arrival").collect()]
    got = rows(read_wide_csv(spark, str(tmp_path), SCHEMA))
    assert [r[0] for r in got] == list(range(6_000)) and got[2_000][1] == "x\n" * 6_000
