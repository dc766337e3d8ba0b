"""Landed pages: what a page costs, and path columns of any value."""

import os

from pyspark.sql import functions as F

from tarmac.sources import pages


def leaves(root):
    return {d: names for d, _, names in os.walk(root) if "=" in os.path.basename(d) and names}


def test_a_page_is_one_file(spark, scratch):
    """No checksum beside it: Hadoop's local file system starts a process for each file and folder it makes."""
    docs = spark.range(40).selectExpr("id % 4 AS folder", "id AS offset", "'{\"n\": 1}' AS value")
    pages.land(docs, f"{scratch}/p", ["folder", "offset"], deal=["folder"])
    files = leaves(f"{scratch}/p")
    assert len(files) == 40 and all(len(names) == 1 for names in files.values())
    pages.land(docs, f"{scratch}/p", ["folder", "offset"], mode="append")
    assert all(len(names) == 2 for names in leaves(f"{scratch}/p").values())


def test_path_columns_come_back(spark, scratch):
    """Values that Spark escapes, a null, repeated pages (one file, whose first line is its document) and null texts."""
    keys = ["plain", "a/b=c", "50%+1 é", "x:y", None, ""]
    rows = [(k, i, '{"n": %d}' % i) for i, k in enumerate(keys)] + [("twice", 7, '{"n": 7}'), ("twice", 7, '{"n": 7}'), ("none", 8, None)]
    docs = spark.createDataFrame(rows, "kind STRING, offset LONG, value STRING")
    pages.land(docs, f"{scratch}/p", ["kind", "offset"])
    got = pages.read_landed_pages(spark, f"{scratch}/p", "n BIGINT, kind STRING, offset BIGINT")
    assert got.columns == ["n", pages.CORRUPT, "kind", "offset"]
    want = {(k or None, i, i) for i, k in enumerate(keys)} | {("twice", 7, 7)}
    assert {(r.kind, r.offset, r.n) for r in got.where("n IS NOT NULL").collect()} == want
    by_spark = spark.read.option("multiLine", True).schema("n BIGINT, kind STRING, offset BIGINT").json(f"{scratch}/p")
    assert sorted(map(str, by_spark.select("n", "kind", "offset").collect())) == sorted(map(str, got.select("n", "kind", "offset").collect()))


def test_folders_are_not_discovered_one_by_one(spark, scratch):
    """Path columns are no partition columns (whose discovery is quadratic), and the listing's setting is put back."""
    docs = spark.range(3).selectExpr("id AS folder", "id AS offset", "'{\"n\": 1}' AS value")
    pages.land(docs, f"{scratch}/p", ["folder", "offset"])
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(name)
    read = pages.read_landed_pages(spark, f"{scratch}/p", "n BIGINT, folder BIGINT, offset BIGINT")
    assert spark.conf.get(name) == before
    plan = read._jdf.queryExecution().analyzed().collectLeaves().head().relation()
    assert plan.partitionSchema().isEmpty()
    assert read.agg(F.sum("folder")).first()[0] == 3
