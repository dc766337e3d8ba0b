"""Operators against brute-force pandas answers, with hostile rows."""

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tarmac.operators import dedup, keys, lookup, ranking, upsert

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
rows_st = st.lists(st.tuples(st.integers(0, 4), st.integers(0, 3), st.integers(0, 50)), min_size=1, max_size=40)


@SETTINGS
@given(rows_st)
def test_keep_first_equals_pandas(spark, rows):
    data = [(k, v, i) for i, (k, _, v) in enumerate(rows)]       # i = arrival order
    df = spark.createDataFrame(data, "k long, v long, ord long")
    got = sorted(tuple(r) for r in dedup.keep_first(df, ["k"], ["ord"]).collect())
    pdf = pd.DataFrame(data, columns=["k", "v", "ord"]).drop_duplicates(subset=["k"], keep="first")
    assert got == sorted(map(tuple, pdf.itertuples(index=False)))


@SETTINGS
@given(rows_st, st.integers(0, 100))
def test_assign_ids_dense_unique_above_max(spark, rows, start):
    data = [(i, k) for i, (k, _, _) in enumerate(rows)]
    df = spark.createDataFrame(data, "u long, k long").repartition(3)
    out = keys.assign_ids(df, ["k", "u"], "id", start=start).collect()
    ids = sorted(r.id for r in out)
    assert ids == list(range(start + 1, start + 1 + len(data)))
    by_order = [r.id for r in sorted(out, key=lambda r: (r.k, r.u))]
    assert by_order == sorted(by_order)


def test_positions_hot_group_spans_partitions(spark):
    # One group holds most rows; the range sort splits it over partitions.
    data = [(0 if i % 10 else i % 7 + 1, i) for i in range(3000)]
    df = spark.createDataFrame(data, "g long, t long")
    out = keys.positions(df, ["t"], group=["g"]).toPandas()
    want = pd.DataFrame(data, columns=["g", "t"]).sort_values(["g", "t"])
    want["pos"] = want.groupby("g").cumcount() + 1
    merged = out.merge(want, on=["g", "t"], suffixes=("", "_want"))
    assert len(merged) == 3000 and (merged.pos == merged.pos_want).all()


def test_take_while_grouped_and_global(spark):
    data = [(1, 1, "a"), (1, 2, "error"), (1, 3, "a"), (2, 1, "error"), (3, 1, "a"), (3, 2, "a")]
    df = spark.createDataFrame(data, "g long, t long, e string")
    got = sorted(tuple(r) for r in ranking.take_while(df, ["t"], F.col("e") == "error", group=["g"]).collect())
    assert got == [(1, 1, "a"), (3, 1, "a"), (3, 2, "a")]
    got_all = ranking.take_while(df.where("g = 1"), ["t"], F.col("e") == "error").collect()
    assert [r.t for r in got_all] == [1]


def test_top1_null_order_last_but_kept(spark):
    df = spark.createDataFrame([(1, None, 1), (1, 5.0, 2), (2, None, 1)], "g long, ms double, lap long")
    got = sorted(tuple(r) for r in ranking.top1(df, ["g"], ["ms", "lap"]).collect())
    assert got == [(1, 5.0, 2), (2, None, 1)]


def test_rank_within_matches_sql_rank(spark):
    data = [(s, e, float(v)) for s in (1, 2) for e, v in enumerate([5, 3, 5, 1, 3, 9])]
    df = spark.createDataFrame(data, "s long, e long, v double")
    got = {(r.s, r.e): r.rnk for r in ranking.rank_within(df, ["s"], [F.col("v").desc()], ["v"], ["e"]).collect()}
    pdf = pd.DataFrame(data, columns=["s", "e", "v"])
    pdf["r"] = pdf.groupby("s")["v"].rank(method="min", ascending=False).astype(int)
    assert got == {(r.s, r.e): r.r for r in pdf.itertuples()}


def test_resolve_rejects_null_and_unknown_keep_key_zero(spark):
    df = spark.createDataFrame([("a",), (None,), ("zz",), ("z",)], "ref string")
    dim = spark.createDataFrame([("a", 0), ("z", 7)], "ref string, id long")
    ok, rej = lookup.resolve(df, dim, "ref", ["id"])
    assert sorted(tuple(r) for r in ok.collect()) == [("a", 0), ("z", 7)]       # id 0 resolves (Q6)
    assert sorted((r.ref or "") for r in rej.collect()) == ["", "zz"]


def test_lookup_or_create_one_id_per_new_ref(spark):
    refs = spark.createDataFrame([("x",), ("new",), ("new",), ("b",)], "ref string")
    dim = spark.createDataFrame([("x", 4)], "ref string, id long")
    merged, new = keys.lookup_or_create(refs, dim, "ref", "id")
    got = {r.ref: (r.id, r.created) for r in merged.collect()}
    assert got == {"x": (4, False), "b": (5, True), "new": (6, True)}


def test_update_guarded_semantics(spark):
    t = spark.createDataFrame([(1, None, 1.0), (2, 3, 2.0), (3, None, None), (4, None, 1.0)],
                              "k long, a long, b double")
    u = spark.createDataFrame([(1, 10, 10.0), (2, 20, 20.0), (3, 30, None), (1, 11, 11.0)],
                              "k long, na long, nb double").withColumn("o", F.monotonically_increasing_id())
    got = {r.k: (r.a, r.b) for r in upsert.update_guarded(t, u, "k", {"a": "na", "b": "nb"}, order=["o"]).collect()}
    assert got == {1: (11, 11.0), 2: (3, 2.0), 3: (None, None), 4: (None, 1.0)}


def test_update_from_changes_only_distinct(spark):
    t = spark.createDataFrame([(1, None), (2, 5), (3, 6)], "k long, c long")
    u = spark.createDataFrame([(1, 9), (2, 5), (3, 7)], "k long, n long")
    new, changed = upsert.update_from(t, u, "k", "c", "n")
    got = {r.k: (r.c, r._changed) for r in new.collect()}
    assert got == {1: (9, True), 2: (5, False), 3: (7, True)}


def test_insert_new_idempotent(spark):
    target = spark.createDataFrame([(1, "a")], "k long, v string")
    batch = spark.createDataFrame([(1, "z", 0), (2, "b", 1), (2, "c", 2), (None, "n", 3)], "k long, v string, o long")
    once = upsert.apply_insert(target, batch, "k", order=["o"])
    twice = upsert.apply_insert(once, batch, "k", order=["o"])
    assert sorted(tuple(r) for r in twice.collect()) == [(1, "a"), (2, "b")]


def test_page_numbers(spark):
    df = spark.range(95).withColumnRenamed("id", "e")
    got = {r.page: r.n for r in ranking.page_numbers(df, ["e"], 30).groupBy("page").count()
           .withColumnRenamed("count", "n").collect()}
    assert got == {0: 30, 1: 30, 2: 30, 3: 5}


def test_one_page_and_observed_counts(spark):
    from tarmac.operators import filters

    df = spark.range(100).withColumnRenamed("id", "e")
    assert [r.e for r in ranking.one_page(df, ["e"], 30, 30).collect()] == list(range(30, 60))
    tagged = filters.classify(df, [("odd", F.col("e") % 2 == 1)])
    out, obs = filters.observed(tagged)
    out.write.format("noop").mode("overwrite").save()
    assert obs.get == {"n_read": 100, "n_kept": 50}


def _skewed(n=3000):
    # Key 0 holds a third of the rows; the rest spread over 200 keys.
    rows = []
    for i in range(n):
        k = 0 if i % 3 == 0 else 1 + (i * 7919) % 200
        rows.append((k, (i * 104729) % n, "stop" if (i * 31) % 97 == 0 else "go"))
    return rows


def test_keep_first_hot_key(spark):
    rows = _skewed()
    df = spark.createDataFrame(rows, "k long, t long, e string").repartition(8)
    got = sorted(tuple(r) for r in dedup.keep_first(df, ["k"], ["t"]).collect())
    pdf = pd.DataFrame(rows, columns=["k", "t", "e"]).sort_values(["k", "t"]).drop_duplicates("k")
    assert got == sorted(map(tuple, pdf.itertuples(index=False)))


def test_take_while_hot_key(spark):
    rows = _skewed()
    df = spark.createDataFrame(rows, "k long, t long, e string").repartition(8)
    got = sorted(tuple(r) for r in ranking.take_while(df, ["t"], F.col("e") == "stop", group=["k"]).collect())
    pdf = pd.DataFrame(rows, columns=["k", "t", "e"]).sort_values(["k", "t"])
    pdf["seen"] = pdf.groupby("k")["e"].transform(lambda s: (s == "stop").cumsum())
    want = sorted(map(tuple, pdf[pdf.seen == 0][["k", "t", "e"]].itertuples(index=False)))
    assert got == want


def test_rank_within_null_group_and_tie(spark):
    df = spark.createDataFrame([(None, 1, 5.0), (None, 2, 5.0), (None, 3, None), (1, 4, 2.0)],
                               "s long, e long, v double")
    got = {r.e: r.rnk for r in ranking.rank_within(df, ["s"], [F.col("v").desc_nulls_last()], ["v"], ["e"]).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 1}


def test_take_while_null_group_is_a_group(spark):
    df = spark.createDataFrame([(None, 1, "a"), (None, 2, "error"), (None, 3, "a")], "g long, t long, e string")
    got = [r.t for r in ranking.take_while(df, ["t"], F.col("e") == "error", group=["g"]).collect()]
    assert got == [1]
