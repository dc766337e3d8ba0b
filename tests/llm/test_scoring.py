"""Mixing, quality, toxicity, language and search."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from tarmac.llm import language, mixing, quality, topk, toxicity
from tarmac.llm.queries import ORACLE, QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 1, 0), (2, 0, 1), (7, 0, 1), (None, 1, 1), (12, None, None)],
                                 "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, name):
    import duckdb

    c = duckdb.connect()
    for t in ("documents", "embeddings"):
        c.execute(f"CREATE VIEW {t} AS FROM '{SF}/{t}.parquet'")
    want = c.sql(ORACLE[name])
    got = QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(want.project(",".join(columns)).fetchall())


def test_targets_reach_the_share(spark):
    sizes = spark.createDataFrame([("a", 10), ("a", 90), ("b", 1000), (None, 5), ("c", 0)], "source string, size long")
    rows = {r.source: r for r in mixing.source_targets(sizes).collect()}
    # weights 3, 1, 2, 3 for a, b, c, null: a and null stop at twice their size, b takes the rest
    assert rows["a"].target == 200 and rows[None].target == 10 and rows["c"].target == 0
    assert rows["b"].target == pytest.approx(1.5 * 1105 - 210)
    assert rows["a"].rate == 2


def test_mix_is_repeatable_and_near_its_target(spark, odd):
    docs = spark.range(20_000).selectExpr("id AS doc_id", "repeat('w ', cast(id % 7 + 1 AS int)) AS text",
                                          "concat('s', id % 3) AS source")
    first = {r.doc_id: r for r in mixing.taken_words(docs).collect()}
    again = {r.doc_id: r for r in mixing.taken_words(docs.repartition(7)).collect()}
    assert first == again
    for s in range(3):
        rows = [r for r in first.values() if r.doc_id % 3 == s]
        assert sum(r.taken for r in rows) == pytest.approx(rows[0].target, rel=0.03)
    assert all(r.taken <= 2 * r.size for r in first.values())
    mixed = mixing.mix(odd)
    assert mixed.columns == odd.columns
    copies = Counter(r.doc_id for r in mixed.collect())
    # rows that share an id, or have none, are drawn one by one
    nameless = spark.createDataFrame([(None, f"text {i}", "a") for i in range(2_000)] + [(7, "same text", "a")] * 2_000
                                     + [(i, "one two", "b") for i in range(4_000)], "doc_id long, text string, source string")
    taken = mixing.taken_words(nameless).collect()
    for own in (lambda r: r.doc_id is None, lambda r: r.doc_id == 7 and r.target == taken[0].target):
        got = [r for r in taken if own(r)]
        share = got[0].target / got[0].source_size
        assert sum(r.taken for r in got) == pytest.approx(share * sum(r.size for r in got), rel=0.06)
    counted = mixing.mix_counts(odd).groupBy("doc_id").sum("copies").collect()
    assert copies == Counter({r[0]: r[1] for r in counted if r[1]})


def test_mixing_empty(none):
    assert mixing.taken_words(none).count() == 0 and mixing.mix(none).count() == 0


def base(text):
    words, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
    grams = Counter(zip(words, words[1:], words[2:]))
    hit = set()
    for i, g in enumerate(zip(words, words[1:], words[2:])):
        if grams[g] > 1:
            hit |= {i, i + 1, i + 2}
    failed = len(words) < 50 or 100 * len(hit) > 50 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit), failed)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def grams(text):
    ones = [xxhash.xxh64_intdigest(w.encode(), seed=42) for w in WORD.findall(text)]
    twos = [xxhash.xxh64_intdigest(b.to_bytes(8, "little"), seed=xxhash.xxh64_intdigest(a.to_bytes(8, "little"), seed=42))
            for a, b in zip(ones, ones[1:])]
    return [g & 1023 for g in ones + twos]


@pytest.mark.parametrize("name", ["odd", "documents"])
def test_quality_is_brute_force(request, spark, labels, name):
    docs = request.getfixturevalue(name)
    if name == "documents":
        labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    rows = docs.select("doc_id", "text").collect()
    trusted = {r.doc_id for r in labels.collect() if r.quality == 1 and r.doc_id is not None}
    raw, target = Counter(), Counter()
    for r in rows:
        raw.update(grams(r.text or ""))
        if r.doc_id in trusted:
            target.update(grams(r.text or ""))
    n_raw, n_target = raw.total() + 1024, target.total() + 1024
    weight = [round(1e6 * (np.log((target[b] + 1) / n_target) - np.log((raw[b] + 1) / n_raw))) for b in range(1024)]
    want = []
    for r in rows:
        g, b = grams(r.text or ""), base(r.text or "")
        score = sum(weight[x] for x in g) / len(g) / 1e6 if g else None
        want.append((r.doc_id, *b, not b[-1] and score >= -0.04))
    got = quality.quality(docs, labels, buckets=1024).drop("score")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_quality_without_labels_or_rows(spark, odd, none, labels):
    assert quality.quality(odd, labels.limit(0)).count() == odd.count()
    assert quality.quality(none, labels).count() == 0


def test_toxicity_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    marks = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    out = toxicity.score(docs, toxicity.train(docs, marks))
    rows = out.join(marks, "doc_id").where("held_out").collect()
    hit = [r.predicted == 1 for r in rows if r.toxic == 1]
    false = [r.predicted == 1 for r in rows if r.toxic == 0]
    assert np.mean(hit) >= 0.8 and np.mean(false) <= 0.02
    assert all((zlib.crc32(str(r.doc_id).encode()) % 3 == 1) == r.held_out for r in rows)


def test_toxicity_odd_rows(odd, none, labels):
    model = toxicity.train(odd, labels, support=1)
    rows = toxicity.score(odd, model).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    named = odd.withColumn("extra col", odd["lang"]).withColumn("a.b", odd["lang"])
    assert toxicity.keep_clean(named, labels).columns == named.columns
    assert toxicity.keep_clean(odd, labels.limit(0)).count() == odd.count()
    assert toxicity.score(none, model).count() == 0


def test_only_copies_leave_the_mining(spark):
    rng = np.random.default_rng(11)
    passage = [f"common{i}" for i in range(60)]
    own = ["only" + chr(97 + i // 26) + chr(97 + i % 26) for i in range(120)]
    rows = [(i, 1, " ".join([f"w{rng.integers(10**6)}" for _ in range(140)] + passage + [own[i]])) for i in range(120)]
    rows += [(1_000 + i, 1, t + " tail") for i, _, t in rows[:5]]  # near copies of kept rows
    rows += [rows[7], rows[7], (7, 1, "another text with a repeated id onlyother")]
    rows += [(5_000, 0, "clean words")]
    sample = spark.createDataFrame(rows, "doc_id long, label int, text string")
    found = toxicity.mine(sample.repartition(5), voters=10**6, support=1, precision=0.98)
    assert set(own) <= set(found)
    assert {"tail", "onlyother", "clean"} & set(found) == {"onlyother"}


def test_copies_are_brute_force():
    rng = np.random.default_rng(5)
    sets = []
    for _ in range(60):
        base = np.unique(rng.integers(0, 1 << 32, rng.integers(1, 80), dtype=np.uint32))
        sets += [base, *(np.unique(np.r_[base[rng.random(len(base)) < keep], rng.integers(0, 1 << 32, 1, dtype=np.uint32)])
                         for keep in (0.95, 0.9, 0.85, 0.8))]
    is_copy, kept = toxicity.Copies(), []
    for s in sets:
        want = any(5 * len(np.intersect1d(s, k)) >= 4 * len(np.union1d(s, k)) for k in kept)
        assert is_copy(s) == want
        if not want:
            kept.append(s)
    assert 60 < len(kept) < len(sets)


def test_label_model_trusts_agreement():
    rng = np.random.default_rng(0)
    truth = rng.random(4_000) < 0.2
    votes = np.c_[[truth & (rng.random(4_000) < 0.6) | ~truth & (rng.random(4_000) < 0.005) for _ in range(6)]].T
    p = toxicity.label_model(votes)
    assert ((p > 0.5) == truth).mean() > 0.97


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = language.identify(docs, language.train(docs)).join(docs, "doc_id").where("held_out AND lang_pred <> 'und'").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) >= 0.98


def test_language_odd_rows(odd, none):
    model = language.train(odd)
    rows = language.identify(odd, model).collect()
    assert len(rows) == odd.count()
    assert all(r.lang_pred == "und" and r.score == 0 for r in rows if r.doc_id in (4, 5, 6))
    assert language.identify(none, language.train(none)).count() == 0
    assert {r.lang_pred for r in language.identify(odd, language.train(none)).collect()} == {"und"}
    signs = odd.sparkSession.createDataFrame([(i, x) for i, x in enumerate(("²", "½ 12", "①②", "Ⅷ", "a", "ª"))], "doc_id long, text string")
    assert [r.lang_pred == "und" for r in language.identify(signs, model).orderBy("doc_id").collect()] == [True] * 4 + [False] * 2


def test_samples_are_bounded_by_rows(spark):
    """An id that stands for many rows takes no more of a sample than its bound."""
    own = next(i for i in range(8) if zlib.crc32(str(i).encode()) % 4 != 2 and zlib.crc32(str(i).encode()) % 3 != 1)
    rows = [(own, f"word{i} and more", "en", 1) for i in range(300)] + [(own, "the same text", "en", 1)] * 300 \
        + [(i, f"palabra{i} nueva", "es", 0) for i in range(8, 400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int").repartition(8)
    size = []
    fit = language.fit
    try:
        language.fit = lambda x, langs, families: size.append(Counter(langs)) or fit(x, langs, families)
        language.train(docs, per_language=50)
    finally:
        language.fit = fit
    assert size[0]["en"] == 50 and size[0]["es"] == 50
    labels = docs.select("doc_id", "toxic").distinct()
    sample = toxicity.labelled_sample(docs, labels, "toxic", 3, 1, 40).groupBy("label").count().collect()
    assert all(r["count"] <= 40 for r in sample) and len(sample) == 2


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, qb int, ids string") \
        .select("vec_id", "embedding", "label")


def test_search_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 1, 1, ""), (100, [0.5, -1.0], 1, 1, ""), (200, None, 1, 1, ""), (300, [nan, 1.0], 1, 1, ""),
            (400, [inf, 1.0], 1, 1, ""), (500, [None, 1.0], 1, 1, ""), (None, [1.0, 1.0], 1, 1, ""), (7, [3.0], 1, 1, "")]
    rows += [(i, [1.0, 1.0], 1, 1, "") for i in range(1, 6)] + [(3, [1.0, 1.0], 1, 1, "")]
    v = topk.quantized(vectors(spark, rows))
    found = topk.search(v.where("vec_id % 100 = 0"), v, k=4, wave_bytes=16)
    got = {}
    for r in found.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    m = 1024 * 1024
    assert got == {0: [(1, 3 * m), (2, 3 * m), (3, 3 * m), (3, 3 * m)], 100: [(7, 3 * m // 2), (1, -m // 2), (2, -m // 2), (3, -m // 2)]}
    assert topk.search(v.where("vec_id < 0"), v).count() == 0
    assert topk.search(v, v.where("vec_id < 0")).count() == 0


def test_search_large_components(spark):
    """Components of 65,536 and more take part; scores are exact integers, and held at 64 bits."""
    rows = [(i, [70000.0 + i, -(2.0 ** 18) * i, 3.0], 1, 1, "") for i in range(0, 300, 4)]
    v = topk.quantized(vectors(spark, rows))
    whole = {r.vec_id: [int(x) for x in r.v] for r in v.collect()}
    found = topk.search(v.where("vec_id % 100 = 0"), v, k=5).collect()
    for q in (0, 100, 200):
        best = sorted((-sum(a * b for a, b in zip(whole[q], w)), i) for i, w in whole.items() if i != q)[:5]
        assert sorted((-r.score, r.vec_id) for r in found if r.query_id == q) == best
    v = topk.quantized(spark.createDataFrame([(0, [1e300]), (1, [1e300]), (2, [-1e300]), (3, [0.0]), (4, [1e306])],
                                             "vec_id long, embedding array<double>"))
    top = 2 ** 63 - 1
    assert [(r.vec_id, r.score) for r in topk.search(v.where("vec_id = 0"), v, k=4).orderBy("rank").collect()] \
        == [(1, top), (4, top), (3, 0), (2, -top - 1)]


def test_repeated_query_ids_are_the_sql(spark, tmp_path):
    import duckdb

    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=4).astype(float).tolist(), 0, 0, "") for i in [*range(300), 100, 100, 200, 150]]
    rows.append(rows[200])  # a whole query row twice
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, qb int, ids string") \
        .select("vec_id", "embedding").repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    c = duckdb.connect()
    c.execute(f"CREATE VIEW embeddings AS FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    want = c.sql(ORACLE["op3_exact_topk"]).project("query_id, rank, vec_id, score").fetchall()
    got = QUERIES["op3_exact_topk"](spark, str(tmp_path)).select("query_id", "rank", "vec_id", "score").collect()
    assert sorted(map(tuple, got)) == sorted(want) and len(want) == 30
