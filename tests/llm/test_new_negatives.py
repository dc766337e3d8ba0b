"""Hard negatives against a loop over all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.llm import hard_negatives
from tarmac.llm.vectors import scores

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
                       T.StructField("label", T.IntegerType()),
                       *[T.StructField(c, T.StringType()) for c in ("x", "anchor", "slot", "score", "rank", "number")]])


def frame(spark, rows):
    return spark.createDataFrame([(*r, *["?"] * 6) for r in rows], SCHEMA).repartition(4)


def brute(rows, scale, k=5):
    ok = [(i, [math.floor(scale * x) for x in v], g) for i, v, g in rows
          if i is not None and g is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, v, g in {(i, tuple(v), g) for i, v, g in ok if i % 100 == 0}:
        other = sorted((-sum(map(int.__mul__, v, w)), j, h) for j, w, h in ok if j != i)
        for s, j, _ in [o for o in other if o[2] == g][:k]:
            p = -s
            hits = [(-t, n) for t, n, h in other if h != g and 80 * p <= -100 * t <= 100 * p][:k]
            out += [(i, j, r + 1, n, p, t) for r, (t, n) in enumerate(hits)]
    return sorted(out)


def mined(df, scale, **kw):
    return sorted(map(tuple, hard_negatives.mine(df, F.col("vec_id") % 100 == 0, scale=scale, **kw).collect()))


def random_rows(n, dim, seed, spread=1.0):
    rng = np.random.default_rng(seed)
    centre = rng.normal(0, 1, dim)
    return [(i, (centre + rng.normal(0, spread, dim)).tolist(), int(rng.integers(0, 4))) for i in range(n)]


@pytest.mark.parametrize("wave_bytes", [1 << 22, 64])
def test_random_vectors(spark, wave_bytes):
    rows = random_rows(400, 8, 1, 0.3)
    assert mined(frame(spark, rows), 256.0, wave_bytes=wave_bytes) == brute(rows, 256.0)


def test_ties_repeats_and_a_hot_vector(spark):
    rows = [(i, [1.0, 0.5], i % 2) for i in range(120)]                       # all alike: ties by id
    rows += [(200, [1.0, 0.5], 0), (200, [1.0, 0.5], 0), (200, [0.25, 0.5], 1)]    # equal and unequal anchors of one id
    rows += [(300 + i, [0.9 + i / 1000, 0.5], 1) for i in range(60)] + [(7, [1.0, 0.5], 1)] * 3
    assert mined(frame(spark, rows), 256.0) == brute(rows, 256.0)


def test_rows_that_take_no_part(spark):
    rows = random_rows(150, 4, 3, 0.2)
    rows += [(None, [1.0] * 4, 1), (100, None, 1), (100, [1.0, None, 1.0, 1.0], 2), (100, [math.nan] * 4, 2),
             (100, [math.inf, 0.0, 0.0, 0.0], 2), (100, [1.0] * 4, None), (100, [], 1), (100, [2.0, 2.0], 1),
             (100, [-3.0] * 4, 1)]
    got = mined(frame(spark, rows), 256.0)
    assert got == brute(rows, 256.0) and any(r[4] == 0 for r in got)   # an empty vector is one of zeros


def test_large_components_are_exact(spark):
    rows = [(i, [float(3 ** 19 + i), float(2 ** 29 + 7 * i)], i % 3) for i in range(0, 300, 5)]
    assert mined(frame(spark, rows), 1.0) == brute(rows, 1.0)
    a = np.array([[1e300, 1.0]])
    assert scores(a, a)[0, 0] == np.iinfo(np.int64).max and scores(a, -a)[0, 0] == np.iinfo(np.int64).min


def test_no_rows(spark):
    assert mined(frame(spark, []), 256.0) == []
    assert mined(frame(spark, [(1, [1.0], 1)]), 256.0) == [] and mined(frame(spark, [(100, [1.0], 1)]), 256.0) == []
