"""Column functions on hostile values (FIXTURES.md §6)."""

from pyspark.sql import functions as F

from tarmac.functions import clean as C


def one(spark, expr, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()[0]


def test_to_number(spark):
    assert one(spark, C.to_number("x"), "12.5") == 12.5
    assert one(spark, C.to_number("x"), "\\N") is None
    assert one(spark, C.to_number("x"), "R") is None
    assert one(spark, C.to_number("x"), " 1e3 ") == 1000.0


def test_null_sentinel_and_csv_tokens(spark):
    assert one(spark, C.null_sentinel("x"), "\\N") is None
    assert one(spark, C.null_sentinel("x"), "N") == "N"
    assert one(spark, C.csv_nulls("x"), "NA") is None
    assert one(spark, C.csv_nulls("x"), "\\N") == "\\N"


def test_duration_exact_and_legacy(spark):
    assert one(spark, C.duration_ms("x"), "1:10.040") == 70040
    assert one(spark, C.duration_ms("x", legacy_float=True), "1:10.040") == 70039
    assert one(spark, C.duration_ms("x"), "23.004") == 23004
    assert one(spark, C.duration_ms("x"), "1:14.773") == 74773
    assert one(spark, C.duration_seconds("x"), "1:14.773") == 74.773


def test_duration_matches_integer_formula(spark):
    rows = [(m, s, ms) for m in range(0, 3) for s in range(0, 60, 7) for ms in (0, 40, 999)]
    df = spark.createDataFrame(rows, "m int, s int, ms int")
    txt = F.concat(F.col("m").cast("string"), F.lit(":"), F.lpad(F.col("s").cast("string"), 2, "0"),
                   F.lit("."), F.lpad(F.col("ms").cast("string"), 3, "0"))
    out = df.select((F.col("m") * 60000 + F.col("s") * 1000 + F.col("ms")).alias("want"),
                    C.duration_ms(txt).alias("got")).collect()
    assert all(r.want == r.got for r in out)


def test_trunc_int_toward_zero(spark):
    assert one(spark, C.trunc_int("x"), "-37.84") == -37
    assert one(spark, C.trunc_int("x"), "37.84") == 37


def test_digit_guard_and_safe_int(spark):
    assert one(spark, C.digits_only("x"), "R") is None
    assert one(spark, C.digits_only("x"), "12") == 12
    assert one(spark, C.digits_only("x"), "") is None
    assert one(spark, C.safe_int("x"), "") is None
    assert one(spark, C.safe_int("x"), "0") == 0


def test_keys_defaults_and_fallbacks(spark):
    df = spark.createDataFrame([(1, None, "")], "a int, b string, c string")
    r = df.select(C.compose_key("a", "b", F.lit("x")).alias("k"),
                  C.field_or_default("b").alias("d"),
                  C.truthy_fallback("c", "fb").alias("t"),
                  C.text_equals(F.lit(1), "1").alias("e")).first()
    assert r.k == "1_x" and r.d == "Unknown" and r.t == "fb" and r.e is True


def test_strip_z_and_times(spark):
    assert one(spark, C.strip_z("x"), "13:00:00Z") == "13:00:00"
    ts = C.to_timestamp_fmt(F.col("x"))
    assert one(spark, C.time_of_day(ts), "2024-03-01 13:45:10") == "13:45:10"
    assert one(spark, ts, "not a time") is None
    assert one(spark, C.date_to_ts_text(F.to_date(F.col("x"))), "2024-03-01") == "2024-03-01T00:00:00"


def test_fill_zero_text_and_numbers(spark):
    df = spark.createDataFrame([(None, None)], "n double, t string")
    r = C.fill_zero(df, ["n", "t", "missing"]).first()
    assert r.n == 0.0 and r.t == "0"


def test_exact_sum_is_order_independent(spark):
    vals = [(0.1,), (0.2,), (0.3,)] * 100
    got = spark.createDataFrame(vals, "v double").repartition(7).agg(C.exact_sum("v")).first()[0]
    assert got == 60.0


def test_to_bigint_equals_try_cast(spark):
    vals = ["1", " 12 ", "+5", "-7", "1.0", "1e3", "0x1F", "", " ", "9223372036854775807",
            "9223372036854775808", "12x", "\t3\n", "\x013\x7f", "1_000", "\u0663", "--1", "+", "00012", "-0",
            "\u20003", None]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    out = df.select(F.col("s").try_cast("bigint").alias("a"), C.to_bigint("s").alias("b")).collect()
    assert all(r.a == r.b for r in out), [(v, r.a, r.b) for v, r in zip(vals, out) if r.a != r.b]


def test_nan_to_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.5,), (None,)], "x double")
    assert [r[0] for r in df.select(C.nan_to_null("x")).collect()] == [None, 1.5, None]


def test_strict_int_raises_on_bad_text_under_ansi(spark):
    import pytest
    from pyspark.errors import PySparkException

    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    df = spark.createDataFrame([('{"k": "x"}',)], "props string")
    with pytest.raises((PySparkException, Exception)) as err:
        df.select(C.strict_int(F.get_json_object("props", "$.k"))).collect()
    assert "CAST_INVALID_INPUT" in str(err.value) or "cast" in str(err.value).lower()


def test_json_field_or_default_missing_vs_null(spark):
    df = spark.createDataFrame([('{"status": "Finished"}',), ('{"status": null}',), ('{}',)], "v string")
    got = [r[0] for r in df.select(C.json_field_or_default("v", "$.status")).collect()]
    assert got == ["Finished", None, "Unknown"]
    assert [r[0] for r in df.select(C.field_or_default(F.get_json_object("v", "$.status"))).collect()] == \
        ["Finished", "Unknown", "Unknown"]                                   # the default (coalesce) form
