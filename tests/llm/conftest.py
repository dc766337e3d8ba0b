import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that the operators use themselves
    *[T.StructField(c, T.StringType()) for c in (
        "code", "fingerprint", "component_id", "size", "rate", "copies", "ord", "th", "kept", "score", "row", "block", "ids",
        "label", "key", "words", "vec_id", "h", "pos")]])

PASSAGE = " ".join(f"shared{i}" for i in range(60))


def rows():
    """Nulls, empty and very long texts, ties, repeated rows, repeated ids, odd white space."""
    out = [
        (1, "the quick brown fox jumps over the lazy dog " + PASSAGE, "en", "b"),
        (2, PASSAGE + " and then something else entirely", "en", "a"),
        (3, "intro words " + PASSAGE, None, None),
        (4, None, "en", "b"), (5, "", "de", "b"), (6, "  \t\n\x0b ", "de", None),
        (7, "one two", "en", "a"), (8, "ONE two", "en", "a"),
        (9, " ".join(f"w{i % 977}" for i in range(30_000)), "en", "c"),
        (10, PASSAGE, "fr", "a"), (10, PASSAGE, "fr", "a"), (10, "another text with a repeated id", "fr", "a"),
        (None, PASSAGE, "fr", "a"), (None, None, None, None), (11, PASSAGE, "fr", "a"),
        (12, "a a a a a a a a " * 20, "es", "c"), (13, "a a a a a a a a " * 20, "es", "c"),
        (14, "naïve café — ñandú x   日本語 <|endoftext|> don't  we'll \x1c y\n\n  z ", "es", "c"),
        (15, "line one\nline two\nline one\n\n \nline one", "en", "c"),
    ]
    return [(*r, None if r[1] is None else len(r[1]), *["x"] * 19) for r in out]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet").cache()
