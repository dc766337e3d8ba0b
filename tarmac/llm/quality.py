"""Quality rules: base counts and hashed n-gram importance (native operations only).

The verdict is the log-likelihood ratio of a document's hashed unigrams and
bigrams between two multinomials over ``buckets`` buckets: one of the trusted
target (documents labelled quality 1), one of the raw corpus (every document).
It is divided by the number of n-grams and compared with ``threshold``.

Both multinomials come from one pass over all documents: n-grams are counted
by bucket before the shuffle, so each task sends at most ``buckets`` rows
however skewed the words are.  The weights (one per bucket, rounded to
millionths so that sums are exact integers and do not depend on order) are
the only thing that goes to the driver; their number is the ``buckets``
parameter.  Scoring needs no shuffle: a document is scored in its own row.

Defined cases: a null or wordless text has all counts 0, fails the base rules
and has no score (null); without trusted documents both multinomials are
smoothed alike and the ratio is finite; a doc_id that is labelled more than
once is trusted if any label says so; repeated rows each get their own row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, text_of

SYMBOLS = r"[#*$%&|<>]"
SCALE = 1_000_000


def _tail(a: Column, start: int, drop: int) -> Column:
    """Elements of ``a`` from ``start`` (1-based), ``drop`` fewer than there are in all."""
    return F.slice(a, F.lit(start), F.greatest(F.size(a) - F.lit(drop), F.lit(0)))


def placed_repeats(trigrams: Column) -> Column:
    """(hash, position) of the 3-word windows in order of hash; null if none repeats.

    Equal windows are found by sorting, so the work is n log n in the length
    of the text, whatever repeats in it.
    """
    placed = F.sort_array(F.transform(trigrams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(trigrams)) < F.size(trigrams), placed)


def repeated_words(placed: Column) -> Column:
    """Words covered by a window whose neighbour in order of hash is equal."""
    pairs = F.arrays_zip(_tail(placed, 1, 1).alias("a"), _tail(placed, 2, 1).alias("b"))
    twins = F.filter(pairs, lambda z: z["a"]["h"] == z["b"]["h"])
    covered = F.flatten(F.transform(twins, lambda z: F.array(
        z["a"]["i"], z["a"]["i"] + 1, z["a"]["i"] + 2, z["b"]["i"], z["b"]["i"] + 1, z["b"]["i"] + 2)))
    return F.when(placed.isNull(), F.lit(0)).otherwise(F.size(F.array_distinct(covered)))


def with_grams(rows: DataFrame) -> DataFrame:
    """Words of ``text`` and the hashes of words, pairs and triples of neighbours, each made from the one before."""
    rows = rows.withColumn("words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    rows = rows.withColumn("ones", F.transform("words", lambda w: F.xxhash64(w)))
    return rows.withColumn("twos", F.zip_with(_tail(F.col("ones"), 1, 1), _tail(F.col("ones"), 2, 1),
                                              lambda a, b: F.xxhash64(a, b)))


def base_counts(docs: DataFrame) -> DataFrame:
    """doc_id, the base columns and the n-gram hashes of every document."""
    rows = with_grams(docs.select("doc_id", text_of(docs).alias("text")))
    lines = F.filter(F.split("text", "\n", -1), lambda x: x.rlike(WORD))
    rows = rows.select(
        "doc_id", "ones", "twos", F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
        lines.alias("lines"),
        F.zip_with(_tail(F.col("twos"), 1, 1), _tail(F.col("ones"), 3, 2), lambda a, b: F.xxhash64(a, b)).alias("trigrams"))
    rows = rows.withColumn("placed", placed_repeats(F.col("trigrams")))
    return rows.select(
        "doc_id", "ones", "twos", "n_words", "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        repeated_words(F.col("placed")).cast("bigint").alias("n_repeat_words"))


def bucket(h: Column, buckets: int) -> Column:
    """The bucket of a hash; ``buckets`` is a power of two."""
    return h.bitwiseAND(F.lit(buckets - 1).cast("bigint")).cast("int")


def bucket_weights(docs: DataFrame, trusted: DataFrame, buckets: int, smooth: float) -> list[int]:
    """Log ratio target / raw of each bucket, in millionths."""
    marks = trusted.select(F.col("doc_id").alias("trusted_id")).where("trusted_id IS NOT NULL").distinct()
    rows = docs.select("doc_id", text_of(docs).alias("text"))
    rows = rows.join(marks.hint("shuffle_hash"), F.col("doc_id") == F.col("trusted_id"), "left")
    rows = with_grams(rows.select(F.col("trusted_id").isNotNull().cast("int").alias("is_trusted"), "text"))
    grams = rows.select("is_trusted", F.explode(F.concat("ones", "twos")).alias("h"))
    counts = grams.groupBy(bucket(F.col("h"), buckets).alias("bucket")).agg(F.count(F.lit(1)).alias("raw"), F.sum("is_trusted").alias("target"))
    found = {r["bucket"]: (r["raw"], r["target"]) for r in counts.collect()}  # at most `buckets` rows
    raw_all = sum(r for r, _ in found.values()) + smooth * buckets
    target_all = sum(t for _, t in found.values()) + smooth * buckets
    out = []
    for b in range(buckets):
        raw, target = found.get(b, (0, 0))
        out.append(round(SCALE * (math.log((target + smooth) / target_all) - math.log((raw + smooth) / raw_all))))
    return out


def quality(docs: DataFrame, labels: DataFrame, buckets: int = 1 << 14, smooth: float = 1.0,
            threshold: float = -0.04, min_words: int = 50, max_repeat_percent: int = 50) -> DataFrame:
    """Base columns, ``score`` (mean log ratio per n-gram) and ``kept`` of every document."""
    trusted = labels.where(F.col("quality") == 1)
    weights = bucket_weights(docs, trusted, buckets, smooth)
    table = F.split(F.lit(",".join(map(str, weights))), ",").cast("array<bigint>")  # folded to a constant
    rows = base_counts(docs)
    add = lambda acc, h: acc + F.get(table, bucket(h, buckets))
    total = F.aggregate("twos", F.aggregate("ones", F.lit(0).cast("bigint"), add), add)
    n = F.size("ones") + F.size("twos")
    score = F.when(n > 0, total / n / float(SCALE))
    failed = ((F.col("n_words") < min_words)
              | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words")))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       failed.alias("base_failed"), score.alias("score")).withColumn(
        "kept", ~F.col("base_failed") & F.coalesce(F.col("score") >= threshold, F.lit(False)))
