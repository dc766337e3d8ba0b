"""Mixing sources to target weights (native DataFrame operations only).

1. Each document's size is its number of words; sizes are summed per source.
2. Weighted sources share ``share`` of all words.  A source's target stops at
   ``max_repeat`` times its size; what exceeds it is shared again by weight
   among the others until none is above (water filling).
3. A source's repetition rate is target / size.  Every document is emitted
   floor(rate) times, plus once more if a hash of its id, its text and its
   number among rows equal in both, read as a number in [0, 1), is below the
   fraction.  The draw depends on nothing but the seed and the row, so reruns
   and lost executors give the same mix, and rows that share an id, or have
   none, are drawn one by one.  Only rows of repeated ids are shuffled to be
   numbered.

The per-source table holds one row per source.  Only three numbers a round
go to the driver (sum of the stopped targets, weight of the free sources,
their count), whatever the number of sources.

Defined cases: a null text has size 0; null sources form one source, ordered
last; a source of size 0 has target 0 and rate 0, so its (empty) documents
are dropped from the mix; a null doc_id draws as the empty id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.keys import positions
from .common import WORD, column, text_of

DRAW_DIGITS = 12


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def draw(row: Column, seed: str) -> Column:
    """A number in [0, 1) fixed by ``seed`` and the row's own text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), row), 256)
    return F.conv(F.substring(digest, 1, DRAW_DIGITS), 16, 10).cast("double") / float(16 ** DRAW_DIGITS)


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` (doc_id, source, digest ...) with ``nth``: 0, 1, ... among rows equal in doc_id and digest, by source."""
    again = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select(
        F.col("doc_id").alias("again_id"), F.lit(True).alias("again")).checkpoint()
    if again.isEmpty():
        return rows.withColumn("nth", F.lit(0).cast("bigint"))
    told = rows.join(again, rows["doc_id"].eqNullSafe(again["again_id"]), "left").drop("again_id")
    once = told.where(F.col("again").isNull()).drop("again").withColumn("nth", F.lit(0).cast("bigint"))
    more = positions(told.where("again").drop("again"), ["source"], name="nth", group=["doc_id", "digest"])
    return once.unionByName(more.withColumn("nth", F.col("nth") - 1))


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (3.0, 1.0, 2.0), share: float = 1.5,
                   max_repeat: float = 2.0) -> DataFrame:
    """(source, source_size, target, rate) of ``sizes`` (source, size).

    ``weights`` repeat over the sources in code-point order, null last.
    """
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = positions(sums, ["source"], name="pos")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     (F.pmod(F.col("pos") - 1, F.lit(len(weights))) + 1).cast("int"))
    src = ranked.select("source", "source_size", w.alias("weight"),
                        (F.col("source_size") * F.lit(max_repeat)).alias("stop")).checkpoint()
    total = (src.agg(F.sum("source_size")).head()[0] or 0) * share
    # Rounds of resharing: a source is stopped once level * weight reaches its stop.
    # The level only rises, so the stopped set only grows; it is settled when its size is.
    level, stopped = 0.0, -1
    while True:
        free = F.col("weight") * F.lit(level) < F.col("stop")
        row = src.agg(F.sum(F.when(~free, F.col("stop")).otherwise(0.0)).alias("fixed"),
                      F.sum(F.when(free, F.col("weight")).otherwise(0.0)).alias("open"),
                      F.sum((~free).cast("int")).alias("n")).head()
        if not row["open"] or row["n"] == stopped:
            break
        stopped, level = row["n"], (total - row["fixed"]) / row["open"]
    target = F.least(F.col("stop"), F.col("weight") * F.lit(level))
    return src.select("source", "source_size", target.alias("target"),
                      F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(0.0).alias("rate"))


def mix_counts(docs: DataFrame, weights: tuple[float, ...] = (3.0, 1.0, 2.0), share: float = 1.5,
               max_repeat: float = 2.0, seed: str = "mix", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, rate, copies (and ``keep``)."""
    rows = docs.select("doc_id", "source", word_count(docs["text"].cast("string")).alias("size"),
                       F.md5(text_of(docs)).alias("digest"), *[column(docs, c).alias(f"kept_{c}") for c in keep])
    sizes = rows.select("source", "size")
    src = source_targets(sizes, weights, share, max_repeat).withColumnRenamed("source", "src")
    rows = numbered(rows)
    out = rows.join(src, rows["source"].eqNullSafe(src["src"]), "left").drop("src")
    whole = F.floor("rate")
    row = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "digest", F.col("nth").cast("string"))
    extra = (draw(row, seed) < F.col("rate") - whole).cast("bigint")
    return out.withColumn("copies", (whole + extra).cast("bigint")).drop("digest", "nth")


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: the rows of ``docs``, each as often as the mix takes it, same columns."""
    counted = mix_counts(docs, keep=tuple(docs.columns), **options)
    taken = counted.where(F.col("copies") > 0).withColumn(
        "copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
    return taken.select(*[column(taken, f"kept_{c}").alias(c) for c in docs.columns])


def taken_words(docs: DataFrame, **options) -> DataFrame:
    """Digest of the mix: doc_id, size, source_size, target, taken."""
    out = mix_counts(docs, **options)
    return out.select("doc_id", "size", "source_size", "target",
                      (F.col("size") * F.col("copies")).alias("taken"))


#: The same rows in DuckDB SQL.  The water level is that of the shortest prefix, in order of
#: stop / weight, that leaves every later source below its stop.
SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(text, '')) AS digest,
         row_number() OVER (PARTITION BY doc_id, md5(coalesce(text, '')) ORDER BY source NULLS LAST) - 1 AS nth
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
  SELECT source, source_size, source_size * 2.0::DOUBLE AS stop,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
              WHEN 0 THEN 3.0 WHEN 1 THEN 1.0 ELSE 2.0 END::DOUBLE AS weight
  FROM s
), o AS (
  SELECT *, stop / weight AS ratio,
         coalesce(sum(stop) OVER before, 0)::DOUBLE AS fixed,
         sum(weight) OVER after AS open,
         (sum(source_size) OVER ())::DOUBLE * 1.5 AS total
  FROM w
  WINDOW before AS (ORDER BY stop / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         after AS (ORDER BY stop / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), lev AS (
  SELECT coalesce(max((total - fixed) / open) FILTER (WHERE (total - fixed) / open < ratio), 0) AS level FROM o
), t AS (
  SELECT source, source_size, least(stop, weight * level)::DOUBLE AS target,
         CASE WHEN source_size > 0 THEN least(stop, weight * level) / source_size ELSE 0 END::DOUBLE AS rate
  FROM w, lev
)
SELECT d.doc_id, d.size, t.source_size, t.target,
       d.size * (floor(t.rate)::BIGINT + CASE WHEN
         ('0x' || substr(sha256('mix:' || coalesce(d.doc_id::VARCHAR, '') || ':' || d.digest || ':' || d.nth), 1, 12))::BIGINT::DOUBLE
           / 281474976710656.0 < t.rate - floor(t.rate) THEN 1 ELSE 0 END) AS taken
FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
"""
