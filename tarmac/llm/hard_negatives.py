"""Hard negatives of anchors, from score windows below each positive, by slots.

An anchor's positives are its best rows of the same label.  The negatives of a
positive with score p are the best rows of other labels with scores from a
share of p up to p.  The windows of an anchor overlap; their upper limits
p1 >= p2 >= ... cut the scores into disjoint slots instead: a score belongs to
the lowest limit that it does not exceed.  A task keeps the best ``k`` rows of
each slot of each anchor (the combiner), Spark the best ``k`` over all tasks.
Read from the lowest slot up, a window's answer is its slot's rows followed by
the answer of the next lower window, cut at ``k`` and at the window's own
lower limit.

Rows are scored where they are read: of the anchors, a wave of bounded bytes at
a time is sent to all tasks, so no row of the table is shuffled, and what is
shuffled is ``k`` rows per task, anchor and slot.  Scores are exact integers.

Defined cases: rows with a null label, id or vector, or a null, NaN or
infinite component take no part; a shorter vector counts as padded with
zeros; other rows of an anchor are those with another vec_id, so rows that
repeat an id are ranked as often as they occur; anchor rows that are equal
are one anchor, and rows that share an id but differ are anchors of their
own; a positive of negative score has an empty window; scores beyond 64 bits
are held at the largest 64-bit value; columns other than those named are not
looked at; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .vectors import Rows, finite_rows, floors, scores

#: Bytes of anchor components that are sent to the tasks at once.
WAVE_BYTES = 1 << 22
#: Scores that a task holds at once.
_CELLS = 1 << 20
_LONG = (np.iinfo(np.int64).min, np.iinfo(np.int64).max)
_NOTHING = tuple(np.zeros(0, np.int64) for _ in range(3))


def _first(order: tuple[np.ndarray, ...], group: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k`` of each group; ``order`` as for lexsort, least important first."""
    at = np.lexsort((*order, group))
    g = group[at]
    start = np.flatnonzero(np.r_[True, g[1:] != g[:-1]]) if len(g) else np.zeros(0, np.int64)
    nth = np.arange(len(g)) - np.repeat(start, np.diff(np.r_[start, len(g)]))
    return at[nth < k]


def _best(batches: Iterator[pa.RecordBatch], anchors: Rows, scale: float, k: int, n_slots: int,
          slot_of: Callable[[np.ndarray, np.ndarray, Rows], tuple[np.ndarray, np.ndarray, np.ndarray]]
          ) -> Iterator[pa.RecordBatch]:
    """(anchor, slot, vec_id, score): the best ``k`` rows of each slot among the rows of a task.

    ``slot_of(scores, floor, rows)`` gives anchor, row and slot of the scores that belong to one;
    ``floor`` is, per anchor and slot, what a full slot asks of a newcomer.
    """
    held = _NOTHING
    new: list[tuple[np.ndarray, ...]] = []
    floor = np.full((len(anchors.ids), n_slots), _LONG[0], np.int64)
    for batch in batches:
        rows = floors(batch, scale)
        for part in rows.parts(max(1, _CELLS // max(len(anchors.ids), 1))):
            s = scores(anchors.m, part.m)
            a, r, slot = slot_of(s, floor, part)
            new.append((a * n_slots + slot, part.ids[r], s[a, r]))
            if sum(len(x[0]) for x in new) > max(_CELLS // 4, len(held[0])):
                held, floor = _cut(held, new, k, floor.shape)
                new = []
    group, ids, score = _cut(held, new, k, floor.shape)[0]
    yield pa.RecordBatch.from_pydict({"anchor": anchors.numbers[group // n_slots], "slot": (group % n_slots).astype(np.int32),
                                      "vec_id": ids, "score": score})


def _cut(held: tuple[np.ndarray, ...], new: list[tuple[np.ndarray, ...]], k: int,
         shape: tuple[int, int]) -> tuple[tuple[np.ndarray, ...], np.ndarray]:
    """The best ``k`` of each group, and what a full group asks of a newcomer."""
    group, ids, score = (np.concatenate(c) for c in zip(held, *new, strict=True))
    kept = _first((ids, ~score), group, k)  # ~x falls as x grows, and cannot overflow
    group, ids, score = group[kept], ids[kept], score[kept]
    size = shape[0] * shape[1]
    low = np.full(size, _LONG[1])
    np.minimum.at(low, group, score)
    return (group, ids, score), np.where(np.bincount(group, minlength=size) >= k, low, _LONG[0]).reshape(shape)


def _positives(anchors: Rows) -> Callable:
    def slot_of(s: np.ndarray, floor: np.ndarray, rows: Rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ok = (rows.labels[None, :] == anchors.labels[:, None]) & (rows.ids[None, :] != anchors.ids[:, None])
        a, r = np.nonzero(ok & (s >= floor[:, :1]))
        return a, r, np.zeros(len(a), np.int64)
    return slot_of


def _negatives(anchors: Rows, limits: np.ndarray, count: np.ndarray, low: int, high: int) -> Callable:
    """``limits``: the positives' scores, best first, one line per anchor; ``count``: how many it has.

    The slot of a score is the place of the lowest limit that it does not exceed.
    """
    last = np.where(count > 0, limits[np.arange(len(limits)), np.maximum(count - 1, 0)], np.iinfo(np.int64).max)
    bottom = np.array([-(-low * int(p) // high) for p in last], object).clip(*_LONG).astype(np.int64)  # least of all windows
    known = np.arange(limits.shape[1])[None, :] < count[:, None]

    def slot_of(s: np.ndarray, floor: np.ndarray, rows: Rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ok = (rows.labels[None, :] != anchors.labels[:, None]) & (count > 0)[:, None]
        a, r = np.nonzero(ok & (s >= bottom[:, None]) & (s <= limits[:, :1]))
        got = s[a, r]
        slot = ((limits[a] >= got[:, None]) & known[a]).sum(axis=1) - 1
        new = got >= floor[a, slot]
        return a[new], r[new], slot[new]
    return slot_of


_FOUND = "anchor long, slot int, vec_id long, score long"


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor", "slot").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _merged(slots: list[Column], k: int) -> list[Column]:
    """The best ``k`` at or below each slot, from the lowest slot up: a slot's rows come before those of all below it."""
    out = [slots[-1]]
    for rows in reversed(slots[:-1]):
        out.append(F.slice(F.concat(rows, out[-1]), 1, k))
    return out[::-1]


def mine(rows: DataFrame, is_anchor: Column, scale: float = 1.0, n_positives: int = 5, k: int = 5,
         low: int = 80, high: int = 100, wave_bytes: int = WAVE_BYTES) -> DataFrame:
    """Hard negatives of the anchors among ``rows`` (vec_id, label, embedding).

    Components become floor(scale * x).  Negatives of a positive score p are rows of another label with
    ``low * p <= high * score <= high * p``.  Returns anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score.
    """
    spark = rows.sparkSession
    vectors = finite_rows(rows)
    anchors = vectors.where(is_anchor).dropDuplicates(["vec_id", "label", "x"]).checkpoint()
    size = anchors.agg(F.count(F.lit(1)), F.max(F.size("x"))).head()
    waves = max(1, -(-size[0] * 8 * max(size[1] or 1, 1) // wave_bytes))
    wave = F.pmod(F.xxhash64("vec_id", "label", "x"), F.lit(waves))
    out = None
    for w in range(waves):
        # A wave is of about wave_bytes by its count; the anchors of all waves never meet on the driver.
        mine_ = _wave(vectors, floors(anchors.where(wave == w).toArrow(), scale), scale, n_positives, k, low, high)
        out = mine_ if out is None else out.unionByName(mine_)
    return out


def _wave(vectors: DataFrame, anchors: Rows, scale: float, n_positives: int, k: int, low: int, high: int) -> DataFrame:
    spark = vectors.sparkSession
    sent = spark.sparkContext.broadcast(anchors)
    found = vectors.mapInArrow(
        lambda it: _best(it, sent.value, scale, n_positives, 1, _positives(sent.value)), _FOUND)
    positives = _top(found, n_positives).checkpoint()

    # Bounded by the wave: n_positives rows an anchor.
    got = positives.select("anchor", "rank", "score").toArrow()
    limits = np.full((len(anchors.ids), n_positives), np.iinfo(np.int64).min, np.int64)
    at = np.searchsorted(anchors.numbers, got["anchor"].to_numpy())
    limits[at, got["rank"].to_numpy() - 1] = got["score"].to_numpy()
    count = np.bincount(at, minlength=len(anchors.ids))
    told = spark.sparkContext.broadcast((limits, count))
    found = vectors.mapInArrow(
        lambda it: _best(it, sent.value, scale, k, n_positives, _negatives(sent.value, *told.value, low, high)), _FOUND)
    slots = [F.sort_array(F.collect_list(F.when(F.col("slot") == j, F.struct(F.bitwise_not("score").alias("down"), "vec_id"))))
             .alias(f"s{j}") for j in range(n_positives)]  # at most k rows a slot
    best = _top(found, k).groupBy("anchor").agg(*slots)
    windows = best.select("anchor", F.posexplode(F.array(*_merged([F.col(f"s{j}") for j in range(n_positives)], k)))
                          .alias("slot", "below"))
    pairs = positives.select("anchor", (F.col("rank") - 1).alias("slot"), F.col("vec_id").alias("positive_id"),
                             F.col("score").alias("positive_score"))
    rows = pairs.join(windows, ["anchor", "slot"]).select("*", F.posexplode("below").alias("at", "hit"))
    rows = rows.withColumn("negative_score", F.bitwise_not("hit.down"))
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    rows = rows.where(wide("negative_score") * high >= wide("positive_score") * low)
    ids = spark.createDataFrame(pa.table({"number": anchors.numbers, "anchor_id": anchors.ids}))
    return rows.join(F.broadcast(ids), rows["anchor"] == ids["number"]).select(
        "anchor_id", "positive_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("negative_id"),
        "positive_score", "negative_score")


SQL = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND list_count(embedding) = len(embedding)
    AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, c.label = a.label AS same, list_inner_product(a.v, c.v)::BIGINT AS score
  FROM e a JOIN e c ON a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5
"""
