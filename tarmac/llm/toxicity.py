"""Toxicity by weak supervision: mined voters, a generative label model, a linear classifier.

1. Voters.  From a bounded sample of labelled rows (``per_class`` of each
   class, by hash of the id; of toxic texts that share 0.8 of their 3-word
   shingles the smallest id alone counts) the words and word
   stems that toxic documents have and clean ones lack are mined: whole words
   are the lexicon, stems the patterns.  A voter votes toxic where it occurs
   and abstains elsewhere; one more voter votes clean where none occurs.
2. Label model.  Expectation maximisation over the votes alone estimates how
   often each voter fires on either class.  Voters whose firing stays
   correlated once the class is known form a clique and share one vote.
3. Classifier.  Logistic regression from voter occurrences to the label
   model's posteriors.  It scores every whole text, in one pass without a
   shuffle.

The label model never sees a label, and neither the classifier: labels only
choose which words are worth a voter.

Defined cases: null, empty and wordless texts get the score of a text in which
no voter fires; without toxic labels nothing is mined and every score is 0;
a doc_id labelled twice counts as toxic if any label says so; repeated rows
and rows without a doc_id are scored like all others.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import column, text_of

_WORD = re.compile(r"[^\W\d_]+")
STEMS = (4, 5, 6)
SHARED = (4, 5)  # the Jaccard similarity of shingles from which two texts are copies


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text falls in the fold that is never learned from; false without an id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def words_of(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def patterns_of(text: str) -> set[str]:
    """Words, and stems with a star."""
    words = words_of(text)
    out = set(words)
    for k in STEMS:
        out.update({w[:k] + "*" for w in words if len(w) >= k})
    return out


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, fold: int, per_class: int) -> DataFrame:
    """(doc_id, label, text): at most ``per_class`` labelled rows of each class outside the fold, by hash of the id."""
    marks = (labels.select(labels["doc_id"].cast("bigint").alias("id"), labels[label].alias("label"))
             .where("id IS NOT NULL AND label IS NOT NULL").where(~held_out(F.col("id"), folds, fold))
             .groupBy("id").agg(F.max("label").alias("label")))
    of_class = lambda own: marks.where(own).orderBy(F.xxhash64("id"), "id").limit(per_class)
    chosen = of_class(F.col("label") == 1).unionByName(of_class(F.col("label") != 1)).select("id", "label")
    rows = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), text_of(docs).alias("text"))
    # At most per_class ids of each class are broadcast.
    found = rows.join(F.broadcast(chosen), F.col("doc_id") == F.col("id")).select("doc_id", "label", "text").checkpoint()
    # An id may stand for any number of rows, so the rows are bounded too.
    first = lambda own: found.where(own).orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text")).limit(per_class)
    return first(F.col("label") == 1).unionByName(first(F.col("label") != 1))


def _shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, th, shingles): the distinct hashed 3-word shingles in order, as bytes; fewer words make one."""
    for b in batches:
        out = []
        for t in b.column(2).to_pylist():
            w = t.split()
            h = [zlib.crc32(" ".join(w[i:i + 3]).encode("utf-8", "surrogatepass")) for i in range(max(1, len(w) - 2))]
            out.append(np.unique(np.array(h, np.uint32)).tobytes())
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.binary())], ["doc_id", "th", "shingles"])


class Copies:
    """Whether a set of shingles shares ``SHARED`` (a ratio) of the union with a set kept before; all others are kept.

    Two sets that share so much meet in their smallest n - ceil(ratio * n) + 1 hashes, so no pair is missed.
    """

    def __init__(self) -> None:
        self.kept: list[np.ndarray] = []
        self.at: dict[int, list[int]] = {}

    def __call__(self, shingles: np.ndarray) -> bool:
        up, down = SHARED
        n = len(shingles)
        first = shingles[:n + (-up * n // down) + 1].tolist()
        for i in sorted({i for x in first for i in self.at.get(x, ())}):
            other = self.kept[i]
            if down * min(n, len(other)) < up * max(n, len(other)):
                continue
            both = len(np.intersect1d(shingles, other, assume_unique=True))
            if down * both >= up * (n + len(other) - both):
                return True
        for x in first:
            self.at.setdefault(x, []).append(len(self.kept))
        self.kept.append(shingles)
        return False


def _pattern_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for label, text in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
            found = sorted(patterns_of(text))
            yield pa.RecordBatch.from_pydict({"pattern": pa.array(found, pa.string()),
                                              "label": pa.array([int(label)] * len(found), pa.int64())})


def mine(sample: DataFrame, voters: int, support: int, precision: float) -> list[str]:
    """Patterns that mark toxic documents, at most ``voters``, most frequent first."""
    toxic = sample.where("label = 1").dropDuplicates(["doc_id", "text"]).withColumn("th", F.xxhash64("text"))
    rows = toxic.select("doc_id", "th", "text").mapInArrow(_shingles, "doc_id long, th long, shingles binary").orderBy("doc_id", "th")
    is_copy = Copies()
    copies = [(r["doc_id"], r["th"]) for r in rows.toLocalIterator()  # the sample's bound
              if is_copy(np.frombuffer(r["shingles"], np.uint32))]
    if copies:
        gone = sample.sparkSession.createDataFrame(copies, "gone_id long, gone_th long")
        toxic = toxic.join(F.broadcast(gone), (F.col("doc_id") == F.col("gone_id")) & (F.col("th") == F.col("gone_th")), "left_anti")
    once = toxic.select(*sample.columns).unionByName(sample.where("label <> 1"))
    counts = once.mapInArrow(_pattern_rows, "pattern string, label long").groupBy("pattern").agg(
        F.sum("label").alias("toxic"), F.count(F.lit(1)).alias("n"))
    good = counts.where((F.col("toxic") >= support) & (F.col("toxic") >= precision * F.col("n")))
    return [r["pattern"] for r in good.orderBy(F.col("toxic").desc(), "pattern").limit(voters).collect()]


class Voters:
    """Which of a list of patterns a text holds."""

    def __init__(self, patterns: list[str]) -> None:
        self.words = {p: i for i, p in enumerate(patterns) if not p.endswith("*")}
        self.stems = [(k, {p[:-1]: i for i, p in enumerate(patterns) if p.endswith("*") and len(p) == k + 1}) for k in STEMS]

    def __call__(self, text: str) -> list[int]:
        words = words_of(text)
        out = [self.words[w] for w in words & self.words.keys()]
        for k, stems in self.stems:
            if stems:
                out += [stems[s] for s in {w[:k] for w in words} & stems.keys()]
        return out


def cliques(votes: np.ndarray, limit: float = 0.7) -> np.ndarray:
    """Clique of each voter: voters whose votes correlate by more than ``limit`` over ``votes``, rows of one class."""
    n = votes.shape[1]
    group = np.arange(n)
    if len(votes) < 2:
        return group
    centred = votes - votes.mean(axis=0)
    cov = centred.T @ centred
    sd = np.sqrt(np.diag(cov))
    with np.errstate(divide="ignore", invalid="ignore"):
        strong = np.nan_to_num(cov / np.outer(sd, sd)) > limit
    for i in range(n):
        for j in np.flatnonzero(strong[i, :i]):
            group[group == group[i]] = group[j]
    return group


def label_model(votes: np.ndarray, rounds: int = 50, start: float = 0.9, belief: float = 2.0) -> np.ndarray:
    """Posterior of the toxic class for each row of 0/1 ``votes``.

    A voter is right with its accuracy when it votes, and whether it votes says nothing by itself.
    Accuracies start at ``start``, a prior worth ``belief`` votes; both classes are alike beforehand.
    """
    v = np.c_[votes, ~votes.any(axis=1)].astype(np.float64)  # the last voter votes clean where no other votes
    sign = np.r_[np.ones(votes.shape[1]), -1.0]
    accuracy = np.full(v.shape[1], start)
    group = np.arange(v.shape[1])
    p = np.full(len(v), 0.5)
    for _ in range(rounds):
        _, member, size = np.unique(group, return_inverse=True, return_counts=True)
        logit = v @ (sign * np.log(accuracy / (1 - accuracy)) / size[member])
        new = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        settled = np.abs(new - p).max() < 1e-6
        p = new
        right = np.where(sign > 0, p @ v, (1 - p) @ v)
        accuracy = np.clip((right + start * belief) / (v.sum(axis=0) + belief), 0.5, 1 - 1e-4)
        group = cliques(v[p > 0.5])
        if settled:
            break
    return p


@dataclass(frozen=True)
class Classifier:
    patterns: list[str]
    weights: list[float]
    bias: float


def fit_linear(votes: np.ndarray, target: np.ndarray, ridge: float = 0.02, rounds: int = 30) -> tuple[np.ndarray, float]:
    """Logistic regression on soft targets by Newton steps."""
    x = np.c_[votes.astype(np.float64), np.ones(len(votes))]
    penalty = np.r_[np.full(votes.shape[1], ridge), 1e-3]
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (q * (1 - q) + 1e-6)[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(h, x.T @ (target - q) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def _vote_rows(batches: Iterator[pa.RecordBatch], patterns: list[str]) -> Iterator[pa.RecordBatch]:
    voters = Voters(patterns)
    for b in batches:
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array([sorted(voters(t)) for t in b.column(2).to_pylist()], pa.list_(pa.int32()))],
            ["doc_id", "votes"])


def train(docs: DataFrame, labels: DataFrame, per_class: int = 4000, voters: int = 300, support: int = 3,
          precision: float = 0.98) -> Classifier:
    sample = labelled_sample(docs, labels, "toxic", 3, 1, per_class).checkpoint()
    patterns = mine(sample, voters, support, precision)
    if not patterns:
        return Classifier([], [], -30.0)
    rows = sample.mapInArrow(lambda it: _vote_rows(it, patterns), "doc_id long, votes array<int>").collect()
    votes = np.zeros((len(rows), len(patterns)), bool)
    for i, r in enumerate(sorted(rows, key=lambda r: (r["doc_id"], r["votes"]))):
        votes[i, r["votes"]] = True
    weights, bias = fit_linear(votes, label_model(votes))
    return Classifier(patterns, weights.tolist(), bias)


def score_texts(texts: Iterable[str | None], model: Classifier, voters: Voters) -> np.ndarray:
    z = np.array([model.bias + sum(sorted(model.weights[i] for i in voters(t or ""))) for t in texts])
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _score(batches: Iterator[pa.RecordBatch], model: Classifier) -> Iterator[pa.RecordBatch]:
    voters = Voters(model.patterns)
    for b in batches:
        s = score_texts(b.column(b.num_columns - 1).to_pylist(), model, voters)
        yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(s)], [*b.schema.names[:-1], "score"])


def score(docs: DataFrame, model: Classifier, cut: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    rows = docs.select(docs["doc_id"], held_out(docs["doc_id"], 3, 1).alias("held_out"), text_of(docs).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    out = rows.mapInArrow(lambda it: _score(it, model), f"doc_id {kind}, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= cut).cast("int"))


def keep_clean(docs: DataFrame, labels: DataFrame, cut: float = 0.7) -> DataFrame:
    """The rows of ``docs`` that the classifier doesn't reject, same columns."""
    model = train(docs, labels)
    columns = docs.columns
    rows = docs.select(F.struct(*[column(docs, c) for c in columns]).alias("row"), text_of(docs).alias("text"))
    schema = T.StructType([T.StructField("row", rows.schema["row"].dataType), T.StructField("score", T.DoubleType())])
    out = rows.mapInArrow(lambda it: _score(it, model), schema).where(F.col("score") < cut)
    return out.select(*[F.col("row").getField(c).alias(c) for c in columns])
