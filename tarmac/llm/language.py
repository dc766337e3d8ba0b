"""Language identification: family first, then pairwise linear SVMs within the family.

Features are hashed byte 1- to 4-grams of the lower-cased text, square-rooted
and scaled to length 1.  A linear SVM per language family, each against the
rest, picks the family; inside it every pair of languages has its own linear
SVM, and the language with the most votes wins (ties: larger sum of margins,
then code order).  The families are a parameter; a language in none is a
family of its own.

Training uses at most ``per_language`` labelled documents of each language,
chosen by hash of the id, and never those of the held-out fold; rows that are
equal in id, language and text count once.  Every whole
text is scored in one pass without a shuffle.

Defined cases: a null text, or one without a letter, is ``und`` with score 0;
without labelled documents every text is ``und``; with one learned language
it is predicted throughout; repeated rows and null ids are like all others.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .toxicity import held_out

UNKNOWN = "und"
BITS = 12
MAX_GRAM = 4
_BLOCK = 1 << 20
#: Tasks that first choose the sample of one language.
SALTS = 64

#: ISO 639-1 codes of closely related languages.
FAMILIES = {
    "germanic": ("da", "de", "en", "is", "nl", "no", "sv"),
    "romance": ("ca", "es", "fr", "gl", "it", "pt", "ro"),
    "slavic": ("bg", "cs", "hr", "pl", "ru", "sk", "sl", "sr", "uk"),
    "uralic": ("et", "fi", "hu"),
    "turkic": ("az", "kk", "tr", "uz"),
}


def has_letter(text: str) -> bool:
    """Whether a character of Unicode category L occurs, as ``\\p{L}`` says in training."""
    return any(map(str.isalpha, text))


def features(text: str) -> np.ndarray:
    """Square roots of hashed n-gram counts, scaled to length 1."""
    data = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8)
    count = np.zeros(1 << BITS, np.int64)
    for at in range(0, len(data), _BLOCK):  # a long text block by block, overlapping by a gram
        part = data[at:at + _BLOCK + MAX_GRAM - 1].astype(np.uint32)
        gram = np.zeros(len(part), np.uint32)
        for n in range(1, MAX_GRAM + 1):
            gram = gram[:len(part) - n + 1] * np.uint32(257) + part[n - 1:]
            own = gram[:_BLOCK] * np.uint32(2654435769) + np.uint32(n * 40503)
            count += np.bincount((own * np.uint32(0x85EBCA6B)) >> np.uint32(32 - BITS), minlength=1 << BITS)
            if len(part) <= n:
                break
    out = np.sqrt(count).astype(np.float32)
    return out / max(float(np.linalg.norm(out)), 1e-9)


def linear_svm(x: np.ndarray, y: np.ndarray, cost: float = 10.0, rounds: int = 200) -> np.ndarray:
    """Weights and bias of a linear SVM (squared hinge loss) for targets +1 and -1, classes weighed alike.

    Conjugate-gradient Newton steps; starts at zero, so the fit is deterministic.
    """
    x = np.c_[x, np.ones(len(x), np.float32)]
    share = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)) * cost * len(x) / 100
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        slack = 1 - y * (x @ w)
        on = slack > 0
        grad = w - 2 * x[on].T @ (share[on] * y[on] * slack[on])
        if np.linalg.norm(grad) < 1e-4:
            break
        step, r = np.zeros_like(w), -grad
        d, rr = r.copy(), r @ r
        for _ in range(30):
            hd = d + 2 * x[on].T @ (share[on] * (x[on] @ d))
            a = rr / (d @ hd)
            step, r = step + a * d, r - a * hd
            new = r @ r
            if new < 1e-10:
                break
            d, rr = r + (new / rr) * d, new
        t, loss = 1.0, 0.5 * w @ w + (share[on] * slack[on] ** 2).sum()
        while t > 1e-4:
            v = w + t * step
            s = np.maximum(1 - y * (x @ v), 0)
            if 0.5 * v @ v + (share * s ** 2).sum() < loss:
                break
            t /= 2
        w = w + t * step
    return w


@dataclass(frozen=True)
class Model:
    families: list[list[str]]
    to_family: np.ndarray  # one row of weights per family; no rows if there is one family
    pairs: dict[int, list[tuple[str, str]]] = field(default_factory=dict)
    to_first: dict[int, np.ndarray] = field(default_factory=dict)  # one row per pair; positive: the first


def fit(x: np.ndarray, langs: list[str], families: dict[str, tuple[str, ...]]) -> Model:
    of = {c: name for name, codes in families.items() for c in codes}
    groups: dict[str, list[str]] = {}
    for c in sorted(set(langs)):
        groups.setdefault(of.get(c, c), []).append(c)
    found = [groups[k] for k in sorted(groups)]
    lang = np.array(langs)
    rows = [linear_svm(x, np.where(np.isin(lang, g), 1.0, -1.0)) for g in found] if len(found) > 1 else []
    pairs, to_first = {}, {}
    for i, g in enumerate(found):
        if len(g) > 1:
            pairs[i] = list(combinations(g, 2))
            weights = []
            for a, b in pairs[i]:
                own = np.isin(lang, (a, b))
                weights.append(linear_svm(x[own], np.where(lang[own] == a, 1.0, -1.0)))
            to_first[i] = np.array(weights)
    return Model(found, np.array(rows), pairs, to_first)


def _sure(margin: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(3 * margin, -30, 30))))


def predict(model: Model, text: str | None) -> tuple[str, float]:
    if not text or not model.families or not has_letter(text):
        return UNKNOWN, 0.0
    x = np.r_[features(text), np.float32(1)]
    best, score = 0, 1.0
    if len(model.families) > 1:
        m = model.to_family @ x
        best = int(np.argmax(m))
        score = _sure(m[best])
    langs = model.families[best]
    if len(langs) == 1:
        return langs[0], score
    votes, margins = dict.fromkeys(langs, 0), dict.fromkeys(langs, 0.0)
    for (a, b), m in zip(model.pairs[best], (model.to_first[best] @ x).tolist(), strict=True):
        votes[a if m >= 0 else b] += 1
        margins[a] += m
        margins[b] -= m
    lang = min(langs, key=lambda c: (-votes[c], -margins[c], c))
    return lang, score * _sure(margins[lang] / (len(langs) - 1))


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = [features(t or "") for t in b.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([r.tobytes() for r in rows], pa.binary())],
                                         ["id", "lang", "x"])


def _first_rows(rows: DataFrame, group: list[str], order: list, n: int) -> DataFrame:
    nth = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return rows.withColumn("nth", nth).where(F.col("nth") <= n)


def train(docs: DataFrame, per_language: int = 500, families: dict[str, tuple[str, ...]] | None = None) -> Model:
    """Learn from ``docs`` (doc_id, text, lang); at most ``per_language`` feature rows per language reach the driver."""
    rows = docs.select(docs["doc_id"].cast("bigint").alias("id"), docs["lang"].cast("string").alias("lang"),
                       docs["text"].cast("string").alias("text"))
    rows = rows.where("id IS NOT NULL AND lang IS NOT NULL").where(~held_out(F.col("id"), 4, 2)).where(F.col("text").rlike(r"\p{L}"))
    rows = rows.withColumn("th", F.xxhash64("text"))
    # A language is dealt over SALTS tasks first, so its one task of the second choice reads SALTS * per_language
    # rows at most; rows that repeat an id are in one of them.
    order = [F.xxhash64("id"), F.col("id"), F.col("th")]
    some = rows.select("id", "lang", "th", F.pmod(F.hash("id"), F.lit(SALTS)).alias("salt"))
    some = _first_rows(some, ["lang", "salt"], order, per_language).select("id", "lang", "th").distinct()
    chosen = _first_rows(some, ["lang"], order, per_language).select(*[F.col(c).alias(f"chosen_{c}") for c in ("id", "lang", "th")])
    is_it = [F.col(c) == F.col(f"chosen_{c}") for c in ("id", "lang", "th")]
    picked = rows.join(F.broadcast(chosen), is_it).dropDuplicates(["id", "lang", "th"])  # a row per chosen one
    out = picked.select("id", "lang", "text").mapInArrow(_feature_rows, "id long, lang string, x binary").collect()
    out.sort(key=lambda r: (r["lang"], r["id"], bytes(r["x"])))
    if not out:
        return Model([], np.zeros((0, 0)))
    return fit(np.array([np.frombuffer(bytes(r["x"]), np.float32) for r in out]), [r["lang"] for r in out], families or FAMILIES)


def _predict(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = [predict(model, t) for t in b.column(2).to_pylist()]
        lang, score = zip(*out, strict=True) if out else ((), ())
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                                         ["doc_id", "held_out", "lang_pred", "score"])


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document."""
    rows = docs.select(docs["doc_id"], held_out(docs["doc_id"], 4, 2).alias("held_out"), docs["text"].cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(lambda it: _predict(it, model), f"doc_id {kind}, held_out boolean, lang_pred string, score double")
