"""Exact repeated byte strings by prefix doubling, spread over Spark's tasks.

:mod:`passages` deals the suffixes that can still repeat by the hash of a
gram of theirs.  Two cases are decided without ranks: whole copies of a
smaller document's text, by a join on its md5, and contexts that equal one of
a smaller document, by comparing their bytes (:func:`match_contexts`).  The
other contexts of an anchor are ranked in their task, by ``np.unique`` and not
by a sort of Spark's: first by 8 bytes, then doubling, where the rank of 2 h
bytes is the rank of the pair (rank at p, rank at p + h).  A suffix whose rank
is unique leaves; the last pair, of two overlapping ranks, reaches the
threshold length exactly.  Suffixes of equal final rank share their first
``length`` bytes, compared in full and not by hash; all but those of the
smallest document repeat.

Doubling over every byte of the corpus in the cluster would sort records of
several times the input in each round.  Dealing by anchors first keeps the
rounds inside tasks without losing a pair, because a repeated string brings
its anchor along.

Defined cases: a null text is empty; texts shorter than ``length`` keep
everything; repeated ids are told apart by their texts and never repeat each
other; a null doc_id counts as the largest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NO_ID
from .passages import Contexts, Scheme, covered, repeated_spans, runs, unpack_contexts, unpacked

#: Bytes of contexts that are ranked together.
CHUNK = 4 << 20


def _byte_units(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(texts), np.uint8), np.r_[0, np.cumsum([len(t) for t in texts])].astype(np.int64)


def _byte_context(text: bytes) -> Callable[[int, int], bytes]:
    return lambda a, b: text[a:b]


def byte_scheme(length: int, gram: int = 24) -> Scheme:
    return Scheme(length, min(gram, length), _byte_units, _byte_context)


def ranks(data: np.ndarray, room: np.ndarray, length: int) -> np.ndarray:
    """Rank of the ``length`` bytes at each position; -1 where they are unique or pass the end.

    ``room``: bytes left at each position in its own string.
    """
    n = len(data)
    kind = np.int32 if n < 1 << 31 else np.int64
    out = np.full(n, -1, kind)
    h = 1
    word = data.astype(np.uint64)
    while h < 8 and 2 * h <= length:  # up to 8 bytes a rank is the bytes themselves
        more = word[h:].copy()
        word <<= np.uint64(8 * h)
        word[:len(more)] |= more
        del more
        h *= 2
    alive = np.flatnonzero(room >= h).astype(kind)
    value = word[alive]
    del word
    while True:
        order = np.argsort(value)
        value = value[order]
        new = np.r_[np.ones(min(1, len(value)), bool), value[1:] != value[:-1]]
        del value
        kept = ~(new & np.r_[new[1:], np.ones(min(1, len(new)), bool)])
        alive = alive[order[kept]]
        del order
        out[:] = -1
        out[alive] = np.cumsum(new, dtype=kind)[kept]
        alive.sort()
        if h == length or not len(alive):
            return out
        step = min(h, length - h)
        alive = alive[room[alive] >= h + step]
        second = out[alive + step]
        alive, second = alive[second >= 0], second[second >= 0]
        value = out[alive].astype(np.int64) * (int(out.max()) + 1) + second
        h += step


def _windows(contexts: list[bytes], owner: np.ndarray, length: int) -> Iterator[np.ndarray]:
    """For each context, which window starts stand in a context of a smaller owner."""
    sizes = np.fromiter(map(len, contexts), np.int64, len(contexts))
    data = np.frombuffer(b"".join(contexts), np.uint8)
    ends = np.cumsum(sizes)
    kind = np.int32 if len(data) < 1 << 31 else np.int64
    of = np.repeat(np.arange(len(contexts), dtype=kind), sizes)
    rank = ranks(data, ends.astype(kind)[of] - np.arange(len(data), dtype=kind), length)
    hit = np.zeros(len(data), bool)
    at = np.flatnonzero(rank >= 0)
    least = np.full(int(rank.max(initial=-1)) + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, rank[at], owner[of[at]])
    hit[at] = owner[of[at]] > least[rank[at]]
    for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True):
        yield hit[a:b]


def match_contexts(c: Contexts, length: int, windows: Callable[[list, np.ndarray, int], Iterator[np.ndarray]],
                   size: Callable[[bytes], int]) -> pa.Table:
    """Spans (ord, th, s, e) of the places of whole groups.

    A place whose context a smaller document has is covered whole; of the others the ``windows``
    that stand in another context of a smaller document.
    """
    seen: dict[tuple[int, bytes], int] = {}
    one = np.fromiter((seen.setdefault(k, len(seen)) for k in zip(c.h.tolist(), c.text, strict=True)), np.int64, len(c.h))
    of, contexts = one[c.of], [k[1] for k in seen]
    group = np.fromiter((k[0] for k in seen), np.int64, len(seen))
    _, member, count = np.unique(group, return_inverse=True, return_counts=True)
    owner = np.full(len(contexts), np.iinfo(np.int64).max)
    np.minimum.at(owner, of, c.ord)
    own: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    asked = np.flatnonzero(count[member] > 1)  # a context alone in its group repeats itself only
    if len(asked):
        for i, hit in zip(asked.tolist(), windows([contexts[i] for i in asked], owner[asked], length), strict=True):
            if hit.any():
                a, b = runs(hit)
                own[i] = (a, b + length - 1)
    whole = c.ord > owner[of]
    sizes = np.fromiter(map(size, contexts), np.int64, len(contexts))
    out = [(c.ord[whole], c.th[whole], c.first[whole], c.first[whole] + sizes[of[whole]])]
    for i in np.flatnonzero(~whole & np.isin(of, list(own))).tolist():
        a, b = own[int(of[i])]
        out.append((np.full(len(a), c.ord[i]), np.full(len(a), c.th[i]), c.first[i] + a, c.first[i] + b))
    o, d, s, e = (np.concatenate(x) for x in zip(*out, strict=True))
    return pa.table({"ord": pa.array(o, pa.int64()), "th": pa.array(d, pa.int64()), "s": pa.array(s.astype(np.int32)),
                     "e": pa.array(e.astype(np.int32))})


def _match(t: pa.Table, length: int) -> pa.Table:
    return pa.concat_tables([match_contexts(c, length, _windows, len) for c in unpack_contexts(t).groups(CHUNK)])


def repeated_bytes(docs: DataFrame, length: int = 50) -> DataFrame:
    """(ord, th, z, starts, ends, is_copy): byte spans covered by ``length`` bytes that start in a smaller document."""
    return repeated_spans(docs, byte_scheme(length), lambda t: _match(t, length))


def mask(n: int, starts: np.ndarray, ends: np.ndarray, is_copy: bool, length: int) -> np.ndarray:
    return np.full(n, n >= length) if is_copy else covered(n, starts, ends)


def span_rows(batch: pa.RecordBatch) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, bool]]:
    """(text, starts, ends, is_copy) of rows (ord, th, z, starts, ends, is_copy)."""
    none = np.zeros(0, np.int64)
    for text, s, e, copy in zip(unpacked(batch.column(2)), batch.column(3), batch.column(4), batch.column(5), strict=True):
        yield (text, *((x.values.to_numpy() if x.is_valid else none) for x in (s, e)), copy.as_py())


def ids(batch: pa.RecordBatch) -> pa.Array:
    ord_ = batch.column(0).to_numpy(zero_copy_only=False)
    return pa.array(ord_, mask=ord_ == NO_ID)


def _digest(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text, starts, ends, copy in span_rows(batch):
            gone = mask(len(text), starts, ends, copy, length)
            kept = np.frombuffer(text, np.uint8)[~gone].tobytes() if gone.any() else text
            out.append((len(text), int(gone.sum()), len(runs(gone)[0]), hashlib.sha256(kept).hexdigest()))
        n, removed, spans, sha = zip(*out, strict=True) if out else ((), (), (), ())
        yield pa.RecordBatch.from_arrays([ids(batch), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
                                          pa.array(spans, pa.int64()), pa.array(sha, pa.string())],
                                         ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def digest(docs: DataFrame, length: int = 50) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    return repeated_bytes(docs, length).mapInArrow(
        lambda it: _digest(it, length), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def _kept(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept = []
        for text, starts, ends, copy in span_rows(batch):
            gone = mask(len(text), starts, ends, copy, length)
            kept.append(np.frombuffer(text, np.uint8)[~gone].tobytes())
        yield pa.RecordBatch.from_arrays([ids(batch), pa.array(kept, pa.binary())], ["doc_id", "kept"])


def remove_repeats(docs: DataFrame, length: int = 50) -> DataFrame:
    """(doc_id, kept): the bytes left of every document; a cut may fall inside a character."""
    return repeated_bytes(docs, length).mapInArrow(lambda it: _kept(it, length), "doc_id long, kept binary") \
        .select("doc_id", F.col("kept"))
