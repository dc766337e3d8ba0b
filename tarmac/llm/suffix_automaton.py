"""Repeated passages of words by suffix automata of reference shards.

The words of a shard's passages go into a suffix automaton, smallest document
first.  Before a document's passage is added, it is streamed through the
automaton, which gives at every word the longest match that ends there (the
matching statistics); where it reaches ``length`` words, the window repeats a
smaller document.

A shard is a set of anchors with all passages around them (see
:mod:`passages`); its size is bounded by ``CHUNK``, so the automaton's is
too, unless one anchor alone holds more.  Every automaton would have to be
broadcast to every document otherwise, and together they grow with the
corpus; here the shuffle brings each automaton just the passages that can
match it.

Defined cases: a null text has no words; texts shorter than a window keep
everything; repeated ids are told apart by their texts and never repeat each
other; a null doc_id counts as the largest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from .passages import Scheme, repeated_spans, unpack_contexts
from .suffix_array import ids, mask, match_contexts, span_rows

#: Bytes of passages in a shard.
CHUNK = 1 << 20


def _word_units(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    words = [t.split() for t in texts]  # bytes: space and U+0009..U+000D
    offsets = np.r_[0, np.cumsum([len(w) for w in words])].astype(np.int64)
    units = np.fromiter((xxhash.xxh3_64_intdigest(w) for ws in words for w in ws), np.uint64, offsets[-1])
    return units, offsets


def _word_context(text: bytes) -> Callable[[int, int], bytes]:
    words = text.split()
    return lambda a, b: b" ".join(words[a:b])


def word_scheme(length: int, gram: int = 24) -> Scheme:
    return Scheme(length, min(gram, length), _word_units, _word_context)


class Automaton:
    """A suffix automaton over several sequences."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]

    def _state(self, length: int, next_: dict, link: int) -> int:
        self.next.append(next_)
        self.link.append(link)
        self.length.append(length)
        return len(self.link) - 1

    def _split(self, p: int, c, q: int) -> int:
        """The state of the p + c strings alone, split off from q."""
        clone = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def add(self, words: list) -> None:
        next_, link, length = self.next, self.link, self.length
        last = 0
        for c in words:
            q = next_[last].get(c)
            if q is not None:
                last = q if length[q] == length[last] + 1 else self._split(last, c, q)
                continue
            p, last = last, self._state(length[last] + 1, {}, 0)
            while p >= 0 and c not in next_[p]:
                next_[p][c] = last
                p = link[p]
            if p >= 0:
                q = next_[p][c]
                link[last] = q if length[q] == length[p] + 1 else self._split(p, c, q)

    def matches(self, words: list, least: int) -> list[int]:
        """Ends (exclusive) of the places where a match of ``least`` words or more ends."""
        next_, link, length = self.next, self.link, self.length
        state, n, out = 0, 0, []
        for i, c in enumerate(words, 1):
            to = next_[state].get(c)
            while to is None and state:
                state = link[state]
                n = length[state]
                to = next_[state].get(c)
            if to is not None:
                state, n = to, n + 1
                if n >= least:
                    out.append(i)
        return out


def _windows(contexts: list[bytes], owner: np.ndarray, length: int) -> Iterator[np.ndarray]:
    """For each context, which window starts stand in a context of a smaller owner."""
    words = [c.split(b" ") for c in contexts]
    hits = [np.zeros(len(w), bool) for w in words]
    shard = Automaton()
    by_owner = groupby(np.argsort(owner, kind="stable").tolist(), key=lambda i: owner[i])
    for _, same in by_owner:
        same = list(same)
        for i in same:
            for end in shard.matches(words[i], length):
                hits[i][end - length] = True
        for i in same:
            shard.add(words[i])
    yield from hits


def _match(t: pa.Table, length: int) -> pa.Table:
    return pa.concat_tables([match_contexts(c, length, _windows, lambda x: x.count(b" ") + 1)
                             for c in unpack_contexts(t).groups(CHUNK)])


def repeated_words(docs: DataFrame, length: int = 50) -> DataFrame:
    """(ord, th, z, starts, ends, is_copy): word spans covered by ``length`` words that start in a smaller document."""
    return repeated_spans(docs, word_scheme(length), lambda t: _match(t, length))


def _kept(text: bytes, starts: np.ndarray, ends: np.ndarray, copy: bool, length: int) -> tuple[list[bytes], int]:
    words = text.split()
    if not (copy or len(starts)):
        return words, len(words)
    gone = mask(len(words), starts, ends, copy, length)
    return [w for w, g in zip(words, gone.tolist(), strict=True) if not g], len(words)


def _digest(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text, starts, ends, copy in span_rows(batch):
            kept, n = _kept(text, starts, ends, copy, length)
            out.append((n, n - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
        n, removed, sha = zip(*out, strict=True) if out else ((), (), ())
        yield pa.RecordBatch.from_arrays([ids(batch), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
                                          pa.array(sha, pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256"])


def digest(docs: DataFrame, length: int = 50) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document."""
    return repeated_words(docs, length).mapInArrow(
        lambda it: _digest(it, length), "doc_id long, n_words long, n_removed long, kept_sha256 string")


def _clean(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Only the documents that lose words: (ord, th, kept)."""
    for batch in batches:
        rows = [(i, *_kept(*row, length)) for i, row in enumerate(span_rows(batch))]
        cut = [(i, kept) for i, kept, n in rows if len(kept) < n]
        at = pa.array([i for i, _ in cut], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(at), batch.column(1).take(at),
             pa.array([b" ".join(k).decode("utf-8", "replace") for _, k in cut], pa.string())], ["ord", "th", "kept"])


def cut_texts(docs: DataFrame, length: int = 50) -> DataFrame:
    """(ord, th, kept) of the documents that lose words: id, xxhash64 of the text, and the words left, space-joined."""
    found = repeated_words(docs, length)
    return found.where("is_copy OR size(starts) > 0").mapInArrow(
        lambda it: _clean(it, length), "ord long, th long, kept string")
