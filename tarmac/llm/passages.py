"""Spans of documents that repeat an earlier document, found from shared anchors.

The frame that exact substring operators over bytes and over words share.  A
*window* is ``length`` consecutive units; it repeats if the same window also
starts in a document with a smaller id.

1. Anchors (see :mod:`winnow`) of all documents are dealt by hash; those seen
   in one document only leave here.  This loses nothing: a repeated window
   has its anchors in common with the earlier document.  An anchor that two
   documents of one batch have is settled where it is read; of its rows only
   one goes on to the anchor's task, so a line that a third of the documents
   have does not pile up there.
2. A document cuts out the *contexts* of its windows that may still repeat,
   one for each run of windows with the same anchor.  Contexts are dealt by
   anchor, so every occurrence of a window meets in one task; equal contexts
   of one batch travel as one row with the list of their places.
3. There the operator's own method (``match``) says which windows of each
   context start in a smaller document.
4. The spans go back to their documents.

A document whose whole text stands in a smaller document is a *copy*: all of
its windows repeat, so it sends no contexts.  Both passes over the texts read
them, compressed, from one exchange.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NO_ID, partitions, text_of
from .winnow import candidate_runs, doc_anchors, mix


@dataclass(frozen=True)
class Scheme:
    """How texts are cut into units: their hashes, and the bytes of a run of them."""

    length: int
    gram: int
    units: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]  # -> (unit hashes, offsets by document)
    context: Callable[[bytes], Callable[[int, int], bytes]]  # text -> (from unit, to unit) -> bytes


#: Documents whose anchors are sorted together: their numbers have 16 bits beside a hash's 48.
ROWS = 1 << 16
_DOC, _DOCS = np.uint64(16), np.uint64(ROWS - 1)


def _slices(texts: Iterable[bytes], limit: int = 1 << 22) -> Iterator[tuple[int, list[bytes]]]:
    """Texts a few MB at a time, taken only when their turn comes: (first row, texts)."""
    first, held, n = 0, [], 0
    for i, t in enumerate(texts, 1):
        held.append(t)
        n += len(t)
        if n >= limit:
            yield first, held
            first, held, n = i, [], 0
    if held:
        yield first, held


def _texts(column: pa.Array) -> Iterator[bytes]:
    for t in column.cast(pa.binary()):
        yield t.as_py()


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(ord, th, text) -> (ord, th, z): the text compressed for the shuffle."""
    z = zstandard.ZstdCompressor(3)
    for b in batches:
        out = [z.compress(t) for t in _texts(b.column(2))]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.binary())], ["ord", "th", "z"])


def unpacked(column: pa.Array) -> Iterator[bytes]:
    z = zstandard.ZstdDecompressor()
    for t in column:
        yield z.decompress(t.as_py())


def _blob(*arrays: np.ndarray) -> bytes:
    """Arrays of known types as one compressed value."""
    sizes = np.array([a.nbytes for a in arrays], np.int64)
    return zstandard.compress(sizes.tobytes() + b"".join(a.tobytes() for a in arrays), 3)


def _unblob(blob: bytes, *kinds) -> list[np.ndarray]:
    raw = zstandard.decompress(blob)
    sizes = np.frombuffer(raw, np.int64, len(kinds))
    ends = np.cumsum(sizes) + sizes.nbytes
    return [np.frombuffer(raw, k, n // np.dtype(k).itemsize, e - n) for k, n, e in zip(kinds, sizes.tolist(), ends.tolist(), strict=True)]


def _dealt(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, rows of it)."""
    order = np.argsort(bucket, kind="stable")
    head = np.flatnonzero(np.r_[True, np.diff(bucket[order]) != 0]) if len(order) else order
    for rows in np.split(order, head[1:]) if len(order) else ():
        yield int(bucket[rows[0]]), rows


def _anchor_rows(batches: Iterator[pa.RecordBatch], scheme: Scheme, buckets: int) -> Iterator[pa.RecordBatch]:
    """(ord, text) -> rows (bucket, settled, pairs): packed (hash, ord) pairs.

    Where the batch itself shows that a hash is shared, its pairs are settled, and one of them goes on
    with the open ones to the hash's bucket, for the documents of other batches.
    """
    small = np.min_scalar_type(buckets)
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            ids, number = np.unique(part.column(0).to_numpy(zero_copy_only=False), return_inverse=True)
            key = _anchor_keys(part.column(1), number, scheme)
            if not len(key):
                continue
            head = np.ones(len(key), bool)
            np.not_equal(key[1:] >> _DOC, key[:-1] >> _DOC, out=head[1:])
            known = ~(head & np.r_[head[1:], True])  # a document has a hash once: two pairs of it are of two documents
            settled = key[known]
            key = key[head]
            out = [(False, *x) for x in _pair_packs(key, (key >> _DOC) % np.uint64(buckets), small, ids)]
            spread = (mix(ids.view(np.uint64)) % np.uint64(buckets)).astype(small)
            out += [(True, *x) for x in _pair_packs(settled, spread[(settled & _DOCS).astype(np.uint16)], small, ids)]
            yield pa.RecordBatch.from_arrays([pa.array([x[1] for x in out], pa.int32()), pa.array([x[0] for x in out]),
                                              pa.array([x[2] for x in out], pa.binary())], ["bucket", "settled", "pairs"])


def _anchor_keys(texts: pa.Array, number: np.ndarray, scheme: Scheme) -> np.ndarray:
    """Sorted keys (hash, document number) of the anchors, each once."""
    found = [np.zeros(0, np.uint64)]
    for first, some in _slices(_texts(texts)):
        units, offsets = scheme.units(some)
        d, h = doc_anchors(units, offsets, scheme.length, scheme.gram)
        found.append(h.view(np.uint64) << _DOC | number[first + d].astype(np.uint64))
    key = np.concatenate(found)
    del found
    key.sort()
    if len(key):
        key = key[np.r_[True, key[1:] != key[:-1]]]
    return key


def _pair_packs(key: np.ndarray, bucket: np.ndarray, small: np.dtype, ids: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """(bucket, its pairs in order of ord)."""
    for b, rows in _dealt(bucket.astype(small)):
        k = key[rows]
        number = (k & _DOCS).astype(np.uint16)
        by = np.argsort(number, kind="stable")
        six = (k[by] >> _DOC).view(np.uint8).reshape(-1, 8)[:, :6]  # hashes have 48 bits
        yield b, _blob(np.diff(ids[number[by]], prepend=0), np.ascontiguousarray(six))


def _shared_rows(t: pa.Table) -> pa.Table:
    """The pairs of a bucket -> (ord, h) of the hashes that two documents have."""
    out_o, out_h, open_o, open_h = [], [], [], []
    for settled, blob in zip(t.column("settled").to_pylist(), t.column("pairs").to_pylist(), strict=True):
        step, six = _unblob(blob, np.int64, np.uint8)
        h = np.zeros((len(step), 8), np.uint8)
        h[:, :6] = six.reshape(-1, 6)
        (out_o if settled else open_o).append(np.cumsum(step))
        (out_h if settled else open_h).append(h.reshape(-1).view(np.int64))
    if open_o:
        o, h = np.concatenate(open_o), np.concatenate(open_h)
        order = np.lexsort((o, h))
        o, h = o[order], h[order]
        head = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
        tail = np.r_[head[1:], len(h)]
        keep = np.repeat(o[head] != o[tail - 1], tail - head)
        out_o.append(o[keep])
        out_h.append(h[keep])
    return pa.table({"ord": np.concatenate(out_o), "h": np.concatenate(out_h)})


def _context_rows(batches: Iterator[pa.RecordBatch], scheme: Scheme, buckets: int) -> Iterator[pa.RecordBatch]:
    """Rows (ord, th, z, hs[]) -> (bucket, contexts): each context of a batch once, with its places."""
    for batch in batches:
        ids, th = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
        shared = batch.column(3)
        found: dict[bytes, int] = {}  # a context's anchor is its first window's: equal contexts have equal hashes
        places = []
        for first, texts in _slices(unpacked(batch.column(2))):
            units, offsets = scheme.units(texts)
            mine = [shared[first + i].values.to_numpy(zero_copy_only=False) for i in range(len(texts))]
            for d, a, b, h in candidate_runs(units, offsets, scheme.length, scheme.gram, mine):
                of = np.empty(len(d), np.int32)
                at, cut = -1, None
                for i, (doc, x, y) in enumerate(zip(d.tolist(), a.tolist(), (b + scheme.length).tolist(), strict=True)):
                    if doc != at:
                        at, cut = doc, scheme.context(texts[doc])
                    of[i] = found.setdefault(cut(x, y), len(found))
                places.append((of, (first + d).astype(np.int32), a.astype(np.uint32), h))
        if not found:
            continue
        of, row, start, hash_ = (np.concatenate(x) for x in zip(*places, strict=True))
        del places
        contexts = list(found)
        del found
        h = np.empty(len(contexts), np.int64)
        h[of] = hash_
        by = np.argsort(of, kind="stable")  # places by context
        count = np.bincount(of, minlength=len(contexts))
        end = np.cumsum(count)
        out = []
        for bucket, rows in _dealt((h % buckets).astype(np.min_scalar_type(buckets))):
            rows = rows[np.argsort(h[rows], kind="stable")]
            n = count[rows]
            at = by[np.repeat(end[rows] - np.cumsum(n), n) + np.arange(n.sum())]
            mine = [contexts[r] for r in rows.tolist()]
            out.append((bucket, _blob(h[rows], np.fromiter(map(len, mine), np.uint32, len(mine)), n.astype(np.uint32), ids[row[at]],
                                      th[row[at]], start[at], np.frombuffer(b"".join(mine), np.uint8))))
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.binary())],
                                         ["bucket", "contexts"])


@dataclass(frozen=True)
class Contexts:
    """Contexts in order of hash; place i belongs to context ``of[i]``."""

    h: np.ndarray
    text: list[bytes]
    of: np.ndarray
    ord: np.ndarray
    th: np.ndarray
    first: np.ndarray

    def groups(self, size: int) -> Iterator[Contexts]:
        """Whole groups of equal hash, gathered until they hold ``size`` bytes."""
        ends = np.cumsum([len(t) for t in self.text])
        head = np.flatnonzero(np.r_[True, self.h[1:] != self.h[:-1]])
        bounds = np.searchsorted(self.of, np.r_[head, len(self.h)])
        chunk = (ends[head] - 1) // size  # groups by the bytes before them
        cuts = np.r_[np.flatnonzero(np.r_[True, chunk[1:] != chunk[:-1]]), len(head)]
        at = np.r_[head, len(self.h)]
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            c, p = slice(at[a], at[b]), slice(bounds[a], bounds[b])
            yield Contexts(self.h[c], self.text[c], self.of[p] - at[a], self.ord[p], self.th[p], self.first[p])


def unpack_contexts(t: pa.Table) -> Contexts:
    parts = []
    for blob in t.column("contexts").to_pylist():
        h, sizes, counts, o, th, first, text = _unblob(blob, np.int64, np.uint32, np.uint32, np.int64, np.int64, np.uint32, np.uint8)
        raw, ends = text.tobytes(), np.cumsum(sizes, dtype=np.int64)
        # Copies, as views would keep the bytes of all blobs beside the contexts cut from them.
        parts.append((h.copy(), [raw[a:b] for a, b in pairwise([0, *ends.tolist()])], *(x.copy() for x in (counts, o, th, first))))
        del h, sizes, counts, o, th, first, text, raw
    h = np.concatenate([x[0] for x in parts])
    text = [c for x in parts for c in x[1]]
    of = np.repeat(np.arange(len(h)), np.concatenate([x[2] for x in parts]))
    o, th, first = (np.concatenate([x[i] for x in parts]).astype(np.int64) for i in (3, 4, 5))
    order = np.argsort(h, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    by = np.argsort(rank[of], kind="stable")
    return Contexts(h[order], [text[i] for i in order.tolist()], rank[of][by], o[by], th[by], first[by])


def repeated_spans(docs: DataFrame, scheme: Scheme, match: Callable[[pa.Table], pa.Table]) -> DataFrame:
    """Rows (ord, th, z, starts, ends, is_copy) of every document: the unit spans of its repeated windows.

    ``ord`` is the doc_id, a null one as the largest id; ``th`` tells apart documents that repeat an
    id; ``z`` is the compressed text (:func:`unpacked`).  ``match`` maps the packed contexts of a
    bucket (:func:`unpack_contexts`) to spans (ord, th, s, e).
    """
    buckets = 2 * partitions(docs.sparkSession)
    rows = docs.select(F.coalesce(docs["doc_id"].cast("bigint"), F.lit(NO_ID)).alias("ord"), text_of(docs).alias("text"))
    # Neither column is ever null; said here, so that both readers have one plan and share its exchange.
    texts = (rows.select("ord", F.xxhash64("text").alias("th"), "text")
             .mapInArrow(_packed, "ord long, th long, z binary").where("ord IS NOT NULL"))
    anchor = rows.mapInArrow(lambda it: _anchor_rows(it, scheme, buckets), "bucket int, settled boolean, pairs binary")
    shared = anchor.groupBy("bucket").applyInArrow(_shared_rows, "ord long, h long").where("ord IS NOT NULL")
    # Dealt before it is gathered: a list for every task's share of a document would only be larger.
    wanted = shared.repartition("ord").groupBy("ord").agg(F.collect_list("h").alias("hs"))

    prints = rows.select("ord", F.xxhash64("text").alias("th"), F.md5("text").alias("digest"))
    firsts = prints.groupBy("digest").agg(F.min("ord").alias("least")).withColumnRenamed("digest", "of_digest")
    copies = (prints.join(firsts, (F.col("digest") == F.col("of_digest")) & (F.col("ord") > F.col("least")))
              .groupBy("ord").agg(F.collect_set("th").alias("copied")))

    asked = wanted.join(copies, "ord", "left").select(F.col("ord").alias("w_ord"), "hs", "copied")
    near = texts.join(asked.hint("shuffle_hash"), F.col("ord") == F.col("w_ord"))
    near = near.where(~F.coalesce(F.array_contains("copied", F.col("th")), F.lit(False)))
    context = near.select("ord", "th", "z", "hs").mapInArrow(
        lambda it: _context_rows(it, scheme, buckets), "bucket int, contexts binary")
    spans = context.groupBy("bucket").applyInArrow(match, "ord long, th long, s int, e int")
    back = spans.repartition("ord").groupBy("ord").agg(F.collect_list(F.struct("th", "s", "e")).alias("spans"))

    marks = back.join(copies, "ord", "full").select(F.col("ord").alias("m_ord"), "spans", "copied")
    out = texts.join(marks.hint("shuffle_hash"), F.col("ord") == F.col("m_ord"), "left")
    own = F.filter("spans", lambda x: x["th"] == F.col("th"))
    return out.select("ord", "th", "z", F.transform(own, lambda x: x["s"]).alias("starts"),
                      F.transform(own, lambda x: x["e"]).alias("ends"),
                      F.coalesce(F.array_contains("copied", F.col("th")), F.lit(False)).alias("is_copy"))


def covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of ``n`` units lie in a span."""
    step = np.zeros(n + 1, np.int32)
    np.add.at(step, starts, 1)
    np.add.at(step, ends, -1)
    return np.cumsum(step[:n]) > 0


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edge = np.flatnonzero(np.diff(np.r_[0, mask.view(np.int8), 0]))
    return edge[::2], edge[1::2]
