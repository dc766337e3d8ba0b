"""Winnowing of unit sequences (bytes or words) in numpy.

Of every window of ``length`` units one gram of ``gram`` units is chosen, by
hash, leftmost on ties: the window's *anchor*.  The choice looks at nothing
but the window, so equal windows have equal anchors at equal places.  Every
window that occurs in two documents therefore shows up as an anchor gram that
occurs in both, and about 2 / (length - gram + 2) of all positions are anchors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
#: Bits of a hash that give way to the position when anchors are compared.
_POS = 22
_LOW = _U((1 << _POS) - 1)
#: Units handled at once; longer documents go in overlapping parts.
PART = 1 << 18


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> _U(32))
    x *= _U(0xD6E8FEB86659FD93)
    x ^= x >> _U(32)
    x *= _U(0xD6E8FEB86659FD93)
    x ^= x >> _U(32)
    return x


def gram_hash(units: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` units from each position, by doubling."""
    done, out, h, size, power = 0, None, units, 1, _BASE
    while size <= gram:
        if gram & size:
            out = h if out is None else out[: len(out)]
            if done:
                # the low part so far follows this power-of-two part
                n = len(out) - size
                out = h[:n] * _U(pow(_BASE, done, 1 << 64)) + out[size:size + n]
            done += size
        n = len(h) - size
        if n <= 0:
            break
        if size * 2 <= gram:
            h = h[:n] * _U(power) + h[size:size + n]
        power = power * power % (1 << 64)
        size *= 2
    return mix(out) if done == gram else np.zeros(0, _U)


def sliding_min(a: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        a = np.minimum(a[:-size], a[size:])
        size *= 2
    rest = width - size
    return np.minimum(a[:-rest], a[rest:]) if rest else a


def window_anchors(units: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window starts, anchor of each, gram hashes of all positions) of the windows that end in their own document.

    ``units`` are the unit hashes of several documents; ``ends`` the end of each.
    """
    if len(units) < length:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, _U)
    g = gram_hash(units, gram)
    key = (g & ~_LOW) | np.arange(len(g), dtype=_U)
    least = sliding_min(key, length - gram + 1)
    n = len(least)
    starts = np.r_[0, ends[:-1]]
    own = np.zeros(n + 1, np.int32)
    last = np.maximum(ends - length + 1, starts)  # past the last window of each document
    np.add.at(own, np.minimum(starts, n), 1)
    np.add.at(own, np.minimum(last, n), -1)
    at = np.flatnonzero(np.cumsum(own[:n]) > 0)
    return at, (least[at] & _LOW).astype(np.int64), g


def parts(sizes: np.ndarray, length: int) -> Iterator[list[tuple[int, int, int]]]:
    """Documents in groups of about ``PART`` units: (document, from, to); long ones in overlapping parts."""
    group, n = [], 0
    for doc, size in enumerate(sizes.tolist()):
        at = 0
        while size - at >= length:
            to = min(size, at + PART + length - 1)
            group.append((doc, at, to))
            n += to - at
            if n >= PART:
                yield group
                group, n = [], 0
            if to == size:
                break
            at += PART
    if group:
        yield group


def _grouped(units: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> Iterator[tuple]:
    """For each group of parts: (document and first unit of each part, their ends, window starts, anchors, hashes)."""
    for group in parts(np.diff(offsets), length):
        rows = [units[offsets[d] + a:offsets[d] + b] for d, a, b in group]
        ends = np.cumsum([len(r) for r in rows])
        doc, first = np.array([g[0] for g in group]), np.array([g[1] for g in group])
        yield doc, first, ends, *window_anchors(np.concatenate(rows).astype(_U), ends, length, gram)


def doc_anchors(units: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of the anchors of a batch of documents, each hash once per document."""
    docs, hashes = [], []
    for doc, _, ends, _, anchor, g in _grouped(units, offsets, length, gram):
        at = np.unique(anchor)
        docs.append(doc[np.searchsorted(ends, at, side="right")])
        hashes.append(short(g[at]))
    if not docs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    d, h = np.concatenate(docs), np.concatenate(hashes)
    order = np.lexsort((h, d))
    d, h = d[order], h[order]
    new = np.r_[True, (d[1:] != d[:-1]) | (h[1:] != h[:-1])]
    return d[new], h[new]


def short(g: np.ndarray) -> np.ndarray:
    """48 bits of a hash: anchors only say where to look, so a chance collision costs a look and nothing else."""
    return (g >> _U(16)).astype(np.int64)


def candidate_runs(units: np.ndarray, offsets: np.ndarray, length: int, gram: int,
                   shared: list[np.ndarray]) -> Iterator[tuple[np.ndarray, ...]]:
    """Windows of each document that may repeat, as runs (document, first, last window start, anchor hash).

    ``shared`` holds the anchor hashes of each document that another document has too; the windows of
    one anchor form a run.  (Other anchors in a window prove nothing: whether they are anchors
    depends on what stands around the window.)
    """
    for doc, first, ends, at, anchor, g in _grouped(units, offsets, length, gram):
        if not len(at):
            continue
        place = np.unique(anchor)
        part = np.searchsorted(ends, place, side="right")
        h = short(g[place])
        known = np.zeros(len(place), bool)
        bound = np.searchsorted(part, np.arange(len(doc) + 1))
        for i, d in enumerate(doc.tolist()):
            lo, hi = bound[i], bound[i + 1]
            known[lo:hi] = np.isin(h[lo:hi], shared[d])
        live = known[np.searchsorted(place, anchor)]
        at, anchor = at[live], anchor[live]
        if not len(at):
            continue
        head = np.flatnonzero(np.r_[True, (np.diff(at) != 1) | (np.diff(anchor) != 0)])
        tail = np.r_[head[1:], len(at)] - 1
        of = np.searchsorted(ends, at[head], side="right")
        shift = first[of] - np.r_[0, ends[:-1]][of]
        yield doc[of], at[head] + shift, at[tail] + shift, h[np.searchsorted(place, anchor[head])]
