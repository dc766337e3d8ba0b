"""Links between 64-bit codes that differ in few bits, by a Gray-order hierarchical index.

Inside a task the codes are sorted by Gray rank, so that neighbours differ in
few bits.  Runs of ``FANOUT`` neighbours form a node whose *pattern* keeps the
bits all its codes share (value and mask); runs of nodes form the nodes above.
The search goes down pairs of nodes.  A pair whose patterns already differ in
more than ``max_bits`` shared bits is dropped with everything below it; a pair
that cannot differ in more even if all its unshared bits did is linked whole.

Across tasks the codes are routed by blocks: of ``max_bits`` + 1 blocks of
bits, two codes within ``max_bits`` agree on one at least, and meet in the
bucket of its value.  The task emits a spanning forest of what it finds, at
most one link per code and bucket, never the pairs of a group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FANOUT = 8
#: Codes indexed at once: whole buckets are gathered up to here.
CHUNK = 1 << 16
#: Node pairs expanded at once.
FRONTIER = 1 << 16
_U = np.uint64


def gray_rank(code: np.ndarray) -> np.ndarray:
    """The position of each code in Gray order."""
    out = code.copy()
    for s in (1, 2, 4, 8, 16, 32):
        out ^= out >> _U(s)
    return out


def _levels(code: np.ndarray, bucket: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """From the codes up: (value, mask, first child, first code) of each node; runs never cross buckets.

    ``first child`` and ``first code`` carry one extra entry at the end.
    """
    n = len(code)
    ones = np.full(n, ~_U(0))
    at = np.arange(n + 1)
    levels = [(code, ones, at, at)]
    while True:
        value, mask, _, first = levels[-1]
        starts = np.r_[True, bucket[1:] != bucket[:-1]]
        if starts.all():
            return levels
        base = np.maximum.accumulate(np.where(starts, np.arange(len(bucket)), 0))
        head = np.flatnonzero((np.arange(len(bucket)) - base) % FANOUT == 0)
        child = np.r_[head, len(bucket)]
        low, high = np.bitwise_and.reduceat(value, head), np.bitwise_or.reduceat(value, head)
        same = np.bitwise_and.reduceat(mask, head) & ~(low ^ high)
        levels.append((low & same, same, child, first[child]))
        bucket = bucket[head]


def _expand(a: np.ndarray, b: np.ndarray, child: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    na, nb = child[a + 1] - child[a], child[b + 1] - child[b]
    n = na * nb
    of = np.repeat(np.arange(len(a)), n)
    k = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    x, y = child[a][of] + k // nb[of], child[b][of] + k % nb[of]
    keep = x <= y
    return x[keep], y[keep]


def _ranges(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    n = hi - lo
    return np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())


class _Forest:
    """Smallest index reachable, for links that arrive in blocks."""

    def __init__(self, n: int) -> None:
        self.root = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.root[a], self.root[b]
            open_ = a != b
            a, b = a[open_], b[open_]
            if not len(a):
                return
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = self.root[self.root]
                if np.array_equal(up, self.root):
                    break
                self.root = up


def forest(code: np.ndarray, bucket: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links (code, code) between codes of a bucket within ``max_bits``.

    ``code`` is sorted by (bucket, Gray rank).
    """
    levels = _levels(code, bucket)
    found = _Forest(len(code))
    top = len(levels) - 1
    roots = np.arange(len(levels[top][0]))
    todo = [(top, roots, roots)]
    while todo:
        level, a, b = todo.pop()
        if len(a) > FRONTIER:
            half = len(a) // 2
            todo += [(level, a[half:], b[half:]), (level, a[:half], b[:half])]
            continue
        value, mask, child, first = levels[level]
        both = mask[a] & mask[b]
        sure = np.bitwise_count((value[a] ^ value[b]) & both)
        whole = (sure + np.bitwise_count(~both)) <= max_bits
        if whole.any():
            la, lb = first[a[whole]], first[b[whole]]
            ha, hb = first[a[whole] + 1], first[b[whole] + 1]
            found.link(np.repeat(la, ha - la), _ranges(la, ha))
            found.link(np.repeat(la, hb - lb), _ranges(lb, hb))
        go = (sure <= max_bits) & ~whole
        if go.any() and level:
            todo.append((level - 1, *_expand(a[go], b[go], child)))
    linked = np.flatnonzero(found.root != np.arange(len(code)))
    return code[linked], code[found.root[linked]]


def _link_partition(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, code) sorted by bucket -> links (u, v)."""
    held_b, held_c, n = [], [], 0

    def links(bucket: np.ndarray, code: np.ndarray) -> pa.RecordBatch:
        order = np.lexsort((gray_rank(code), bucket))
        u, v = forest(code[order], bucket[order], max_bits)
        return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

    for batch in batches:
        held_b.append(batch.column(0).to_numpy(zero_copy_only=False))
        held_c.append(batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64))
        n += batch.num_rows
        if n >= CHUNK:
            b, c = np.concatenate(held_b), np.concatenate(held_c)
            cut = int(np.searchsorted(b, b[-1]))  # the last bucket may go on in the next batch
            if cut:
                yield links(b[:cut], c[:cut])
            held_b, held_c, n = [b[cut:]], [c[cut:]], 0
    if held_b:
        b, c = np.concatenate(held_b), np.concatenate(held_c)
        if len(b):
            yield links(b, c)


def block_value(code: Column, block: int, blocks: int) -> Column:
    """The bits of one of ``blocks`` blocks of a 64-bit code."""
    width = -(-64 // blocks)
    mask = F.lit((1 << min(width, 64 - width * block)) - 1)
    return F.shiftrightunsigned(code, width * block).bitwiseAND(mask)


def links(codes: DataFrame, max_bits: int = 3) -> DataFrame:
    """Links (u, v) that span every group of the distinct ``codes`` (code long) within ``max_bits``."""
    blocks = max_bits + 1
    routed = codes.select("code", F.explode(F.array(*[
        (block_value(F.col("code"), i, blocks) * F.lit(blocks) + F.lit(i)).cast("bigint")
        for i in range(blocks)])).alias("bucket"))
    dealt = routed.select("bucket", "code").repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(lambda it: _link_partition(it, max_bits), "u long, v long").distinct()
