"""Byte-level BPE: encode each distinct word of the corpus once, decode by the token-byte table.

1. Documents are dealt into blocks by a hash of the row.  A block lists its
   distinct words - the pieces between places where the pattern always cuts -
   and sends them, sorted and packed by word bucket.
2. A bucket holds every word of its hash range, from all blocks.  It splits
   each distinct word by the pattern, encodes each match by the ranks, once,
   and replies to every block in the block's order.
3. A block joins the replies to the positions of its words and reassembles
   the documents' ids.

A frequent word is sent once per block, not once per use, so no bucket
depends on how often a word occurs; buckets grow with distinct words only.
The shuffles carry packed lists rather than a row per word and position,
which would be several times the input.

Decoding looks ids up in a table of token bytes: as many entries as the
vocabulary has, loaded from the vocabulary file by the tasks.

Defined cases: a null or empty text has no ids and decodes to no bytes;
repeated rows come out as often as they went in, also without a doc_id; an
empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import math
import zlib
from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import tiktoken
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions, text_of
from .pieces import cut, head

_KIND = "<u4"


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def _pack(items: list[bytes]) -> bytes:
    lengths = np.fromiter(map(len, items), _KIND, len(items))
    return zstandard.compress(lengths.tobytes() + b"".join(items), 3)


def _unpack(blob: bytes, n: int) -> list[bytes]:
    raw = zstandard.decompress(blob)
    ends = np.cumsum(np.frombuffer(raw, _KIND, n), dtype=np.int64) + 4 * n
    return [raw[a:b] for a, b in pairwise([4 * n, *ends.tolist()])]


def block_words(texts: list[str], buckets: int) -> dict[int, list[bytes]]:
    """The distinct words of a block by bucket, sorted; a word that is not a text's first starts with its space."""
    heads, rest = set(), set()
    for t in texts:
        start, more = cut(t)
        heads.add(start)
        rest.update(more)
    words = {h.encode() for h in heads if h} | {b" " + w.encode() for w in rest}
    out: dict[int, list[bytes]] = {}
    for w in words:
        out.setdefault(zlib.crc32(w) % buckets, []).append(w)
    for listed in out.values():
        listed.sort()
    return out


def _pack_docs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, text, block) -> one compressed row (block, docs) for each block of a batch."""
    for batch in batches:
        block = batch.column(2).to_numpy(zero_copy_only=False)
        order = np.argsort(block, kind="stable")
        head = np.flatnonzero(np.r_[True, np.diff(block[order]) != 0]) if len(order) else order
        blobs = []
        for rows in np.split(order, head[1:]):
            part = pa.Table.from_batches([batch.select([0, 1]).take(pa.array(rows))])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, part.schema) as w:
                w.write_table(part)
            blobs.append(zstandard.compress(sink.getvalue(), 3))
        yield pa.RecordBatch.from_arrays([pa.array(block[order[head]], pa.int64()), pa.array(blobs[:len(head)], pa.binary())],
                                         ["block", "docs"])


def _docs(rows: pa.Table) -> pa.Table:
    """The (doc_id, text) rows of a block."""
    return pa.concat_tables([pa.ipc.open_stream(zstandard.decompress(b.as_py())).read_all() for b in rows.column("docs")])


def _words(rows: pa.Table, buckets: int) -> pa.Table:
    lists = block_words(_docs(rows).column("text").to_pylist(), buckets)
    return pa.table({
        "bucket": pa.array(list(lists), pa.int32()),
        "block": pa.array([rows.column("block")[0].as_py()] * len(lists), pa.int64()),
        "n": pa.array([len(w) for w in lists.values()], pa.int64()),
        "words": pa.array([_pack(w) for w in lists.values()], pa.binary())})


def _encode_bucket(rows: pa.Table, path: str, pattern: str) -> pa.Table:
    ranks = load_ranks(path)
    bpe = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    known: dict[bytes, bytes] = {}
    replies = []
    for blob, n in zip(rows.column("words"), rows.column("n"), strict=True):
        words = _unpack(blob.as_py(), n.as_py())
        for w in words:
            if w not in known:
                known[w] = np.array(bpe.encode_ordinary(w.decode()), _KIND).tobytes()
        replies.append(_pack([known[w] for w in words]))
    return pa.table({"block": rows.column("block"), "bucket": rows.column("bucket"), "n": rows.column("n"),
                     "ids": pa.array(replies, pa.binary())})


def _assemble(rows: pa.Table, replies: pa.Table, buckets: int) -> pa.Table:
    docs = _docs(rows)
    texts = docs.column("text").to_pylist()
    lists = block_words(texts, buckets)
    first = {head(t) for t in texts}
    heads: dict[str, bytes] = {"": b""}
    rest: dict[str, bytes] = {}
    for bucket, n, blob in zip(replies.column("bucket"), replies.column("n"), replies.column("ids"), strict=True):
        for w, ids in zip(lists.pop(bucket.as_py()), _unpack(blob.as_py(), n.as_py()), strict=True):
            if w[:1] == b" ":
                rest[w[1:].decode()] = ids
            if (whole := w.decode()) in first:  # a text may begin with a space: a head can look like a later word
                heads[whole] = ids
    ids, sizes = [], []
    for t in texts:
        start, more = cut(t)
        raw = heads[start] + b"".join(map(rest.__getitem__, more))
        ids.append(raw)
        sizes.append(len(raw) // 4)
    values = np.frombuffer(b"".join(ids), _KIND).astype(np.int32)
    offsets = np.r_[0, np.cumsum(sizes)].astype(np.int32)
    return pa.table({"doc_id": docs.column("doc_id"), "ids": pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))})


def encode(docs: DataFrame, ranks_path: str, pattern: str, docs_per_block: int = 3000,
           then: Callable[[pa.Table], pa.Table] | None = None, schema: str = "doc_id long, ids array<int>") -> DataFrame:
    """(doc_id, ids array<int>) of every row of ``docs``.

    ``then`` maps a block's rows to others, of ``schema``, in the task that made them.
    """
    blocks = max(1, math.ceil(docs.count() / docs_per_block))
    buckets = partitions(docs.sparkSession)
    rows = docs.select(docs["doc_id"].cast("bigint"), text_of(docs).alias("text"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)))
    packed = rows.mapInArrow(_pack_docs, "block long, docs binary")
    words = packed.groupBy("block").applyInArrow(
        lambda t: _words(t, buckets), "bucket int, block long, n long, words binary")
    replies = words.groupBy("bucket").applyInArrow(
        lambda t: _encode_bucket(t, ranks_path, pattern), "block long, bucket int, n long, ids binary")
    then = then or (lambda t: t)
    return packed.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(
        lambda d, r: then(_assemble(d, r, buckets)), schema)


class TokenBytes:
    """The bytes of every token, end to end."""

    def __init__(self, path: str) -> None:
        ranks = load_ranks(path)
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            tokens[i] = token
        self.length = np.array([len(t) for t in tokens], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def decode(self, ids: np.ndarray) -> bytes:
        n = self.length[ids]
        at = np.repeat(self.start[ids] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return self.bytes[at].tobytes()


def _ids(column: pa.ListArray) -> Iterator[np.ndarray]:
    at, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    for a, b in pairwise(at.tolist()):
        yield values[a:b]


def _decode(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    table = TokenBytes(path)
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([table.decode(i) for i in _ids(b.column(1))], pa.binary())],
                                         ["doc_id", "decoded"])


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """(doc_id, decoded binary) of rows (doc_id, ids)."""
    return encoded.select("doc_id", "ids").mapInArrow(lambda it: _decode(it, ranks_path), "doc_id long, decoded binary")


def _digest(rows: pa.Table, path: str) -> pa.Table:
    table = TokenBytes(path)
    decimal = [str(i) for i in range(len(table.length))]
    sha = lambda b: hashlib.sha256(b).hexdigest()
    out = [(len(i), sha(",".join(map(decimal.__getitem__, i.tolist())).encode()), sha(table.decode(i)))
           for i in _ids(rows.column("ids").combine_chunks())]
    n, ids, text = zip(*out, strict=True) if out else ((), (), ())
    return pa.table({"doc_id": rows.column("doc_id"), "n_tokens": pa.array(n, pa.int64()),
                     "ids_sha256": pa.array(ids, pa.string()), "decoded_sha256": pa.array(text, pa.string())})


def digest(docs: DataFrame, ranks_path: str, pattern: str, docs_per_block: int = 3000) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and, from the ids decoded again, decoded_sha256 of every row of ``docs``."""
    return encode(docs, ranks_path, pattern, docs_per_block, lambda t: _digest(t, ranks_path),
                  "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
