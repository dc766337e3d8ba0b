"""Token-id files with keyed access: raw ids in shards, found by a minimal perfect hash.

A shard holds the documents of one range of doc_id, in ascending order:

- ``shard-N.ids``: the ids of its documents one after the other, little-endian,
  2 bytes each if the vocabulary fits, else 4;
- ``shard-N.idx``: a line of JSON (sizes of what follows), then raw arrays: the
  keys in file order, the bit levels of the hash, and for each hash slot a
  stored fingerprint, the offset and the number of ids.

A key is looked up by hashing it through the levels (a level's set bit means
"this slot is mine alone"), ranking the bit and comparing the fingerprint: a
constant number of reads, and an unknown key is refused.

Files are written by the tasks that encode, under a temporary name that is
renamed at the end, so a repeated task leaves the same file.  Their folder is
any URI that pyarrow can open and all executors share.

Defined cases: a null text is the empty text; a document always has the end
id, so its length is 1 at least; rows that repeat a doc_id are numbered 0, 1,
... within a shard, in the order of their texts' hashes, and each has its own
key there; a null doc_id comes last; the string of a special token in a text
is that token.  An empty table gives no shards and no rows.
"""

from __future__ import annotations

import json
import math
import os
import re
import unicodedata
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import NO_ID, text_of
from .pieces import PieceCache, Recent

_U = np.uint64
GAMMA = 2.0
MAX_LEVELS = 40
#: A shard's number is its task's, shifted by this, plus its place in the task.
PART_BITS = 20


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finalizer with full avalanche."""
    x = x ^ _U((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def key_hash(ids: np.ndarray, nth: np.ndarray) -> np.ndarray:
    """One 64-bit hash for (doc_id, how many rows before it share the id)."""
    return _mix(ids.astype(np.int64).view(_U) + _mix(nth.astype(np.int64).view(_U), 1), 2)


class PerfectHash:
    """Levels of bits: a key belongs to the first level where it was alone on its bit."""

    def __init__(self, sizes: list[int], bits: np.ndarray) -> None:
        self.sizes, self.bits = sizes, bits
        self.ranks = np.r_[0, np.cumsum(bits, dtype=np.int64)]

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        sizes, levels, rest = [], [], keys
        while len(rest) and len(sizes) < MAX_LEVELS:
            m = max(1, math.ceil(GAMMA * len(rest)))
            at = (_mix(rest, 100 + len(sizes)) % _U(m)).astype(np.int64)
            alone = np.bincount(at, minlength=m) == 1
            sizes.append(m)
            levels.append(alone)
            rest = rest[~alone[at]]
        if len(rest):
            raise ValueError("two keys share their 64-bit hash")
        return cls(sizes, np.concatenate(levels) if levels else np.zeros(0, bool))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 if it hits no bit (then it is surely unknown)."""
        out = np.full(len(keys), -1, np.int64)
        todo, base = np.arange(len(keys)), 0
        for level, m in enumerate(self.sizes):
            at = base + (_mix(keys[todo], 100 + level) % _U(m)).astype(np.int64)
            hit = self.bits[at]
            out[todo[hit]] = self.ranks[at[hit]]
            todo, base = todo[~hit], base + m
        return out


def _put(base: str, name: str, parts: Iterable[bytes]) -> None:
    store, root = fs.FileSystem.from_uri(base)
    temp = f"{root}/.{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(temp) as f:
        for p in parts:
            f.write(p)
    store.move(temp, f"{root}/{name}")


def write_shard(base: str, shard: int, ids: np.ndarray, nth: np.ndarray, payload: list[bytes], width: int) -> None:
    keys = key_hash(ids, nth)
    table = PerfectHash.build(keys)
    slot = table.slots(keys)
    count = np.fromiter((len(p) // width for p in payload), np.int64, len(payload))
    prints, offsets, counts = np.zeros(len(keys), np.uint32), np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
    prints[slot] = (_mix(keys, 3) >> _U(32)).astype(np.uint32)
    offsets[slot], counts[slot] = np.cumsum(count) - count, count
    arrays = {"ids": ids, "nth": nth, "bits": np.packbits(table.bits), "prints": prints, "offsets": offsets, "counts": counts}
    head = {"width": width, "levels": table.sizes, "arrays": {k: [a.dtype.str, len(a)] for k, a in arrays.items()}}
    _put(base, f"shard-{shard:07d}.ids", payload)
    _put(base, f"shard-{shard:07d}.idx", [json.dumps(head).encode() + b"\n", *(a.tobytes() for a in arrays.values())])


class Shard:
    """Keyed access to one shard."""

    def __init__(self, base: str, shard: int) -> None:
        self.store, root = fs.FileSystem.from_uri(base)
        with self.store.open_input_stream(f"{root}/shard-{shard:07d}.idx") as f:
            raw = f.read()
        line, _, body = raw.partition(b"\n")
        head, at = json.loads(line), 0
        for name, (kind, n) in head["arrays"].items():
            a = np.frombuffer(body, kind, n, at)
            at += a.nbytes
            setattr(self, name, a)
        self.width = head["width"]
        self.table = PerfectHash(head["levels"], np.unpackbits(self.bits, count=sum(head["levels"])).astype(bool))
        self.file = self.store.open_input_file(f"{root}/shard-{shard:07d}.ids")

    def locate(self, ids: np.ndarray, nth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(offset, count) of each key; count -1 if it is not in the shard."""
        keys = key_hash(ids, nth)
        slot = self.table.slots(keys)
        known = slot >= 0
        known[known] = self.prints[slot[known]] == (_mix(keys[known], 3) >> _U(32)).astype(np.uint32)
        return np.where(known, self.offsets[slot], 0), np.where(known, self.counts[slot], -1)

    def read(self, offset: int, count: int) -> np.ndarray:
        self.file.seek(int(offset) * self.width)
        return np.frombuffer(self.file.read(int(count) * self.width), f"<u{self.width}")

    def get(self, doc_id: int | None, nth: int = 0) -> np.ndarray | None:
        offset, count = self.locate(np.array([NO_ID if doc_id is None else doc_id]), np.array([nth]))
        return self.read(offset[0], count[0]) if count[0] >= 0 else None


def _latin(first: str) -> str:
    """The characters up to U+024F of a Unicode category, for a character class (letters and digits have kept theirs)."""
    return "".join(re.escape(chr(c)) for c in range(0x250) if unicodedata.category(chr(c))[0] == first)


_SPACE = "\\t-\\r \x85\xa0"
_L, _N = _latin("L"), _latin("N")
#: The vocabulary's own split pattern, for texts of these characters.
PRE_TOKEN = re.compile(f"'(?:s|t|re|ve|m|ll|d)| ?[{_L}]+| ?[{_N}]+| ?[^{_SPACE}{_L}{_N}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
#: Characters above this have the library itself look for the places to split.
LAST = "\u024f"
_BEYOND = re.compile(f"[^\0-{LAST}]")


def library_encoder(path: str, width: int, specials_as_text: bool = False, limit: int = 500_000):
    """(encode, special): ids of pieces, as bytes, by the tokenizers library, and the strings of special tokens.

    A piece of Latin characters is split into pre-tokens, and each distinct one goes through the library
    once as long as it is used now and then; other pieces go through it whole.  A special token's
    string in a text is that token, the library's default, or ordinary text with ``specials_as_text``.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = specials_as_text
    special = [] if specials_as_text else [a.content for a in t.get_added_tokens_decoder().values()]
    kind = f"<u{width}"
    known = Recent(limit)

    def library(texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, kind).tobytes() for e in t.encode_batch_fast(texts, add_special_tokens=False)]

    end = library(["\n"])[0]

    def by_line(words: list[str]) -> dict[str, bytes]:
        """Ids of pre-tokens.  A line end between two that are not space is a pre-token of its own, so those go
        through the library in one call, a line each, and no id of theirs is that of the line end."""
        lines = [w for w in words if not w.isspace()] if len(end) == width else []
        rest = [w for w in words if w.isspace()] if lines else words
        out = dict(zip(rest, library(rest), strict=True)) if rest else {}
        if lines:
            ids = np.frombuffer(library(["\n".join(lines)])[0], kind)
            at = (np.flatnonzero(ids == np.frombuffer(end, kind)[0]) * width).tolist()
            raw = ids.tobytes()
            out |= zip(lines, [raw[a:b] for a, b in zip([0, *[x + width for x in at]], [*at, len(raw)], strict=True)], strict=True)
        return out

    def encode(pieces: list[str], uncut: bool = False) -> list[bytes]:
        if uncut:
            return library(pieces)
        split = [[p] if not p or _BEYOND.search(p) else PRE_TOKEN.findall(p) for p in pieces]
        coded = [list(map(known.young.get, parts)) for parts in split]
        if any(None in ids for ids in coded):
            new = known.missing(x for parts in split for x in parts)
            if new:
                whole = [x for x in new if not x or _BEYOND.search(x)]
                if whole:
                    known.young.update(zip(whole, library(whole), strict=True))
                known.young.update(by_line([x for x in new if x not in known.young] if whole else new))
            coded = [list(map(known.young.__getitem__, parts)) for parts in split]
        return [b"".join(ids) for ids in coded]

    return encode, special


class TextCoder:
    """Ids (as bytes) of whole texts.

    A text of Latin characters is split into pre-tokens at once: they repeat more often than the pieces between
    spaces, which carry punctuation.  Others are cut into pieces first, so that few of them go through the library whole.
    """

    def __init__(self, path: str, width: int) -> None:
        self.encode, self.special = library_encoder(path, width)
        self.pieces = PieceCache(self.encode, self.special, limit=100_000)

    def ids(self, text: str) -> bytes:
        if _BEYOND.search(text) or any(x in text for x in self.special):
            return self.pieces.ids(text)
        return self.encode([text])[0] if text else b""


_coders: dict[tuple[str, int], TextCoder] = {}


def _write(batches: Iterator[pa.RecordBatch], base: str, path: str, width: int, end_id: int, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Shards of one task: rows (key, text) in order; a shard is written when its ids reach ``max_bytes``."""
    if (path, width) not in _coders:
        _coders[path, width] = TextCoder(path, width)
    coder, end = _coders[path, width], int(end_id).to_bytes(width, "little")
    ids, payload, size, done = [], [], 0, 0

    def flush() -> pa.RecordBatch:
        own = np.array(ids, np.int64)
        first = np.r_[True, own[1:] != own[:-1]]
        nth = np.arange(len(own)) - np.maximum.accumulate(np.where(first, np.arange(len(own)), 0))
        shard = (TaskContext.get().partitionId() << PART_BITS) + done
        write_shard(base, shard, own, nth, payload, width)
        return pa.RecordBatch.from_pydict({"shard": [shard], "n_docs": [len(own)], "n_ids": [size // width]})

    for b in batches:
        for key, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            coded = coder.ids(text.as_py()) + end
            ids.append(key)
            payload.append(coded)
            size += len(coded)
            if size >= max_bytes:
                yield flush()
                ids, payload, size, done = [], [], 0, done + 1
    if payload:
        yield flush()


def write_files(docs: DataFrame, base: str, tokenizer: str, vocab: int, end_id: int = 0,
                docs_per_shard: int = 4096, shard_bytes: int = 1 << 25) -> DataFrame:
    """Encode ``docs`` into shards under ``base``; the manifest (shard, n_docs, n_ids, first), also kept there.

    A shard holds about ``docs_per_shard`` documents, and no further one once its ids reach ``shard_bytes``.
    Rows are dealt by id and text, so rows without an id, or with one id, spread over shards too.
    """
    spark = docs.sparkSession
    width = 2 if vocab <= 1 << 16 else 4
    store, root = fs.FileSystem.from_uri(base)
    store.create_dir(root)
    shards = max(1, math.ceil(docs.count() / docs_per_shard))
    text = text_of(docs)
    rows = docs.select(F.coalesce(docs["doc_id"].cast("bigint"), F.lit(NO_ID)).alias("key"), text.alias("text"),
                       F.xxhash64(text).alias("th"))
    dealt = rows.repartitionByRange(shards, "key", "th").sortWithinPartitions("key", "th", "text").select("key", "text")
    dealt.mapInArrow(lambda it: _write(it, base, tokenizer, width, end_id, shard_bytes), "shard long, n_docs long, n_ids long") \
         .write.mode("overwrite").parquet(f"{base}/manifest")
    shards_seen = spark.read.parquet(f"{base}/manifest")
    # One row per shard, not per document: a single window over it is small.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return shards_seen.withColumn("first", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def _read(batches: Iterator[pa.RecordBatch], base: str) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for shard, first in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            s = Shard(base, shard)
            offset, count = s.locate(s.ids, s.nth)
            sums = [zlib.crc32(s.read(o, n).astype("<u4").tobytes()) for o, n in zip(offset, count, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(s.ids, mask=s.ids == NO_ID), pa.array(first + offset), pa.array(count), pa.array(sums, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"])


def read_digest(manifest: DataFrame, base: str) -> DataFrame:
    """Every document looked up in its shard by key: doc_id, start, n_tokens, ids_crc32; a task per shard."""
    shards = manifest.select("shard", F.col("first").cast("bigint"))
    # The number is given, so adaptive execution does not merge the few bytes of the manifest into one task.
    dealt = shards.repartitionByRange(max(1, manifest.count()), "shard")
    return dealt.mapInArrow(lambda it: _read(it, base), "doc_id long, start long, n_tokens long, ids_crc32 long")
