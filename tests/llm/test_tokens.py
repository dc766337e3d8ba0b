"""Tokenizing operators against the libraries."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tarmac.llm import token_files, word_bpe
from tarmac.llm.pieces import PieceCache
from tarmac.session import work_path

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(JSON)
    return lambda x: t.encode(x, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def ranked():
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=word_bpe.load_ranks(RANKS),
                             special_tokens={}).encode_ordinary


def test_pieces_are_independent(library, ranked):
    rng = random.Random(2)
    cache = PieceCache(*token_files.library_encoder(JSON, 2, limit=300), limit=500)
    parts = [" ", "  ", "\n", "\t", "a", "é", "don't", "'s", "1", "<", "日", " ", "\x1c", " ", ".", "word"]
    for _ in range(3_000):
        x = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert np.frombuffer(cache.ids(x), "<u2").tolist() == library(x)


def test_whole_texts_are_the_library_and_share_words(library):
    """Latin texts are split at once: a known word costs nothing new with other punctuation around it."""
    rng = random.Random(4)
    coder = token_files.TextCoder(JSON, 2)
    parts = [" ", "  ", "\n", "\t", " \r\n", "a", "é", "don't", "'s", "'", "12", "<", "\xa0", "\x85", "\x1c", ".", "word", "\u0153", "ß!"]
    for odd in ([], ["日", "<|endoftext|>", "\u2003"]):
        for _ in range(2_000):
            x = "".join(rng.choice(parts + odd) for _ in range(rng.randint(0, 20)))
            assert np.frombuffer(coder.ids(x), "<u2").tolist() == library(x)
    coder = token_files.TextCoder(JSON, 2)
    marks = [a + b for a in ".,;!?" for b in ["", "\n", "\t"]]
    for i in range(100):
        coder.ids("".join(f" w{chr(97 + j % 26)}{rng.choice(marks)}{rng.choice(marks)}" for j in range(i % 40)))
    assert not coder.pieces.known.young


def uri(spark):
    base = work_path(spark, "token-files")
    return base if "://" in base else f"file://{base}"


def test_files_round_trip(spark, odd, library):
    base = uri(spark)
    got = token_files.read_digest(token_files.write_files(odd, base, JSON, 50_257, docs_per_shard=5), base).collect()
    hashed = odd.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"))
    rows = sorted(hashed.collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0, r.th))
    want, at = [], 0
    for r in rows:
        ids = np.array([*library(r.text or ""), 0], "<u4")
        want.append((r.doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_shards_are_bounded_and_read_by_many_tasks(spark, library):
    """Rows without an id spread over shards, a shard ends at its bytes, and each shard is read by a task of its own."""
    rows = [(None, f"text {i} " * 20) for i in range(400)] + [(5, f"other {i}") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    base = uri(spark)
    manifest = token_files.write_files(docs, base, JSON, 50_257, docs_per_shard=50)
    seen = manifest.collect()
    assert len(seen) >= 8 and max(r.n_docs for r in seen) <= 150
    got = token_files.read_digest(manifest, base)
    assert got.rdd.getNumPartitions() == len(seen)
    assert got.count() == 500 and got.agg(F.sum("n_tokens")).head()[0] == sum(len(library(t)) + 1 for _, t in rows)
    base = uri(spark)
    small = token_files.write_files(docs, base, JSON, 50_257, shard_bytes=1000)
    assert small.count() > 20
    starts = sorted((r.start, r.n_tokens) for r in token_files.read_digest(small, base).collect())
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:]))


def test_keyed_access(spark, odd, library):
    base = uri(spark)
    token_files.write_files(odd, base, JSON, 50_257, docs_per_shard=10**6)
    shard = token_files.Shard(base, 0)
    assert shard.get(7).tolist() == [*library("one two"), 0]
    assert shard.get(10, 2).tolist() != shard.get(10, 0).tolist() and shard.get(10, 3) is None
    assert shard.get(None, 1) is not None and shard.get(999) is None


def test_perfect_hash_is_minimal():
    keys = token_files.key_hash(np.arange(50_000) * 7 - 100, np.zeros(50_000))
    h = token_files.PerfectHash.build(keys)
    assert sorted(h.slots(keys).tolist()) == list(range(50_000))


@pytest.mark.parametrize("name", ["odd", "documents"])
def test_word_bpe_is_the_library(request, ranked, name):
    docs = request.getfixturevalue(name)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for r in docs.select("doc_id", "text").collect():
        ids = ranked(r.text or "")
        want.append((r.doc_id, len(ids), sha(",".join(map(str, ids)).encode()), sha((r.text or "").encode())))
    got = word_bpe.digest(docs, RANKS, public_tokenizers.PATTERN, docs_per_block=16).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_decode_gives_the_text(odd):
    encoded = word_bpe.encode(odd, RANKS, public_tokenizers.PATTERN)
    got = [(r.doc_id, bytes(r.decoded).decode()) for r in word_bpe.decode(encoded, RANKS).collect()]
    assert sorted(got, key=str) == sorted(((r.doc_id, r.text or "") for r in odd.collect()), key=str)


def test_empty_tables(spark, none):
    base = uri(spark)
    assert token_files.read_digest(token_files.write_files(none, base, JSON, 50_257), base).count() == 0
    assert word_bpe.digest(none, RANKS, public_tokenizers.PATTERN).count() == 0
