"""SimHash, suffix-array and suffix-automaton operators against brute force."""

import hashlib
import tracemalloc

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pytest
from pyspark.sql import functions as F
import xxhash
import zstandard

from tarmac.llm import gray_index, passages, simhash, suffix_array, suffix_automaton, winnow
from tarmac.llm.common import NO_ID
from tarmac.llm.components import components


def split(text):
    return (text or "").encode().split()


def fingerprint(text):
    words = split((text or "").encode().lower().decode())
    grams = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def linked(codes):
    """Smallest index reachable by links of at most 3 bits."""
    root = list(range(len(codes)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(codes)):
        for j in range(i):
            if (codes[i] ^ codes[j]).bit_count() <= 3:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(codes))]


@pytest.mark.parametrize("name", ["odd", "documents"])
def test_simhash_is_brute_force(request, name):
    docs = request.getfixturevalue(name)
    rows = docs.select("doc_id", "text").collect()
    codes = [fingerprint(r.text) for r in rows]
    root = linked(codes)
    least = {}
    for r, k in zip(rows, root, strict=True):
        least[k] = min(least.get(k, NO_ID), NO_ID if r.doc_id is None else r.doc_id)
    want = sorted(((r.doc_id, f"{c:016x}", least[k]) for r, c, k in zip(rows, codes, root, strict=True)), key=str)
    assert sorted(map(tuple, simhash.near_duplicates(docs).collect()), key=str) == want


def test_one_row_of_each_component_stays(odd):
    kept = simhash.keep_representatives(odd.withColumn("extra col", F.lit(1)).withColumn("a.b", F.lit(2)))
    assert kept.columns == [*odd.columns, "extra col", "a.b"]
    rows = kept.collect()
    ids = [r.doc_id for r in rows]
    # those without an id are copies of rows that have one; the two texts of id 10 are not alike
    assert ids.count(None) == 0 and ids.count(7) == 1 and 8 not in ids and 11 not in ids
    assert [r.text for r in rows if r.doc_id == 10].count("another text with a repeated id") == 1
    assert len(rows) == len(set(linked([fingerprint(r.text) for r in odd.select("doc_id", "text").collect()])))


def test_index_finds_all_links_in_tight_groups():
    rng = np.random.default_rng(7)
    centres = rng.integers(0, 1 << 63, 20, dtype=np.uint64)
    codes = np.unique(np.concatenate([c ^ (np.uint64(1) << rng.integers(0, 64, 300, dtype=np.uint64))
                                      ^ (np.uint64(1) << rng.integers(0, 64, 300, dtype=np.uint64)) for c in centres]))
    codes = codes[np.argsort(gray_index.gray_rank(codes))]
    u, v = gray_index.forest(codes, np.zeros(len(codes), np.int64), 3)
    at = {int(c): i for i, c in enumerate(codes)}
    root = list(range(len(codes)))
    for a, b in zip(u.tolist(), v.tolist(), strict=True):
        root[at[a]] = at[b]
    while any(root[r] != r for r in root):
        root = [root[r] for r in root]
    assert root == linked([int(c) for c in codes])
    assert len(u) < len(codes)


def test_gray_neighbours_differ_in_one_bit():
    rank = np.arange(256, dtype=np.uint64)
    code = rank ^ (rank >> np.uint64(1))
    assert (gray_index.gray_rank(code) == rank).all()


def test_components_of_a_long_path(spark):
    edges = spark.range(60).selectExpr("id + 1 AS u", "id AS v")
    assert {r.root for r in components(edges).collect()} == {0}
    assert components(edges.where("u < 0")).count() == 0


def covered(units, seen, length):
    gone = np.zeros(len(units), bool)
    for a in range(len(units) - length + 1):
        if tuple(units[a:a + length]) in seen:
            gone[a:a + length] = True
    return gone


def brute(rows, cut, length):
    """Rows in order of id (null last), each against the windows of smaller ids."""
    rows = sorted(rows, key=lambda r: NO_ID if r.doc_id is None else r.doc_id)
    seen, out, at = set(), [], 0
    while at < len(rows):
        same = [r for r in rows[at:] if r.doc_id == rows[at].doc_id]
        cuts = [cut(r.text) for r in same]
        out += [(r.doc_id, u, covered(u, seen, length)) for r, u in zip(same, cuts, strict=True)]
        for u in cuts:
            seen.update(tuple(u[a:a + length]) for a in range(len(u) - length + 1))
        at += len(same)
    return out


@pytest.mark.parametrize("name,length", [("odd", 50), ("odd", 7), ("documents", 50)])
def test_words_against_brute_force(request, name, length):
    docs = request.getfixturevalue(name)
    want = []
    for i, words, gone in brute(docs.select("doc_id", "text").collect(), split, length):
        kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g)
        want.append((i, len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest()))
    got = map(tuple, suffix_automaton.digest(docs, length).collect())
    assert sorted(got, key=str) == sorted(want, key=str)


@pytest.mark.parametrize("length", [50, 9])
def test_bytes_against_brute_force(odd, length):
    docs = odd.where("doc_id IS NULL OR doc_id <> 9")  # the long text is covered by the words
    want, texts = [], []
    for i, units, gone in brute(docs.select("doc_id", "text").collect(), lambda t: (t or "").encode(), length):
        kept = bytes(b for b, g in zip(units, gone, strict=True) if not g)
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        want.append((i, len(units), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
        texts.append((i, kept))
    assert sorted(map(tuple, suffix_array.digest(docs, length).collect()), key=str) == sorted(want, key=str)
    left = [(r.doc_id, bytes(r.kept)) for r in suffix_array.remove_repeats(docs, length).collect()]
    assert sorted(left, key=str) == sorted(texts, key=str)


def test_empty_tables(none):
    assert simhash.near_duplicates(none).count() == 0
    assert suffix_array.digest(none).count() == 0
    assert suffix_automaton.digest(none).count() == 0


def test_ranks_compare_in_full():
    data = np.frombuffer(b"abcabcabdabcabcabdxyz" * 2, np.uint8)
    for length in (1, 2, 3, 5, 8, 9, 16, 20):
        r = winnow_free_ranks(data, length)
        got = suffix_array.ranks(data, np.arange(len(data), 0, -1), length)
        assert [(a >= 0) for a in got] == [n > 1 for n in r[0]]
        same = {}
        for g, key in zip(got.tolist(), r[1], strict=True):
            if g >= 0:
                assert same.setdefault(g, key) == key


def winnow_free_ranks(data, length):
    keys = [bytes(data[i:i + length]) if i + length <= len(data) else None for i in range(len(data))]
    return [keys.count(k) if k is not None else 0 for k in keys], keys


def test_shared_windows_are_candidates():
    rng = np.random.default_rng(3)
    passage = rng.integers(1, 5, 80)
    texts = [np.r_[rng.integers(1, 5, n), passage, rng.integers(1, 5, n)].astype(np.uint64) for n in (20, 13, 700)]
    offsets = np.r_[0, np.cumsum([len(t) for t in texts])]
    doc, h = winnow.doc_anchors(np.concatenate(texts), offsets, 50, 24)
    shared = [np.array([x for x in h[doc == d] if len(set(doc[h == x].tolist())) > 1]) for d in range(3)]
    assert 0 < sum(map(len, shared)) < len(h) / 2
    found = set()
    for runs in winnow.candidate_runs(np.concatenate(texts), offsets, 50, 24, shared):
        for d, a, b, x in zip(*(r.tolist() for r in runs), strict=True):
            found |= {(d, i, x) for i in range(a, b + 1)}
    for d, n in enumerate((20, 13, 700)):
        assert {i for f, i, _ in found if f == d} >= set(range(n, n + 31))
    place = lambda d, n: {(i - n, x) for f, i, x in found if f == d and n <= i < n + 31}
    assert place(0, 20) == place(1, 13) == place(2, 700)


def test_long_documents_in_parts_have_the_same_windows(monkeypatch):
    units = np.random.default_rng(5).integers(0, 1 << 40, 5_000).astype(np.uint64)
    offsets = np.array([0, 4_000, 5_000])

    def windows():
        doc, h = winnow.doc_anchors(units, offsets, 50, 24)
        shared = [h[doc == d] for d in range(2)]
        return set(zip(doc.tolist(), h.tolist(), strict=True)), {
            (d, i, x) for runs in winnow.candidate_runs(units, offsets, 50, 24, shared)
            for d, a, b, x in zip(*(r.tolist() for r in runs), strict=True) for i in range(a, b + 1)}

    whole = windows()
    assert len(whole[1]) == 3_951 + 951
    monkeypatch.setattr(winnow, "PART", 128)
    assert windows() == whole


def test_a_word_that_repeats_for_ever(spark):
    docs = spark.createDataFrame([(i, "ha " * (3_000 + i)) for i in range(4)], "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_removed) for r in suffix_automaton.digest(docs).collect()}
    assert got == {0: (3_000, 0), 1: (3_001, 3_001), 2: (3_002, 3_002), 3: (3_003, 3_003)}


def peak_bytes(f):
    tracemalloc.start()
    try:
        f()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def repeated_texts():
    """Texts whose lines are half their own and half other texts'."""
    rng = np.random.default_rng(3)
    lines = [rng.integers(97, 123, 80, dtype=np.uint8).tobytes() for _ in range(60_000)]
    return [b"\n".join(lines[i] for i in (*range(25 * r, 25 * r + 25), *rng.integers(0, len(lines), 25).tolist())) for r in range(2400)]


def test_bytes_take_few_times_their_batch():
    """Peaks in bytes a byte of text (about 6.7, 25 and 94 with records of Python objects and 64-bit steps)."""
    texts = repeated_texts()
    size, scheme = sum(map(len, texts)), suffix_array.byte_scheme(50)
    ids = pa.array(range(len(texts)), pa.int64())
    rows = pa.record_batch([ids, pa.array(texts, pa.binary())], ["ord", "text"])
    anchors = []
    assert peak_bytes(lambda: anchors.extend(passages._anchor_rows(iter([rows]), scheme, 40))) < 5.5 * size
    pairs = pa.Table.from_batches(anchors)
    shared = [passages._shared_rows(pairs.filter(pa.compute.equal(pairs["bucket"], b))) for b in range(40)]
    hs = pa.concat_tables(shared).group_by("ord").aggregate([("h", "list")]).sort_by("ord")
    assert hs["ord"].to_pylist() == ids.to_pylist()
    z = pa.array([zstandard.compress(t) for t in texts], pa.binary())
    rows = pa.record_batch([ids, ids, z, hs["h_list"].combine_chunks()], ["ord", "th", "z", "hs"])
    contexts = []
    assert peak_bytes(lambda: contexts.extend(passages._context_rows(iter([rows]), scheme, 1))) < 21 * size
    table = pa.Table.from_batches(contexts)
    assert len(passages.unpack_contexts(table).text) > 50_000
    data = np.frombuffer(b"".join(texts[::8]), np.uint8)
    room = np.arange(len(data), 0, -1)
    assert peak_bytes(lambda: suffix_array.ranks(data, room, 50)) < 50 * len(data)
