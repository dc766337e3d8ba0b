"""Fill-in-the-middle forms against plain Python."""

import hashlib
import re

import pytest

from tarmac.llm import fim

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]")


def brute(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    hexes = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(hexes[i:i + 8], 16) for i in range(0, 32, 8)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = ("".join(units[x:y]) for x, y in ((0, a), (a, b), (b, n)))
    if text == "" or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    if h[3] % 100 < 20:
        return doc_id, n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return doc_id, n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def check(docs):
    want = sorted((brute(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()), key=str)
    got = fim.transform(docs)
    assert sorted(map(tuple, got.drop("text").collect()), key=str) == want
    for r in fim.digest(docs).select("doc_id", "output_sha256", "restored_sha256").join(
            docs.select("doc_id", "text").distinct(), "doc_id").collect():
        if r.doc_id != 10:  # that id is repeated with different texts
            assert r.restored_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    return want


@pytest.mark.parametrize("name", ["odd", "documents"])
def test_forms_and_round_trip(request, name):
    want = check(request.getfixturevalue(name))
    if name == "documents":
        assert {w[2] for w in want} == {"plain", "psm", "spm"}


def test_markers_signs_and_very_long_texts(spark):
    texts = ["a<P>b", "x <S", "<M", "<M>", "<", "P>", "a$1 \\2 {3}+ (b)", "日本語" * 9, "\n\r\n  x\x00y", "🙂" * 50,
             "ab " * 400_000, "é" * 1_000_000, "a" * 3_000_000]
    rows = [(i * 100 + j, t) for i, t in enumerate(texts) for j in range(4 if len(t) > 1000 else 30)]
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(8))


def test_no_rows(none):
    assert fim.digest(none).collect() == []
