"""The pipeline's stages on odd rows, and the entry's guard."""

import hashlib
import os
import re
import shutil
import subprocess
import sys
from collections import Counter

import corpus_pipeline
import public_tokenizers
import pytest
import tiktoken
import xxhash
from tarmac.llm import toxicity, word_bpe
from tarmac.llm.common import NO_ID
from tarmac.session import work_path
from test_dedup import brute, fingerprint, linked, split

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def run(spark, docs, sf_dir):
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        path = work_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = out[name] = spark.read.parquet(path)
    return out


def test_stages(spark, odd):
    out = run(spark, odd, "/root/testdata/sf0.001")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert all(out[n].columns == odd.columns for n in names[:-1])
    cut = {r.doc_id: r for r in out["substring_dedup"].collect()}
    assert cut[2].text == "and then something else entirely" and cut[2].n_chars == len(cut[2].text)
    assert cut[1].text.startswith("the quick brown fox")
    assert 11 not in cut  # all its words stand in document 1
    assert out[names[-1]].count() == out["mix_sources"].count()


def plain_toxicity(rows, model):
    scores = toxicity.score_texts([r.text for r in rows], model, toxicity.Voters(model.patterns))
    return [r for r, x in zip(rows, scores, strict=True) if x < 0.7]


def plain_near_dedup(rows):
    """Of each component the row of the smallest id, null last; of rows that share it that of the smallest text hash."""
    root, least = linked([fingerprint(r.text) for r in rows]), {}
    for r, k in zip(rows, root, strict=True):
        th = xxhash.xxh64_intdigest((r.text or "").encode(), 42)
        least.setdefault(k, []).append((NO_ID if r.doc_id is None else r.doc_id, th - (th >> 63 << 64), r))
    return [min(rs, key=lambda x: x[:2])[2] for rs in least.values()]


def plain_cut(rows):
    rows, out = sorted(rows, key=lambda r: NO_ID if r.doc_id is None else r.doc_id), []
    for r, (_, words, gone) in zip(rows, brute(rows, split, 50), strict=True):
        kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g).decode()
        if not gone.any():
            out.append(r)
        elif kept:
            new = r.asDict() | {"text": kept, "n_chars": len(kept)}
            out.append(tuple(new[c] for c in r.__fields__))
    return out


def plain_mix(rows):
    size = Counter()
    for r in rows:
        size[r.source] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    names = sorted(size, key=lambda x: (x is None, x or ""))
    weight = {n: (3, 1, 2)[i % 3] for i, n in enumerate(names)}
    stopped, level = set(), 0.0
    while len(stopped) < len(names):
        level = (1.5 * size.total() - sum(2 * size[n] for n in stopped)) / sum(weight[n] for n in names if n not in stopped)
        full = {n for n in names if weight[n] * level >= 2 * size[n]}
        if full <= stopped:
            break
        stopped |= full
    out, seen = [], Counter()
    for r in rows:
        n = r.source
        rate = min(2 * size[n], weight[n] * level) / size[n] if size[n] else 0.0
        digest = hashlib.md5((r.text or "").encode()).hexdigest()
        key = f"mix:{'' if r.doc_id is None else r.doc_id}:{digest}:{seen[r.doc_id, digest]}"
        seen[r.doc_id, digest] += 1
        draw = int(hashlib.sha256(key.encode()).hexdigest()[:12], 16) / 2 ** 48
        out += [r] * (int(rate) + (draw < rate - int(rate)))
    return out


def plain_bpe(rows):
    ranks = word_bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    encode = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    return [(r.doc_id, tuple(encode(r.text or ""))) for r in rows]


@pytest.mark.parametrize("name", ["odd", "documents"])
def test_all_rows_are_brute_force(request, spark, name):
    """Each stage in plain Python, from the rows that the stage before was found to give."""
    sf = "/root/testdata/sf0.001"
    docs = request.getfixturevalue(name)
    out = {n: d.collect() for n, d in run(spark, docs, sf).items()}
    rows = docs.collect()
    same = lambda stage, want: Counter(map(tuple, out[stage])) == Counter(map(tuple, want))
    assert same("toxicity", plain_toxicity(rows, toxicity.train(docs, spark.read.parquet(f"{sf}/labels.parquet"))))
    assert same("simhash_near_dedup", plain_near_dedup(out["toxicity"]))
    assert same("substring_dedup", plain_cut(out["simhash_near_dedup"]))
    assert same("mix_sources", plain_mix(out["substring_dedup"]))
    want = Counter(plain_bpe(out["mix_sources"]))
    assert Counter((r.doc_id, tuple(r.ids)) for r in out["word_bpe"]) == want
    if name == "documents":
        assert Counter((r.doc_id, tuple(r.ids)) for r in corpus_pipeline.run(spark, sf).collect()) == want


def test_empty(spark, none):
    assert all(d.count() == 0 for d in run(spark, none, "/root/testdata/sf0.001").values())


def test_entry_without_the_subpackage(tmp_path):
    shutil.copytree(ROOT, tmp_path / "r", ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert q and 'pipeline' not in q and not any(k.startswith('op1') for k in q)"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "r", check=True, env=env, timeout=120)
