"""A training corpus from ``documents``, in five stages.

1. toxicity: documents that the classifier rejects go;
2. SimHash near-dedup: of each group of near copies the smallest doc_id stays;
3. substring dedup: passages of 50 words or more that an earlier document
   has are cut; documents that lose no word keep their text as it is, and
   those that lose every word go;
4. mixing: every document is emitted as often as the mix takes it;
5. byte-level BPE: the ids of every emitted document.

Each stage is written as Parquet under the shared checkpoint folder and read
again, so a lost executor costs one stage at most.  All but the last return
the columns of ``documents``; n_chars follows the text.

Defined cases: those of the operators.  Extra columns are carried along; an
empty table passes through all stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm import mixing, simhash, suffix_automaton, toxicity, word_bpe
from tarmac.llm.common import NO_ID, table
from tarmac.session import work_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_representatives(docs, shingle=3, max_bits=3)


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = suffix_automaton.cut_texts(docs, length=50).withColumnRenamed("ord", "cut_ord").withColumnRenamed("th", "cut_th")
    cut = cut.dropDuplicates(["cut_ord", "cut_th"])
    is_it = ((F.coalesce(docs["doc_id"].cast("bigint"), F.lit(NO_ID)) == cut["cut_ord"])
             & (F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit(""))) == cut["cut_th"]))
    kept = cut["kept"]
    rows = docs.join(cut, is_it, "left").where(kept.isNull() | (kept != ""))
    text = F.coalesce(kept, docs["text"])
    size = F.when(kept.isNull(), docs["n_chars"]).otherwise(F.length(kept))
    new = {"text": text, "n_chars": size.cast(docs.schema["n_chars"].dataType)}
    return rows.select(*[new.get(c, docs[c]).alias(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return word_bpe.encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("toxicity", drop_toxic), ("simhash_near_dedup", near_dedup), ("substring_dedup", cut_passages),
          ("mix_sources", mix_sources), ("word_bpe", encode)]

#: The classifier, the fingerprints and BPE cannot be expressed in SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        out = work_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
