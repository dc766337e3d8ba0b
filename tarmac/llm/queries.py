"""The ``opN_*`` queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_path
from . import (
    fim,
    hard_negatives,
    language,
    minhash,
    mixing,
    quality,
    simhash,
    suffix_array,
    suffix_automaton,
    token_files,
    topk,
    toxicity,
    word_bpe,
)
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(table(spark, sf_dir, "documents"))


ORACLE["op2_mix_sources"] = mixing.SQL


@query
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)


@query
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = work_path(spark, "token-files")
    base = base if "://" in base else f"file://{base}"
    manifest = token_files.write_files(table(spark, sf_dir, "documents"), base,
                                       public_tokenizers.path("byte_bpe_50k.json"), vocab=50_257)
    return token_files.read_digest(manifest, base)


@query
def op8_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return word_bpe.digest(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


@query
def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.quantized(table(spark, sf_dir, "embeddings")).checkpoint()
    return topk.search(vectors.where("vec_id % 100 = 0"), vectors, k=10)


ORACLE["op3_exact_topk"] = topk.SQL


@query
def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_array.digest(table(spark, sf_dir, "documents"), length=50)


@query
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_automaton.digest(table(spark, sf_dir, "documents"), length=50)


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.identify(docs, language.train(docs))


@query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(rows["vec_id"] % 7 == 0, (rows["label"] + 1) % 10).otherwise(rows["label"])
    rows = rows.select("vec_id", label.alias("label"), "embedding")
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0, scale=256.0)


ORACLE["op11_hard_negatives"] = hard_negatives.SQL


@query
def op12_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, percent=80)


ORACLE["op12_minhash_near_dedup"] = minhash.SQL


@query
def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digest(table(spark, sf_dir, "documents"))


ORACLE["op13_fill_in_middle"] = fim.SQL
