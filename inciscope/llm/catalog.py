"""The operators applied to the test tables, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from inciscope.llm import bpe, fingerprints, hamming, hmm, lexical, ngram_join, packing, pii, secret_scan, toxicity, urls, whitening, wrappers
from inciscope.llm.common import read

VOCABULARY = "word_bpe_49k.json"


def op1_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_likeness(read(spark, sf_dir, "documents"))


def op2_concatenate_and_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY)).drop("ids")


def op3_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op4_zstd_novelty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan(read(spark, sf_dir, "documents")))


def op5_checked_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find(read(spark, sf_dir, "documents")))


def op6_t_occurrence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.groups(read(spark, sf_dir, "documents")).drop("node")


def op7_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score(read(spark, sf_dir, "documents"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digest(read(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op9_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return hamming.nearest(vectors, vectors.where("vec_id % 100 = 0"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(read(spark, sf_dir, "pages"))


def op11_max_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op12_incremental_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings"))


def op13_wrapper_inference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extract(read(spark, sf_dir, "pages"))


OPERATORS = (
    op1_order_minhash, op2_concatenate_and_cut, op3_weak_supervision, op4_zstd_novelty, op5_checked_patterns,
    op6_t_occurrence, op7_hidden_markov, op8_bpe, op9_multi_index_hashing, op10_url_filter,
    op11_max_sketches, op12_incremental_whitening, op13_wrapper_inference,
)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in OPERATORS}
ORACLE = {
    "op6_t_occurrence": ngram_join.oracle(),
    "op9_multi_index_hashing": hamming.oracle(),
    "op10_url_filter": urls.oracle(),
    "op11_max_sketches": lexical.oracle(),
}
