"""The corpus pipeline: stages over documents, each written as Parquet and read again by the next.

Every stage takes null and empty texts, repeated rows, rows without doc_id and tables without rows. The first three
return the columns they are given, whatever further ones there are; packing reads the id and the text alone.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from inciscope.llm import ngram_join, packing, secret_scan, toxicity
from inciscope.llm.common import read
from inciscope.session import materialise


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier trained on weak labels rejects go. A null text is judged as empty and stays null;
    each repeated row is judged alike; without labels of both classes nothing is rejected."""
    return toxicity.keep_clean(docs, read(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked shingle sets stays, that of the least doc_id. Documents without words, null
    texts among them, link with nothing and stay."""
    return ngram_join.representatives(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced by a mark, and n_chars set anew where a text changed. All rows stay, a null text
    as null."""
    return secret_scan.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left is laid end to end and cut into training sequences: a row for each piece. A null or empty text is its
    end id alone; rows of one or no doc_id are packed one by one."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_join", drop_near_copies),
    ("secret_scan", redact_secrets),
    ("packing", pack),
]

#: No SQL: neither a trained classifier nor tokens can be had in it. Tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialise(docs, f"pipeline-{name}")
    return docs
