"""A training corpus from raw documents: five stages, each stored and read again.

1. language: documents whose language is not recognised go.
2. near_duplicates: of near-duplicate documents (five-word shingles, similarity 0.8) one stays.
3. decontamination: documents in which ten successive words of a benchmark item occur go whole.
4. mixing: sources are sent in turn to their target weights; a document sent twice is there twice.
5. tokens: what is left is encoded and stored as grammar-compressed shards, and read back.

`ORACLE_SQL` is None: the language stage learns a model, which SQL cannot express.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from arrivals.llm.common import store, table
from arrivals.llm.decontaminate import decontaminate
from arrivals.llm.language import keep_known
from arrivals.llm.minhash import keep_one
from arrivals.llm.mixing import mix
from arrivals.llm.tokens import tokenize


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_known(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return tokenize(docs)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("tokens", token_ids),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows: doc_id, start, n_tokens and ids_crc32 of each document of the corpus."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
