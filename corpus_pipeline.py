"""From documents to encoded training text, in five stages that each write their result.

Every stage takes the documents its predecessor kept and calls one operator of
``starloom.llm``.  All but the last return the columns of documents; the last
returns a row of ids and digests for each document left.  Null and empty texts
go in the first stage, being in no language.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from starloom.llm import bpe, decontaminate, language, simhash, toxicity
from starloom.session import stage_table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach."""
    return language.known_language(docs, language.learn(language.labelled_part(docs)))


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which no toxic grade is likelier than not."""
    return toxicity.civil(docs, toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component."""
    return simhash.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window with the benchmark."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every document and the digests of ids and decoded bytes."""
    return bpe.encode_documents_with_digests(
        docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("language_id", language_id),
    ("toxicity", without_toxic),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", without_benchmark),
    ("byte_bpe", byte_bpe),
]

#: Language and severity are learned, which SQL cannot express; tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage_table(stage(spark, docs, sf_dir), name)
    return docs
