"""Training-text pipeline: quality rules, near-dedup, decontamination, personal data, BPE.

Each stage is a function of (spark, docs, sf_dir); all but the last keep the
columns of ``documents``. Between two stages the rows are written as Parquet to
the shared folder and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from martloom.llm import bpe, decontaminate, pii, quality, simhash
from martloom.sinks.folders import fresh_folder


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep, each judged by its own text. Null and empty texts go; repeated rows share a verdict."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one of the smallest id (null last), as ``one_of_each`` defines it."""
    return simhash.one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated. Null and empty texts stay, and all do where the benchmark has no words."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, one row for each row, personal data in their texts masked. A null text stays null."""
    return pii.mask(docs)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of each document's ids and of what they decode to, one row for each row. A null text is empty."""
    return bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("personal_data", personal_data),
    ("bpe_encoding", bpe_encoding),
]

#: The learned quality verdict, XXH64 and BPE have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what lies between two stages is in a folder of this process.

    Empty tables give an empty result, empty ``labels`` leave quality to the base rules, and an empty ``benchmark``
    contaminates nothing. Other columns of ``documents`` are handed on up to the last stage.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = fresh_folder(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{number}-{name}")
            docs = spark.read.parquet(f"{folder}/{number}-{name}")
    return docs
