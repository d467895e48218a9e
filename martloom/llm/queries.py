"""The registered queries of the operators and of the pipeline, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, centroids, decontaminate, licenses, pii, prefixes, quality, secrets, simhash, substring, suffixes, topk, toxicity


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        F.col("n_hit").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontaminate.contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


def op2_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring.substring_dedup(table(spark, folder, "documents"))


def op3_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.license_scan(table(spark, folder, "documents"))


def op4_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.suffix_dedup(table(spark, folder, "documents"))


def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op6_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.secret_spans(table(spark, folder, "documents"))
    base = F.filter("found", lambda s: s["kind"] < len(secrets.BASE))
    return found.select(
        "doc_id",
        *(secrets.count_of(F.col("found"), kind).alias(f"n_{kind}") for kind in secrets.BASE),
        F.sha2(secrets.spans_text(base), 256).alias("base_sha256"),
        secrets.spans_text(F.col("found")).alias("spans"),
    )


def op7_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op9_bpe_encoding(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encode(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op10_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return pii.personal_data(table(spark, folder, "documents"))


def op11_centroid_clustering(spark: SparkSession, folder: str) -> DataFrame:
    return centroids.clusters(table(spark, folder, "embeddings"))


def op12_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return topk.top_inner_products(vectors.where("vec_id % 50 = 0"), vectors)


def op13_conversation_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefixes.prefix_trie(table(spark, folder, "conversations"))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES = {
    f.__name__: f
    for f in (
        op1_benchmark_decontamination,
        op2_substring_dedup,
        op3_license_scan,
        op4_suffix_array_dedup,
        op5_quality_rules,
        op6_secret_scan,
        op7_simhash_near_dedup,
        op8_toxicity,
        op9_bpe_encoding,
        op10_personal_data,
        op11_centroid_clustering,
        op12_exact_top_k,
        op13_conversation_prefix_trie,
        pipeline,
    )
}
