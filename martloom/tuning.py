"""Session settings the marts are planned for. All are plain run-time SQL settings."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Run-time planning: small shuffle outputs become broadcasts, partitions are
    # merged or split by their real size.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # A hot join key is split even where that costs one more exchange, as in chains
    # of joins on the same key.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Prune the far side of a selective join before it is shuffled.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # A generated method beyond this size is never compiled by HotSpot; separate
    # operators are faster than one interpreted stage.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Rows already sorted by the grouping key are aggregated one key after the other, not
    # in a table of all keys.
    "spark.sql.execution.replaceHashWithSortAgg": "true",
    # A rewrite for a date replaces that date only.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def tune(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark
