"""Connected components of a graph given as links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.sinks.folders import fresh_folder, remove


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links(a, b)``: the least node that it reaches.

    Every round hooks each node's greater neighbours to its least one, then its lesser
    ones; the links become stars after a number of rounds that grows as the logarithm
    of the longest chain. Least neighbours are combined within each task first, so of a hub's links
    one row a task is exchanged; the joins that hand them on read both sides from exchanges of their own,
    where adaptive execution can split a hub. Each round is written to
    the shared folder, and the one before it removed. Stars have the fewest links that
    hold their nodes together, so they are looked for where a round made no link less.
    """
    spark = links.sparkSession
    folder = fresh_folder(spark, "components")
    now = _stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), f"{folder}/0")
    number, before = 0, None
    while True:
        count = now.count()
        if not count or count == before and _are_stars(now):
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b").distinct())
        number, before = number + 1, count
        halfway = _stored(_large_star(now), f"{folder}/{number}-large")
        remove(spark, f"{folder}/{number - 1}")
        now = _stored(_small_star(halfway), f"{folder}/{number}")
        remove(spark, f"{folder}/{number}-large")


def _stored(df: DataFrame, path: str) -> DataFrame:
    spark: SparkSession = df.sparkSession
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _are_stars(links: DataFrame) -> bool:
    """Whether every greater end has one link and is no lesser end; ``links`` has none twice."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("ups"), F.lit(0).alias("downs"))
    ends = ends.union(links.select("b", F.lit(0), F.lit(1))).groupBy("node").agg(F.sum("ups").alias("ups"), F.max("downs").alias("downs"))
    return ends.agg(F.max(F.col("ups") + F.when(F.col("ups") > 0, F.col("downs")).otherwise(0))).first()[0] == 1


def least_neighbours(links: DataFrame) -> DataFrame:
    """(node, m): the least ``b`` of each ``a``.

    The hash among the grouping columns changes no group; it
    keeps the aggregate from being joined in place, which would pin a node's links to its task.
    """
    least = links.groupBy(F.col("a").alias("node"), F.hash("a").alias("spread")).agg(F.min("b").alias("m"))
    return least.select("node", "m")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select("b", "a"))
    least = least_neighbours(both).select("node", F.least("m", "node").alias("m"))
    return both.join(least, both["a"] == least["node"]).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    # Every link leads from its greater end, a, to its lesser one.
    least = least_neighbours(links)
    hooked = links.join(least, links["a"] == least["node"])
    below = hooked.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return below.union(least.select("node", "m")).distinct()
