"""External partitioned tables and their partitions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FORMATS = ("parquet", "orc")


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def create_external_table(
    spark: SparkSession,
    table: str,
    columns: Mapping[str, str],
    partition: Mapping[str, str],
    location: str,
    file_format: str = "parquet",
) -> None:
    """An empty external table: ``columns`` and ``partition`` map names to SQL types."""
    if file_format not in FORMATS:
        raise ValueError(f"file_format must be one of {FORMATS}")
    fields = ", ".join(f"`{n}` {t}" for n, t in {**columns, **partition}.items())
    keys = ", ".join(f"`{n}`" for n in partition)
    spark.sql(
        f"CREATE TABLE {table} ({fields}) USING {file_format} PARTITIONED BY ({keys}) LOCATION '{location}'"
    )


def insert_dates(df: DataFrame, table: str, partition: str) -> None:
    """Replace the partitions that occur in ``df`` in an existing table; ``swap_partition`` replaces one named day, also by no rows."""
    spark = df.sparkSession
    names = spark.table(table).columns
    (
        df.select(*names)
        .hint("rebalance", partition)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .insertInto(table)
    )


def drop_partition(spark: SparkSession, table: str, column: str, value: str) -> None:
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (`{column}`='{value}')")


def add_partition(
    spark: SparkSession, table: str, column: str, value: str, location: str
) -> None:
    spark.sql(
        f"ALTER TABLE {table} ADD PARTITION (`{column}`='{value}') LOCATION '{location}'"
    )


def swap_partition(
    df: DataFrame, table: str, column: str, value: str, location: str
) -> None:
    """Point a partition at newly written files, which may hold no rows.

    The files are complete before the catalog changes, and that is one change of the
    partition's location (or its addition), so a reader sees the old partition or the
    new one and a failure leaves the old one. ``location`` must be new.
    """
    spark = df.sparkSession
    stored = [c for c in spark.table(table).columns if c != column]
    kind = dict(spark.table(table).dtypes)
    provider = table_format(spark, table)
    df.select(*[F.col(c).cast(kind[c]) for c in stored]).write.format(provider).mode(
        "errorifexists"
    ).save(location)
    one = f"PARTITION (`{column}`='{value}')"
    if spark.sql(f"SHOW PARTITIONS {table} {one}").isEmpty():
        add_partition(spark, table, column, value, location)
    else:
        spark.sql(f"ALTER TABLE {table} {one} SET LOCATION '{location}'")


def table_format(spark: SparkSession, table: str) -> str:
    """``parquet`` or ``orc``; reads the table's description, not its data."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter(F.col("col_name") == "Provider")
    return rows.first()["data_type"].lower()
