"""Dated folders, per-date overwrite and materialised stages."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from martloom.functions.dates import as_date
from martloom.sources.readers import ddmmyyyy, mm_yyyy

_SETTING = "spark.checkpoint.dir"

_owned: list[Callable[[SparkSession], object]] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir``, else the session's warehouse.

    On a cluster a warehouse on a local disk is an error, as each executor would write to
    its own and later reads would miss rows.
    """
    folder = spark.conf.get(_SETTING, None)
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir")
        require_shared(_file_system(spark, folder).getScheme(), spark.sparkContext.master)
    return folder.rstrip("/")


def require_shared(scheme: str, master: str) -> None:
    """Raise where a file system is one machine's own and the executors are on others."""
    if scheme == "file" and not master.startswith("local"):
        raise ValueError(f"the warehouse is local to one machine; name a shared folder in {_SETTING}")


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one. It is the process's own and removed when that ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    at_end(lambda session: remove(session, path))
    return path


def at_end(remove: Callable[[SparkSession], object]) -> None:
    """Have something of the process's own removed when it ends, or earlier by ``remove_owned``."""
    if not _owned:
        atexit.register(remove_owned)
    _owned.append(remove)


def remove_owned() -> None:
    """Remove what ``at_end`` was told, last first, while a session is there to do it."""
    spark = SparkSession.getActiveSession()
    while spark is not None and _owned:
        _owned.pop()(spark)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the process's own that nothing reads any more."""
    _file_system(spark, path).delete(spark._jvm.org.apache.hadoop.fs.Path(path), True)


def _file_system(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def evenly(df: DataFrame, *columns: str) -> DataFrame:
    """Rebalance before a partitioned write.

    Few files per date, and adaptive execution splits a date that holds much more
    than the others, which a plain repartition by date would send to one task.
    """
    return df.hint("rebalance", *columns)


def write_dated_folder(
    df: DataFrame, base: str, day: date | str, month_folder: bool = False
) -> str:
    """Write ``<base>/[MM-yyyy/]ddMMyyyy``; an existing folder is an error."""
    month = f"/{mm_yyyy(day)}" if month_folder else ""
    path = f"{base.rstrip('/')}{month}/{ddmmyyyy(day)}"
    df.write.mode("errorifexists").parquet(path)
    return path


def overwrite_dates(df: DataFrame, base: str, column: str = "dt") -> None:
    """Replace exactly the dates that occur in ``df``; all other dates stay."""
    (
        evenly(df, column)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .parquet(base)
    )


def overwrite_date(df: DataFrame, base: str, day: date | str, column: str = "dt") -> None:
    """Replace one run date, also by no rows at all. A rerun gives the same files; history is kept."""
    folder = f"{base.rstrip('/')}/{column}={as_date(day).isoformat()}"
    evenly(df.drop(column)).write.mode("overwrite").parquet(folder)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a stage to the shared folder and continue from the written table.

    Later stages survive a lost executor without recomputing earlier ones, and are
    planned with the table's real size instead of a guess multiplied up by joins.
    """
    spark = df.sparkSession
    path = fresh_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
