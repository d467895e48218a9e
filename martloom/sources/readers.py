"""Parquet folders, dated layouts, snapshots and delimited dimensions."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.functions.dates import as_date, day_literal


def ddmmyyyy(day: date | str) -> str:
    return as_date(day).strftime("%d%m%Y")


def mm_yyyy(day: date | str) -> str:
    return as_date(day).strftime("%m-%Y")


def dataset_path(
    root: str, source: str, name: str, leaf: str = "", day: date | str | None = None
) -> str:
    """``root/source/name[/MM-yyyy]/leaf``; the month folder belongs to ``day`` itself."""
    parts = [root.rstrip("/"), source, name]
    if day is not None:
        parts.append(mm_yyyy(day))
    if leaf:
        parts.append(leaf)
    return "/".join(parts)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_dated_folders(spark: SparkSession, base: str) -> DataFrame:
    """Every ``<base>/<folder>/`` of a layout without ``key=value`` names.

    No folder can be skipped by a date filter here; ``read_dated`` on a ``dt=``
    layout can.
    """
    return spark.read.parquet(f"{base.rstrip('/')}/*/")


def read_dated(
    spark: SparkSession,
    base: str,
    first: date | str | None = None,
    last: date | str | None = None,
    column: str = "dt",
) -> DataFrame:
    """A ``dt=`` partitioned dataset, optionally only the days ``first`` to ``last``.

    With both bounds only the wanted days' folders are opened: the base folder's names
    are matched, other days' files are neither listed nor read. With one bound all days
    are listed and the partition filter keeps the others from being read. If none of
    the wanted days is there, the result has the dataset's columns and no rows.
    """
    base = base.rstrip("/")
    if first is not None and last is not None:
        count = (as_date(last) - as_date(first)).days + 1
        wanted = ",".join(str(as_date(first) + timedelta(days=i)) for i in range(count))
        try:
            return spark.read.option("basePath", base).parquet(f"{base}/{column}={{{wanted}}}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    df = spark.read.parquet(base)
    if first is not None:
        df = df.filter(F.col(column) >= day_literal(first))
    if last is not None:
        df = df.filter(F.col(column) <= day_literal(last))
    return df


def read_snapshot(
    spark: SparkSession, base: str, as_of: date | str, offset_days: int, column: str = "dt"
) -> DataFrame:
    """The one day ``as_of + offset_days`` of a ``dt=`` partitioned dataset."""
    day = as_date(as_of) + timedelta(days=offset_days)
    return read_dated(spark, base, day, day, column)


def read_snapshot_folder(
    spark: SparkSession, base: str, as_of: date | str, offset_days: int, month_folder: bool = False
) -> DataFrame:
    """One day of a ``<base>/[MM-yyyy/]ddMMyyyy`` layout.

    Month folder and day folder come from the same day, also across a month's end.
    """
    day = as_date(as_of) + timedelta(days=offset_days)
    month = f"/{mm_yyyy(day)}" if month_folder else ""
    return spark.read.parquet(f"{base.rstrip('/')}{month}/{ddmmyyyy(day)}")


def read_csv_dimension(
    spark: SparkSession, path: str, columns: Sequence[str], separator: str = ";"
) -> DataFrame:
    """The named columns of a delimited file with a header, whatever else it has and in what order.

    Every column stays text, nothing is inferred; a name that the header lacks is an error.
    """
    return spark.read.csv(path, sep=separator, header=True).select(*columns)
