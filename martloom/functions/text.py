"""String keys and identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def digits(col: Column) -> Column:
    """Keep the digits only."""
    return F.regexp_replace(col, "[^0-9]+", "")


def clean_id(col: Column) -> Column:
    """The digits of a text id as a bigint; NULL if there are none or too many.

    Text without digits becomes NULL before the cast: a failing ``try_cast`` raises
    and catches an exception per row, which is some ten times slower than a row that
    parses.
    """
    return F.nullif(digits(col.cast("string")), F.lit("")).try_cast("bigint")


def clean_code(col: Column) -> Column:
    return F.trim(col)


def cut(col: Column, length: int) -> Column:
    """At most the first ``length`` characters."""
    return F.when(F.length(col) > length, F.substring(col, 1, length)).otherwise(col)


def drop_head(col: Column, count: int = 2) -> Column:
    """All but the first ``count`` characters."""
    return F.substring(col, count + 1, 2**31 - 1)


def first_part(col: Column, separator: str) -> Column:
    """The first run of characters that holds no ``separator``, which is one character."""
    if len(separator) != 1:
        raise ValueError("a separator is one character")
    return F.regexp_extract(col, f"([^\\{separator}]+)" if not separator.isalnum() else f"([^{separator}]+)", 1)


def joined(*parts: Column | str) -> Column:
    """Concatenate text and columns of any type; NULL if any part is NULL."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
