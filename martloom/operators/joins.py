"""Lookup joins.

No join here carries a broadcast hint. A side is broadcast only when Spark's own
size check (``spark.sql.autoBroadcastJoinThreshold``, at planning time from file
sizes and again at run time from shuffle sizes) allows it; past that limit the
join is a shuffled one, where adaptive execution splits the partition of a hot
or NULL key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.dates import day_literal


def unique_lookup(dim: DataFrame, keys: Sequence[str], *payload: str) -> DataFrame:
    """One row per key, so that a left join to it can never repeat a fact row.

    Among rows of one key the one with the greatest payload stays, its columns compared
    one after the other and NULL less than any value; for one column this is its
    maximum. NULL keys can match nothing and are dropped.

    The hash of the key among the grouping columns changes no group. It makes the
    aggregate's partitioning differ from the join's, so a shuffled join reads both
    sides from exchanges of its own - the shape in which adaptive execution can split
    the fact's partition of a hot key. An aggregate on the bare key would be joined in
    place and pin every row of a hot key to one task. A broadcast join is unaffected.
    """
    known = dim.select(*keys, *payload)
    for key in keys:
        known = known.filter(F.col(key).isNotNull())
    groups = known.groupBy(*keys, F.hash(*keys).alias("_spread"))
    if not payload:
        return groups.agg(F.lit(1)).select(*keys)
    if len(payload) == 1:  # the same maximum; of a fixed width it stays in the hash aggregate
        return groups.agg(F.max(payload[0]).alias("_row")).select(*keys, F.col("_row").alias(payload[0]))
    best = groups.agg(F.max(F.struct(*payload)).alias("_row"))
    return best.select(*keys, *[F.col("_row")[p].alias(p) for p in payload])


def left_join_where(
    left: DataFrame, right: DataFrame, on: Sequence[str], right_condition: Column
) -> DataFrame:
    """Left join with a constant condition of the ON clause on the right side.

    Filtering the right side first keeps the unmatched left rows, which the same
    condition after the join would drop.
    """
    return left.join(right.filter(right_condition), list(on), "left")


def role_lookup(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    roles: Mapping[str, Mapping[str, str]],
    how: str = "left",
) -> DataFrame:
    """Join one dimension once per role.

    ``roles`` maps a fact column to ``{dimension column: output column}``.
    """
    out = fact
    for i, (fact_key, columns) in enumerate(roles.items()):
        role = unique_lookup(dim, [key], *columns)
        role = role.select(
            F.col(key).alias(f"_role{i}"), *[F.col(c).alias(name) for c, name in columns.items()]
        )
        out = out.join(role, out[fact_key] == role[f"_role{i}"], how).drop(f"_role{i}")
    return out


def lookup_many(
    fact: DataFrame, dim: DataFrame, key: str, value: str, outputs: Mapping[str, str]
) -> DataFrame:
    """The same code lookup for several fact columns: ``{fact column: output column}``."""
    return role_lookup(fact, dim, key, {c: {value: name} for c, name in outputs.items()})


def first_match(
    df: DataFrame, row_key: str, candidates: Sequence[str], known: DataFrame, known_key: str, out: str
) -> DataFrame:
    """The first of several candidate columns whose trimmed value is a known key.

    Only ``row_key`` and the candidates go through the lookup, as one narrow row per
    candidate that is not NULL; each of the different (row_key, candidates) that has a known
    one comes back as one row, and ``df`` is joined with these once. So every row of ``df``
    stays as it is, also where ``row_key`` is NULL or repeated. Hot candidates are split in the
    lookup and hot row keys in the last join, as ``unique_lookup`` describes. ``df`` is used
    twice; exchanges that its derivation has in common for both uses are run once.
    """
    keys = unique_lookup(known.select(F.trim(known_key).alias("_known_key")), ["_known_key"])
    tries = F.array(*[F.trim(F.col(c)) for c in candidates])
    asked = df.select(F.col(row_key).alias("_row_key"), tries.alias("_tries"))
    asked = asked.select("*", F.posexplode("_tries").alias("_place", "_try")).filter(F.col("_try").isNotNull())
    found = (
        asked.join(keys, F.col("_try") == F.col("_known_key"))
        .groupBy("_row_key", "_tries", F.hash("_row_key", "_tries").alias("_spread"))
        .agg(F.min("_place").alias("_first"))
    )
    best = found.select("_row_key", F.col("_tries").alias("_tried"), F.element_at("_tries", F.col("_first") + 1).alias("_hit"))
    rows = df.select("*", tries.alias("_tries"))
    return rows.join(
        best, rows[row_key].eqNullSafe(best["_row_key"]) & (rows["_tries"] == best["_tried"]), "left"
    ).select(*[rows[c] for c in df.columns], F.col("_hit").alias(out))


def valid_on(
    end: Column, as_of: date | str, *, last_day_counts: bool, open_ended: bool
) -> Column:
    """Effective-dated rows still valid on ``as_of``.

    ``last_day_counts`` includes rows that end on the day itself; ``open_ended``
    includes rows with no end date.
    """
    day = day_literal(as_of)
    live = end >= day if last_day_counts else end > day
    return end.isNull() | live if open_ended else live
