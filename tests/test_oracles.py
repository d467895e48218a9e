"""Every registered query against its SQL on DuckDB."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from workloads.compare import difference
from workloads.oracles import ORACLES
from workloads.queries import QUERIES


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, sf, name):
    assert difference(spark, name, sf) is None


def test_entry(spark):
    result = entry(spark)
    assert result.columns == ["period", "subs_key", "ban_key", "region"]
    assert result.count() > 0
