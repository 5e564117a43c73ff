"""Every registered query against its SQL, at the smallest scale."""

import pytest
from oracle import differences, duck

from __spark_entry__ import entry, oracle_sql, queries

SQL = oracle_sql()
QUERIES = queries()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(name, spark, sf_dir, con):
    assert differences(QUERIES[name](spark, sf_dir), con, SQL[name]) == []


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry_gives_a_status_per_dataset(spark):
    rows = entry(spark).collect()
    assert {r.drift_status for r in rows} <= {"ok", "warning", "critical"}
    assert sum(r.is_total for r in rows) == 1
