"""Driver contract: entry() runs, every registered query matches its DuckDB
oracle on the smallest driver tables (row count, columns, value hash)."""

import re

import pytest
from oracle_compare import duck, duck_digest, spark_digest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["TimeGenerated", "AnomalyType", "Severity", "ServerName", "User", "Database",
                          "SourceHost", "MetricName", "MetricValue", "Details"]
    assert df.count() >= 0


#: The queries of the optional training-data subpackage have tests of their own.
KEYS = sorted(k for k in E.queries() if not re.match(r"op\d+_|pipeline$", k))


def test_every_query_has_an_oracle():
    assert set(KEYS) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    from check_oracle import duck_types, spark_types
    df = E.queries()[key](spark, SF)
    assert spark_digest(df) == duck_digest(con, E.oracle_sql()[key])
    assert spark_types(df) == duck_types(con, E.oracle_sql()[key])
