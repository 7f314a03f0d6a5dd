"""Every registered query with an oracle equals DuckDB at sf0.01."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF01
from tests.oracle import compare, duck

SQL = E.oracle_sql()
QUERIES = E.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, SF01, name, QUERIES[name], SQL[name], con)
    assert ok, msg


def test_oracle_keys_are_registered():
    assert set(SQL) <= set(QUERIES)


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["true_class", "rule_alert", "severity", "n", "tp", "fp", "fn",
                          "tn", "mean_anomaly_score"]


def test_every_query_is_mapped_to_operators():
    from vigil.plans.catalog import QUERIES as CATALOG
    from vigil.plans.catalog import QUERY_OPERATORS
    assert set(QUERY_OPERATORS) == set(CATALOG) <= set(QUERIES)
