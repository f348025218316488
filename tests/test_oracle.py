"""Every registered query against its oracle, rows and types."""

import os

import pytest

import __spark_entry__ as contract
from tests import compare
from workload import oracle, registry

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
QUERIES = registry.queries()
ORACLES = oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_matches_oracle(spark, duck, key):
    df = QUERIES[key](spark, SF_DIR)
    columns, rows = compare.spark_rows(df)
    expected_columns, expected = compare.oracle_rows(duck, ORACLES[key])
    assert columns == expected_columns
    assert expected, "the oracle returns no rows"
    assert len(rows) == len(expected)
    assert rows == expected
    assert dict(df.dtypes) == compare.oracle_types(duck, ORACLES[key])


def test_entry(spark):
    assert contract.entry(spark).count() > 0
