"""Corpus queries against their DuckDB oracles, rows and types."""

import os

import pytest

from tests import compare
from tidemark.llm import registry

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
QUERIES = registry.queries()
ORACLES = registry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF_DIR)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_matches_oracle(spark, duck, key):
    df = QUERIES[key](spark, SF_DIR)
    columns, rows = compare.spark_rows(df)
    expected_columns, expected = compare.oracle_rows(duck, ORACLES[key])
    assert columns == expected_columns
    assert expected, "the oracle returns no rows"
    assert rows == expected
    assert dict(df.dtypes) == compare.oracle_types(duck, ORACLES[key])
