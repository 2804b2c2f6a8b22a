"""Every registered query against DuckDB on the generated tables."""

import os

import pytest

import __spark_entry__ as entry
from harness import connect, integers_are_long, oracle_rows, spark_rows

SF_DIR = os.environ.get("TREELENS_SF_DIR", "/root/testdata/sf0.001")
LLM = entry._llm()[0]  # tested in their own folder
QUERIES, ORACLES = ({k: v for k, v in found.items() if k not in LLM} for found in (entry.queries(), entry.oracle_sql()))


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    assert integers_are_long(df), df.dtypes
    names, got = spark_rows(df)
    expected_names, expected = oracle_rows(con, ORACLES[name])
    assert names == expected_names
    missing, extra = expected - got, got - expected
    assert got == expected, (sum(missing.values()), sum(extra.values()), list(missing.items())[:2], list(extra.items())[:2])


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() == 848
