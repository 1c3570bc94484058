"""Every registered query equals its DuckDB oracle on the sf0.01 driver tables."""

import os

import pytest

import __spark_entry__ as E
from tests.parity import compare, duck_connection

SF = "/root/testdata/sf0.01"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def duck():
    return duck_connection(SF)


def test_every_query_has_an_oracle():
    """All but training-data operators that SQL can't express; these are tested by brute force."""
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(E.queries()) - set(E.oracle_sql()) <= set(E.LLM_QUERIES)


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_parity(spark, duck, name):
    assert compare(spark, name, SF, duck) == []


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["suite", "suite_seq", "total_tested", "failed_records", "errors", "skipped", "failure_rate", "status", "reason"]
    assert df.count() == 6
