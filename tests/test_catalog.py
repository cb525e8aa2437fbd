"""Every registered query next to its SQL."""

import pytest

import __spark_entry__ as entry
from tests.compare import compare, connect

QUERIES, ORACLE = entry.queries(), entry.oracle_sql()
# trains 100 trees; tests/test_text.py fits a small forest instead
SLOW = {"classifier_report"}


@pytest.fixture(scope="module")
def database(sf):
    return connect(sf)


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SLOW])
def test_matches_sql(spark, database, sf, name):
    assert compare(spark, database, sf, QUERIES[name], ORACLE.get(name)) is None


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["dataset", "sample_count", "avg_duration", "unique_accents"]
    assert df.count() > 0
