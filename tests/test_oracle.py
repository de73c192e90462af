"""Every registered query against its SQL."""

import oracle
import pytest

from threadloom.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(folder):
    return oracle.connect(folder)


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, con, folder):
    _, difference = oracle.compare(spark, con, QUERIES[name], ORACLES[name], folder)
    assert difference is None


def test_entry(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.columns[0] == "tweet_id" and df.count() > 0
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql()) <= set(entry.queries())
