"""Registered corpus queries against SQL, or against what must hold of their results."""

import oracle
import pytest

from threadloom.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(name, spark, folder):
    _, difference = oracle.compare(spark, oracle.connect(folder), QUERIES[name], ORACLES[name], folder)
    assert difference is None


def test_each_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_registered(spark):
    import __spark_entry__ as entry

    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
