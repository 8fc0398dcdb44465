"""Every named query against its independent SQL answer, over whole tables."""

import pytest
from compare import differences, duck

import __spark_entry__ as contract
from turnstile.plans import answers, registry

# Those of the training-data folder are compared in its own tests.
QUERIES, ANSWERS = registry.all_queries(), answers.answers()


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


def test_every_query_has_an_answer():
    assert set(QUERIES) == set(ANSWERS)
    assert set(QUERIES) <= set(contract.queries()) and set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf, name):
    diff, _ = differences(spark, con, QUERIES[name], ANSWERS[name], sf)
    assert diff is None, diff
