import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session", autouse=True)
def able(spark):
    from turnstile.llm.staging import ready

    return ready(spark)


@pytest.fixture(scope="session")
def documents(spark, sf):
    """Rows of the given documents."""
    return spark.read.parquet(os.path.join(sf, "documents.parquet")).collect()


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and blank texts, ties, repeated rows, and a long text."""
    return [(1, "a b"), (1, "a b"), (2, None), (None, "a b"), (3, ""), (4, " \t\n"), (5, "A b"), (6, "w " * 30_000), (7, "é ü"), (None, None)]

