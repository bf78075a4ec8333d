"""Every registered query against its SQL, row for row."""

import pytest

import __spark_entry__
from suite.compare import differences, oracle_connection
from suite.oracle import ORACLE
from suite.queries import QUERIES

from .conftest import SF


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, connection, name):
    result = __spark_entry__.queries()[name](spark, SF)
    assert differences(result, connection, __spark_entry__.oracle_sql()[name]) == []


def test_entry_has_rows(spark):
    assert __spark_entry__.entry(spark).count() > 0
