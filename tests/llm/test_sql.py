"""The queries of the subpackage that SQL can express, against that SQL."""

import pytest

import __spark_entry__ as entry
from rankwatch.llm import oracle
from tests.compare import connect, differences
from tests.conftest import SMALL_DIR


@pytest.fixture(scope="module")
def con():
    return connect(SMALL_DIR)


@pytest.mark.parametrize("name", sorted(oracle.statements()))
def test_query_equals_sql(spark, con, name):
    assert differences(entry.queries()[name](spark, SMALL_DIR), con, oracle.statements()[name]) == []
