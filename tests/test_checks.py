import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tagwright.plans.checks import CHECKS
from tagwright.plans.queries import QUERIES
from tests.checker import difference, duck
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def connection():
    return duck(SMALL)


def test_every_query_has_a_check():
    assert set(QUERIES) == set(CHECKS)
    assert set(QUERIES) <= set(queries()) and set(CHECKS) <= set(oracle_sql())


@pytest.mark.parametrize("name", list(CHECKS))
def test_query_equals_sql(spark, connection, name):
    assert difference(queries()[name](spark, SMALL), connection, oracle_sql()[name]) is None


def test_entry(spark):
    tagged = entry(spark)
    assert tagged.columns == ["Id", "tags"] and tagged.count() > 0
