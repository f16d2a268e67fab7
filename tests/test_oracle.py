"""Every query against its SQL on the small tables."""

import pytest

from checks.compare import connect, differences
from checks.oracle import ORACLE
from checks.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name):
    got = QUERIES[name](spark, FOLDER).toArrow()
    assert differences(duck, got, ORACLE[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_without_sql_has_rows(spark, name):
    assert not QUERIES[name](spark, FOLDER).isEmpty()


def test_sql_only_for_known_queries():
    assert set(ORACLE) <= set(QUERIES)
