"""Every registered query against its SQL in DuckDB, at the smallest scale.

``tools/compare.py`` does the same at any scale.
"""

import pytest

from tablewright.plans.oracle import ORACLE
from tablewright.plans.queries import QUERIES
from tests.conftest import SMALL
from tools.compare import connect, difference

NAMES = list(QUERIES)


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", NAMES)
def test_query_agrees_with_sql(spark, duck, name):
    assert difference(spark, duck, SMALL, name) is None
