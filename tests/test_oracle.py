"""Every registered query against its SQL."""

import pytest

from landfall.catalog.oracle import SQL
from landfall.catalog.queries import QUERIES
from tests.comparing import SF_DIR, assert_same


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, name):
    assert_same(QUERIES[name](spark, SF_DIR), SQL[name])
