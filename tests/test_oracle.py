"""Every registered query against its SQL."""

import pytest

from checks.compare import connect, difference
from checks.oracle import ORACLE
from checks.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert difference(QUERIES[name](spark, SF_DIR), con, ORACLE[name]) is None
