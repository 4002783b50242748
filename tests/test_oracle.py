"""Every registered query against its SQL."""

import pytest

from checks.compare import connect, differences
from checks.oracle import ORACLE
from checks.registry import QUERIES

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_result(spark, duck, name):
    assert differences(QUERIES[name](spark, FOLDER), duck, ORACLE[name]) is None
