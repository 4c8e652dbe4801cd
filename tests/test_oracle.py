"""Every catalogue query against its SQL statement."""

import pytest

from __spark_entry__ import entry
from municipia.oracle import ORACLES
from municipia.plans.catalogue import QUERIES
from tests.oracle_check import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    with connect(FOLDER) as con:
        yield con


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, name):
    assert compare(spark, duck, FOLDER, name) is None


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


def test_entry(spark):
    assert entry(spark).count() > 0
