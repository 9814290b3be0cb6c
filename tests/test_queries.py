"""Every registered query against its SQL on the smallest test tables."""

from pathlib import Path

import pytest

from workloads.check import compare, connect
from workloads.oracle import ORACLE
from workloads.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are absent")


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, connection, name):
    assert compare(spark, connection, FOLDER, name) is None


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES)
