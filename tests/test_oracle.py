"""Every registered query against its SQL, over the generated tables."""

import os

import pytest
from compare import compare, duck

from alvara.registered.oracle import ORACLE
from alvara.registered.queries import QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no generated tables")


@pytest.fixture(scope="module")
def con():
    connection = duck(FOLDER)
    yield connection
    connection.close()


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert compare(QUERIES[name](spark, FOLDER), con, ORACLE[name]) is None
