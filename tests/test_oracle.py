"""Every registered query against its SQL, run by another engine on the same files."""

import pytest

from bindings import ORACLE, QUERIES
from bindings.compare import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, connection, name):
    assert compare(spark, connection, FOLDER, QUERIES[name], ORACLE[name]) is None
