"""Every registered query against its DuckDB SQL."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.oracle_check import compare, duck
from tideline.plans.registered import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert QUERIES.keys() <= oracle_sql().keys() <= queries().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, name, queries()[name], oracle_sql()[name], SF) is None


def test_entry(spark):
    assert entry(spark).count() > 0
