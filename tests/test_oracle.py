"""Every SQL-expressible catalogue query against its DuckDB statement at sf0.01:
same column names, same Arrow types, same multiset of rows."""

import pytest

from conftest import SF001
from vialflow.plans.oracle import SQL


@pytest.fixture(scope="module")
def con():
    from vialflow.plans.compare import duck
    return duck(SF001)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    from vialflow.plans.compare import compare
    r = compare(spark, name, SF001, con)
    assert r["ok"], r


def test_every_query_is_registered(queries):
    assert set(SQL) <= set(queries)
