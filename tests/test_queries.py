"""Every registered query against its SQL counterpart; those without one must run."""

import pytest
from compare import compare, connect

from __spark_entry__ import entry, oracle_sql, queries


@pytest.fixture(scope="module")
def duck(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_sql(spark, duck, small, name):
    rows, problem = compare(spark, duck, small, name, queries()[name], oracle_sql()[name])
    assert not problem
    assert rows > 0


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_runs(spark, small, name):
    assert queries()[name](spark, small).count() > 0


def test_entry(spark):
    assert entry(spark).count() == 2
