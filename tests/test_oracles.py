"""Every registered query against its SQL, on the smallest data."""

import pytest

from checks.compare import compare, database
from checks.oracle import oracle_sql
from checks.workload import queries

FOLDER = "/root/testdata/sf0.001"
SQL = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return database(FOLDER)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, con, name):
    result = compare(spark, FOLDER, queries()[name], SQL[name], con)
    assert result.startswith("ok") and "types" not in result, result


@pytest.mark.parametrize("name", sorted(set(queries()) - set(SQL)))
def test_query_without_sql_gives_rows(spark, name):
    assert queries()[name](spark, FOLDER).count() > 0
