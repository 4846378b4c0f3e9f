import oracle
import pytest

from docframe.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_says_what_its_sql_says(spark, sf, name):
    oracle.check(spark, sf, QUERIES[name], ORACLE_SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_query_without_sql_gives_rows(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0
