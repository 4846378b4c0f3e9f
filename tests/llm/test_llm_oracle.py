import oracle
import pytest

from docframe.llm import decontamination, lm_score, url_filter


@pytest.mark.parametrize("module", [url_filter, decontamination, lm_score])
def test_query_says_what_its_sql_says(spark, module):
    for name, sql in module.ORACLE_SQL.items():
        oracle.check(spark, "/root/testdata/sf0.01", module.QUERIES[name], sql)
