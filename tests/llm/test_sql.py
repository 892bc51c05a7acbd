"""Registered queries of the operators against their SQL."""

import pytest
from gate.compare import canonical, oracle_frame
from ordermart.llm.queries import ORACLE, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_agrees_with_its_sql(spark, name):
    got, expected = QUERIES[name](spark, SMALL).toPandas(), oracle_frame(SMALL, ORACLE[name])
    assert sorted(got.columns) == sorted(expected.columns)
    assert canonical(got) == canonical(expected)
