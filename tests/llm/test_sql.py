import pytest

from contrail.llm.queries import ORACLE, QUERIES
from tests.oracle import connect, rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, con, name):
    got, want = QUERIES[name](spark, SF).toPandas(), con.sql(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and rows(got) == rows(want)
