import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from contrail.plans import adapters as A
from contrail.plans.queries import ORACLE, QUERIES
from tests.oracle import connect, rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, con, name):
    got, want = QUERIES[name](spark, SF).toPandas(), con.sql(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and rows(got) == rows(want)


def test_latest_wins_on_ties_and_nulls(spark, tmp_path):
    """Equal line numbers across tasks, NULL keys, numbers and quantities; one thread, as DuckDB's own ties go by thread."""
    n = 4000
    key = [None if i % 97 == 0 else i * 7 % 61 for i in range(n)] + [1000, 1000, 1001, 1002, 1002]
    line = [None if i % 89 == 0 else i % 3 for i in range(n)] + [1, 2, None, None, 1]
    quantity = [None if i % 5 == 0 else float(i) for i in range(n)] + [3.0, None, 4.0, 5.0, None]
    order = sorted(range(len(key)), key=lambda i: i * 7919 % 10007)
    table = pa.table({"l_orderkey": pa.array([key[i] for i in order], pa.int64()), "l_linenumber": pa.array([line[i] for i in order], pa.int32()), "l_quantity": pa.array([quantity[i] for i in order], pa.float64())})
    path = f"{tmp_path}/lineitem.parquet"
    pq.write_table(table, path, row_group_size=100)
    con = duckdb.connect(config={"threads": 1})
    con.sql(f"CREATE VIEW lineitem AS SELECT * FROM '{path}'")
    sql = ORACLE["k9_latest_wins"].removeprefix(A.WITH)  # the other tables aren't needed
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = QUERIES["k9_latest_wins"](spark, str(tmp_path)).toPandas()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert rows(got) == rows(con.sql(sql).df())
