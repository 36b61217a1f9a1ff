import duckdb
import pytest

from vellum.llm import bases as B


@pytest.mark.parametrize("name", sorted(B.QUERIES))
def test_query_equals_its_sql(spark, name):
    d, con = "/root/testdata/sf0.01", duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet'")
    got = B.QUERIES[name](spark, d)
    columns = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({B.ORACLES[name]})").fetchall()
    rows = [tuple(r) for r in got.select(*columns).collect()]
    assert sorted(rows, key=str) == sorted(want, key=str) and rows
