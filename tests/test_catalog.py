import duckdb
import pytest

from tests import given_rows
from vellum.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = ("nation", "region", "part", "customer", "documents", "pages", "benchmark", "labels", "conversations", "orders", "lineitem", "embeddings")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_its_sql(spark, con, name):
    got = catalog.QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({catalog.ORACLES[name]})").fetchall()
    rows = [tuple(r) for r in got.select(*columns).collect()]
    assert len(rows) == len(want) and rows
    assert sorted(rows, key=str) == sorted(want, key=str)


@pytest.mark.parametrize("name", sorted(given_rows.QUERIES))
def test_given_rows(spark, con, name):
    got = given_rows.QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({given_rows.ORACLES[name]})").fetchall()
    assert sorted((tuple(r) for r in got.select(*columns).collect()), key=str) == sorted(want, key=str)
