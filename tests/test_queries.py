import duckdb
import pytest

from readloom.plans.queries import ORACLES, QUERIES

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in ("nation", "events", "orders", "documents", "supplier", "part"):
        c.sql(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    return c


def canonical(df):
    return sorted(tuple("" if v is None or v != v else f"{v:.9g}" if isinstance(v, float) else str(v) for v in row) for row in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, duck, name):
    assert canonical(QUERIES[name](spark, DIR).toPandas()) == canonical(duck.sql(ORACLES[name]).df())


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 50
    assert set(e.oracle_sql()) <= set(e.queries())
