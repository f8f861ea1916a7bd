"""Every query with SQL gives DuckDB's rows on the same tables."""

import duckdb
import pytest

from tallyspark.plans import registry

TABLES = "region nation customer supplier part orders lineitem events pages".split()


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return c


def rows(df):
    df = df[sorted(df.columns)]
    show = lambda v: "null" if v is None or v != v else f"{float(v):.4f}" if isinstance(v, (int, float)) else str(v)
    return sorted(tuple(show(v) for v in r) for r in df.astype(object).where(df.notna(), None).values.tolist())


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_same_rows(spark, sf, duck, name):
    got, want = registry.queries()[name](spark, sf).toPandas(), duck.execute(registry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_chain_holds_every_state_once(spark, sf):
    got = [r.state for r in registry.queries()["nearest_chain_order"](spark, sf).orderBy("place").collect()]
    assert len(got) == len(set(got)) > 0
