"""Every registered query against its SQL, on the smallest tables."""

import duckdb
import pytest

from skein.plans import inputs, registry

registry.load()
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in inputs.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con


def rows(df):
    df = df[sorted(df.columns)].astype(object).where(lambda x: x.notna(), None)
    return sorted(map(tuple, df.to_numpy().tolist()), key=repr)


@pytest.mark.parametrize("name", registry.ORACLE)
def test_query(spark, duck, name):
    mine, other = registry.QUERIES[name](spark, SMALL).toPandas(), duck.execute(registry.ORACLE[name]).df()
    assert sorted(mine.columns) == sorted(other.columns)
    assert rows(mine) == rows(other)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE)))
def test_runs(spark, name):
    assert registry.QUERIES[name](spark, SMALL).count() >= 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
