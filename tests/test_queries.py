"""Each query against its SQL on the smallest tables."""

import collections
import os

import duckdb
import pandas as pd
import pytest

from anchorwise.plans import registry

D = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{D}/{t}.parquet'")
    return c


def cell(x):
    if hasattr(x, "tolist"):
        x = x.tolist()
    if x is None or x is pd.NA or x != x:
        return None
    return round(x, 6) if isinstance(x, float) else str(x)


def rows(df):
    df = df[sorted(df.columns)]
    return collections.Counter(tuple(map(cell, r)) for r in df.astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, con, name):
    got = registry.queries()[name](spark, D).toPandas()
    sql = registry.oracle_sql().get(name)
    if sql is None:
        assert len(got) or name == "hash_sample"
        return
    want = con.sql(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_entry(spark):
    import __spark_entry__

    assert os.path.isdir(D) and __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
