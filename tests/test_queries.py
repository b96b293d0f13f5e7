"""Every catalogued query against its SQL, value for value."""

import duckdb
import pandas as pd
import pytest

from anchorline.plans import stages, tables  # noqa: F401
from anchorline.plans.catalogue import ORACLE, QUERIES

SF = "/root/testdata/sf0.01"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES.split():
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def values(df: pd.DataFrame):
    df = df[sorted(df.columns)].astype(object)
    return sorted(tuple("NULL" if pd.isna(v) else repr(float(v)) if isinstance(v, float) else str(v) for v in r) for r in df.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows(spark, con, name):
    got, want = QUERIES[name](spark, SF).toPandas(), con.execute(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) and values(got) == values(want)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(QUERIES) <= set(__spark_entry__.queries()) and set(ORACLE) <= set(__spark_entry__.oracle_sql())
