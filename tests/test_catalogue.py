"""Every query of the catalogue against its SQL on the smallest test tables."""

import duckdb
import pandas as pd
import pytest

from quillframe import plans
from quillframe.session import TABLES


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


def rows(df):
    df = df[sorted(df.columns)]

    def cell(v):
        if v is None or pd.isna(v):
            return "~"
        return f"{float(v):.9g}" if isinstance(v, (int, float)) and not isinstance(v, bool) or hasattr(v, "dtype") and v.dtype.kind in "iuf" else str(v)

    return sorted(tuple(map(cell, r)) for r in df.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(plans.queries()))
def test_query(spark, duck, sf, name):
    got = plans.queries()[name](spark, sf).toPandas()
    sql = plans.oracle_sql().get(name)
    if sql is None:
        assert len(got) > 0
        return
    want = duck.execute(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
