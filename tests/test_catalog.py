"""Every query of the catalogue against its SQL oracle on the smallest tables; those without one must run and have rows."""

import glob
import os

import duckdb
import numpy as np
import pandas as pd
import pytest

from hearthline import catalog


def plain(v):
    if isinstance(v, np.generic):
        v = v.item()
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
        return None
    if isinstance(v, (int, float)) and not isinstance(v, bool):
        return round(float(v), 6)
    return v.isoformat()[:10] if hasattr(v, "isoformat") else v


def rows(df):
    return sorted(str(tuple(plain(v) for v in r)) for r in df[sorted(df.columns)].astype(object).values.tolist())


@pytest.fixture(scope="module")
def duck(data):
    c = duckdb.connect()
    for p in glob.glob(data + "/*.parquet"):
        c.sql(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, data, duck, name):
    got = catalog.QUERIES[name](spark, data).toPandas()
    if name in catalog.ORACLES:
        want = duck.sql(catalog.ORACLES[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got) == rows(want)
    else:
        assert len(got)
