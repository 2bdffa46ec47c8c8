"""Every registered query against its SQL twin, at the smallest scale."""

import os

import duckdb
import pandas as pd
import pytest

from gaugeworks.plans import catalog, pages_catalog, rules_catalog

QUERIES, ORACLES = catalog.QUERIES | pages_catalog.QUERIES | rules_catalog.QUERIES, catalog.ORACLES | pages_catalog.ORACLES | rules_catalog.ORACLES
DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(DIR):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{DIR}/{f}'")
    return con


def rows(df):
    def show(v):
        if v is None or (not isinstance(v, (list, dict)) and pd.isna(v)):
            return "NULL"
        return f"{v:.9g}" if isinstance(v, float) else str(v)

    df = df[sorted(df.columns)]
    return sorted(tuple(show(float(v) if isinstance(v, int) and not isinstance(v, bool) else v) for v in r) for r in df.astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got, want = QUERIES[name](spark, DIR).toPandas(), duck.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
