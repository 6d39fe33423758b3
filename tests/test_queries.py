"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import math
import os
from collections import Counter

import duckdb
import pytest

from orewise import queries as yard

yard.load()
SF = "/root/testdata/sf0.001"
MODELS = {"m02_spatial_folds", "m03_balanced_sample", "m04_out_of_fold", "m04_random_forest", "m20_downscaled", "g12_forest_downscaled"}


@pytest.fixture(scope="module")
def con():
    out = duckdb.connect()
    for f in os.listdir(SF):
        out.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return out


def cell(x):
    return round(x, 6) + 0.0 if isinstance(x, float) and math.isfinite(x) else x


@pytest.mark.parametrize("name", sorted(yard.SQL))
def test_sql(spark, con, name):
    want = con.execute(yard.SQL[name]).fetchall()
    columns = [x[0] for x in con.description]
    df = yard.QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(columns)
    got = df.select(*columns).collect()
    rows = lambda t: Counter(tuple(map(cell, r)) for r in t)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(q for q in set(yard.QUERIES) - set(yard.SQL) - MODELS if "_sheet_" not in q))  # those: test_models, test_sheets
def test_runs(spark, name):
    assert yard.QUERIES[name](spark, SF).count() >= 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0 and set(entry.oracle_sql()) <= set(entry.queries())
