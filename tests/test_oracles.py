"""Every registered query against DuckDB on the driver tables."""

import glob
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from golden_files import SMALL

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    folder = os.environ.get("CHECK_SF_DIR", SMALL)
    for path in glob.glob(f"{folder}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def sorted_rows(pdf):
    pdf = pdf[sorted(pdf.columns)]
    return sorted((tuple(None if pd.isna(v) else v for v in r) for r in pdf.itertuples(index=False)), key=repr)


def test_registries_agree():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, duck, name):
    folder = os.environ.get("CHECK_SF_DIR", SMALL)
    got, want = QUERIES[name](spark, folder).toPandas(), duck.sql(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want) and len(got) > 0
    assert sorted_rows(got) == sorted_rows(want)


def test_entry(spark):
    assert entry.entry(spark).columns == ["window_end", "rank", "item_id", "cnt"]
