"""Queries against their SQL in DuckDB, on the smallest driver tables."""

import glob
import os

import duckdb
import pytest
from tidewatch.llm import registry, secrets

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    for path in glob.glob(f"{SMALL}/*.parquet"):
        db.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    sql = db.execute(registry.ORACLES[name])
    names = [d[0] for d in sql.description]
    mine = registry.QUERIES[name](spark, SMALL)
    assert sorted(mine.columns) == sorted(names)
    order = lambda rows: sorted(rows, key=str)
    assert order(tuple(r) for r in mine.select(names).collect()) == order(sql.fetchall())


def test_secrets_sql_on_odd_texts(spark):
    """Nulls, empty and repeated rows, letters beyond ASCII that match without regard to case, matches side by side."""
    key, hexes = "aB3dE5gH7jK9mN1pQ", "0123456789abcdef0f1e2d3c4b5a"
    texts = [
        None, "", "é😀 " * 30 + f"password={key}", f"PassWord = '{key}' ſecret={key}{key} toKen:{key}", f"AKIA{'A' * 14}AKIA{'0' * 3}",
        hexes * 3 + "Z" + hexes, f"{hexes} {hexes.upper()}\n{key}{key}", f"secret=token={key}", "api-key: short", f"x{key}{key}=example{key}", "=" * 40, hexes * 40,
    ]
    docs = spark.createDataFrame([(i % 9, t) for i, t in enumerate(texts)], "doc_id long, text string")
    db = duckdb.connect()
    db.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    db.executemany("INSERT INTO documents VALUES (?, ?)", [(i % 9, t) for i, t in enumerate(texts)])
    sql = db.execute(registry.ORACLES["op9_secrets"])
    names = [d[0] for d in sql.description]
    order = lambda rows: sorted(map(tuple, rows), key=str)
    assert order(secrets.found_secrets(docs).select(names).collect()) == order(sql.fetchall())
