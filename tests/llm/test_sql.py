"""Queries that SQL can express, against DuckDB."""

import duckdb
import pytest

from hexstats.llm.oracles import ORACLES
from hexstats.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf_dir, name):
    db = duckdb.connect()
    for table in ("documents", "pages", "labels", "embeddings", "benchmark"):
        db.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    found = QUERIES[name](spark, sf_dir)
    columns = sorted(found.columns)
    expected = db.sql(f"select {', '.join(columns)} from ({ORACLES[name]})").fetchall()
    assert sorted(map(tuple, found.select(*columns).collect()), key=str) == sorted(expected, key=str)
