"""Queries with SQL against DuckDB."""

from __future__ import annotations

import pytest

from checks.compare import _rows, duck
from comptoir.llm.queries import QUERIES
from tests.conftest import SF


@pytest.mark.parametrize("name", [n for n, (_, sql) in QUERIES.items() if sql])
def test_same_rows(name, spark):
    fn, sql = QUERIES[name]
    df = fn(spark, SF)
    con = duck(SF)
    for name in ("documents", "embeddings", "pages", "labels", "conversations"):
        con.execute(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    res = con.execute(sql)
    columns = [d[0] for d in res.description]
    assert sorted(columns) == sorted(df.columns)
    assert _rows(df.columns, df.collect()) == _rows(columns, res.fetchall())
