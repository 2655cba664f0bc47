"""Queries that SQL can express, against DuckDB over the same tables."""

import duckdb
import pytest

from martlet.llm.queries import ORACLE, REGISTRY

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(ORACLE[name])
    columns = [c[0] for c in want.description]
    got = REGISTRY[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)

    def key(rows):
        return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))

    assert key(tuple(r) for r in got.select(*columns).collect()) == key(want.fetchall())
