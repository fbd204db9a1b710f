"""The operators' queries that SQL can express, against DuckDB."""

import duckdb
import pytest

from salesmart.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = queries.QUERIES[name](spark, SF)
    cursor = con.execute(queries.ORACLE[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(got.columns)
    in_order = lambda rows: sorted(rows, key=lambda r: [(v is not None, v) for v in r])
    assert in_order(map(tuple, got.select(*names).collect())) == in_order(cursor.fetchall())
