"""Every registered query against its DuckDB reference SQL at sf0.001 (multiset equality)."""

import datetime as dt
import decimal

import pytest

import __spark_entry__ as E
from mart_data import SF_SMALL
from salesmart.plans.registry import QUERIES

KEYS = sorted(QUERIES)
# Queries that write and read files or run a stream are covered in test_sources.py.
SLOW = {"src_sales_json", "src_ordinal", "src_customers_json", "src_target_projection", "stream_incremental_load"}


def _norm(v):
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return v.normalize()
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _key(row):
    return tuple((v is None, str(v)) for v in row)


def test_every_query_has_oracle():
    assert set(KEYS) <= set(E.oracle_sql()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", [k for k in KEYS if k not in SLOW])
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    s_cols = df.columns
    s_rows = [tuple(_norm(v) for v in r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    d_cols = [c[0] for c in res.description]
    assert sorted(s_cols) == sorted(d_cols)
    idx = [d_cols.index(c) for c in s_cols]
    d_rows = [tuple(_norm(r[i]) for i in idx) for r in res.fetchall()]
    assert len(s_rows) == len(d_rows)
    assert sorted(map(_key, s_rows)) == sorted(map(_key, d_rows))


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["region", "category", "total_sales"]
    assert df.count() > 0
