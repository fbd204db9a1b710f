"""File sources and the streaming load, checked against the tables they were written from."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from mart_data import SF_SMALL
from salesmart.plans import fixtures as X
from salesmart.schemas import RAW_SALES_COLUMNS
from salesmart.session import scratch_path


def _same(a, b):
    return sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)


@pytest.mark.parametrize("name", ["src_sales_json", "src_ordinal"])
def test_sales_json_roundtrip(spark, name):
    got = E.queries()[name](spark, SF_SMALL)
    assert _same(got.select(*RAW_SALES_COLUMNS), X.raw_sales(spark, SF_SMALL).select(*RAW_SALES_COLUMNS))


def test_customers_json_roundtrip(spark):
    from salesmart.operators.customers import source_defaults
    got = E.queries()["src_customers_json"](spark, SF_SMALL)
    assert _same(got, source_defaults(X.raw_customers(spark, SF_SMALL)))


def test_missing_path_fails(spark):
    from salesmart.sources.files import read_customers_json
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        read_customers_json(spark, "/nonexistent/customers.json").count()


def test_stream_equals_batch_load(spark):
    streamed = E.queries()["stream_incremental_load"](spark, SF_SMALL)
    batch = X.existing_fact_sales(spark, SF_SMALL).unionByName(E.queries()["fact_insert_new"](spark, SF_SMALL))
    assert _same(streamed.select(*batch.columns), batch)


def test_array_files_are_read_once_each(spark):
    """Spark's own array reader opens a file again and again: customers and sales are read as text, a large file in blocks."""
    from salesmart.sources import files as SF
    path = scratch_path(spark, "customers")
    rows = [(f"C{i}", 'a "b" {c}' if i % 3 else None, f"{i}@x", None, "2024-01-01", str(i)) for i in range(700)]
    df = spark.createDataFrame(rows, "customer_id string, customer_name string, email string, region string, join_date string, loyalty_points string")
    SF.write_json_arrays(df.withColumn("_b", F.lit(0)), path, F.col("_b"), [F.col("email")], df.columns)
    for whole_file in (SF.WHOLE_FILE, 1_000):
        got = SF.read_customers_json(spark, path, whole_file)
        assert "Scan json" not in got._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, got.select(*df.columns).collect())) == sorted(rows)
    assert "Scan json" not in SF.read_sales_json(spark, path)._jdf.queryExecution().executedPlan().toString()
