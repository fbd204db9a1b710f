"""Pipeline properties: conservation identities, idempotency, skewed keys, the small customer case."""

import json

from pyspark.sql import functions as F

from mart_data import SF_SMALL
from salesmart.operators import customers as CU
from salesmart.operators import dedup as DD
from salesmart.operators.sales import SalesRun
from salesmart.plans import fixtures as X
from salesmart.plans import registry as R
from salesmart.schemas import RAW_SALES_COLUMNS
from salesmart.session import scratch_path
from salesmart.sources import files as SF


def test_row_conservation(spark):
    run = R.sales_run(spark, SF_SMALL, materialize=True)
    m = run.metrics.collect()[0].asDict()
    assert m["rows_in"] == m["rows_clean"] + m["full_row_duplicates"] + m["missing_transaction_id"] \
        + m["duplicate_transaction_product"]
    distinct = run.fact_distinct.count()  # lines that differ only before cleaning are one
    assert distinct < m["rows_clean"] and distinct == m["fact_rows"] + m["duplicate_fact_key"] and m["duplicate_fact_key"] > 0


def test_log_rows_equal_rule_counts(spark):
    run = R.sales_run(spark, SF_SMALL, materialize=True)
    m = run.metrics.collect()[0].asDict()
    expected = (m["full_row_duplicates"] + m["missing_transaction_id"] + m["duplicate_transaction_product"]
                + m["customer_missing"] + m["product_id_missing"] + m["product_name_missing"]
                + m["category_missing"] + m["price_invalid"]
                + m["quantity_invalid"] + m["discount_invalid"]
                + m["date_missing"] + m["date_invalid"] + m["region_missing"] + m["duplicate_fact_key"])
    log = run.bad_data_log
    assert log.count() == expected
    assert log.select("log_id").distinct().count() == expected


def test_rerun_inserts_nothing(spark):
    row = R.QUERIES["fact_rerun_idempotent"](spark, SF_SMALL).collect()[0]
    assert row.first_run_inserted > 0 and row.second_run_inserted == 0


def test_clean_facts_invariants(spark):
    fact = R.QUERIES["fact_insert_new"](spark, SF_SMALL)
    bad = fact.filter(F.col("transaction_id").isNull() | F.col("product_id").isNull() | (F.col("quantity") < 0)
                      | (F.col("discount") < 0)).count()
    assert bad == 0
    assert fact.groupBy("transaction_id", "product_id").count().filter("count > 1").count() == 0


def test_hot_key_dedup_keeps_one_and_logs_the_rest(spark):
    """One row repeated many times plus many distinct rows: keep-first stays exact under skew."""
    n_hot = 30_000
    hot = spark.range(n_hot).select(*[F.lit(v).alias(c) for c, v in zip(
        RAW_SALES_COLUMNS, ["T1", "C1", "P1", "ring", "SMALL", "9.50", "2", "0.10", "2012-05-03", "ASIA"])])
    cold = spark.range(1000).select(
        F.concat(F.lit("T"), F.col("id") + 2).alias("transaction_id"), F.lit("C1").alias("customer_id"),
        F.lit("P1").alias("product_id"), F.lit("ring").alias("product_name"), F.lit("SMALL").alias("category"),
        F.lit("9.50").alias("price"), F.lit("2").alias("quantity"), F.lit("0.10").alias("discount"),
        F.lit("2012-05-03").alias("date"), F.lit("ASIA").alias("region"))
    # the same transaction and product with other quantities: pair duplicates of the hot key
    pair = spark.range(500).select(*[F.lit(v).alias(c) for c, v in zip(
        RAW_SALES_COLUMNS[:6], ["T1", "C1", "P1", "ring", "SMALL", "9.50"])],
        (F.col("id") + 3).cast("string").alias("quantity"),
        *[F.lit(v).alias(c) for c, v in zip(RAW_SALES_COLUMNS[7:], ["0.10", "2012-05-03", "ASIA"])])
    run = SalesRun(hot.unionByName(cold).unionByName(pair), "r", X.ts_lit(X.RUN_TS))
    assert run.full_row_rejects.count() == n_hot - 1
    assert run.full_row_rejects.select("_copy").distinct().count() == n_hot - 1
    assert run.pair_rejects.count() == 500
    kept = run.clean_rows.filter("transaction_id = 'T1'").collect()
    # the first row in source order: quantity strings compare as text, so '10' precedes '2'
    first_qty = min(["2"] + [str(i + 3) for i in range(500)])
    assert len(kept) == 1 and kept[0].quantity == float(first_qty)


def test_extra_copies_chunks(spark, monkeypatch):
    monkeypatch.setattr(DD, "COPIES_PER_TASK", 7)
    g = spark.createDataFrame([("a", 50), ("b", 1), ("c", 8)], "k string, _n long")
    rows = DD.extra_copies(g, ["k"]).collect()
    assert sorted((r.k, r._copy) for r in rows) == sorted(
        [("a", i) for i in range(2, 51)] + [("c", i) for i in range(2, 9)])


# A small customer file with one record per rule (written here, not copied from anywhere).
CUSTOMERS = [
    {"customer_id": "C1", "customer_name": "Ann", "email": "ann@x.org", "region": "North",
     "join_date": "2024-06-11", "loyalty_points": 10},
    {"customer_id": "C1", "customer_name": "Ann", "email": "ann@x.org", "region": "North",
     "join_date": "2024-06-11", "loyalty_points": 10},
    {"customer_id": "C2", "customer_name": "", "email": None, "region": None,
     "join_date": "2023/04/05", "loyalty_points": -5},
    {"customer_id": "C2", "customer_name": "Bob", "email": "bob@x.org", "region": "West",
     "join_date": "2023/04/05", "loyalty_points": 7},
    {"customer_id": "C3", "customer_name": "N" * 300, "email": "no-at-sign", "region": "East",
     "join_date": "invalid_date", "loyalty_points": None},
    {"customer_id": "  ", "customer_name": "Blank", "email": "b@x.org", "region": "East",
     "join_date": "2022-09-15T00:00:00Z", "loyalty_points": 3},
    {"customer_id": None, "customer_name": "Null id", "email": "n@x.org", "region": "East",
     "join_date": None, "loyalty_points": 1},
]


def test_customer_json_flow(spark):
    path = scratch_path(spark, "cust_small")
    import os
    os.makedirs(path.replace("file:", ""), exist_ok=True)
    with open(os.path.join(path.replace("file:", ""), "customers.json"), "w") as f:
        json.dump(CUSTOMERS, f)
    raw = SF.read_customers_json(spark, path)
    out = {r.customer_id: r for r in CU.prepare_customers(raw).collect()}
    assert set(out) == {"C1", "C2", "C3"}
    # The row that sorts first by points ('-5' < '7') survives, then gets cleaned
    assert (out["C2"].customer_name, out["C2"].email, out["C2"].region, out["C2"].loyalty_points) == \
        ("Unknown", "Unknown", "Unknown", 0)
    assert out["C3"].customer_name == "N" * 255 and out["C3"].email == "invalid"
    assert out["C3"].join_date == 19900101 and out["C3"].loyalty_points == 0
    assert out["C1"].join_date == 20240611
    assert CU.blank_id_rejects(raw).count() == 2


def test_end_to_end_jobs_are_idempotent(spark):
    """Customer load then sales load into an empty mart; re-running the sales load adds no facts."""
    import datetime as dt
    from salesmart.plans import pipeline as P
    root = scratch_path(spark, "mart")
    cust_in = SF.write_json_arrays(
        X.raw_customers(spark, SF_SMALL).withColumn("loyalty_points", F.col("loyalty_points").cast("bigint")),
        scratch_path(spark, "cust_in"), F.length("customer_name") % 2)
    sales_in = X.sales_files(spark, SF_SMALL, scratch_path(spark, "sales_in"))
    t1, t2 = dt.datetime(2024, 7, 1), dt.datetime(2024, 7, 2)
    P.load_customers(spark, cust_in, root, t1)
    out = P.load_sales(spark, sales_in, root, t1)
    facts = spark.read.parquet(out["fact_sales"])
    n1 = facts.count()
    assert n1 == R.sales_run(spark, SF_SMALL).fact_typed.count()
    assert facts.groupBy("transaction_id", "product_id").count().filter("count > 1").count() == 0
    out2 = P.load_sales(spark, sales_in, root, t2)
    assert spark.read.parquet(out2["fact_sales"]).count() == n1
    # the second product version has nothing new or changed: same rows, no row touched at t2
    v2 = spark.read.parquet(out2["dim_product"])
    assert v2.count() == spark.read.parquet(out["dim_product"]).count()
    assert v2.filter(F.col("updated_at") > F.lit("2024-07-01 00:00:00").cast("timestamp_ntz")).count() == 0
    assert spark.read.parquet(out["bad_data_log"]).count() > 0
    # reports read the published tables: query 1 totals equal the fact lines joined to products
    rep = P.report(spark, root)
    q1 = rep["q1_region_category"].agg(F.sum("total_sales")).collect()[0][0]
    m = P.read_mart(spark, root)
    direct = (m["fact_sales"].join(m["dim_product"], "product_id")
              .agg(F.sum(F.col("quantity") * F.col("price") * (1 - F.coalesce("discount", F.lit(0))))).collect()[0][0])
    assert abs(float(q1) - float(direct)) < 1.0
    assert rep["dash_kpi_cards"].count() == 1


def test_customer_numbers_strict_fails_lenient_logs(spark):
    import datetime as dt
    import os

    import pytest

    from salesmart.plans import pipeline as P
    bad = CUSTOMERS + [
        {"customer_id": "C9", "customer_name": "Eve", "email": "e@x.org", "region": "North",
         "join_date": "bad-string-x", "loyalty_points": "abc"}]
    path = scratch_path(spark, "cust_bad")
    os.makedirs(path.replace("file:", ""), exist_ok=True)
    with open(os.path.join(path.replace("file:", ""), "customers.json"), "w") as f:
        json.dump(bad, f)
    raw = SF.read_customers_json(spark, path)
    with pytest.raises(Exception):
        CU.prepare_customers(raw).collect()
    root = scratch_path(spark, "mart_lenient")
    out = P.load_customers(spark, path, root, dt.datetime(2024, 7, 1), strict=False)
    dim = {r.customer_id: r for r in spark.read.parquet(out["dim_customer"]).collect()}
    assert dim["C9"].loyalty_points == 0 and dim["C9"].join_date == 19900101
    log = spark.read.parquet(out["bad_data_log"]).filter("record_id = 'C9'")
    assert sorted(r.bad_column for r in log.collect()) == ["join_date", "loyalty_points"]


def test_the_customer_load_reads_its_input_once(spark, monkeypatch):
    """Log rows and dimension changes come from the rows written by route; a bad number in strict mode publishes nothing."""
    import datetime as dt
    import os

    import pytest

    from salesmart.plans import pipeline as P
    path = scratch_path(spark, "cust_once")
    os.makedirs(path.replace("file:", ""))
    with open(os.path.join(path.replace("file:", ""), "customers.json"), "w") as f:
        json.dump(CUSTOMERS, f)
    logs, changes, append_log, upsert = [], [], P.append_log, P.CM.upsert
    monkeypatch.setattr(P, "append_log", lambda s, log, *a: (logs.append(log.inputFiles()), append_log(s, log, *a))[1])

    def seen(s, root, schema, key, first, make, run=""):
        changes.append(make(first()).inputFiles())
        return upsert(s, root, schema, key, first, make, run)
    monkeypatch.setattr(P.CM, "upsert", seen)
    root = scratch_path(spark, "mart_once")
    out = P.load_customers(spark, path, root, dt.datetime(2024, 7, 1))
    read = logs[0] + changes[0]
    assert read and not [f for f in read if "cust_once" in f]
    log = spark.read.parquet(out["bad_data_log"])
    assert sorted(r.record_id or "" for r in log.collect()) == ["", "  "]
    dim = spark.read.parquet(out["dim_customer"])
    assert sorted(r.customer_id for r in dim.collect()) == ["C1", "C2", "C3", "Unknown"]
    routed = CU.routed(SF.read_customers_json(spark, path))
    want = sorted(map(tuple, CU.prepare_customers(SF.read_customers_json(spark, path)).collect()))
    assert sorted(map(tuple, routed.filter("route = 'valid'").select("target.*").collect())) == want

    with open(os.path.join(path.replace("file:", ""), "more.json"), "w") as f:
        json.dump([{"customer_id": "C9", "customer_name": "Eve", "email": "e@x.org", "region": "North", "join_date": "2024-01-01", "loyalty_points": "abc"}], f)
    strict_root = scratch_path(spark, "mart_strict")
    with pytest.raises(Exception, match="not an integer"):
        P.load_customers(spark, path, strict_root, dt.datetime(2024, 7, 1))
    assert not os.path.exists(strict_root.replace("file:", ""))


def _flat(spark, rows):
    from salesmart.operators.sales import with_order
    from salesmart.schemas import RAW_SALES_COLUMNS
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in RAW_SALES_COLUMNS))
    return with_order(df)


def test_observed_counters_equal_counted_ones(spark):
    """The counters observed while the annotated frame is written, against the same aggregate over the frame; empty input too."""
    from salesmart.operators.sales import SalesRun
    full = X.raw_sales(spark, SF_SMALL)
    for raw in (full, _flat(spark, [])):
        kinds = [SalesRun(raw, "run", F.lit("2024-07-01").cast("timestamp_ntz"), materialize=m) for m in (True, False)]
        observed, counted = [k.metrics for k in kinds]
        assert observed.collect() == counted.collect() and observed.columns == counted.columns
        assert raw is not full or kinds[0]._observed["rows_in"] == full.count()
        # W3 still reads the frame's fact columns; the flags it does not need are not read again
        assert "_flags" not in kinds[0].metrics._jdf.queryExecution().executedPlan().toString()
        kinds[0].close()
