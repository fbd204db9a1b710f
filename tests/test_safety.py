"""The load jobs under failure and dirt: incomplete versions, broken files, source order, references, own folders."""

import datetime as dt
import json
import os
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from mart_data import SF_SMALL
from salesmart import schemas as SC
from salesmart import session as S
from salesmart.operators import checks as CK
from salesmart.operators import dedup as DD
from salesmart.operators import dims as D
from salesmart.operators import measures as M
from salesmart.operators import upsert as U
from salesmart.operators.sales import SalesRun
from salesmart.plans import fixtures as X
from salesmart.plans import pipeline as P
from salesmart.session import scratch_path
from salesmart.sources import files as SF
from salesmart.streaming.incremental import start_incremental_load

T1 = dt.datetime(2024, 7, 1)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _local(path):
    return path.removeprefix("file:")


def _rows(df, *drop):
    return sorted((tuple(r) for r in df.drop(*drop).collect()), key=str)


def _record(txn="T1", quantity="9", date="2012-05-03", customer="C1", product="P1"):
    return {"transaction_id": txn, "customer_id": customer, "product": {"id": product, "name": "ring", "category": "SMALL", "price": "9.50"},
            "quantity": quantity, "discount": "0.10", "date": date, "region": "ASIA"}


def _input(spark, *files, lines=False):
    path = scratch_path(spark, "in")
    os.makedirs(_local(path))
    for i, records in enumerate(files):
        with open(f"{_local(path)}/f{i}.json", "w") as f:
            f.write(records if isinstance(records, str) else "\n".join(map(json.dumps, records)) if lines else json.dumps(records))
    return path


def _mart(spark, customers=("C1",)):
    root = scratch_path(spark, "mart")
    rows = [("Unknown", "Unknown Customer", "Unknown", "Unknown", 19900101, 0, T1, T1)] + [(c, c, "a@b", "ASIA", 20200101, 1, T1, T1) for c in customers]
    U.publish(spark.createDataFrame(rows, SC.DIM_CUSTOMER), f"{root}/dim_customer", "1")
    return root


def test_a_half_written_version_is_passed_over(spark):
    root = scratch_path(spark, "dim")
    U.publish(X.dim_customer(spark, SF_SMALL), root, "20240701T000000")
    n = P.read_versioned(spark, root, SC.DIM_CUSTOMER).count()
    os.makedirs(f"{_local(root)}/v=20240702T000000/_temporary")
    assert n > 1 and P.read_versioned(spark, root, SC.DIM_CUSTOMER).count() == n
    only = scratch_path(spark, "dim")
    os.makedirs(f"{_local(only)}/v=20240702T000000/_temporary")
    with pytest.raises(RuntimeError, match="no complete version"):
        P.read_versioned(spark, only, SC.DIM_CUSTOMER)


def test_an_unreadable_target_raises(spark):
    path = scratch_path(spark, "fact")
    os.makedirs(_local(path))
    with open(f"{_local(path)}/part-0.parquet", "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception):
        P.read_or_empty(spark, path, SC.FACT_SALES).count()


def test_checkpoint_folder_is_required_on_a_cluster():
    assert S.on_one_machine("local[8]") and not S.on_one_machine("local-cluster[3,2,1024]") and not S.on_one_machine("yarn")

    class Conf:
        def get(self, *_):
            return None

    class Option:
        def isDefined(self):
            return False

    class Context:
        master = "spark://host:7077"
        _jsc = property(lambda self: self)

        def sc(self):
            return self

        def getCheckpointDir(self):
            return Option()

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        S.ensure_checkpoint_dir(Session())


def test_the_first_record_wins_in_every_format(spark):
    pair = [_record(quantity="9"), _record(quantity="2")]
    arrays, lines = _input(spark, pair), _input(spark, pair, lines=True)
    roots = [_mart(spark) for _ in range(4)]
    P.load_sales(spark, arrays, roots[0], T1)
    P.load_sales(spark, lines, roots[1], T1, multiline=False)
    start_incremental_load(spark, arrays, roots[2], scratch_path(spark, "ck"), T1).awaitTermination()
    start_incremental_load(spark, lines, roots[3], scratch_path(spark, "ck"), T1, multiline=False).awaitTermination()
    assert [spark.read.parquet(f"{r}/fact_sales").first().quantity for r in roots] == [9] * 4


def test_a_broken_file_fails_the_stream(spark):
    path = _input(spark, [_record()], '[{"transaction_id": "T2", "quan')
    with pytest.raises(Exception):
        start_incremental_load(spark, path, _mart(spark), scratch_path(spark, "ck"), T1).awaitTermination()


def test_source_order_needs_no_join_or_window(spark):
    for df in (SF.read_sales_with_ordinal(spark, _input(spark, [_record()])), SF.read_sales_with_ordinal(spark, _input(spark, [_record()], lines=True), multiline=False)):
        assert not re.search("Join|Window|Exchange", _plan(df))


def test_unresolved_references_are_mapped_and_logged(spark):
    path = _input(spark, [_record("T1"), _record("T2", date="2035-01-05"), _record("T3", customer="C9"), _record("T4", customer="")])
    root = _mart(spark)
    out = P.load_sales(spark, path, root, T1)
    facts = {r.transaction_id: (r.customer_id, r.date_key) for r in spark.read.parquet(out["fact_sales"]).collect()}
    assert facts == {"T1": ("C1", 20120503), "T2": ("C1", 19900101), "T3": ("Unknown", 20120503), "T4": ("Unknown", 20120503)}
    log = spark.read.parquet(out["bad_data_log"]).filter("issue_type = 'unknown_reference'").collect()
    assert sorted((r.record_id, r.bad_column, json.loads(r.original_record)["date_key"], json.loads(r.original_record)["customer_id"]) for r in log) == \
        [("T2", "date", 20350105, "C1"), ("T3", "customer_id", 20120503, "C9")]
    counters = spark.read.parquet(out["run_metrics"]).first()
    assert (counters.rows_in, counters.fact_rows, counters.customer_unmatched, counters.date_unmatched) == (4, 4, 1, 1)
    strict = _mart(spark)
    with pytest.raises(ValueError, match="date"):
        P.load_sales(spark, path, strict, T1, strict_dates=True)
    assert not os.path.exists(f"{_local(strict)}/fact_sales") and not os.path.exists(f"{_local(strict)}/dim_product")


def test_a_rerun_changes_nothing_and_leaves_no_stage(spark):
    path, root = _input(spark, [_record("T1"), _record("T1"), _record("T2", date="bad")]), _mart(spark)
    base = f"{_local(S.ensure_checkpoint_dir(spark))}/salesmart"
    before = set(os.listdir(base))
    P.load_sales(spark, path, root, T1)
    names = ("fact_sales", "bad_data_log")
    first = {n: _rows(spark.read.parquet(f"{root}/{n}")) for n in names}
    start_incremental_load(spark, path, root, scratch_path(spark, "ck"), T1).awaitTermination()
    assert {n: _rows(spark.read.parquet(f"{root}/{n}")) for n in names} == first
    assert not {n for n in set(os.listdir(base)) - before if n.startswith(("load", "sales-run"))}


def test_stream_and_batch_load_give_the_same_tables(spark):
    inbox = X.sales_files(spark, SF_SMALL, scratch_path(spark, "inbox"))
    roots = []
    for _ in range(2):
        root = scratch_path(spark, "mart")
        U.publish(X.dim_customer(spark, SF_SMALL), f"{root}/dim_customer", "1")
        roots.append(root)
    P.load_sales(spark, inbox, roots[0], X.RUN_TS)
    start_incremental_load(spark, inbox, roots[1], scratch_path(spark, "ck"), X.RUN_TS).awaitTermination()
    batch, stream = (P.read_mart(spark, r) for r in roots)
    for name in ("fact_sales", "dim_product"):
        assert _rows(batch[name]) == _rows(stream[name]) != []
    assert _rows(spark.read.parquet(f"{roots[0]}/bad_data_log")) == _rows(spark.read.parquet(f"{roots[1]}/bad_data_log")) != []


def test_survivors_take_one_exchange_and_write_nothing(spark):
    path = scratch_path(spark, "raw")
    X.raw_sales(spark, SF_SMALL).write.parquet(path)
    base = f"{_local(S.ensure_checkpoint_dir(spark))}/salesmart"
    before = set(os.listdir(base))
    run = SalesRun(spark.read.parquet(path), "r", X.ts_lit(X.RUN_TS), materialize=True)
    plan = _plan(run.clean_rows)
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1 and "Join" not in plan and set(os.listdir(base)) == before


def test_a_small_merge_does_not_shuffle_the_target(spark):
    path = scratch_path(spark, "dim")
    X.existing_dim_product(spark, SF_SMALL).write.parquet(path)
    target = spark.read.parquet(path)
    source = spark.createDataFrame(
        [("P1", "ring", "SMALL", 1.0), ("P_new", "cup", "LARGE", 2.0)], "product_id string, product_name string, category string, price double").withColumn("price", F.col("price").cast("decimal(10,2)"))
    small = scratch_path(spark, "source")
    source.write.parquet(small)  # as in the load job, which stages its source
    source = spark.read.parquet(small)
    merged = U.merge(target, source, "product_id", ["product_name", "category", "price"], X.ts_lit(X.RUN_TS))
    assert "SortMergeJoin" not in _plan(merged) and "Exchange hashpartitioning" not in _plan(merged)
    assert merged.count() == target.count() + 1 and merged.filter("product_id = 'P1'").first().product_name == "ring"


def test_copies_of_nameless_rows_spread_over_tasks(spark):
    g = spark.range(400).select(F.lit(None).cast("string").alias("transaction_id"), F.col("id").cast("string").alias("x"), F.lit(5).cast("long").alias("_n"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = DD.extra_copies(g, ["transaction_id", "x"]).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(tasks) > 1 and sum(r["count"] for r in tasks) == 1600


def test_unknown_customers_bypass_the_lookup(spark):
    fact = spark.createDataFrame([("Unknown", 1), ("C1", 2), ("C9", 3)], "customer_id string, n int")
    got = {r.n: (r.customer_id, r._customer) for r in U.resolve_customer(fact, X.dim_customer(spark, SF_SMALL).limit(0)).collect()}
    assert got == {1: ("Unknown", None), 2: ("Unknown", "C1"), 3: ("Unknown", "C9")}


def test_a_null_key_is_no_orphan(spark):
    fact = spark.createDataFrame([(None,), ("C1",), ("C9",), ("C9",)], "customer_id string")
    parent = spark.createDataFrame([("C1",), (None,)], "customer_id string")
    assert tuple(CK.fk_orphans(fact, {"fk": (parent, "customer_id")}).first()) == ("fk", 2, 1)


def test_slicers_reach_the_scan_of_the_laid_out_fact(spark):
    path = scratch_path(spark, "fact")
    P.append_facts(X.fact_base(spark, SF_SMALL).withColumn("created_at", X.ts_lit(X.RUN_TS)), path)
    fact = spark.read.parquet(path)
    view = D.vw_dim_date(D.dim_date(spark))
    sliced = M.filtered_sales(fact, X.dim_product(spark, SF_SMALL), view, years=[2012], months=[1, 2], products=["P1", "P2"])
    pushed = re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(date_key,20120100\)[^\]]*\]", _plan(sliced))
    assert pushed
    every = M.filtered_sales(fact, X.dim_product(spark, SF_SMALL), view).filter("year = 2012 and month in (1, 2) and product_id in ('P1', 'P2')")
    assert _rows(sliced) == _rows(every)


def test_preaggregation_gives_the_same_totals(spark, monkeypatch):
    from salesmart.operators import analytics as A

    fact, products = X.fact_base(spark, SF_SMALL), X.dim_product(spark, SF_SMALL)
    want = [_rows(A.sales_by_region_category(fact, products)), _rows(A.top_products_by_revenue(fact, products)), _rows(A.monthly_trend(fact, products, D.dim_date(spark)))]
    monkeypatch.setattr(A, "fits_broadcast", lambda df: False)
    assert [_rows(A.sales_by_region_category(fact, products)), _rows(A.top_products_by_revenue(fact, products)), _rows(A.monthly_trend(fact, products, D.dim_date(spark)))] == want


@pytest.mark.parametrize(("name", "keys"), [("q1_region_category", ("region", "category")), ("q3_monthly_trend", ("year", "month")), ("q4_avg_discount", ("region",)),
                                            ("cust_sorted", ("loyalty_points", "join_date", "region", "email", "customer_name", "customer_id"))])
def test_results_come_in_order(spark, duck, name, keys):
    got = [tuple(r[k] for k in keys) for r in E.queries()[name](spark, SF_SMALL).collect()]
    cursor = duck.execute(E.oracle_sql()[name])
    at = [[c[0] for c in cursor.description].index(k) for k in keys]
    assert got == [tuple(r[i] for i in at) for r in cursor.fetchall()] and len(got) > 1
