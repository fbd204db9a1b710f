"""Rows of keys that no other row has are neither shuffled nor sorted; rules and stages are made once."""

import random
from pathlib import Path

from pyspark.sql import functions as F

from mart_data import SF_SMALL
from salesmart.operators import dedup as DD
from salesmart.operators.sales import RAW, SalesRun
from salesmart.plans import fixtures as X
from salesmart.plans import registry as R
from salesmart.session import scratch_path, write_stage
from test_safety import _local, _plan, _rows


def test_flags_by_shared_keys_equal_flags_by_all(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["hot", None, f"k{rng.randrange(300)}"]), rng.choice(["p", None]), rng.choice([i, None]), f"v{i}") for i in range(500)]
    df = write_stage(spark.createDataFrame(rows, "a string, b string, _ord long, v string"), "t", scratch_path(spark, "t"))
    keys = ["a", "b"]
    flagged = DD.flag_first_of_shared(df, DD.shared_keys(df, keys, scratch_path(spark, "t"), "shared"), keys)
    assert _rows(flagged) == _rows(DD.flag_first(df, keys))
    assert "Exchange hashpartitioning" not in _plan(flagged) and "SortMergeJoin" not in _plan(flagged)


def test_written_distinct_rows_are_flagged_without_a_shuffle(spark):
    run = R.sales_run(spark, SF_SMALL, materialize=True)
    named = run.full_row_groups.select(*RAW, "_ord").filter("transaction_id is not null")
    assert "Exchange hashpartitioning" not in _plan(run._flag_pairs(named))
    run.close()


def test_each_number_is_read_once(spark):
    """Without the flags Spark would write a number's pattern into each use of it."""
    run = SalesRun(X.raw_sales(spark, SF_SMALL), "r", X.ts_lit(X.RUN_TS), materialize=True)
    plan = run.clean_rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RLIKE(_") == 3 + 2 and plan.count("[eE]") == 3


def test_a_rerun_reads_written_tables(spark):
    assert "lineitem" not in _plan(R.QUERIES["fact_rerun_idempotent"](spark, SF_SMALL))


def test_the_inbox_is_compressed(spark):
    inbox = Path(_local(X.sales_files(spark, SF_SMALL, scratch_path(spark, "inbox"))))
    files = [f for f in inbox.rglob("*") if f.is_file() and f.parent.name.startswith("bucket=") and not f.name.startswith(".")]
    assert files and all(f.suffix == ".gz" for f in files)
