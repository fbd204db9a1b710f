"""Plan properties the design relies on: pruned scans, checked broadcasts, no raw windows."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from mart_data import SF_SMALL
from salesmart.operators import joins as J
from salesmart.plans import fixtures as X
from salesmart.plans import registry as R


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_scans_read_only_needed_columns(spark):
    plan = _plan(E.queries()["q1_region_category"](spark, SF_SMALL))
    li = [line for line in plan.splitlines() if "lineitem" in line and "ReadSchema" in line]
    assert li, plan
    for line in li:
        schema = line[line.index("ReadSchema"):]
        assert "l_tax" not in schema and "l_returnflag" not in schema and "l_extendedprice" not in schema


def test_small_dimension_is_broadcast(spark):
    dim = X.dim_product(spark, SF_SMALL)
    assert J.fits_broadcast(dim)
    plan = _plan(E.queries()["q1_region_category"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in plan


def test_broadcast_refused_over_limit(spark):
    dim = X.dim_product(spark, SF_SMALL)
    assert not J.fits_broadcast(dim, limit=16)
    assert J.sized_broadcast(dim, limit=16) is dim          # no hint: Spark picks the join
    assert J.sized_broadcast(dim) is not dim                # within the limit: broadcast hint


def test_a_lookup_is_sized_by_the_table_it_hangs_on(spark):
    regions = X.customer_regions(spark, SF_SMALL)
    small = X.read_table(spark, SF_SMALL, "region")
    assert J.sized_broadcast(regions, limit=1 << 20, at_most=small) is not regions
    assert J.sized_broadcast(regions, limit=16, at_most=small) is regions


def test_sales_passes_use_no_window_over_rows(spark):
    run = R.sales_run(spark, SF_SMALL, materialize=False)
    for df in (run.annotated, run.fact_deduped, run.product_extract, run.bad_data_log):
        assert "Window" not in _plan(df)


def test_dedup_aggregates_partially_before_shuffle(spark):
    run = R.sales_run(spark, SF_SMALL, materialize=False)
    plan = _plan(run.full_row_groups.select("_n"))
    assert "partial_count" in plan


def test_filters_reach_the_scan(spark):
    plan = _plan(X.fact_base(spark, SF_SMALL).filter(F.col("region") == "ASIA"))
    assert "EqualTo(r_name,ASIA)" in plan


def test_small_batch_probes_large_target(spark, monkeypatch):
    """Target over the limit, batch within it: broadcast the batch keys instead of shuffling the target."""
    from salesmart.operators import upsert as U
    answers = iter([False, True])          # 1st check: target keys, 2nd check: batch keys
    monkeypatch.setattr(U, "fits_broadcast", lambda df, limit=None: next(answers))
    target = X.fact_base(spark, SF_SMALL)
    batch = target.limit(20)
    out = U.new_rows(batch, target, ["transaction_id", "product_id"])
    assert out.count() == 0
    plan = _plan(out)
    assert "LeftSemi" in plan and "BroadcastExchange" in plan


def test_usual_dates_take_few_patterns_and_fused_code_stays_compilable(spark):
    """A usual date is read apart from the month names and the table of layouts; reading a table bounds the fused code of a stage."""
    from salesmart.functions.dates import YEAR_FIRST, YEAR_LAST, parse_sales_date
    values = ["2012-01-05", "2012/1/5", "2012-01-05T00:00:00Z", "2012-01-05 may 6", "05-01-2012", "13-13-2012", "1/13/2012", "13.1.2012", "13.01.2012 10:30",
              "5 May 2012", "May 5, 74", "5/6/75", "#5 6 2012", "may 5 june 2012", "20120105", "2012-13-01", "2012/01-05", None]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = {r.v: (str(r.d) if r.d else None, r.usual) for r in df.select("v", parse_sales_date(F.col("v")).alias("d"), (F.col("v").rlike(YEAR_FIRST) | F.col("v").rlike(YEAR_LAST)).alias("usual")).collect()}
    assert got == {"2012-01-05": ("2012-01-05", True), "2012/1/5": ("2012-01-05", True), "2012-01-05T00:00:00Z": ("2012-01-05", True), "2012-01-05 may 6": ("2012-01-05", True),
                   "05-01-2012": ("2012-01-05", True), "13-13-2012": (None, True), "1/13/2012": ("2012-01-13", True), "13.1.2012": ("2012-01-13", True),
                   "13.01.2012 10:30": ("2012-01-13", False), "5 May 2012": ("2012-05-05", False), "May 5, 74": ("2074-05-05", False), "5/6/75": ("1975-05-06", False),
                   "#5 6 2012": ("2012-05-06", False), "may 5 june 2012": (None, False), "20120105": ("2012-01-05", False), "2012-13-01": (None, True), "2012/01-05": (None, False), None: (None, None)}
    X.read_table(spark, SF_SMALL, "region")
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000


def test_rows_of_a_task_are_bounded_by_size_not_by_the_session(spark):
    """The session's fixed number of partitions would let the rows that one task sorts grow with the facts."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    li = X.read_table(spark, SF_SMALL, "lineitem", "l_orderkey", "l_partkey")
    bounded = J.in_bounded_parts(li, "l_orderkey", part_bytes=J.estimated_size(li) // (3 * parts))
    assert bounded.rdd.getNumPartitions() >= 3 * parts
    assert sorted(map(tuple, bounded.collect())) == sorted(map(tuple, li.collect()))
    assert J.in_bounded_parts(li, "l_orderkey", part_bytes=1 << 40) is li
