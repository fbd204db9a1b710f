"""Runs with stages keep few bytes a row on disk: only hashes are shuffled, rows are written once, reports leave nothing behind."""

import os
import random
import re

import pytest
from pyspark.sql import functions as F

from mart_data import SF_SMALL
from salesmart.operators import joins as J
from salesmart.operators import sales as SL
from salesmart.operators.sales import RAW, SalesRun
from salesmart.plans import fixtures as X
from salesmart.plans import registry as R
from salesmart.schemas import FACT_COLUMNS
from salesmart.session import SHUFFLE_CLEANUP, ensure_checkpoint_dir, scratch_path, write_stage
from salesmart.sources import files as SF
from salesmart.sources.files import write_json_arrays
from salesmart.streaming.ledger import Ledger
from test_safety import _local, _plan, _rows

TS = "2024-07-01 00:00:00"
FRAMES = ("full_row_survivors", "pair_rejects", "fact_distinct", "fact_key_flagged", "fact_key_rejects", "bad_data_log", "metrics")


def _raw(spark, n=300, seed=2, shared=0.3):
    """Rows mostly of ids of their own; the others are copies, equal pairs, ids equal once cleaned, rows without an id or without a place."""
    rng, rows = random.Random(seed), []
    for i in range(n):
        if rng.random() < shared:
            txn = rng.choice(["T-hot", " T-hot", f"T{rng.randrange(20)}", None, "nan", " "])
            rows.append((txn, "C1", rng.choice(["P1", " P1", "Unknown", "", None]), "ring", "SMALL", "9.5", rng.choice(["1", "2"]), None, "2012-05-03", "ASIA", rng.choice([i, None])))
        else:
            rows.append((f"U{i}", None, rng.choice([f"P{i}", ""]), None, "NaN", "-1", "two", "0.1", rng.choice(["2012/05/03", "never"]), " ASIA", rng.choice([i, i, i, None])))
    rows += rng.sample(rows, n // 10)
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in RAW) + ", _ord long")


def _run(raw, **kw):
    return SalesRun(raw, "r", F.lit(TS).cast("timestamp_ntz"), **kw)


def _same(plain, staged):
    for name in FRAMES:
        drop = () if plain.own_order else ("_ord",)
        assert _rows(getattr(staged, name).select(*sorted(getattr(plain, name).drop(*drop).columns))) == _rows(getattr(plain, name).select(*sorted(getattr(plain, name).drop(*drop).columns))), name
    staged.close()


@pytest.mark.parametrize("shared", [0.0, 0.3, 1.0])
@pytest.mark.parametrize("placed", [True, False])
def test_a_run_with_stages_gives_the_same_tables(spark, shared, placed):
    raw = write_stage(_raw(spark, 200, shared=shared), "raw", scratch_path(spark, "t"))
    raw = raw if placed else raw.drop("_ord")
    _same(_run(raw), _run(raw, materialize=True))


def test_more_shared_keys_than_a_broadcast_takes(spark, monkeypatch):
    raw = write_stage(_raw(spark), "raw", scratch_path(spark, "t"))
    plain = _run(raw)
    monkeypatch.setattr(SL, "fits_broadcast", lambda df: False)
    monkeypatch.setattr(SL, "sized_broadcast", lambda df, **kw: df)
    staged = _run(raw, materialize=True)
    staged.full_row_groups
    assert os.path.exists(f"{_local(staged.folder)}/lone_rows")
    _same(plain, staged)


def test_a_row_of_its_own_key_is_written_once_and_never_shuffled(spark):
    raw = _raw(spark, 400, shared=0.0)
    run = _run(raw, materialize=True)
    assert run.bad_data_log.count() > 0 and run.metrics.first().rows_in == raw.count()
    held = {name: spark.read.parquet(f"{run.folder}/{name}").count() for name in os.listdir(_local(run.folder))}
    assert held["raw"] == raw.count() and all(n <= 100 for name, n in held.items() if name != "raw"), held
    assert "Exchange hashpartitioning" not in _plan(run.annotated)
    run.close()


def test_a_stage_of_a_run_leaves_no_shuffle_files(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    held = lambda: {b for b in blocks.getAllBlocks().mkString(" ").split() if b.startswith("shuffle_")}
    was, before = spark.conf.get(SHUFFLE_CLEANUP, None), held()
    write_stage(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "t", scratch_path(spark, "t"))
    assert not held() - before and spark.conf.get(SHUFFLE_CLEANUP, None) == was


@pytest.mark.parametrize("name", ["bad_data_summary", "run_metrics", "check_pk_duplicates", "check_not_null", "check_widths"])
def test_a_report_leaves_no_stage_of_its_run(spark, name):
    base = f"{_local(ensure_checkpoint_dir(spark))}/salesmart"
    os.makedirs(base, exist_ok=True)
    before = set(os.listdir(base))
    df = R.QUERIES[name](spark, SF_SMALL)
    assert df.count() > 0 and df.count() > 0
    assert not {n for n in set(os.listdir(base)) - before if n.startswith("sales-run")}


def test_records_dealt_in_passes_give_the_same_files(spark):
    rows = write_stage(_raw(spark, 120), "rows", scratch_path(spark, "t"))
    bucket = F.col("_ord") % 7  # null for some rows
    texts = []
    for passes in (1, 3):
        path = write_json_arrays(rows, scratch_path(spark, "arrays"), bucket, [F.col("_ord")], RAW, passes=passes)
        texts.append({d: sorted(t for f in os.listdir(f"{_local(path)}/{d}") if not f.startswith((".", "_")) for t in [open(f"{_local(path)}/{d}/{f}").read()])
                      for d in os.listdir(_local(path)) if d.startswith("bucket=")})
    assert texts[0] == texts[1] and len(texts[0]) == 8


def test_input_rows_are_staged_before_they_are_dealt_to_files(spark, monkeypatch):
    plans = []
    write = SF.write_json_arrays
    monkeypatch.setattr(SF, "write_json_arrays", lambda df, *args: plans.append(_plan(df)) or write(df, *args))
    path = X.sales_files(spark, SF_SMALL, scratch_path(spark, "inbox"))
    assert "Join" not in plans[0] and SF.read_sales_json(spark, path).count() == X.raw_sales(spark, SF_SMALL).count()
    assert not [n for n in os.listdir(f"{_local(ensure_checkpoint_dir(spark))}/salesmart") if n.startswith("nested")]


def test_customers_are_joined_to_orders_before_lines(spark, monkeypatch):
    """Where they are too many for a broadcast, lines are shuffled for orders and products only."""
    monkeypatch.setattr(J.join_dim, "__defaults__", ("inner", 0, None))
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(X.raw_sales(spark, SF_SMALL))
        keys = re.findall(r"Exchange hashpartitioning\((\w+)#", plan)
        assert sorted(keys) == ["c_custkey", "l_orderkey", "l_partkey", "o_custkey", "o_orderkey", "p_partkey"], keys
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def test_an_epoch_is_held_against_a_ledger_of_whole_digests(spark):
    """Entries that an earlier version has written with 32 bytes a digest are met; a first epoch is joined to no ledger at all."""
    raw = _raw(spark, 60).withColumn("_ord", F.struct(F.lit("f").alias("file"), F.lit(0).cast("long").alias("block"), F.monotonically_increasing_id().alias("position")))
    raw = write_stage(raw, "raw", scratch_path(spark, "t"))
    root = scratch_path(spark, "mart")
    first = _run(raw, materialize=True, ledger=Ledger(spark, root, "r", 0), staged=True)
    clean = first.clean_rows.count()
    assert clean and "stream_ledger" not in _plan(first.full_row_groups)
    whole = lambda cols: F.unhex(F.sha2(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}), 256))
    rows = first.full_row_groups.withColumn("row", whole(RAW))
    txn = SL.clean_txn(F.col("transaction_id"))
    rows = rows.select("row", F.col("_n").alias("n"), "_ord.*", F.when(~SL.txn_missing(txn), txn).alias("transaction_id"), F.col("product_id").alias("raw_product_id"))
    first.ledger.record(rows, first.fact_distinct.select("transaction_id", "product_id", whole(FACT_COLUMNS).alias("fact")))
    assert spark.read.parquet(f"{root}/stream_ledger/run=r/rows").select(F.max(F.octet_length("row"))).first()[0] == 32
    again = _run(raw, materialize=True, ledger=Ledger(spark, root, "r", 1), staged=True)
    assert again.clean_rows.count() == 0 and again.fact_key_flagged.count() == 0
    assert again.full_row_rejects.count() == raw.count()
    again.record()
    assert spark.read.parquet(f"{root}/stream_ledger/run=r/rows/epoch=000000001").select(F.max(F.octet_length("row"))).first()[0] == 16
