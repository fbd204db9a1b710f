"""The source order as one long: the same first rows, by hash aggregates."""

import random

from pyspark.sql import functions as F

from salesmart.operators import dedup as DD
from salesmart.operators.sales import RAW, SalesRun
from salesmart.session import scratch_path, write_stage
from test_safety import _plan, _rows

PLACED = ", ".join(f"{c} string" for c in RAW) + ", _ord struct<file: string, block: long, position: long>"


def _raw(spark, n=600, seed=1):
    """Rows of three files of several blocks in no order: full copies, equal pairs that differ, blanks, null and hot keys."""
    rng, rows = random.Random(seed), []
    for i in range(n):
        txn = rng.choice(["T-hot"] * 3 + [f"T{rng.randrange(120)}", f" T{rng.randrange(120)} ", None, "nan", ""])
        place = (f"f{i % 3}", (i // 3) % 4 * 1000, i // 12)
        rows.append((txn, rng.choice(["C1", None]), rng.choice(["P1", "P2", None]), "ring", rng.choice(["SMALL", "?"]), rng.choice(["9.5", "-1"]),
                     str(rng.randrange(3)), "0.1", "2012-05-03", "ASIA", place))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, PLACED)


def test_places_keep_the_order_and_are_unique(spark):
    raw = _raw(spark)
    placed = DD.with_places(raw.withColumn("was", F.col("_ord")), scratch_path(spark, "t"))
    got = [tuple(r) for r in placed.orderBy("_ord").select("was.file", "was.block", "was.position", "_ord").collect()]
    assert len(got) == raw.count() == len({g[3] for g in got})
    assert [g[:3] for g in got] == sorted(g[:3] for g in got)


def test_other_orders_stay(spark):
    plain = _raw(spark, 5).drop("_ord")
    assert DD.with_places(plain, "unused") is plain
    valued = plain.withColumn("_ord", F.struct("region", "price"))
    assert DD.with_places(valued, "unused") is valued


def test_an_empty_table_has_no_places(spark):
    assert DD.with_places(_raw(spark).limit(0), scratch_path(spark, "t")).collect() == []


def test_first_rows_are_the_same_without_a_sort_aggregate(spark):
    raw = write_stage(_raw(spark), "raw", scratch_path(spark, "t"))
    placed = DD.with_places(raw, scratch_path(spark, "t"))
    values = [c for c in RAW if c not in ("transaction_id", "product_id")]
    by_struct, by_place = (DD.first_row_per_key(df, ["transaction_id", "product_id"], values) for df in (raw, placed))
    assert _rows(by_place, "_ord") == _rows(by_struct, "_ord")
    assert "SortAggregate" in _plan(by_struct) and "SortAggregate" not in _plan(by_place)


def test_a_run_gives_the_same_tables_by_places_and_staged_flags(spark):
    raw = _raw(spark)
    ts = F.lit("2024-07-01 00:00:00").cast("timestamp_ntz")
    plain = SalesRun(raw, "r", ts)
    staged = SalesRun(DD.with_places(write_stage(raw, "raw", scratch_path(spark, "t")), scratch_path(spark, "t")), "r", ts, materialize=True)
    staged.stage_fact_flags()
    for frame in ("fact_typed", "product_typed", "clean_rows", "bad_data_log", "metrics", "pair_rejects", "fact_key_rejects"):
        assert _rows(getattr(staged, frame), "_ord") == _rows(getattr(plain, frame), "_ord"), frame
    assert "SortAggregate" not in _plan(staged.fact_typed) + _plan(staged.product_typed)
    staged.close()
