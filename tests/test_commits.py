"""Published tables: the commit log, races, reruns, older run times, deltas, dead writers."""

import datetime as dt
import os
import threading

import pytest
from pyspark.sql import functions as F

from salesmart import schemas as SC
from salesmart.operators import dims as D
from salesmart.operators import upsert as U
from salesmart.plans import fixtures as X
from salesmart.plans import pipeline as P
from salesmart.session import scratch_path
from salesmart.sources import commits as CM
from salesmart.streaming.incremental import start_incremental_load
from test_safety import T1, _input, _local, _mart, _record, _rows

T0, T2 = dt.datetime(2024, 6, 1), dt.datetime(2024, 7, 2)


def _products(spark, root):
    return {r.product_id: r for r in P.read_versioned(spark, f"{root}/dim_product", SC.DIM_PRODUCT).collect()}


def test_a_number_is_claimed_once_by_many_writers(spark):
    path = f"{scratch_path(spark, 'claim')}/_commits/1.json"
    won, threads = [], []
    for k in range(8):
        threads.append(threading.Thread(target=lambda k=k: won.append(k) if CM.put_if_absent(spark, path, f"writer {k} " * 1000) else None))
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(won) == 1 and CM._read_text(spark, path) == f"writer {won[0]} " * 1000
    assert os.listdir(os.path.dirname(_local(path))) in (["1.json"], [".1.json.crc", "1.json"])


def test_a_rerun_at_the_same_time_changes_nothing(spark):
    path, root = _input(spark, [_record("T1"), _record("T1"), _record("T2", date="bad")]), _mart(spark)
    P.load_sales(spark, path, root, T1)
    state = lambda: [_rows(spark.read.parquet(f"{root}/{n}")) for n in ("fact_sales", "bad_data_log")] + [_rows(P.read_versioned(spark, f"{root}/dim_product", SC.DIM_PRODUCT)), CM.commits(spark, f"{root}/dim_product"), CM.commits(spark, f"{root}/fact_sales")]
    first = state()
    P.load_sales(spark, path, root, T1)
    assert state() == first


def test_a_load_with_an_older_run_time_stays_visible(spark):
    root = _mart(spark)
    P.load_sales(spark, _input(spark, [_record("T1", product="P1")]), root, T2)
    P.load_sales(spark, _input(spark, [_record("T2", product="P2")]), root, T1)
    assert _products(spark, root).keys() == {"P1", "P2", "Unknown"}
    facts = P.read_mart(spark, root)["fact_sales"]
    assert facts.join(P.read_mart(spark, root)["dim_product"], "product_id").count() == facts.count() == 2


def test_a_stream_that_started_before_a_batch_load_keeps_its_products(spark):
    root, inbox, ck = _mart(spark), _input(spark, [_record("T1", product="P1")]), scratch_path(spark, "ck")
    start_incremental_load(spark, inbox, root, ck, T0).awaitTermination()
    P.load_sales(spark, _input(spark, [_record("T2", product="P2")]), root, T2)
    with open(f"{_local(inbox)}/later.json", "w") as f:
        import json
        json.dump([_record("T3", product="P3")], f)
    start_incremental_load(spark, inbox, root, ck, T0).awaitTermination()
    assert _products(spark, root).keys() == {"P1", "P2", "P3", "Unknown"}
    assert {r.transaction_id for r in P.read_mart(spark, root)["fact_sales"].collect()} == {"T1", "T2", "T3"}


def _source(spark, *rows):
    return spark.createDataFrame(rows, "product_id string, product_name string, category string, price double").withColumn("price", F.col("price").cast("decimal(10,2)"))


def _upsert(spark, root, source, ts=T1, **kw):
    make = kw.get("changes") or (lambda now: U.merge_changes(now, source, "product_id", P.PRODUCT_COMPARE, X.ts_lit(ts)))
    return CM.upsert(spark, root, SC.DIM_PRODUCT, "product_id", lambda: D.unknown_product(spark, ts), make, "test")


def test_two_writers_at_once_keep_every_row(spark):
    root = scratch_path(spark, "dim")
    _upsert(spark, root, _source(spark, ("P0", "a", "b", 1.0)))
    mine, calls = _source(spark, ("P1", "mine", "b", 1.0), ("P0", "changed", "b", 1.0)), []

    def overtaken(now):
        if not calls:  # another load publishes while this one is at work
            _upsert(spark, root, _source(spark, ("P2", "theirs", "b", 2.0)), T2)
        calls.append(1)
        return U.merge_changes(now, mine, "product_id", P.PRODUCT_COMPARE, X.ts_lit(T1))

    _upsert(spark, root, mine, changes=overtaken)
    rows = {r.product_id: r.product_name for r in CM.read_table(spark, root, SC.DIM_PRODUCT, "product_id").collect()}
    assert len(calls) == 2 and rows == {"Unknown": "Unknown Product", "P0": "changed", "P1": "mine", "P2": "theirs"}
    assert CM.commits(spark, root) == list(range(1, 1 + len(CM.commits(spark, root))))


def test_concurrent_loads_lose_and_double_nothing(spark):
    root = _mart(spark)
    inputs = [_input(spark, [_record(f"T{k}", product=f"P{k}"), _record("T-both", product="P-both")]) for k in range(3)]
    failed = []

    def load(k):
        try:
            P.load_sales(spark, inputs[k], root, T1 + dt.timedelta(hours=k))
        except Exception as e:  # noqa: BLE001
            failed.append(e)

    P.ensure_dim_date(spark, root)
    threads = [threading.Thread(target=load, args=(k,)) for k in range(3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed
    facts = sorted((r.transaction_id, r.product_id) for r in P.read_mart(spark, root)["fact_sales"].collect())
    assert facts == sorted([("T-both", "P-both"), *[(f"T{k}", f"P{k}") for k in range(3)]])
    assert _products(spark, root).keys() == {"Unknown", "P-both", "P0", "P1", "P2"}


def test_bytes_written_follow_the_change_set_and_deltas_are_folded(spark):
    root = scratch_path(spark, "dim")
    _upsert(spark, root, _source(spark, *[(f"P{k}", "n", "c", 1.0) for k in range(200)]))
    for k in range(CM.MAX_DELTAS):
        folder = _upsert(spark, root, _source(spark, (f"P{k}", "new", "c", 1.0), (f"P{k + 1}", "n", "c", 1.0), (f"Q{k}", "q", "c", 3.0)), T2)
        assert spark.read.parquet(folder).count() == 2
    head = CM.head(spark, root)
    assert len(head.deltas) == CM.MAX_DELTAS and (head.base_rows, head.delta_rows) == (201, 2 * CM.MAX_DELTAS)
    before = _rows(CM.read_table(spark, root, SC.DIM_PRODUCT, "product_id"))
    assert len(before) == 201 + CM.MAX_DELTAS and sum(r[1] == "new" for r in before) == CM.MAX_DELTAS
    assert CM.compact(spark, root, SC.DIM_PRODUCT, "product_id", head, force=True)
    assert CM.head(spark, root).deltas == [] and _rows(CM.read_table(spark, root, SC.DIM_PRODUCT, "product_id")) == before
    created = {r.product_id: (r.created_at, r.updated_at) for r in CM.read_table(spark, root, SC.DIM_PRODUCT, "product_id").collect()}
    assert created["P0"] == (T1, T2) and created["P150"] == (T1, T1) and created["Q0"] == (T2, T2)


def test_a_writer_that_dies_between_claim_and_move_is_completed(spark, monkeypatch):
    root, path = _mart(spark), _input(spark, [_record("T1")])
    move = CM._move

    def die(spark, table, *rest):
        if table.endswith("fact_sales"):
            raise KeyboardInterrupt
        move(spark, table, *rest)

    monkeypatch.setattr(CM, "_move", die)
    with pytest.raises(KeyboardInterrupt):
        P.load_sales(spark, path, root, T1)
    monkeypatch.setattr(CM, "_move", move)
    assert P.read_mart(spark, root)["fact_sales"].count() == 0
    P.load_sales(spark, _input(spark, [_record("T1", quantity="5"), _record("T2")]), root, T2)
    assert sorted((r.transaction_id, r.quantity) for r in P.read_mart(spark, root)["fact_sales"].collect()) == [("T1", 9), ("T2", 9)]


def test_a_half_written_calendar_is_written_again(spark):
    root, path = _mart(spark), _input(spark, [_record("T1")])
    D.dim_date(spark).limit(100).write.parquet(f"{root}/dim_date")
    os.remove(f"{_local(root)}/dim_date/_SUCCESS")
    P.load_sales(spark, path, root, T1)
    assert P.read_mart(spark, root)["fact_sales"].first().date_key == 20120503 and P.read_mart(spark, root)["dim_date"].count() == 7671


def test_the_replay_test_of_the_log_reads_one_run(spark):
    root = _mart(spark)
    for ts in (T1, T2):
        P.load_sales(spark, _input(spark, [_record("T1"), _record("T2", date="bad")]), root, ts)
    sub = [d for d in os.listdir(f"{_local(root)}/bad_data_log") if d.startswith("source_system")]
    assert len(sub) == 1 and sorted(os.listdir(f"{_local(root)}/bad_data_log/{sub[0]}")) == ["run=20240701T000000", "run=20240702T000000"]
    assert spark.read.parquet(f"{root}/bad_data_log").groupBy("source_system", "run").count().count() == 2


def test_run_time_and_lenient_mode_on_the_command_line(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(P, "load_customers", lambda *a: seen.append(a[3:]))
    monkeypatch.setattr("salesmart.session.build_session", lambda master: type("S", (), {"stop": lambda self: None})())
    P.main(["customers", "--input", "in", "--root", "r", "--lenient", "--run-time", "2024-07-01T02:03:04"])
    P.main(["customers", "--input", "in", "--root", "r"])
    assert seen[0] == (dt.datetime(2024, 7, 1, 2, 3, 4), False) and seen[1][1] is True
