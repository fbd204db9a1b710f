"""Checks from the manifest: the same reports as checks of the whole tables, but only new files are read."""

from pyspark.sql import functions as F

from salesmart import constants as K
from salesmart import schemas as SC
from salesmart.operators import checks as CK
from salesmart.plans import integrity as IN
from salesmart.plans import pipeline as P
from salesmart.session import child_names
from salesmart.sources import commits as CM
from test_commits import T0, T2
from test_safety import T1, _input, _mart, _record, _rows

RULES = IN.RULES["fact_sales"]
KEYS = ["transaction_id", "product_id"]


def _fact(txn, product="P1", customer="C1", date=20120503, quantity=1, discount="0.10", region="ASIA"):
    from decimal import Decimal
    return (txn, product, customer, date, quantity, Decimal(discount), region, T1)


def _parents(spark, products=("P1", "P2")):
    one = lambda c, keys, t="string": spark.createDataFrame([(k,) for k in keys], f"{c} {t}")
    return {"fk_customer": one("customer_id", ["C1"]), "fk_product": one("product_id", products), "fk_date": one("date_key", [20120503], "int")}


def _append(spark, root, rows):
    """Append rows as they are, duplicates included, with their key index."""
    frame = spark.createDataFrame(rows, SC.FACT_SALES).coalesce(1)
    CM.append(spark, root, SC.FACT_SALES, lambda target: frame, batch=frame.select(*KEYS), keys=KEYS)


def _whole(spark, root, parents):
    facts = spark.read.schema(SC.FACT_SALES).parquet(root)
    return {"pk_duplicates": CK.pk_duplicates({"fact_sales": (facts.na.drop(subset=KEYS), KEYS)}), "not_null": CK.not_null({"fact_sales": (facts, RULES.required)}),
            "ranges": CK.ranges(facts), "widths": CK.widths({"fact_sales": (facts, RULES.widths)}),
            "fk_orphans": CK.fk_orphans(facts, {name: (parents[name], column) for name, column in RULES.refs.items()})}


def _same(spark, root, parents):
    got, want = IN.reports(spark, root, RULES, parents), _whole(spark, root, parents)
    assert got.keys() == want.keys()
    for kind, frame in want.items():
        assert got[kind].columns == frame.columns, kind
        assert _rows(got[kind]) == _rows(frame), kind


def _opened(monkeypatch):
    seen, real = [], IN.open_files

    def spy(spark, root, schema, paths):
        seen.append(len(paths))
        return real(spark, root, schema, paths)
    monkeypatch.setattr(IN, "open_files", spy)
    return seen


DIRTY = [
    [_fact(f"T{k}") for k in range(40)] + [_fact("T3"), _fact("X" * 30), _fact("N1", quantity=-2, discount="-0.50")],
    [_fact(f"U{k}") for k in range(40)] + [_fact("T3"), _fact("T5"), _fact("O1", product="P9"), _fact("O2", product="P9"), _fact("O3", customer="C7")],
    [_fact(f"V{k}") for k in range(40)] + [_fact("T3"), _fact("O4", product="P8"), _fact("O5", date=20130101), _fact("O6", customer=None)],
    [_fact(None), _fact(None), _fact("M1", product=None), _fact("M1", product=None), _fact("M2", date=None)],
]


def test_reports_equal_checks_of_the_whole_table(spark, tmp_path):
    root, parents = str(tmp_path / "fact_sales"), _parents(spark)
    for rows in DIRTY:
        _append(spark, root, rows)
        assert len(IN.check_table(spark, root, RULES, parents)) == 1
        _same(spark, root, parents)
    found = IN.reports(spark, root, RULES, parents)["pk_duplicates"].first()
    assert (found.duplicate_keys, found.rows_involved) == (2, 6)  # T3 in three files, twice in the first; T5 in two


def test_one_check_of_all_files_finds_the_same(spark, tmp_path):
    root, parents = str(tmp_path / "fact_sales"), _parents(spark)
    for rows in DIRTY:
        _append(spark, root, rows)
    assert len(IN.check_table(spark, root, RULES, parents)) == 4
    _same(spark, root, parents)


def test_only_new_files_are_read(spark, tmp_path, monkeypatch):
    root, parents = str(tmp_path / "fact_sales"), _parents(spark)
    for c in range(6):
        _append(spark, root, [_fact(f"{c}-{k:03d}") for k in range(50)])
    assert len(IN.check_table(spark, root, RULES, parents)) == 6
    seen = _opened(monkeypatch)
    _append(spark, root, [_fact(f"6-{k:03d}") for k in range(50)])
    assert len(IN.check_table(spark, root, RULES, parents)) == 1
    assert seen == [1]  # no older file can hold the new keys
    _append(spark, root, [_fact("2-007"), _fact("9-000")])
    IN.check_table(spark, root, RULES, parents)
    assert seen[1] == 1 and sum(seen[2:]) <= 3  # the file of key 2-007, by its Bloom words, and rarely one more
    del seen[:]
    assert IN.check_table(spark, root, RULES, parents) == [] and seen == []
    _same(spark, root, parents)


def test_a_late_parent_heals_an_orphan_without_reading_facts(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "fact_sales")
    _append(spark, root, DIRTY[1])
    IN.check_table(spark, root, RULES, _parents(spark))
    seen = _opened(monkeypatch)
    later = _parents(spark, ("P1", "P2", "P9"))
    assert IN.check_table(spark, root, RULES, later) == [] and seen == []
    _same(spark, root, later)


def test_a_check_repeated_by_another_process_adds_nothing(spark, tmp_path, monkeypatch):
    root, parents = str(tmp_path / "fact_sales"), _parents(spark)
    for rows in DIRTY[:2]:
        _append(spark, root, rows)
    IN.check_table(spark, root, RULES, parents)
    n = spark.read.parquet(f"{root}/_checks").count()
    real = IN.manifest
    monkeypatch.setattr(IN, "manifest", lambda s, r: real(s, r).limit(0))  # as one sees it that began before the other's commit
    assert len(IN.check_table(spark, root, RULES, parents)) == 2
    monkeypatch.undo()
    assert spark.read.parquet(f"{root}/_checks").count() == n
    _same(spark, root, parents)


def test_an_absent_or_empty_table(spark, tmp_path):
    root, parents = str(tmp_path / "fact_sales"), _parents(spark)
    assert IN.check_table(spark, root, RULES, parents) == []
    assert IN.reports(spark, root, RULES, parents)["ranges"].first().rows_checked == 0
    _append(spark, root, [])
    IN.check_table(spark, root, RULES, parents)
    _same(spark, root, parents)


def test_the_mart_is_checked_after_each_load(spark, monkeypatch):
    root = _mart(spark)
    P.load_sales(spark, _input(spark, [_record(f"T{k}") for k in range(20)] + [_record("T1")]), root, T0)
    first = IN.check_mart(spark, root)
    assert {r.table_name for r in first["not_null"].collect()} == set(K.NOT_NULL)
    assert first["ranges"].first().rows_checked == 20
    files = len([n for n in child_names(spark, f"{root}/fact_sales") if not n.startswith(("_", "."))])
    P.load_sales(spark, _input(spark, [_record("U1"), _record("U1"), _record("U2", customer="C9")]), root, T2)
    seen = _opened(monkeypatch)
    second = IN.check_mart(spark, root)
    assert sum(seen) < 2 * files + 4
    facts, log = (spark.read.parquet(f"{root}/{t}") for t in ("fact_sales", "bad_data_log"))
    assert second["ranges"].first().rows_checked == facts.count() == 22
    assert all(r.orphan_rows == 0 for r in second["fk_orphans"].collect())
    whole = CK.widths({"fact_sales": (facts, K.WIDTHS["fact_sales"]), "bad_data_log": (log, K.WIDTHS["bad_data_log"])})
    assert _rows(second["widths"].filter(F.col("table_name").isin("fact_sales", "bad_data_log"))) == _rows(whole)
    assert all(r.duplicate_keys == 0 for r in second["pk_duplicates"].collect())
