"""Random dirty sales rows: the cleaned output keeps its invariants whatever the input."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from salesmart.operators.sales import SalesRun
from salesmart.plans import fixtures as X
from salesmart.schemas import RAW_SALES_COLUMNS

TEXT = st.one_of(st.none(), st.sampled_from(["", "  ", "None", "nan", "NaN", "n/a", "two", "-4", "-0.05",
                                              "3", "0.10", " 12.5 ", "1e2", "inf", "abc"]),
                 st.text(alphabet="ABCT0123456789 -/", max_size=12))
DATES = st.one_of(TEXT, st.sampled_from(["03-05-2012", "2012/05/03", "03 May 2012", "2012-05-03",
                                         "2012-05-03T10:00:00Z", "31-02-2024", "invalid_date"]))
ROW = st.tuples(st.one_of(st.none(), st.sampled_from(["T1", " T1 ", "T2", "   ", "none", "T3"])),
                TEXT, st.one_of(st.none(), st.sampled_from(["P1", " P1", "", "P2"])),
                TEXT, TEXT, TEXT, TEXT, TEXT, DATES, TEXT)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(ROW, min_size=1, max_size=60))
def test_invariants_on_random_rows(spark, rows):
    raw = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in RAW_SALES_COLUMNS))
    run = SalesRun(raw, "r", X.ts_lit(X.RUN_TS))
    clean = run.clean_rows.collect()
    for r in clean:
        assert r.transaction_id and r.transaction_id.strip() == r.transaction_id
        assert r.transaction_id.lower() not in ("nan", "none")
        assert r.price >= 0 and r.quantity >= 0 and r.discount >= 0
        assert 10000101 <= r.date_key <= 99991231
        assert r.customer_id and r.product_id and r.region
    keys = [(r.transaction_id, r.product_id) for r in run.fact_typed.collect()]
    assert len(keys) == len(set(keys))
    m = run.metrics.collect()[0]
    assert m.rows_in == len(rows)
    assert m.rows_in == m.rows_clean + m.full_row_duplicates + m.missing_transaction_id \
        + m.duplicate_transaction_product
    assert m.rows_clean == len(clean)
