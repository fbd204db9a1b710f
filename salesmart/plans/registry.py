"""Named queries: one per operator of the inventory.

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
driver's tables at ``sf_dir``.  Keys match ``salesmart.plans.oracle.ORACLE``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import constants as K
from ..operators import analytics as A
from ..operators import checks as CK
from ..operators import customers as CU
from ..operators import dims as D
from ..operators import measures as M
from ..operators import quality as Q
from ..operators import sales as SL
from ..operators import upsert as U
from ..operators.joins import in_bounded_parts
from ..schemas import CUSTOMER_COLUMNS, DIM_CUSTOMER_COLUMNS, FACT_COLUMNS, FACT_SALES, RAW_SALES_COLUMNS
from ..session import scratch_path, write_small, write_stage
from ..sources import files as SF
from . import fixtures as X

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def query(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        return fn
    return deco


def _star(spark: SparkSession, sf: str):
    return X.fact_base(spark, sf), X.dim_product(spark, sf)


# ---------------------------------------------------------------- analytics (A1-A5)
@query("q1_region_category")
def q1(spark, sf):
    return A.sales_by_region_category(*_star(spark, sf))


@query("q2_top5_products")
def q2(spark, sf):
    return A.top_products_by_revenue(*_star(spark, sf))


@query("q3_monthly_trend")
def q3(spark, sf):
    return A.monthly_trend(*_star(spark, sf), D.dim_date(spark))


@query("q4_avg_discount")
def q4(spark, sf):
    return A.avg_discount_by_region(X.fact_base(spark, sf))


@query("q5_high_value_lines")
def q5(spark, sf):
    return A.high_value_lines(*_star(spark, sf))


# ---------------------------------------------------------------- measures
@query("m_total_sales")
def m_total_sales(spark, sf):
    return M.total_sales(*_star(spark, sf))


@query("m_avg_sale_per_transaction")
def m_avg_sale(spark, sf):
    return M.avg_sale_per_transaction(*_star(spark, sf))


@query("m_total_loyalty_points")
def m_loyalty(spark, sf):
    return M.total_loyalty_points(X.dim_customer(spark, sf))


@query("m_high_value_transactions")
def m_hv(spark, sf):
    return M.high_value_transactions(*_star(spark, sf))


@query("m_total_customers")
def m_customers(spark, sf):
    return M.total_customers(X.fact_base(spark, sf))


@query("dash_kpi_cards")
def dash_kpi(spark, sf):
    return M.kpi_cards(*_star(spark, sf), X.dim_customer(spark, sf))


@query("dash_monthly_trend")
def dash_monthly(spark, sf):
    return M.monthly_sales_trend(*_star(spark, sf), D.vw_dim_date(D.dim_date(spark)))


@query("dash_top5_products")
def dash_top5(spark, sf):
    return M.top_products(*_star(spark, sf))


@query("dash_loyalty_by_region")
def dash_loyalty(spark, sf):
    return M.loyalty_by_region(X.dim_customer(spark, sf))


@query("dash_category_trend")
def dash_category(spark, sf):
    return M.category_trend(*_star(spark, sf), D.vw_dim_date(D.dim_date(spark)))


@query("dash_sales_by_region")
def dash_region(spark, sf):
    return M.sales_by_region(*_star(spark, sf))


@query("m_sales_ytd_daily")
def ytd_daily(spark, sf):
    return M.sales_ytd_daily(*_star(spark, sf), D.vw_dim_date(D.dim_date(spark)))


@query("m_sales_ytd_monthly")
def ytd_monthly(spark, sf):
    return M.sales_ytd_monthly(*_star(spark, sf), D.vw_dim_date(D.dim_date(spark)))


# The slicer selections exercised by the dashboard queries.
SLICER_YEARS = (2012, 2013)
SLICER_MONTHS = (1, 2, 3, 4, 5, 6)
SLICER_REGIONS = ("ASIA", "EUROPE")
SLICER_CATEGORIES = ("ECONOMY", "PROMO", "SMALL")


@query("dash_filtered_sales")
def dash_filtered(spark, sf):
    return M.filtered_sales(*_star(spark, sf), D.vw_dim_date(D.dim_date(spark)),
                            years=SLICER_YEARS, months=SLICER_MONTHS, regions=SLICER_REGIONS,
                            categories=SLICER_CATEGORIES)


@query("dash_product_sales")
def dash_product(spark, sf):
    """The product slicer."""
    return M.filtered_sales(*_star(spark, sf), D.vw_dim_date(D.dim_date(spark)), products=[f"P{k}" for k in range(1, 26)])


# ---------------------------------------------------------------- sales cleaning (C1-C13, W1-W5, B*, A17)



def sales_run(spark, sf, materialize: bool = False) -> SL.SalesRun:
    """One sales load over the dirty fixture; ``materialize`` writes the stages that log and counters share."""
    return SL.SalesRun(X.raw_sales(spark, sf), X.RUN_ID, X.ts_lit(X.RUN_TS), materialize=materialize)


def _reported(run: SL.SalesRun, *reports: DataFrame) -> DataFrame:
    """The rows of small reports on a run, written one report after the other; then the run's stages, which hold every sales row, are deleted.

    The disk holds the shuffle files of one report at a time, and none of them nor a stage while the result is read.
    """
    folder = scratch_path(run.raw.sparkSession, "report")
    written = [write_stage(r, f"part-{i}", folder) for i, r in enumerate(reports)]
    run.close()
    return reduce(DataFrame.unionByName, written)


def _raw_with(spark, sf, col: str, *exprs) -> DataFrame:
    """raw_sales with one column replaced by the given expression(s) (a rule applied alone)."""
    raw = X.raw_sales(spark, sf)
    out = []
    for c in RAW_SALES_COLUMNS:
        out.extend(exprs if c == col else [F.col(c)])
    return raw.select(*out)


@query("clean_transaction_id")
def clean_txn(spark, sf):
    raw = X.raw_sales(spark, sf)
    txn = SL.clean_txn(F.col("transaction_id"))
    return (raw.withColumn("transaction_id", txn).filter(~SL.txn_missing(F.col("transaction_id")))
            .select(*RAW_SALES_COLUMNS))


def _placeholder_query(col: str, placeholders):
    def fn(spark, sf):
        cleaned, missing = SL.placeholder_rule(F.col(col), placeholders)
        return _raw_with(spark, sf, col, cleaned.alias(col), missing.alias(f"{col}_missing"))
    return fn


query("clean_customer_id")(_placeholder_query("customer_id", K.CUSTOMER_PLACEHOLDERS))
query("clean_product_id")(_placeholder_query("product_id", K.PRODUCT_ID_PLACEHOLDERS))
query("clean_product_name")(_placeholder_query("product_name", K.PRODUCT_NAME_PLACEHOLDERS))
query("clean_category")(_placeholder_query("category", K.CATEGORY_PLACEHOLDERS))
query("clean_region")(_placeholder_query("region", K.REGION_PLACEHOLDERS))


def _number_query(col: str):
    def fn(spark, sf):
        cleaned, missing, negative = SL.number_rule(F.col(col))
        return _raw_with(spark, sf, col, cleaned.alias(col), missing.alias(f"{col}_missing"),
                         negative.alias(f"{col}_negative"))
    return fn


query("clean_price")(_number_query("price"))
query("clean_quantity")(_number_query("quantity"))
query("clean_discount")(_number_query("discount"))


@query("clean_date")
def clean_date(spark, sf):
    key, missing, invalid = SL.date_rule(F.col("date"))
    raw = SL.with_parsed_date(X.raw_sales(spark, sf), F.col("date"))
    out = []
    for c in RAW_SALES_COLUMNS:
        out.extend([key.alias("date_key"), missing.alias("date_missing"), invalid.alias("date_invalid")]
                   if c == "date" else [F.col(c)])
    return raw.select(*out)


@query("dedup_full_row")
def dedup_full_row(spark, sf):
    return sales_run(spark, sf).full_row_survivors.select(*RAW_SALES_COLUMNS)


@query("dedup_full_row_rejects")
def dedup_full_row_rejects(spark, sf):
    return sales_run(spark, sf).full_row_rejects.select(*RAW_SALES_COLUMNS, F.col("_copy").alias("copy_no"))


@query("dedup_txn_product")
def dedup_txn_product(spark, sf):
    return sales_run(spark, sf).pair_survivors.select(*RAW_SALES_COLUMNS)


@query("dedup_txn_product_rejects")
def dedup_txn_product_rejects(spark, sf):
    return sales_run(spark, sf).pair_rejects.select(*RAW_SALES_COLUMNS)


@query("sales_clean")
def sales_clean(spark, sf):
    return sales_run(spark, sf).clean_rows


@query("fact_distinct")
def fact_distinct(spark, sf):
    return sales_run(spark, sf).fact_distinct.select(*FACT_COLUMNS)


@query("fact_dedup_key")
def fact_dedup_key(spark, sf):
    return sales_run(spark, sf).fact_deduped.select(*FACT_COLUMNS)


@query("fact_cast")
def fact_cast(spark, sf):
    return sales_run(spark, sf).fact_typed.select(*FACT_COLUMNS)


@query("product_extract")
def product_extract(spark, sf):
    return sales_run(spark, sf).product_extract


@query("product_cast")
def product_cast(spark, sf):
    return sales_run(spark, sf).product_typed


@query("bad_data_log")
def bad_data_log(spark, sf):
    return sales_run(spark, sf, materialize=True).bad_data_log


@query("bad_data_summary")
def bad_data_summary(spark, sf):
    run = sales_run(spark, sf, materialize=True)
    return _reported(run, Q.summary(run.bad_data_log))


@query("run_metrics")
def run_metrics(spark, sf):
    run = sales_run(spark, sf, materialize=True)
    return _reported(run, run.metrics)


# ---------------------------------------------------------------- loads
def _fact_resolved(spark, sf):
    """Facts with both references resolved; replaced values in ``_customer`` and ``_date``."""
    return U.resolve_date(_fact_customers(spark, sf), D.dim_date(spark))


def _fact_customers(spark, sf):
    run = sales_run(spark, sf)
    return U.resolve_customer(run.fact_typed.select(*FACT_COLUMNS), X.dim_customer(spark, sf))


@query("fact_customer_fk")
def fact_customer_fk(spark, sf):
    return _fact_customers(spark, sf).select(*FACT_COLUMNS)


@query("fact_date_fk")
def fact_date_fk(spark, sf):
    """A fact date outside the calendar becomes 19900101."""
    return _fact_resolved(spark, sf).select(*FACT_COLUMNS)


@query("fact_fk_log")
def fact_fk_log(spark, sf):
    """Log rows of the replaced customer and date references."""
    return U.reference_log(_fact_resolved(spark, sf), X.RUN_ID, X.ts_lit(X.RUN_TS))


@query("fact_insert_new")
def fact_insert_new(spark, sf):
    fact = _fact_resolved(spark, sf).select(*FACT_COLUMNS)
    return U.insert_only(fact, X.existing_fact_sales(spark, sf), ["transaction_id", "product_id"],
                         X.ts_lit(X.RUN_TS))


@query("fact_rerun_idempotent")
def fact_rerun_idempotent(spark, sf):
    """Load twice: the second run finds every key loaded and inserts nothing.

    Facts, target and the first run's rows are written once, as each is read several times, and dealt to as many tasks as their size asks for.
    """
    keys = ["transaction_id", "product_id"]
    fact = in_bounded_parts(write_stage(_fact_resolved(spark, sf).select(*FACT_COLUMNS), "facts"), *keys)
    target = write_stage(X.existing_fact_sales(spark, sf), "target")
    first = write_stage(U.insert_only(fact, target, keys, X.ts_lit(X.RUN_TS)), "inserted")
    after = target.unionByName(first)
    second = U.insert_only(fact, after, keys, X.ts_lit(X.RUN_TS))
    return Q.fold_rows(first.agg(F.count(F.lit(1)).alias("first_run_inserted")),
                       second.agg(F.count(F.lit(1)).alias("second_run_inserted")),
                       after.agg(F.count(F.lit(1)).alias("rows_after")))


PRODUCT_COMPARE = ["product_name", "category", "price"]


@query("product_new")
def product_new(spark, sf):
    src = sales_run(spark, sf).product_typed
    ts = X.ts_lit(X.RUN_TS)
    return (U.new_rows(src, X.existing_dim_product(spark, sf), ["product_id"])
            .withColumn("created_at", ts).withColumn("updated_at", ts))


@query("product_changed")
def product_changed(spark, sf):
    return U.changed_rows(sales_run(spark, sf).product_typed, X.existing_dim_product(spark, sf),
                          "product_id", PRODUCT_COMPARE)


@query("product_upsert")
def product_upsert(spark, sf):
    return U.merge(X.existing_dim_product(spark, sf), sales_run(spark, sf).product_typed,
                   "product_id", PRODUCT_COMPARE, X.ts_lit(X.RUN_TS))


@query("audit_columns")
def audit_columns(spark, sf):
    """K4: audit timestamps on the rows a load inserts (run timestamp passed in)."""
    fact = fact_insert_new(spark, sf)
    return fact.groupBy("created_at").agg(F.count(F.lit(1)).alias("n_rows"))


# ---------------------------------------------------------------- customer flow

CUSTOMER_COMPARE = ["customer_name", "email", "region", "join_date", "loyalty_points"]


def _cust_src(spark, sf) -> DataFrame:
    return CU.source_defaults(X.raw_customers(spark, sf))


def _cust_rule(col: str, fn):
    def q(spark, sf):
        src = _cust_src(spark, sf)
        return src.select(*[fn(F.col(c)).alias(c) if c == col else F.col(c) for c in CUSTOMER_COLUMNS])
    return q


query("cust_name")(_cust_rule("customer_name", CU.clean_name))
query("cust_region")(_cust_rule("region", CU.clean_region))
query("cust_email")(_cust_rule("email", CU.clean_email))
query("cust_loyalty")(_cust_rule("loyalty_points", CU.clean_loyalty))
query("cust_join_date")(_cust_rule("join_date", CU.clean_join_date))


@query("cust_dedup_full")
def cust_dedup_full(spark, sf):
    return CU.dedup_full(_cust_src(spark, sf))


@query("cust_dedup_id")
def cust_dedup_id(spark, sf):
    return CU.dedup_by_id(CU.dedup_full(_cust_src(spark, sf)))


@query("cust_sorted")
def cust_sorted(spark, sf):
    """The full-row sort order (points, date, region, email, name, id), ascending."""
    return CU.dedup_full(_cust_src(spark, sf)).orderBy(*CU.FIRST_ORDER, "customer_id")


def _cust_cleaned(spark, sf) -> DataFrame:
    return CU.clean_columns(CU.dedup_by_id(CU.dedup_full(_cust_src(spark, sf))))


@query("cust_route")
def cust_route(spark, sf):
    return CU.route(_cust_cleaned(spark, sf))


@query("cust_valid_id")
def cust_valid_id(spark, sf):
    return _cust_cleaned(spark, sf).filter(CU.valid_id(F.col("customer_id")))


@query("cust_schema_enforce")
def cust_schema_enforce(spark, sf):
    return CU.prepare_customers(X.raw_customers(spark, sf))


def _cust_prepared_and_target(spark, sf):
    return CU.prepare_customers(X.raw_customers(spark, sf)), X.existing_dim_customer(spark, sf)


@query("cust_lookup_match")
def cust_lookup_match(spark, sf):
    src, tgt = _cust_prepared_and_target(spark, sf)
    return src.join(tgt.select("customer_id"), "customer_id", "left_semi")


@query("cust_lookup_nomatch")
def cust_lookup_nomatch(spark, sf):
    src, tgt = _cust_prepared_and_target(spark, sf)
    return U.new_rows(src, tgt, ["customer_id"])


@query("cust_changed")
def cust_changed(spark, sf):
    src, tgt = _cust_prepared_and_target(spark, sf)
    return U.changed_rows(src, tgt, "customer_id", CUSTOMER_COMPARE)


@query("cust_unchanged")
def cust_unchanged(spark, sf):
    src, tgt = _cust_prepared_and_target(spark, sf)
    return U.unchanged_rows(src, tgt, "customer_id", CUSTOMER_COMPARE)


@query("cust_upsert")
def cust_upsert(spark, sf):
    src, tgt = _cust_prepared_and_target(spark, sf)
    return U.merge(tgt, src, "customer_id", CUSTOMER_COMPARE, X.ts_lit(X.RUN_TS)).select(
        *DIM_CUSTOMER_COLUMNS, "created_at", "updated_at")


@query("cust_bad_data_log")
def cust_bad_data_log(spark, sf):
    """Customer rows dropped for a blank id, logged with source ssis_pkg."""
    rej = CU.blank_id_rejects(X.raw_customers(spark, sf))
    return Q.log_rows(rej, F.array(Q.issue_when(F.lit(True), "customer_blank_id")), F.col("customer_id"),
                      Q.record_json(CUSTOMER_COLUMNS), X.RUN_ID, X.ts_lit(X.RUN_TS), K.SOURCE_CUSTOMERS)


# ---------------------------------------------------------------- dimensions
def _date_usage(spark, sf, dim: DataFrame) -> DataFrame:
    """Dimension rows with the number of fact lines on each day (work grows with the facts)."""
    per_day = X.fact_base(spark, sf).groupBy("date_key").agg(F.count(F.lit(1)).alias("fact_lines"))
    j = dim.join(per_day, "date_key", "left")
    return j.select(*dim.columns, F.coalesce(F.col("fact_lines"), F.lit(0)).alias("fact_lines"))


@query("dim_date")
def dim_date_q(spark, sf):
    return _date_usage(spark, sf, D.dim_date(spark))


@query("vw_dim_date")
def vw_dim_date_q(spark, sf):
    return _date_usage(spark, sf, D.vw_dim_date(D.dim_date(spark)))


@query("dim_date_bounds")
def dim_date_bounds(spark, sf):
    """Bounds of the generated calendar next to the bounds of the facts' dates."""
    cal = D.date_bounds(D.calendar(spark))
    facts = X.fact_base(spark, sf).agg(F.min("date_key").alias("fact_min_date_key"),
                                       F.max("date_key").alias("fact_max_date_key"))
    return Q.fold_rows(cal, facts)


@query("dim_date_guard")
def dim_date_guard(spark, sf):
    """Populate an unpopulated date dimension once; a second run adds nothing.

    The guard reads at most two rows of the target.  The report also counts
    the fact lines whose date resolves in the populated dimension.
    """
    target = D.unknown_date(spark)
    first, n1 = D.populate_dim_date_if_empty(spark, target)
    second, n2 = D.populate_dim_date_if_empty(spark, first)
    keys = second.select("date_key")
    resolved = X.fact_base(spark, sf).join(keys, "date_key", "left_semi")
    return Q.fold_rows(second.agg(F.count(F.lit(1)).alias("rows_after")),
                       resolved.agg(F.count(F.lit(1)).alias("fact_lines_resolved"))).select(
        F.lit(n1).cast("bigint").alias("first_run_inserted"), F.lit(n2).cast("bigint").alias("second_run_inserted"),
        "rows_after", "fact_lines_resolved")


@query("unknown_members")
def unknown_members(spark, sf):
    """Seed each dimension's unknown member once; seeding again changes nothing."""
    ts = X.EXISTING_TS
    rows = []
    for name, dim, unknown, key in [
        ("dim_customer", X.dim_customer(spark, sf, with_unknown=False), D.unknown_customer(spark, ts), "customer_id"),
        ("dim_product", X.dim_product(spark, sf, with_unknown=False), D.unknown_product(spark, ts), "product_id"),
        ("dim_date", D.calendar(spark), D.unknown_date(spark), "date_key"),
    ]:
        once = D.seed_unknown(dim, unknown, key)
        twice = D.seed_unknown(once, unknown, key)
        rows.append(Q.fold_rows(dim.agg(F.count(F.lit(1)).alias("rows_before")),
                                once.agg(F.count(F.lit(1)).alias("rows_after_seed")),
                                twice.agg(F.count(F.lit(1)).alias("rows_after_reseed")))
                    .select(F.lit(name).alias("table_name"), "rows_before", "rows_after_seed", "rows_after_reseed"))
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


# ---------------------------------------------------------------- integrity checks
@query("check_pk_duplicates")
def check_pk(spark, sf):
    m = X.dirty_mart(spark, sf)
    run = sales_run(spark, sf, materialize=True)
    tables = {
        "dim_customer": (m["dim_customer"], ["customer_id"]), "dim_product": (m["dim_product"], ["product_id"]),
        "dim_date": (m["dim_date"], ["date_key"]), "fact_sales": (m["fact_sales"], ["transaction_id", "product_id"]),
        "bad_data_log": (run.bad_data_log, ["log_id"]),
        "raw_fact_lines": (run.fact_distinct, ["transaction_id", "product_id"]),
    }
    return _reported(run, *[CK.pk_duplicates({name: table}) for name, table in tables.items()])


@query("check_not_null")
def check_not_null(spark, sf):
    run = sales_run(spark, sf, materialize=True)
    tables = {**X.dirty_mart(spark, sf), "bad_data_log": run.bad_data_log}
    return _reported(run, *[CK.not_null({name: (tables[name], columns)}) for name, columns in K.NOT_NULL.items()])


@query("check_fk_orphans")
def check_fk(spark, sf):
    m = X.dirty_mart(spark, sf)
    return CK.fk_orphans(m["fact_sales"], {"fk_customer": (m["dim_customer"], "customer_id"),
                                           "fk_product": (m["dim_product"], "product_id"),
                                           "fk_date": (m["dim_date"], "date_key")})


@query("check_ranges")
def check_ranges(spark, sf):
    return CK.ranges(X.dirty_mart(spark, sf)["fact_sales"])


@query("check_widths")
def check_widths(spark, sf):
    run = sales_run(spark, sf, materialize=True)
    tables = {**X.dirty_mart(spark, sf), "bad_data_log": run.bad_data_log}
    return _reported(run, *[CK.widths({name: (tables[name], limits)}) for name, limits in K.WIDTHS.items()])


@query("check_decimals")
def check_decimals(spark, sf):
    m = X.dirty_mart(spark, sf)
    return CK.decimal_ranges({name: (m[name], limits) for name, limits in K.DECIMALS.items()})


# ---------------------------------------------------------------- scalar function surface (2.12)
@query("scalar_functions")
def scalar_functions(spark, sf):
    from ..functions.dates import parse_sales_date
    from ..functions.numeric import coerce_number
    from ..functions.text import strip
    raw = X.raw_sales(spark, sf)
    raw = raw.withColumn("_d", parse_sales_date(F.col("date")))
    d = F.col("_d")
    price = coerce_number(F.col("price"))
    return raw.select(
        strip(F.col("transaction_id")).alias("txn_strip"),
        F.lower(strip(F.col("customer_id"))).alias("customer_lower"),
        F.coalesce(F.col("category").isin("NaN", "nan"), F.lit(False)).alias("category_is_nan"),
        F.coalesce(F.col("product_name"), F.lit("Unknown")).alias("name_or_unknown"),
        price.alias("price_number"),
        F.round(price.cast("decimal(10,2)") * 3, 1).cast("decimal(18,1)").alias("price_x3_round1"),
        F.col("quantity").try_cast("int").alias("quantity_int"),
        d.alias("parsed_date"),
        F.date_format(d, "yyyyMMdd").alias("date_yyyymmdd"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.year(d).alias("d_year"), F.month(d).alias("d_month"), F.dayofmonth(d).alias("d_day"),
        F.quarter(d).alias("d_quarter"),
        F.length(F.col("product_name")).alias("name_len"),
        F.substring(F.col("product_name"), 1, 5).alias("name_sub5"),
        F.instr(F.col("region"), "A").alias("region_pos_a"),
        F.replace(F.col("date"), F.lit("-"), F.lit("")).alias("date_no_dash"),
        F.left(F.col("date"), F.lit(4)).alias("date_left4"),
        F.trim(F.col("region")).alias("region_trim"),
    )


# ---------------------------------------------------------------- sources (S1-S7) and streaming


def _n_files(df: DataFrame, rows_per_file: int = 20_000) -> int:
    """Number of array files for a write: the row count over a bounded file size."""
    return max(1, -(-df.count() // rows_per_file))


@query("src_sales_json")
def src_sales_json(spark, sf):
    path = X.sales_files(spark, sf, scratch_path(spark, "sales_json"))
    return SL.flatten_product(SF.read_sales_json(spark, path)).select(*RAW_SALES_COLUMNS)


@query("src_flatten_product")
def src_flatten_product(spark, sf):
    return SL.flatten_product(X.raw_sales_nested(spark, sf))


@query("src_ordinal")
def src_ordinal(spark, sf):
    """Each record with the number of its file and its position there."""
    path = X.sales_files(spark, sf, scratch_path(spark, "sales_json"))
    flat = SL.flatten_product(SF.read_sales_with_ordinal(spark, path))
    return flat.select(*RAW_SALES_COLUMNS, F.regexp_extract("_ord.file", r"bucket=(\d+)", 1).cast("bigint").alias("file_no"),
                       F.col("_ord.position").alias("position"))


@query("src_preview")
def src_preview(spark, sf):
    return SF.preview(SL.with_order(X.raw_sales(spark, sf))).select(*RAW_SALES_COLUMNS)


@query("src_customers_json")
def src_customers_json(spark, sf):
    raw = X.raw_customers(spark, sf).withColumn("loyalty_points", F.col("loyalty_points").cast("bigint"))
    bucket = F.pmod(F.xxhash64(*raw.columns), F.lit(_n_files(raw)))
    path = SF.write_json_arrays(raw, scratch_path(spark, "customers_json"), bucket)
    return CU.source_defaults(SF.read_customers_json(spark, path))


@query("src_target_projection")
def src_target_projection(spark, sf):
    path = scratch_path(spark, "dim_product")
    X.dim_product(spark, sf).write.parquet(path)
    return spark.read.parquet(path).select("product_id", "price")


def _mart_before(spark, sf) -> str:
    """A mart root with the tables as they are before the load."""
    from ..operators.upsert import publish
    root = scratch_path(spark, "mart")
    write_small(X.existing_fact_sales(spark, sf), f"{root}/fact_sales")
    publish(X.dim_customer(spark, sf), f"{root}/dim_customer", "before")
    publish(X.existing_dim_product(spark, sf), f"{root}/dim_product", "before")
    return root


@query("stream_incremental_load")
def stream_incremental_load(spark, sf):
    """Arriving sales files streamed into the mart; result = the fact table after the stream."""
    from ..streaming.incremental import start_incremental_load
    inbox = X.sales_files(spark, sf, scratch_path(spark, "inbox"))
    root = _mart_before(spark, sf)
    q = start_incremental_load(spark, inbox, root, scratch_path(spark, "stream_ckpt"), X.RUN_TS)
    q.awaitTermination()
    return spark.read.schema(FACT_SALES).parquet(f"{root}/fact_sales")
