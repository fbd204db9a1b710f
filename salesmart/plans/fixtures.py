"""Mart inputs derived by Spark from the driver's TPC-H-style tables.

``fact_base`` and the clean dimensions feed the queries and measures;
``raw_sales`` and ``raw_customers`` are dirty sources derived by fixed rules
(see FIXTURES.md); ``existing_*`` are the target states before a load.
Every frame is a lazy plan over the parquet scans, so its work grows with
the tables.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.dates import date_key_of
from ..operators.joins import estimated_size, in_bounded_parts, join_dim
from ..session import delete_folder, scratch_path, write_stage
from ..sources.tables import read_table

# Audit timestamps used by the fixtures and by the load under test.
EXISTING_TS = dt.datetime(2024, 1, 1, 0, 0, 0)
RUN_TS = dt.datetime(2024, 6, 30, 12, 0, 0)
RUN_ID = "2024-06-30 12:00:00"


def ts_lit(value: dt.datetime) -> Column:
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def _shifted(ts: Column) -> Column:
    """Ship date moved 15 years forward (29 February to the 28th where the year has none)."""
    return F.add_months(F.to_date(ts), 180)


def customer_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``c_custkey -> r_name``; nation and region are fixed-size (25 / 5 rows)."""
    cust = read_table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation", "n_nationkey", "n_regionkey")
    region = read_table(spark, sf_dir, "region", "r_regionkey", "r_name")
    geo = F.broadcast(nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
                      .select("n_nationkey", "r_name"))
    return cust.join(geo, cust.c_nationkey == geo.n_nationkey).select("c_custkey", "c_nationkey", "r_name")


def fact_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean fact lines: one row per (transaction_id, product_id), first by all columns.

    Keep-first is a grouped ``min(struct(...))`` with partial aggregation, so a
    hot key is reduced map-side instead of landing whole in one task.  The
    grouping keys (orderkey, partkey) are refined by the join's orderkey
    partitioning, so no extra shuffle is needed for the dedup.
    """
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_quantity", "l_discount", "l_shipdate")
    orders = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    lines = (in_bounded_parts(li, "l_orderkey").join(orders, F.col("l_orderkey") == orders.o_orderkey)
             .select("l_orderkey", "l_partkey", "o_custkey",
                     date_key_of(_shifted(F.col("l_shipdate"))).alias("date_key"),
                     F.col("l_quantity").cast("int").alias("quantity"),
                     F.col("l_discount").cast("decimal(5,2)").alias("discount")))
    first = (lines.groupBy("l_orderkey", "l_partkey", "o_custkey")
             .agg(F.min(F.struct("date_key", "quantity", "discount")).alias("f")))
    regions = customer_regions(spark, sf_dir).select("c_custkey", "r_name")
    joined = join_dim(first, regions, first.o_custkey == regions.c_custkey, at_most=read_table(spark, sf_dir, "customer"))
    return joined.select(
        F.concat(F.lit("T"), F.col("l_orderkey")).alias("transaction_id"),
        F.concat(F.lit("P"), F.col("l_partkey")).alias("product_id"),
        F.concat(F.lit("C"), F.col("o_custkey")).alias("customer_id"),
        F.col("f.date_key").alias("date_key"),
        F.col("f.quantity").alias("quantity"),
        F.col("f.discount").alias("discount"),
        F.col("r_name").alias("region"),
    )


def dim_product(spark: SparkSession, sf_dir: str, with_unknown: bool = True) -> DataFrame:
    """Product dimension from ``part`` (id, name, type as category, price)."""
    part = read_table(spark, sf_dir, "part", "p_partkey", "p_name", "p_type", "p_retailprice")
    dim = part.select(
        F.concat(F.lit("P"), F.col("p_partkey")).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("price"),
        ts_lit(EXISTING_TS).alias("created_at"),
        ts_lit(EXISTING_TS).alias("updated_at"),
    )
    if with_unknown:
        from ..operators.dims import unknown_product
        dim = unknown_product(spark, EXISTING_TS).unionByName(dim)
    return dim


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty flat sales rows, every column a string, with a source position ``_ord`` (rules of FIXTURES.md section 4)."""
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                    "l_discount", "l_shipdate")
    orders = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    part = read_table(spark, sf_dir, "part", "p_partkey", "p_name", "p_type", "p_retailprice")
    regions = customer_regions(spark, sf_dir)
    # Customers are joined to the orders, which are fewer and narrower than their lines: if they shuffle, the lines do not.
    placed = join_dim(orders, regions, orders.o_custkey == regions.c_custkey, at_most=read_table(spark, sf_dir, "customer"))
    j = in_bounded_parts(li, "l_orderkey").join(placed, li.l_orderkey == placed.o_orderkey)
    j = join_dim(j, part, j.l_partkey == part.p_partkey)

    ok, ck, pk, sk, ln = (F.col(c) for c in ("l_orderkey", "o_custkey", "l_partkey", "l_suppkey", "l_linenumber"))
    day = _shifted(F.col("l_shipdate"))
    text = lambda pattern, d=day: F.date_format(d, pattern)
    null = F.lit(None).cast("string")
    # Rows of orders with key % 307 = 0 arrive twice (exact duplicates); rows of orders with key % 173 = 0
    # arrive again with another spelling of the product id and quantity 1.  One pass, no union.
    copies = F.when(ok % 307 == 0, F.array(F.lit(1), F.lit(2))).when(ok % 173 == 0, F.array(F.lit(1), F.lit(3))).otherwise(F.array(F.lit(1)))
    j = j.withColumn("_copy", F.explode(copies))
    again = F.col("_copy") == 3
    rows = j.select(
        F.when(ok % 211 == 0, null).when(ok % 223 == 0, F.lit("   "))
         .otherwise(F.concat(F.lit(" T"), ok, F.lit(" "))).alias("transaction_id"),
        F.when(ck % 61 == 0, null).when(ck % 67 == 0, F.lit("None")).when(ck % 71 == 0, F.lit("C_absent"))
         .otherwise(F.concat(F.lit("C"), ck)).alias("customer_id"),
        F.when(pk % 199 == 0, F.when(again, null).otherwise(F.lit("")))
         .otherwise(F.concat(F.when(again, F.lit(" P")).otherwise(F.lit("P")), pk)).alias("product_id"),
        F.when(pk % 97 == 0, null).otherwise(F.col("p_name")).alias("product_name"),
        F.when(pk % 89 == 0, F.lit("NaN")).otherwise(F.col("p_type")).alias("category"),
        F.when(pk % 83 == 0, F.lit("n/a")).when(pk % 79 == 0, F.lit("-1.50"))
         .otherwise(F.col("p_retailprice").cast("decimal(12,2)").cast("string")).alias("price"),
        F.when(again, F.lit("1")).when((ln == 7) & (sk % 3 == 0), null).when(sk % 13 == 0, F.lit("-4")).when(sk % 17 == 0, F.lit("two"))
         .otherwise(F.col("l_quantity").cast("int").cast("string")).alias("quantity"),
        F.when(sk % 11 == 0, null).when(sk % 19 == 0, F.lit("-0.05"))
         .otherwise(F.col("l_discount").cast("decimal(4,2)").cast("string")).alias("discount"),
        F.when(ok % 101 == 0, null).when(ok % 103 == 0, F.lit("next week"))
         .when(ok % 107 == 0, text("yyyy-MM-dd", F.add_months(day, 240))).when(ok % 109 == 0, text("dd MMM yyyy"))
         .when(ok % 113 == 0, text("MM/dd/yyyy")).when(ok % 127 == 0, text("MMM d, yyyy")).when(ok % 131 == 0, text("dd-MMM-yyyy"))
         .when(ok % 137 == 0, text("M/d/yy")).when(ok % 139 == 0, text("yyyy.MM.dd")).when(ok % 149 == 0, text("d MMM yyyy HH:mm"))
         .when(ok % 151 == 0, text("MM/dd/yyyy HH:mm"))
         .when(ln % 4 == 0, text("yyyy/MM/dd")).when(ln % 4 == 1, text("dd-MM-yyyy"))
         .when(ln % 4 == 2, text("yyyy-MM-dd'T00:00:00Z'")).otherwise(text("yyyy-MM-dd")).alias("date"),
        F.when(F.col("c_nationkey") % 9 == 0, null).otherwise(F.concat(F.lit(" "), F.col("r_name"))).alias("region"),
        # The source position: order, line, ship day, product and copy in one number (a line number alone repeats).
        ((((ok * 16 + ln) * 8192 + F.datediff(F.to_date("l_shipdate"), F.lit("1990-01-01").cast("date"))) * 65536 + pk % 65536) * 4
         + F.col("_copy")).cast("long").alias("_ord"),
    )
    return rows


def raw_sales_nested(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    """``raw_sales`` in the source JSON shape, with a nested ``product`` struct, in no order of its own."""
    r = raw_sales(spark, sf_dir)
    return r.select(
        "transaction_id", "customer_id",
        F.struct(F.col("product_id").alias("id"), F.col("product_name").alias("name"),
                 F.col("category").alias("category"), F.col("price").alias("price")).alias("product"),
        "quantity", "discount", "date", "region", *keep)


#: Orders whose rows share one input file; files are bounded and their number grows with the table.
ORDERS_PER_FILE = 5_000
#: Bytes of the staged rows whose records are shuffled at a time.
PASS_BYTES = 1 << 30


def sales_files(spark: SparkSession, sf_dir: str, path: str) -> str:
    """Write the nested dirty sales as JSON-array files, compressed: all rows of an order in one file, in source order.

    The rows are staged first, so that the shuffle files of their joins are gone when the records are dealt to files."""
    from ..sources.files import write_json_arrays
    folder = scratch_path(spark, "nested")
    nested = write_stage(raw_sales_nested(spark, sf_dir, "_ord"), "sales", folder)
    orderkey = F.shiftright("_ord", 35)
    bucket = F.floor(orderkey / ORDERS_PER_FILE).cast("long")
    names = [c for c in nested.columns if c != "_ord"]
    passes = -(-estimated_size(nested) // PASS_BYTES)
    write_json_arrays(nested.withColumn("_b", bucket), path, F.col("_b"), [F.col("_ord")], names, "gzip", passes)
    delete_folder(spark, folder)
    return path


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty customer rows, every column a string (rules of FIXTURES.md section 5)."""
    cust = read_table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_acctbal")
    regions = customer_regions(spark, sf_dir)
    j = cust.join(regions, "c_custkey")
    k = F.col("c_custkey")
    null = F.lit(None).cast("string")
    rows = j.select(
        F.when(k % 131 == 0, null).when(k % 137 == 0, F.lit("  ")).otherwise(F.concat(F.lit("C"), k))
         .alias("customer_id"),
        F.when(k % 29 == 0, F.lit("")).when(k % 31 == 0, F.repeat(F.lit("Quayside Trading "), 18))
         .otherwise(F.col("c_name")).alias("customer_name"),
        F.when(k % 23 == 0, null).when(k % 19 == 0, F.lit("no-at-sign.net"))
         .otherwise(F.concat(F.lit("buyer."), k, F.lit("@post.example"))).alias("email"),
        F.when(F.col("c_nationkey") % 9 == 0, null).otherwise(F.col("r_name")).alias("region"),
        F.when(k % 13 == 0, F.lit("someday")).when(k % 11 == 0, null)
         .when(k % 7 == 0, F.concat(F.lit("2023/04/0"), (k % 9 + 1)))
         .when(k % 5 == 0, F.concat(F.lit("2022-09-1"), k % 10, F.lit("T00:00:00Z")))
         .otherwise(F.concat(F.lit("2024-06-1"), k % 10)).alias("join_date"),
        F.when(k % 17 == 0, null).otherwise(F.floor(F.col("c_acctbal")).cast("string")).alias("loyalty_points"),
    )
    copies = rows.filter(F.col("customer_id").endswith("50"))
    conflicts = (rows.filter(F.col("customer_id").endswith("75"))
                 .withColumn("customer_name", F.concat(F.col("customer_name"), F.lit(" Jr"))))
    return rows.unionByName(copies).unionByName(conflicts)


def custkey_of(customer_id: Column) -> Column:
    """Numeric key back out of ``C<key>``; null for other ids."""
    return F.substring(customer_id, 2, 30).try_cast("bigint")


def partkey_of(product_id: Column) -> Column:
    return F.substring(product_id, 2, 30).try_cast("bigint")


def orderkey_of(transaction_id: Column) -> Column:
    return F.substring(transaction_id, 2, 30).try_cast("bigint")


def dim_customer(spark: SparkSession, sf_dir: str, with_unknown: bool = True) -> DataFrame:
    """Customer dimension after the first (all-insert) load of ``raw_customers``."""
    from ..operators.customers import prepare_customers
    from ..operators.dims import unknown_customer
    clean = prepare_customers(raw_customers(spark, sf_dir))
    dim = clean.select(*[F.col(c) for c in
                         ("customer_id", "customer_name", "email", "region", "join_date", "loyalty_points")],
                       ts_lit(EXISTING_TS).alias("created_at"), ts_lit(EXISTING_TS).alias("updated_at"))
    if with_unknown:
        dim = unknown_customer(spark, EXISTING_TS).unionByName(dim)
    return dim


def existing_dim_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target before the customer load: keys % 4 <> 0; keys % 6 = 0 carry 1 point."""
    dim = dim_customer(spark, sf_dir, with_unknown=True)
    key = custkey_of(F.col("customer_id"))
    dim = dim.filter(key.isNull() | (key % 4 != 0))
    return dim.withColumn("loyalty_points",
                          F.when(key % 6 == 0, F.lit(1)).otherwise(F.col("loyalty_points")))


def existing_dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target before the product load: parts % 7 <> 0; parts % 5 = 0 priced 1.00."""
    dim = dim_product(spark, sf_dir, with_unknown=True)
    key = partkey_of(F.col("product_id"))
    dim = dim.filter(key.isNull() | (key % 7 != 0))
    return dim.withColumn("price", F.when(key % 5 == 0, F.lit(1).cast("decimal(10,2)"))
                          .otherwise(F.col("price")))


def existing_fact_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target before the fact load: the clean lines of orders with key % 3 = 0."""
    fb = fact_base(spark, sf_dir)
    return (fb.filter(orderkey_of(F.col("transaction_id")) % 3 == 0)
            .withColumn("created_at", ts_lit(EXISTING_TS)))


def dirty_mart(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The mart tables with known violations of every constraint (FIXTURES.md section 8), inputs of the checks."""
    from ..operators.dims import dim_date as calendar
    fact = fact_base(spark, sf_dir)
    ok, null = orderkey_of(F.col("transaction_id")), F.lit(None).cast("string")
    changed = fact.select(
        F.when(ok % 61 == 0, null).otherwise(F.col("transaction_id")).alias("transaction_id"),
        F.when(ok % 67 == 0, F.lit("P_gone")).otherwise(F.col("product_id")).alias("product_id"),
        F.when(ok % 97 == 0, null).when(ok % 89 == 0, F.lit("C_gone")).otherwise(F.col("customer_id")).alias("customer_id"),
        F.when(ok % 83 == 0, F.lit(20991231)).when(ok % 59 == 0, F.lit(None).cast("int")).otherwise(F.col("date_key")).alias("date_key"),
        F.when(ok % 79 == 0, -F.col("quantity")).otherwise(F.col("quantity")).alias("quantity"),
        F.when(ok % 73 == 0, F.lit(-0.05)).when(ok % 53 == 0, F.lit(1000.0)).otherwise(F.col("discount").cast("double")).alias("discount"),
        F.when(ok % 47 == 0, F.repeat(F.lit("far away "), 7)).otherwise(F.col("region")).alias("region"),
        F.explode(F.when(ok % 71 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("_copy")).drop("_copy")
    customers = dim_customer(spark, sf_dir)
    ck = custkey_of(F.col("customer_id"))
    customers = customers.withColumn("region", F.when(ck % 41 == 0, F.repeat(F.lit("north "), 10)).otherwise(F.col("region"))) \
        .withColumn("customer_id", F.when(ck % 43 == 0, null).otherwise(F.col("customer_id")))
    products = dim_product(spark, sf_dir)
    pk = partkey_of(F.col("product_id"))
    products = products.select(
        F.when(pk % 37 == 0, F.lit("P1")).otherwise(F.col("product_id")).alias("product_id"),
        F.when(pk % 31 == 0, null).otherwise(F.col("product_name")).alias("product_name"), "category",
        F.when(pk % 29 == 0, F.lit(123456789.5)).otherwise(F.col("price").cast("double")).alias("price"))
    dates = calendar(spark).withColumn("month_name", F.when(F.col("day") == 31, F.repeat(F.lit("month "), 4)).when(F.col("day") == 30, null).otherwise(F.col("month_name")))
    return {"fact_sales": changed, "dim_customer": customers, "dim_product": products, "dim_date": dates}
