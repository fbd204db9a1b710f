"""Schemas of the raw inputs and the star-schema targets."""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()

# Raw nested sales record: every leaf a string so that dirty values survive.
PRODUCT_STRUCT = T.StructType([
    T.StructField("id", S), T.StructField("name", S),
    T.StructField("category", S), T.StructField("price", S),
])
SALES_JSON = T.StructType([
    T.StructField("transaction_id", S),
    T.StructField("customer_id", S),
    T.StructField("product", PRODUCT_STRUCT),
    T.StructField("quantity", S),
    T.StructField("discount", S),
    T.StructField("date", S),
    T.StructField("region", S),
])

# Flat raw sales columns, in source order (also the keep-first order).
RAW_SALES_COLUMNS = ["transaction_id", "customer_id", "product_id", "product_name", "category",
                     "price", "quantity", "discount", "date", "region"]

# Raw customer record: six strings.
CUSTOMER_COLUMNS = ["customer_id", "customer_name", "email", "region", "join_date", "loyalty_points"]
CUSTOMERS_JSON = T.StructType([T.StructField(c, S) for c in CUSTOMER_COLUMNS])

DIM_CUSTOMER = T.StructType([
    T.StructField("customer_id", S), T.StructField("customer_name", S),
    T.StructField("email", S), T.StructField("region", S),
    T.StructField("join_date", T.IntegerType()), T.StructField("loyalty_points", T.IntegerType()),
    T.StructField("created_at", T.TimestampNTZType()), T.StructField("updated_at", T.TimestampNTZType()),
])
DIM_PRODUCT = T.StructType([
    T.StructField("product_id", S), T.StructField("product_name", S),
    T.StructField("category", S), T.StructField("price", T.DecimalType(10, 2)),
    T.StructField("created_at", T.TimestampNTZType()), T.StructField("updated_at", T.TimestampNTZType()),
])
DIM_DATE = T.StructType([
    T.StructField("date_key", T.IntegerType()), T.StructField("full_date", T.DateType()),
    T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType()),
    T.StructField("month_name", S), T.StructField("day", T.IntegerType()),
    T.StructField("quarter", T.IntegerType()),
])
FACT_SALES = T.StructType([
    T.StructField("transaction_id", S), T.StructField("product_id", S),
    T.StructField("customer_id", S), T.StructField("date_key", T.IntegerType()),
    T.StructField("quantity", T.IntegerType()), T.StructField("discount", T.DecimalType(5, 2)),
    T.StructField("region", S), T.StructField("created_at", T.TimestampNTZType()),
])
BAD_DATA_LOG = T.StructType([
    T.StructField("log_id", S), T.StructField("etl_run_id", T.TimestampNTZType()),
    T.StructField("source_system", S), T.StructField("record_id", S),
    T.StructField("bad_column", S), T.StructField("issue_type", S),
    T.StructField("original_record", S), T.StructField("notes", S),
])

FACT_COLUMNS = ["transaction_id", "product_id", "customer_id", "date_key", "quantity", "discount", "region"]
PRODUCT_COLUMNS = ["product_id", "product_name", "category", "price"]
DIM_CUSTOMER_COLUMNS = ["customer_id", "customer_name", "email", "region", "join_date", "loyalty_points"]
DIM_DATE_COLUMNS = [f.name for f in DIM_DATE.fields]
