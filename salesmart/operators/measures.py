"""Dashboard measures and visuals.

Measures use the *gross* line amount ``quantity * price`` (no discount), as
the dashboard does.  Every measure is a declarative aggregate; the YTD
running totals run over per-day (or per-month) aggregates, so the window
sorts at most 366 rows per year regardless of the fact size.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..constants import HIGH_VALUE_THRESHOLD, TOP_N
from ..functions.money import gross_amount, money
from .joins import join_dim


def with_gross(fact: DataFrame, dim_product: DataFrame, extra: Iterable[str] = ()) -> DataFrame:
    """Fact lines with the related product (left lookup: a missing product is blank)."""
    cols = ["transaction_id", "product_id", "customer_id", "date_key", "quantity", "region", *extra]
    f = fact.select(*dict.fromkeys(cols))
    p = dim_product.select("product_id", "product_name", "category", "price")
    j = join_dim(f, p, "product_id", "left")
    return j.withColumn("gross", gross_amount(F.col("quantity"), F.col("price")))


def total_sales(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Total Sales = sum of quantity * related price."""
    return with_gross(fact, dim_product).agg(money(F.sum("gross")).alias("total_sales"))


def per_transaction(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Gross total per transaction: one grouped aggregate with map-side combine."""
    return with_gross(fact, dim_product).groupBy("transaction_id").agg(F.sum("gross").alias("txn_total"))


def avg_sale_per_transaction(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Total sales / distinct transactions; blank (null) when there are none.

    Both numbers come from the per-transaction totals, so there is no
    distinct-count aggregate (which Spark would expand row by row).
    """
    t = per_transaction(fact, dim_product)
    return t.agg(money(F.try_divide(F.sum("txn_total"), F.count(F.col("transaction_id"))))
                 .alias("avg_sale_per_transaction"))


def total_loyalty_points(dim_customer: DataFrame) -> DataFrame:
    return dim_customer.agg(F.sum(F.col("loyalty_points").cast("bigint")).alias("total_loyalty_points"))


def high_value_transactions(fact: DataFrame, dim_product: DataFrame,
                            threshold: int = HIGH_VALUE_THRESHOLD) -> DataFrame:
    """Transactions whose gross total exceeds the threshold: two-level aggregation."""
    return per_transaction(fact, dim_product).agg(
        F.count_if(F.col("txn_total") > threshold).alias("high_value_transactions"))


def total_customers(fact: DataFrame) -> DataFrame:
    """Distinct customer ids; a blank id counts as one more value."""
    c = fact.select("customer_id")
    return c.agg((F.count_distinct("customer_id")
                  + F.max(F.col("customer_id").isNull().cast("int")).cast("bigint"))
                 .alias("total_customers"))


def kpi_cards(fact: DataFrame, dim_product: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """The KPI card row: total sales, average per transaction, loyalty, high-value count, customers.

    Gross total, transaction count and the high-value count all come from one
    per-transaction grouping; customers are one more grouping; loyalty reads
    the customer dimension.  The one-row results are stacked and folded.
    """
    t = per_transaction(fact, dim_product).agg(
        F.sum("txn_total").alias("gross"), F.count(F.col("transaction_id")).alias("n_txn"),
        F.count_if(F.col("txn_total") > HIGH_VALUE_THRESHOLD).alias("high_value_transactions"))
    c = total_customers(fact)
    lp = total_loyalty_points(dim_customer)
    stacked = t.unionByName(c, allowMissingColumns=True).unionByName(lp, allowMissingColumns=True)
    row = stacked.agg(*[F.max(x).alias(x) for x in
                        ("gross", "n_txn", "total_customers", "high_value_transactions", "total_loyalty_points")])
    return row.select(money(F.col("gross")).alias("total_sales"),
                      money(F.try_divide(F.col("gross"), F.col("n_txn"))).alias("avg_sale_per_transaction"),
                      "total_loyalty_points", "high_value_transactions", "total_customers")


def _dated(fact: DataFrame, dim_product: DataFrame, vw_date: DataFrame, extra: Iterable[str] = ()) -> DataFrame:
    """Gross lines with year/month from the reporting view (left join: a blank date group is kept)."""
    d = vw_date.select("date_key", "year", "month", "full_date")
    return join_dim(with_gross(fact, dim_product, extra), d, "date_key", "left")


def monthly_sales_trend(fact: DataFrame, dim_product: DataFrame, vw_date: DataFrame) -> DataFrame:
    return (_dated(fact, dim_product, vw_date).groupBy("year", "month")
            .agg(money(F.sum("gross")).alias("total_sales")).orderBy("year", "month"))


def top_products(fact: DataFrame, dim_product: DataFrame, n: int = TOP_N) -> DataFrame:
    return (with_gross(fact, dim_product).groupBy("product_name")
            .agg(money(F.sum("gross")).alias("total_sales"))
            .orderBy(F.desc("total_sales"), F.asc("product_name")).limit(n))


def loyalty_by_region(dim_customer: DataFrame) -> DataFrame:
    """Loyalty points per customer region with the share of the total (percent, 6 places)."""
    per = dim_customer.groupBy("region").agg(F.sum(F.col("loyalty_points").cast("bigint")).alias("loyalty_points"))
    # The share's denominator is a window over the per-region rows (one row per region).
    total = F.sum("loyalty_points").over(Window.partitionBy())
    return (per.select("region", "loyalty_points",
                       F.round(F.try_divide(F.col("loyalty_points").cast("double") * 100, total), 6)
                       .cast("decimal(18,6)").alias("share_pct"))
            .orderBy("region"))


def category_trend(fact: DataFrame, dim_product: DataFrame, vw_date: DataFrame) -> DataFrame:
    return (_dated(fact, dim_product, vw_date).groupBy("year", "month", "category")
            .agg(money(F.sum("gross")).alias("total_sales")).orderBy("year", "month", "category"))


def sales_by_region(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    return (with_gross(fact, dim_product).groupBy("region")
            .agg(money(F.sum("gross")).alias("total_sales")).orderBy("region"))


def sales_ytd_daily(fact: DataFrame, dim_product: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Running gross total within each calendar year, per day."""
    daily = (_dated(fact, dim_product, dim_date).groupBy("year", "full_date", "date_key")
             .agg(F.sum("gross").alias("_day")))
    w = Window.partitionBy("year").orderBy("full_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return daily.select("year", "date_key", money(F.col("_day")).alias("daily_sales"),
                        money(F.sum("_day").over(w)).alias("sales_ytd"))


def sales_ytd_monthly(fact: DataFrame, dim_product: DataFrame, dim_date: DataFrame) -> DataFrame:
    monthly = (_dated(fact, dim_product, dim_date).groupBy("year", "month")
               .agg(F.sum("gross").alias("_m")))
    w = Window.partitionBy("year").orderBy("month").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return monthly.select("year", "month", money(F.col("_m")).alias("monthly_sales"),
                          money(F.sum("_m").over(w)).alias("sales_ytd"))


def _any(conditions: Iterable[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out


def filtered_sales(fact: DataFrame, dim_product: DataFrame, vw_date: DataFrame,
                   years=None, months=None, regions=None, products=None, categories=None) -> DataFrame:
    """Dashboard slicers: any subset of year, month, region, product, category.

    Each given slicer adds one ``isin`` filter; filters on fact columns sit
    below the joins so Catalyst pushes them to the scan.  Years and months are
    also given as ranges of ``date_key``, by which the fact table is laid out.
    """
    f = fact
    if years is not None:
        f = f.filter(_any(F.col("date_key").between(y * 10000 + min(months or (1,)) * 100, y * 10000 + max(months or (12,)) * 100 + 31) for y in years))
    if regions is not None:
        f = f.filter(F.col("region").isin(list(regions)))
    if products is not None:
        f = f.filter(F.col("product_id").isin(list(products)))
    j = _dated(f, dim_product, vw_date)
    if years is not None:
        j = j.filter(F.col("year").isin(list(years)))
    if months is not None:
        j = j.filter(F.col("month").isin(list(months)))
    if categories is not None:
        j = j.filter(F.col("category").isin(list(categories)))
    return j.select("transaction_id", "product_id", "customer_id", "date_key", "year", "month", "region",
                    "category", "quantity", "price", money(F.col("gross")).alias("gross_sales"))
