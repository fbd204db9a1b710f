"""The mart's five analytical queries.

All amounts use exact decimal arithmetic: ``quantity * price * (1 - discount)``
is summed as ``decimal(38,4)`` and only the result is rounded to cents.
A product dimension that fits is broadcast and the lines are aggregated after
the join.  One that does not would have every fact line shuffled on a key of
which ``Unknown`` is hot, so the lines are summed per product first; as the
price depends on the product only, the sums are the same exact decimals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..constants import HIGH_VALUE_THRESHOLD, TOP_N
from ..functions.money import money, net_amount
from .joins import fits_broadcast, join_dim


def _with_net(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    f = fact.select("product_id", "region", "date_key", "quantity", "discount")
    p = dim_product.select("product_id", "product_name", "category", "price")
    j = join_dim(f, p, "product_id")
    return j.withColumn("net", net_amount(F.col("quantity"), F.col("price"), F.col("discount")))


def _net_sums(fact: DataFrame, dim_product: DataFrame, *keys: str) -> DataFrame:
    """Rows with ``keys``, the product's columns and ``net``, which sum to the net sales of any grouping of them."""
    if fits_broadcast(dim_product):
        return _with_net(fact, dim_product)
    units = F.col("quantity").cast("decimal(10,0)") * (1 - F.coalesce(F.col("discount"), F.lit(0).cast("decimal(5,2)")))
    per_product = fact.groupBy("product_id", *keys).agg(F.sum(units).alias("units"))
    p = dim_product.select("product_id", "product_name", "category", "price")
    return join_dim(per_product, p, "product_id").withColumn("net", F.col("units") * F.col("price"))


def sales_by_region_category(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Query 1: net sales by region and category."""
    return (_net_sums(fact, dim_product, "region").groupBy("region", "category")
            .agg(money(F.sum("net")).alias("total_sales"))
            .orderBy("region", "category"))


def top_products_by_revenue(fact: DataFrame, dim_product: DataFrame, n: int = TOP_N) -> DataFrame:
    """Query 2: top-n product names by net revenue (name breaks ties)."""
    return (_net_sums(fact, dim_product).groupBy("product_name")
            .agg(money(F.sum("net")).alias("total_revenue"))
            .orderBy(F.desc("total_revenue"), F.asc("product_name")).limit(n))


def monthly_trend(fact: DataFrame, dim_product: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Query 3: net sales by calendar year and month (star join)."""
    d = dim_date.select("date_key", "year", "month")
    j = join_dim(_net_sums(fact, dim_product, "date_key"), d, "date_key")
    return (j.groupBy("year", "month").agg(money(F.sum("net")).alias("monthly_sales"))
            .orderBy("year", "month"))


def avg_discount_by_region(fact: DataFrame) -> DataFrame:
    """Query 4: mean discount in percent per region, a null discount counting as 0."""
    return (fact.groupBy("region")
            .agg(F.round(F.avg(F.coalesce(F.col("discount"), F.lit(0))) * 100, 2)
                 .cast("decimal(18,2)").alias("avg_discount_percentage"))
            .orderBy("region"))


def high_value_lines(fact: DataFrame, dim_product: DataFrame,
                     threshold: int = HIGH_VALUE_THRESHOLD) -> DataFrame:
    """Query 5: number of fact lines whose net value exceeds the threshold."""
    j = _with_net(fact, dim_product)
    return j.agg(F.count_if(F.col("net") > threshold).alias("high_value_transactions"))
