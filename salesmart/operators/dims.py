"""Dimension generators and seeds."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import constants as K
from ..schemas import DIM_DATE_COLUMNS


# The unknown members' keys, by key column.
UNKNOWN_KEYS = {"customer_id": K.UNKNOWN_CUSTOMER[0], "product_id": K.UNKNOWN_PRODUCT[0], "date_key": K.UNKNOWN_DATE[0]}


def _ts(value: dt.datetime):
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def unknown_customer(spark: SparkSession, ts: dt.datetime) -> DataFrame:
    cid, name, email, region, join_date, points = K.UNKNOWN_CUSTOMER
    return spark.range(1).select(
        F.lit(cid).alias("customer_id"), F.lit(name).alias("customer_name"), F.lit(email).alias("email"),
        F.lit(region).alias("region"), F.lit(join_date).cast("int").alias("join_date"),
        F.lit(points).cast("int").alias("loyalty_points"), _ts(ts).alias("created_at"), _ts(ts).alias("updated_at"))


def unknown_product(spark: SparkSession, ts: dt.datetime) -> DataFrame:
    pid, name, category, price = K.UNKNOWN_PRODUCT
    return spark.range(1).select(
        F.lit(pid).alias("product_id"), F.lit(name).alias("product_name"), F.lit(category).alias("category"),
        F.lit(price).cast("decimal(10,2)").alias("price"), _ts(ts).alias("created_at"), _ts(ts).alias("updated_at"))


def unknown_date(spark: SparkSession) -> DataFrame:
    key, full, year, month, month_name, day, quarter = K.UNKNOWN_DATE
    return spark.range(1).select(
        F.lit(key).cast("int").alias("date_key"), F.lit(full).alias("full_date"),
        F.lit(year).cast("int").alias("year"), F.lit(month).cast("int").alias("month"),
        F.lit(month_name).alias("month_name"), F.lit(day).cast("int").alias("day"),
        F.lit(quarter).cast("int").alias("quarter"))


def calendar(spark: SparkSession, start: dt.date = K.DIM_DATE_START, end: dt.date = K.DIM_DATE_END) -> DataFrame:
    """One row per day in [start, end] with calendar attributes.

    ``spark.range`` spreads the days over tasks; the size is fixed by the range
    (7,670 days for 2010-2030), not by any input.
    """
    days = (end - start).days + 1
    d = F.date_add(F.lit(start), F.col("id").cast("int"))
    return spark.range(days).select(d.alias("full_date")).select(
        (F.year("full_date") * 10000 + F.month("full_date") * 100 + F.dayofmonth("full_date"))
        .cast("int").alias("date_key"),
        "full_date",
        F.year("full_date").alias("year"),
        F.month("full_date").alias("month"),
        F.date_format("full_date", "MMMM").alias("month_name"),
        F.dayofmonth("full_date").alias("day"),
        F.quarter("full_date").alias("quarter"),
    )


def dim_date(spark: SparkSession, with_unknown: bool = True) -> DataFrame:
    cal = calendar(spark)
    return (unknown_date(spark).unionByName(cal) if with_unknown else cal).select(*DIM_DATE_COLUMNS)


def vw_dim_date(dim: DataFrame, date_from: dt.date = K.VIEW_DATE_FROM) -> DataFrame:
    """The reporting view: drops the unknown member."""
    return dim.filter(F.col("full_date") >= F.lit(date_from))


def seed_unknown(target: DataFrame, unknown: DataFrame, key: str) -> DataFrame:
    """Add the unknown member once: ``unknown ▷ target`` on the key, then append."""
    # Only the target's rows with the unknown key can match; the filter keeps the rest out of the join.
    present = target.select(key).filter(F.col(key) == F.lit(UNKNOWN_KEYS[key])).limit(1)
    missing = unknown.join(present, key, "left_anti")
    return target.unionByName(missing)


def is_populated(target: DataFrame) -> bool:
    """Load guard: more than the single unknown row present (A19). Reads at most two rows."""
    return len(target.select(F.lit(1)).limit(2).collect()) > 1


def populate_dim_date_if_empty(spark: SparkSession, target: DataFrame) -> tuple[DataFrame, int]:
    """Return (new target, rows inserted): generate the calendar only for an unpopulated target."""
    if is_populated(target):
        return target, 0
    cal = calendar(spark)
    return target.unionByName(cal.select(*target.columns)), (K.DIM_DATE_END - K.DIM_DATE_START).days + 1


def date_bounds(dim: DataFrame) -> DataFrame:
    """Min and max date of a generated dimension."""
    return dim.agg(F.min("full_date").alias("min_date"), F.max("full_date").alias("max_date"),
                   F.count(F.lit(1)).alias("n_days"))
