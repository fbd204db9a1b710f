"""Sales amounts in exact decimal arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def net_amount(quantity: Column, price: Column, discount: Column) -> Column:
    """quantity * price * (1 - discount), a null discount counting as 0."""
    return quantity * price * (F.lit(1) - F.coalesce(discount, F.lit(0)))


def gross_amount(quantity: Column, price: Column) -> Column:
    """quantity * price (the dashboard's "Total Sales" line amount)."""
    return quantity * price


def money(total: Column) -> Column:
    """Round to cents and cast to the report type ``decimal(18,2)``."""
    return F.round(total, 2).cast("decimal(18,2)")
