"""Spark-native sales data mart.

Cleans nested sales JSON and customer JSON, logs every bad record, builds a
star schema with incremental upserts and integrity checks, and answers the
mart's analytical queries and dashboard measures -- all as DataFrame plans.
"""

__all__ = ["session", "constants", "schemas"]
