"""Dimension joins with a checked broadcast.

A side is broadcast only when the optimizer's own size estimate is below a
bound; otherwise the join is left to Spark's shuffle join, where AQE can still
switch to a broadcast from runtime statistics and split skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Upper bound for an explicit broadcast: estimated (on-disk) bytes; in memory a side may be a few times larger.
BROADCAST_LIMIT_BYTES = 32 * 1024 * 1024


def estimated_size(df: DataFrame) -> int:
    """Catalyst's size estimate of ``df`` in bytes (no job is run).

    Without column statistics the inputs of a join are multiplied, so the
    estimate of a joined side is far too high and never too low.
    """
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return size if isinstance(size, int) else int(str(size))


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> bool:
    return estimated_size(df) <= limit


def sized_broadcast(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES, at_most: DataFrame | None = None) -> DataFrame:
    """``broadcast(df)`` when its estimated size is within ``limit``, else ``df`` unchanged.

    at_most: a frame that is known to have at least as many and as wide rows,
    such as the table that ``df`` is a many-to-one lookup on; its estimate is then used.
    """
    return F.broadcast(df) if fits_broadcast(df if at_most is None else at_most, limit) else df


def join_dim(fact: DataFrame, dim: DataFrame, on: str | list[str] | Column, how: str = "inner",
             limit: int = BROADCAST_LIMIT_BYTES, at_most: DataFrame | None = None) -> DataFrame:
    """Join a fact to a dimension, broadcasting the dimension only when its size is checked small."""
    return fact.join(sized_broadcast(dim, limit, at_most), on, how)


#: Estimated bytes of the rows that one task of ``in_bounded_parts`` takes.
PART_BYTES = 2 << 20


def in_bounded_parts(df: DataFrame, *keys: str, part_bytes: int = PART_BYTES) -> DataFrame:
    """Rows dealt by ``keys`` to as many tasks as their size asks for, if the session's number of partitions is too small.

    That number is fixed, so without it the rows that one task sorts grow with the table; joins and groups on the keys keep the dealing.
    """
    spark = df.sparkSession
    parts = -(-estimated_size(df) // part_bytes)
    return df.repartition(parts, *keys) if parts > int(spark.conf.get("spark.sql.shuffle.partitions")) else df
