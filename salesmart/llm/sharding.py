"""Contiguous shards of near-equal size, cut from global prefix sums of the documents' bytes.

The documents get one total order: equal texts beside each other (by the SHA-256 of the text), then by id.
A range exchange deals them to partitions along that order.  Each partition's total gives the bytes
before it, a running sum inside the partition gives each row's place among all bytes, and the places are
cut at equal targets.  Only ids and sizes travel, never texts, and the one table that goes to a single
task holds a row for each partition.  Copies of one text are split between partitions by id and row, so
no group of copies lands in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.common import stage

SHARDS = 24
#: Bytes that each document costs beside its text.
OVERHEAD = 8


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, text) -> doc_id, size, text_crc32, print (SHA-256 of the text), uid (tells repeated rows apart once staged)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select("doc_id", (F.octet_length(text) + OVERHEAD).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
                       F.unhex(F.sha2(text, 256)).alias("print"), F.monotonically_increasing_id().alias("uid"))


def running_places(rows: DataFrame, order: list[str]) -> DataFrame:
    """Staged rows with a column size -> the same rows with start (bytes before the row), row (rows before it) and total (all bytes).

    ``order`` must be a total order.  The rows are dealt along it by ranges; a table of one row for each
    partition (no more than the shuffle partitions) is summed up in one task and sent to all others.
    """
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    parts = stage(dealt.withColumn("part", F.spark_partition_id()), "shard-parts")
    totals = parts.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    earlier, all_parts = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1), Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = totals.select("part", F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("bytes_before"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("rows_before"),
                           F.sum("bytes").over(all_parts).alias("total"))
    inside = Window.partitionBy("part").orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = parts.withColumn("end", F.sum("size").over(upto)).withColumn("nth", F.row_number().over(inside))
    placed = summed.join(F.broadcast(before), "part")
    return placed.select(*rows.columns, (F.col("bytes_before") + F.col("end") - F.col("size")).alias("start"), (F.col("rows_before") + F.col("nth") - 1).alias("row"), "total")


def shard_by_bytes(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Documents (doc_id, text, ...) -> one row each: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    size is the UTF-8 bytes of the text plus 8.  A document belongs to the shard in which its middle byte
    falls, so a cut misses its target by at most half a document; a document larger than a shard's share
    may leave neighbouring shards empty.  slot counts the documents of a shard from 0.  law is "bytes";
    grown_shard is null, as growing by a shard moves the cuts.

    Null and empty texts have no bytes (size 8, text_crc32 0).  Null ids come first among equal texts and
    stay null; repeated rows are placed each on their own; other columns are ignored, whatever their
    names; an empty table gives an empty result.
    """
    order = ["print", "doc_id", "uid"]
    placed = running_places(stage(sizes(docs), "shard-sizes"), order)
    shard = F.expr(f"((2 * start + size) * {int(shards)}) div (2 * total)").cast("int")
    numbered = stage(placed.select("doc_id", "size", "text_crc32", "row", shard.alias("shard")), "shard-rows")
    first = numbered.groupBy("shard").agg(F.min("row").alias("first_row"))  # at most one row for each shard
    return numbered.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("row") - F.col("first_row")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
