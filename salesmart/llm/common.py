"""Helpers shared by the operators: tables, text rules, staged tables, checked broadcasts."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.session import write_stage

#: Words of the decontamination and licence contracts: runs of ASCII letters, digits and any non-ASCII character.
WORD_CLASS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only.  Pure ASCII text takes the fast ``lower``; the rest is mapped letter by letter."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def remainder(doc_id: Column, mod: int) -> Column:
    """crc32 of the id written as text, modulo ``mod``; null ids have none."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(mod)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: ``df`` as a Parquet table in the shared folder, read back."""
    return write_stage(df, f"llm-{name}")


def bounded(df: DataFrame, max_rows: int) -> DataFrame:
    """``df`` (a staged, narrow table) with a broadcast hint only if it holds at most ``max_rows`` rows.

    Beyond the bound the join stays a shuffle join with the same rows."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def raw_bytes(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    """A text column as UTF-8 bytes."""
    return batch.column(batch.schema.get_field_index(name)).cast(pa.binary()).to_pylist()


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Cut batches of documents into small ones, so that a task holds few texts as Python objects at a time."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)
    pa.default_memory_pool().release_unused()


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str], rows: int = 50_000) -> Iterator[pa.Table]:
    """Re-cut batches that are sorted by ``keys`` into tables of at least ``rows`` rows that never split a key."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        n += batch.num_rows
        if n < rows:
            continue
        t = pa.Table.from_batches(held).combine_chunks()
        last = [t.column(k)[t.num_rows - 1] for k in keys]
        cut = t.num_rows  # the last key may go on in the next batch
        lo = 0
        while lo < cut:  # binary search of the first row with the last key
            mid = (lo + cut) // 2
            if all(t.column(k)[mid] == v for k, v in zip(keys, last, strict=True)):
                cut = mid
            else:
                lo = mid + 1
        if cut:
            yield t.slice(0, cut)
        held = t.slice(cut).to_batches()
        n = t.num_rows - cut
    if held:
        yield pa.Table.from_batches(held).combine_chunks()
