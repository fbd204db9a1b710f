"""Keep-first dedup without windows over raw groups.

"First" is the smallest value of an order column (``_ord``): the source
position for file input (one long in the load jobs), or the row's own columns for the fixtures.  Every
operator here is a grouped aggregate with map-side partial aggregation, so a
key holding a third of all rows is reduced on each map task before the
shuffle; no group is ever collected.  Flagging the non-first rows joins the
rows back to their group's first position -- a plain equi-join that AQE can
split when one key is skewed.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..session import write_stage
from .joins import in_bounded_parts, sized_broadcast

ORD = "_ord"
# Largest number of duplicate copies generated by one task when logging rejects.
COPIES_PER_TASK = 100_000


def count_copies(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per distinct ``cols`` tuple with its copy count ``_n`` and first position."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    if ORD in df.columns:
        aggs.append(F.min(ORD).alias(ORD))
    return df.groupBy(*cols).agg(*aggs)


def extra_copies(groups: DataFrame, cols: Sequence[str]) -> DataFrame:
    """All copies after the first of each group, numbered from 2 (``_copy``).

    With a column ``_before`` (copies met earlier) the numbers go on from there, and all copies of a group met earlier count.
    A group's extra copies are generated in chunks of ``COPIES_PER_TASK``; the
    chunk rows are spread over tasks before they are expanded, so a single
    massively duplicated row does not produce its copies in one task.
    """
    keep = [*cols, *([ORD] if ORD in groups.columns else [])]
    before = F.col("_before") if "_before" in groups.columns else F.lit(0)
    numbered = groups.select(*keep, F.greatest(before + 1, F.lit(2)).alias("_from"), (before + F.col("_n")).alias("_to"))
    chunks = (numbered.filter(F.col("_to") >= F.col("_from"))
              .select(*keep, "_from", "_to", F.explode(F.sequence(F.lit(0), F.floor((F.col("_to") - F.col("_from")) / COPIES_PER_TASK)))
                      .alias("_chunk")))
    spread = chunks.repartition(F.col("_chunk"), *[F.col(c) for c in cols])  # a null or blank first column is no hot key here
    lo = F.col("_from") + F.col("_chunk") * COPIES_PER_TASK
    hi = F.least(F.col("_to"), lo + COPIES_PER_TASK - 1)
    return spread.select(*keep, F.explode(F.sequence(lo, hi)).alias("_copy"))


def first_positions(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Smallest ``_ord`` per key (nulls in keys form their own group)."""
    return df.groupBy(*keys).agg(F.min(ORD).alias("_first"))


def flag_first(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add ``_is_first``: the row holds its key's smallest ``_ord``.

    Keys compare null-safely, as a null key value forms one group.
    """
    firsts = first_positions(df, keys)
    right = firsts.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_first")
    cond = None
    for i, k in enumerate(keys):
        c = df[k].eqNullSafe(right[f"_k{i}"])
        cond = c if cond is None else cond & c
    joined = df.join(right, cond, "inner")
    return (joined.withColumn("_is_first", F.col(ORD) == F.col("_first"))
            .drop("_first", *[f"_k{i}" for i in range(len(keys))]))


def with_first(df: DataFrame, shared: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` with its key's least place ``_first`` from ``shared``; null where no other row has the key."""
    named = shared.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_first", F.lit(True).alias("_shared"))
    cond = reduce(lambda a, b: a & b, [df[k].eqNullSafe(named[f"_k{i}"]) for i, k in enumerate(keys)])
    return df.join(sized_broadcast(named, at_most=shared), cond, "left").drop(*[f"_k{i}" for i in range(len(keys))])


def shared_keys(df: DataFrame, keys: Sequence[str], folder: str, name: str) -> DataFrame:
    """Keys of more than one row, with their least place: a narrow hash aggregate, written to ``folder`` so that its size is known.

    Where few keys are shared, their rows are told apart by a broadcast, and no other row is shuffled or sorted; where many are, the join shuffles.
    """
    counted = df.groupBy(*keys).agg(F.min(ORD).alias("_first"), F.count(F.lit(1)).alias("_rows"))
    return write_stage(counted.filter("_rows > 1").select(*keys, "_first"), name, folder)


def shared_hashes(df: DataFrame, key_hash: Column, folder: str, name: str, met: DataFrame | None = None) -> DataFrame:
    """The hashes ``_h`` that more than one row of ``df`` has, or one row of it and a row of ``met``, whose only column ``_h`` is.

    Only hashes are shuffled, a few bytes a row however wide rows and keys are.  Rows of a hash that is not here are surely alone with their key;
    the others, whose keys may differ all the same, are still to be compared.
    """
    hashes = df.select(key_hash.alias("_h"))
    if met is not None:
        hashes = hashes.select("_h", F.lit(1).alias("_own")).unionByName(met.select("_h", F.lit(None).cast("int").alias("_own")))
    counted = in_bounded_parts(hashes, "_h").groupBy("_h").agg(F.count(F.lit(1)).alias("_rows"), *([] if met is None else [F.count("_own").alias("_own")]))
    return write_stage(counted.filter("_rows > 1" if met is None else "_rows > 1 and _own > 0").select("_h"), name, folder)


def flag_first_of_shared(df: DataFrame, shared: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``flag_first`` by the keys that ``shared_keys`` has found; a row of a key of its own is its first, unless it has no place."""
    return with_first(df, shared, keys).withColumn("_is_first", F.col(ORD) == F.coalesce("_first", ORD)).drop("_first", "_shared")


def first_row_per_key(df: DataFrame, keys: Sequence[str], values: Sequence[str], one_pass: bool = False) -> DataFrame:
    """The values of each key's first row.

    A long ``_ord`` is a row's own place, which no other row has: the least place of a key is found by a hash
    aggregate of keys and places alone, and the rows at these places by a semi join, whose keys are never skewed; ``df``
    is read twice, so it should be a staged table.  Of any other order, or in ``one_pass``, it is one aggregate, ``min(struct(_ord, values))``, which sorts.
    """
    if not one_pass and isinstance(df.schema[ORD].dataType, T.LongType):
        first = df.groupBy(*keys).agg(F.min(ORD).alias(ORD)).select(ORD)
        return df.join(first, ORD, "left_semi").select(*keys, *values, ORD)
    agg = df.groupBy(*keys).agg(F.min(F.struct(F.col(ORD).alias("o"), *[F.col(v) for v in values])).alias("_m"))
    return agg.select(*keys, *[F.col(f"_m.{v}").alias(v) for v in values], F.col("_m.o").alias(ORD))


def with_places(df: DataFrame, folder: str) -> DataFrame:
    """A source order (file, block, position) as one long with the same order, so that its least value is a hash aggregate.

    A block's places start after all of the blocks before it; the blocks' starts are a small table of their own in ``folder``.
    Any other order, or none, is left as it is.
    """
    if ORD not in df.columns or not isinstance(df.schema[ORD].dataType, T.StructType) or df.schema[ORD].dataType.fieldNames() != ["file", "block", "position"]:
        return df
    file, block, position = (F.col(f"{ORD}.{c}") for c in ("file", "block", "position"))
    blocks = df.groupBy(file.alias("_file"), block.alias("_block")).agg((F.max(position) + 1).alias("_n"))
    earlier = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = write_stage(blocks.select("_file", "_block", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start")), "starts", folder)
    placed = df.join(sized_broadcast(starts), (file == F.col("_file")) & (block == F.col("_block")))
    return placed.withColumn(ORD, F.col("_start") + position).drop("_file", "_block", "_start")
