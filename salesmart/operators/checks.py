"""Integrity checks: the target tables' constraints re-aimed as Spark jobs.

Each check returns a small report frame (one row per table/column/constraint)
built from one aggregate per table; nothing is collected to the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from .joins import sized_broadcast


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def pk_duplicates(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Number of key values held by more than one row, per table."""
    rows = []
    for name, (df, keys) in tables.items():
        dup = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
        rows.append(dup.agg(F.count(F.lit(1)).alias("duplicate_keys"),
                            F.coalesce(F.sum(F.col("_n")), F.lit(0)).cast("bigint").alias("rows_involved"))
                    .select(F.lit(name).alias("table_name"), F.lit(",".join(keys)).alias("key_columns"),
                            "duplicate_keys", "rows_involved"))
    return _union(rows)


def not_null(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Null count per NOT NULL column (one aggregate per table, then unpivoted)."""
    rows = []
    for name, (df, cols) in tables.items():
        counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
        long = counts.unpivot([], list(cols), "column_name", "null_count")
        rows.append(long.select(F.lit(name).alias("table_name"), "column_name", "null_count"))
    return _union(rows)


def fk_orphans(fact: DataFrame, refs: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Fact rows whose foreign key has no parent row, per foreign key; a null key refers to nothing and is none.

    The fact is read once: all parents are left-joined, then each flag is counted.
    """
    j = fact.select(*{col: F.col(col) for _, col in refs.values()}.values())
    for i, (parent, col) in enumerate(refs.values()):
        keys = parent.filter(F.col(col).isNotNull()).select(F.col(col).alias(f"_k{i}")).distinct()
        j = j.join(sized_broadcast(keys, at_most=parent), F.col(col) == F.col(f"_k{i}"), "left")
    aggs = []
    for i, (name, (_, col)) in enumerate(refs.items()):
        orphan = F.col(col).isNotNull() & F.col(f"_k{i}").isNull()
        aggs.append(F.struct(F.lit(name).alias("fk_name"), F.count_if(orphan).alias("orphan_rows"),
                             F.count_distinct(F.when(orphan, F.col(col))).alias("orphan_keys")))
    return j.agg(F.array(*aggs).alias("_a")).select(F.explode("_a").alias("_c")).select("_c.*")


def ranges(fact: DataFrame) -> DataFrame:
    """I4: CHECK quantity >= 0 and discount >= 0."""
    return fact.agg(F.count_if(F.col("quantity") < 0).alias("negative_quantity"),
                    F.count_if(F.col("discount") < 0).alias("negative_discount"),
                    F.count(F.lit(1)).alias("rows_checked"))


def widths(tables: Mapping[str, tuple[DataFrame, Mapping[str, int]]]) -> DataFrame:
    """Values longer than the column's declared width, per column."""
    rows = []
    for name, (df, limits) in tables.items():
        aggs = []
        for c, n in limits.items():
            aggs.append(F.struct(F.lit(c).alias("column_name"), F.lit(n).alias("max_width"),
                                 F.count_if(F.length(c) > n).alias("over_width"),
                                 F.max(F.length(c)).alias("longest")))
        one = df.agg(F.array(*aggs).alias("_a"))
        rows.append(one.select(F.explode("_a").alias("_c"))
                    .select(F.lit(name).alias("table_name"), "_c.column_name", "_c.max_width",
                            "_c.over_width", "_c.longest"))
    return _union(rows)


def decimal_ranges(tables: Mapping[str, tuple[DataFrame, Mapping[str, tuple[int, int]]]]) -> DataFrame:
    """Numbers that do not fit their decimal column once rounded to its scale, per column."""
    rows = []
    for name, (df, limits) in tables.items():
        aggs = []
        for c, (p, s) in limits.items():
            aggs.append(F.struct(F.lit(c).alias("column_name"), F.lit(p).alias("precision"), F.lit(s).alias("scale"),
                                 F.count_if(F.abs(F.round(F.col(c).cast("double"), s)) >= 10.0 ** (p - s)).alias("out_of_range")))
        one = df.agg(F.array(*aggs).alias("_a"))
        rows.append(one.select(F.explode("_a").alias("_c")).select(F.lit(name).alias("table_name"), "_c.*"))
    return _union(rows)
