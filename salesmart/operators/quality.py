"""Bad-data log and run counters.

A row can break several rules; each broken rule becomes one log row.  The
rules of one pass are evaluated together: every row carries an array of
issue structs (null where the rule holds), and one ``explode`` turns the
non-null entries into log rows -- a single scan instead of one per rule.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..constants import ISSUES
from ..schemas import BAD_DATA_LOG

LOG_COLUMNS = [f.name for f in BAD_DATA_LOG.fields]


def issue(key: str) -> Column:
    col, kind, note = ISSUES[key]
    return F.struct(F.lit(col).alias("bad_column"), F.lit(kind).alias("issue_type"), F.lit(note).alias("notes"))


def issue_when(cond: Column, key: str) -> Column:
    """The issue struct where ``cond`` holds, else null."""
    return F.when(F.coalesce(cond, F.lit(False)), issue(key))


def record_json(cols: Sequence[str]) -> Column:
    """The row as JSON text, nulls kept as ``null``."""
    return F.to_json(F.struct(*[F.col(c) for c in cols]), {"ignoreNullFields": "false"})


def log_rows(df: DataFrame, issues: Column, record_id: Column, original: Column,
             run_id: str, run_ts: Column, source: str, copy_no: Column | None = None) -> DataFrame:
    """Explode an array of issue structs into bad-data log rows."""
    copy_no = copy_no if copy_no is not None else F.lit(1)
    exploded = df.select(record_id.alias("record_id"), original.alias("original_record"),
                         copy_no.cast("string").alias("_copy"),
                         F.explode(F.filter(issues, lambda x: x.isNotNull())).alias("_i"))
    return exploded.select(
        F.sha2(F.concat_ws("|", F.lit(run_id), F.lit(source), F.col("_i.bad_column"), F.col("_i.issue_type"),
                           F.col("original_record"), F.col("_copy")), 256).alias("log_id"),
        run_ts.alias("etl_run_id"),
        F.lit(source).alias("source_system"),
        F.col("record_id"),
        F.col("_i.bad_column").alias("bad_column"),
        F.col("_i.issue_type").alias("issue_type"),
        F.col("original_record"),
        F.col("_i.notes").alias("notes"),
    )


def summary(log: DataFrame) -> DataFrame:
    """Log rows per run, source, column and issue (the log's index access pattern)."""
    return (log.groupBy("etl_run_id", "source_system", "bad_column", "issue_type")
            .agg(F.count(F.lit(1)).alias("n_rows")))


def fold_rows(*frames: DataFrame) -> DataFrame:
    """Combine single-row frames with disjoint columns into one row (no join)."""
    stacked = frames[0]
    for f in frames[1:]:
        stacked = stacked.unionByName(f, allowMissingColumns=True)
    cols = []
    for f in frames:
        cols.extend(c for c in f.columns if c not in cols)
    return stacked.agg(*[F.max(c).alias(c) for c in cols])
