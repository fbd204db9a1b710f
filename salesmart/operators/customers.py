"""Customer flow: defaults, dedup, cleaning, routing, schema enforcement.

Order follows the source package: dedup runs on the *raw* strings, then the
column rules, then the blank-id split, then schema enforcement.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..constants import UNKNOWN
from ..functions.text import ssis_blank
from ..schemas import CUSTOMER_COLUMNS

# Keep-first order among rows sharing an id: the full-row sort keys after the id.
FIRST_ORDER = ["loyalty_points", "join_date", "region", "email", "customer_name"]


def source_defaults(raw: DataFrame) -> DataFrame:
    """S3: a null string becomes ``''``; null points become ``'0'``."""
    return raw.select(*[F.coalesce(F.col(c), F.lit("0" if c == "loyalty_points" else "")).alias(c)
                        for c in CUSTOMER_COLUMNS])


def dedup_full(df: DataFrame) -> DataFrame:
    """Identical rows collapse to one (hash aggregate with map-side combine)."""
    return df.distinct()


def dedup_by_id(df: DataFrame) -> DataFrame:
    """One row per id, the first in (points, date, region, email, name) byte order.

    ``min(struct)`` per id is a partial/final aggregate: a hot id is reduced on
    each map task before the shuffle, and no group is ever materialised.
    """
    first = df.groupBy("customer_id").agg(F.min(F.struct(*FIRST_ORDER)).alias("_f"))
    return first.select("customer_id", *[F.col(f"_f.{c}").alias(c) for c in FIRST_ORDER]).select(*CUSTOMER_COLUMNS)


def clean_name(c: Column) -> Column:
    """C14: blank -> Unknown; longer than 255 -> cut."""
    return F.when(ssis_blank(c), F.lit(UNKNOWN)).when(F.length(c) > 255, F.substring(c, 1, 255)).otherwise(c)


def clean_region(c: Column) -> Column:
    """Blank -> Unknown."""
    return F.when(ssis_blank(c), F.lit(UNKNOWN)).otherwise(c)


def clean_email(c: Column) -> Column:
    """Blank -> Unknown; no ``@`` -> invalid; longer than 320 -> cut."""
    return (F.when(ssis_blank(c), F.lit(UNKNOWN)).when(F.instr(c, "@") == 0, F.lit("invalid"))
            .when(F.length(c) > 320, F.substring(c, 1, 320)).otherwise(c))


def clean_loyalty(c: Column, strict: bool = True) -> Column:
    """C17: blank -> '0'; negative -> '0'.  A non-numeric value fails the run when strict."""
    n = c.try_cast("int")
    bad = F.raise_error(F.concat(F.lit("loyalty_points is not an integer: "), c)) if strict else F.lit("0")
    return (F.when(ssis_blank(c), F.lit("0")).when(n.isNull(), bad)
            .when(n < 0, F.lit("0")).otherwise(c))


def clean_join_date(c: Column) -> Column:
    """Blank or without ``-``/``/`` -> 19900101; else the first 10 chars without separators."""
    no_sep = (F.instr(c, "-") == 0) & (F.instr(c, "/") == 0)
    cut = F.replace(F.replace(F.left(c, F.lit(10)), F.lit("-"), F.lit("")), F.lit("/"), F.lit(""))
    return (F.when(ssis_blank(c) | no_sep, F.lit("19900101"))
            .when(F.length(c) >= 10, cut).otherwise(F.lit("19900101")))


def clean_columns(df: DataFrame, strict: bool = True, *keep: str) -> DataFrame:
    return df.select(
        *keep,
        "customer_id",
        clean_name(F.col("customer_name")).alias("customer_name"),
        clean_email(F.col("email")).alias("email"),
        clean_region(F.col("region")).alias("region"),
        clean_join_date(F.col("join_date")).alias("join_date"),
        clean_loyalty(F.col("loyalty_points"), strict).alias("loyalty_points"),
    )


def valid_id(c: Column) -> Column:
    """The id is not blank after trimming spaces."""
    return F.coalesce(F.length(F.trim(c)) > 0, F.lit(False))


def route(df: DataFrame) -> DataFrame:
    """One route column; each output is a ``filter`` on it."""
    return df.withColumn("route", F.when(valid_id(F.col("customer_id")), F.lit("valid"))
                         .otherwise(F.lit("blank_id")))


def target_columns(strict: bool = True) -> list[Column]:
    """C20 as columns over a cleaned row: cut to the target widths and cast to int (strict: a bad int fails the run)."""
    def to_int(c: str) -> Column:
        col = F.col(c)
        n = col.try_cast("int")
        if strict:
            return F.when(col.isNotNull() & n.isNull(),
                          F.raise_error(F.concat(F.lit(f"{c} is not an integer: "), col))).otherwise(n)
        return F.coalesce(n, F.lit(19900101 if c == "join_date" else 0))

    return [
        F.substring("customer_id", 1, 50).alias("customer_id"),
        F.substring("customer_name", 1, 255).alias("customer_name"),
        F.substring("email", 1, 320).alias("email"),
        F.substring("region", 1, 50).alias("region"),
        to_int("join_date").cast("int").alias("join_date"),
        to_int("loyalty_points").cast("int").alias("loyalty_points"),
    ]


def enforce_schema(df: DataFrame, strict: bool = True) -> DataFrame:
    """C20 on a frame of cleaned rows."""
    return df.select(*target_columns(strict))


def prepare_customers(raw: DataFrame, strict: bool = True) -> DataFrame:
    """Raw customer rows -> rows ready for the dimension lookup."""
    df = dedup_by_id(dedup_full(source_defaults(raw)))
    df = clean_columns(df, strict)
    df = df.filter(valid_id(F.col("customer_id")))
    return enforce_schema(df, strict)


def blank_id_rejects(raw: DataFrame, strict: bool = True) -> DataFrame:
    """Rows the valid-id split drops (after dedup and cleaning), for the bad-data log."""
    df = clean_columns(dedup_by_id(dedup_full(source_defaults(raw))), strict)
    return df.filter(~valid_id(F.col("customer_id")))


def bad_numbers() -> tuple[Column, Column]:
    """Whether a raw row's points, and its cut join date, are no integers."""
    points = F.col("loyalty_points")
    return (~ssis_blank(points) & points.try_cast("int").isNull(),
            clean_join_date(F.col("join_date")).try_cast("int").isNull())


def routed(raw: DataFrame, strict: bool = True) -> DataFrame:
    """The whole flow in one frame, to be written once and read by ``route``.

    ``raw`` holds a row as it came, ``clean`` after the column rules, ``target`` in the dimension's types (valid rows only);
    ``_points_bad`` and ``_join_date_bad`` mark the numbers that lenient mode replaces.
    """
    points_bad, jd_bad = bad_numbers()
    df = dedup_by_id(dedup_full(source_defaults(raw)))
    df = df.withColumns({"_points_bad": points_bad, "_join_date_bad": jd_bad, "raw": F.struct(*CUSTOMER_COLUMNS)})
    cleaned = clean_columns(df, strict, "raw", "_points_bad", "_join_date_bad")
    df = route(cleaned.withColumn("clean", F.struct(*CUSTOMER_COLUMNS)))
    target = F.when(F.col("route") == "valid", F.struct(*target_columns(strict)))
    return df.select("raw", "clean", target.alias("target"), "_points_bad", "_join_date_bad", "route")


def invalid_numbers(raw: DataFrame) -> DataFrame:
    """Rows kept by the flow whose points or cut join date are not integers (raw values).

    Strict mode fails on them; lenient mode replaces them with 0 / 19900101
    and logs these rows (``_points_bad``, ``_join_date_bad`` say which rule).
    """
    df = dedup_by_id(dedup_full(source_defaults(raw)))
    points_bad, jd_bad = bad_numbers()
    return (df.filter(valid_id(F.col("customer_id")) & (points_bad | jd_bad))
            .select(*CUSTOMER_COLUMNS, points_bad.alias("_points_bad"), jd_bad.alias("_join_date_bad")))
