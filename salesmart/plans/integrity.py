"""Integrity checks of growing tables from a manifest of checked files.

Files of an appending table never change, so what a check has found in one stays true.  Beside each table lies
``_checks``, a table behind a commit log of its own, with rows (file, kind, name, key, n): how many rows a checked file
has, how many break a rule, and which of its keys are held twice or refer to nothing.  A check opens the files that the
manifest does not name yet, and of the older ones only those that, by the key index, may hold a key of the new ones.
Reports are sums over the manifest.

Entries are told apart by (file, kind, name, key): a check that runs beside another one, or again after a dead one, adds
none twice.  A row that referred to nothing is no orphan once its parent is there: the orphans noted are held against
the dimensions as they are when the report is made.  Keys with a null are counted by the null rule, and equal no other key.
"""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from .. import constants as K
from .. import schemas as SC
from ..operators import checks as CK
from ..operators.joins import sized_broadcast
from ..session import path_exists
from ..sources import commits as CM
from ..sources import keyindex as KI

MANIFEST = T.StructType([T.StructField("file", T.StringType()), T.StructField("kind", T.StringType()), T.StructField("name", T.StringType()),
                         T.StructField("key", T.StringType()), T.StructField("n", T.LongType())])
IDENTITY = ["file", "kind", "name", "key"]
ROWS, NULLS, NEGATIVE, WIDE, LONGEST, DUPLICATE, ORPHAN = "rows", "nulls", "negative", "wide", "longest", "duplicate", "orphan"


@dataclass(frozen=True)
class Rules:
    """What a table's rows must hold.  refs: name of a foreign key -> its column."""

    schema: T.StructType
    keys: Sequence[str] = ()
    required: Sequence[str] = ()
    nonnegative: Sequence[str] = ()
    widths: Mapping[str, int] = field(default_factory=dict)
    refs: Mapping[str, str] = field(default_factory=dict)


RULES = {
    "fact_sales": Rules(SC.FACT_SALES, ("transaction_id", "product_id"), K.NOT_NULL["fact_sales"], ("quantity", "discount"), K.WIDTHS["fact_sales"],
                        {"fk_customer": "customer_id", "fk_product": "product_id", "fk_date": "date_key"}),
    "bad_data_log": Rules(SC.BAD_DATA_LOG, (), K.NOT_NULL["bad_data_log"], (), K.WIDTHS["bad_data_log"]),
}


def manifest(spark: SparkSession, table_root: str) -> DataFrame:
    """The findings so far; an unchecked table has none."""
    path = f"{table_root.rstrip('/')}/_checks"
    CM.finish_pending(spark, path)
    held = path_exists(spark, path) and spark.read.schema(MANIFEST).parquet(path)
    return held if held else spark.createDataFrame([], MANIFEST)


def table_files(spark: SparkSession, table_root: str, schema) -> dict[str, str]:
    """Name and path of each file of a table, as Spark lists them."""
    if not path_exists(spark, table_root):
        return {}
    paths = [unquote(p) for p in spark.read.schema(schema).parquet(table_root).inputFiles()]
    return {os.path.basename(p): p for p in paths}


def open_files(spark: SparkSession, table_root: str, schema, paths: Sequence[str]) -> DataFrame:
    """The rows of some files, each with the name of its file."""
    return spark.read.option("basePath", table_root).schema(schema).parquet(*paths).withColumn("file", F.col("_metadata.file_name"))


def _found(kind: str, name: str, n: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), F.lit(name).alias("name"), F.lit("").alias("key"), F.coalesce(n, F.lit(0)).cast("long").alias("n"))


def file_counts(rows: DataFrame, rules: Rules) -> DataFrame:
    """Counts of one aggregate by file; every file has its ``rows`` entry, other entries only if above zero."""
    found = [_found(ROWS, "", F.count(F.lit(1)))]
    found += [_found(NULLS, c, F.count_if(F.col(c).isNull())) for c in rules.required]
    found += [_found(NEGATIVE, c, F.count_if(F.col(c) < 0)) for c in rules.nonnegative]
    for c, width in rules.widths.items():
        found += [_found(WIDE, c, F.count_if(F.length(c) > width)), _found(LONGEST, c, F.max(F.length(c)))]
    each = rows.groupBy("file").agg(F.array(*found).alias("_f")).select("file", F.explode("_f").alias("_f")).select("file", "_f.*")
    return each.filter((F.col("kind") == ROWS) | (F.col("n") > 0))


def orphans(rows: DataFrame, rules: Rules, parents: Mapping[str, DataFrame]) -> list[DataFrame]:
    """Rows by file and key value whose foreign key has no parent; values are summed before they meet the parents."""
    out = []
    for name, column in rules.refs.items():
        held = rows.filter(F.col(column).isNotNull()).groupBy("file", F.col(column).cast("string").alias("key")).agg(F.count(F.lit(1)).alias("n"))
        lost = held.join(sized_broadcast(_parent_keys(parents[name]), at_most=parents[name]), "key", "left_anti")
        out.append(lost.select("file", F.lit(ORPHAN).alias("kind"), F.lit(name).alias("name"), "key", "n"))
    return out


def _parent_keys(parent: DataFrame) -> DataFrame:
    key = F.col(parent.columns[0])
    return parent.filter(key.isNotNull()).select(key.cast("string").alias("key")).distinct()


def duplicates(new: DataFrame, older: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """Of each key of the new files that several rows hold: its rows in every file, new or older, that holds it."""
    whole = lambda df: df.select("file", *keys).na.drop(subset=list(keys)).groupBy("file", *keys).agg(F.count(F.lit(1)).alias("n"))
    held = whole(new)
    if older is not None:
        wanted = new.select(*keys).na.drop().distinct()
        held = held.unionByName(whole(older.select("file", *keys).join(sized_broadcast(wanted, at_most=new), list(keys), "left_semi")))
    several = held.groupBy(*keys).agg(F.sum("n").alias("_n")).filter("_n > 1").drop("_n")
    return held.join(several, list(keys), "left_semi").select("file", F.lit(DUPLICATE).alias("kind"), F.lit("").alias("name"),
                                                              F.to_json(F.struct(*keys)).alias("key"), "n")


def check_table(spark: SparkSession, table_root: str, rules: Rules, parents: Mapping[str, DataFrame]) -> list[str]:
    """Check the files that no earlier check has read and enter the findings into the manifest; returns their names."""
    table_root = table_root.rstrip("/")
    files = table_files(spark, table_root, rules.schema)
    checked = {r.file for r in manifest(spark, table_root).filter(F.col("kind") == ROWS).select("file").collect()}
    names = sorted(set(files) - checked)
    if not names:
        return []
    new = open_files(spark, table_root, rules.schema, [files[n] for n in names])
    found = [file_counts(new, rules), *orphans(new, rules, parents)]
    if rules.keys:
        near = KI.files_for(spark, table_root, sorted(checked & set(files)), new.select(*rules.keys), rules.keys)
        older = open_files(spark, table_root, rules.schema, [files[n] for n in near]) if near else None
        found.append(duplicates(new, older, rules.keys))
    CM.append(spark, f"{table_root}/_checks", MANIFEST, lambda held: CK._union(found).join(held.select(*IDENTITY), IDENTITY, "left_anti").select(*MANIFEST.fieldNames()))
    return names


# ------------------------------------------------------------------ reports: one pass over the manifest each
def _sums(found: DataFrame, cells: Sequence[Column]) -> DataFrame:
    return found.agg(F.array(*cells).alias("_a")).select(F.explode("_a").alias("_c")).select("_c.*")


def _total(kind: str, name: str) -> Column:
    return F.coalesce(F.sum(F.when((F.col("kind") == kind) & (F.col("name") == name), F.col("n"))), F.lit(0)).cast("long")


def reports(spark: SparkSession, table_root: str, rules: Rules, parents: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """What the checks of the whole table would report, in their form, from the manifest."""
    table = F.lit(os.path.basename(table_root.rstrip("/"))).alias("table_name")
    found = manifest(spark, table_root)
    out = {"not_null": _sums(found, [F.struct(table, F.lit(c).alias("column_name"), _total(NULLS, c).alias("null_count")) for c in rules.required])}
    longest = lambda c: F.max(F.when((F.col("kind") == LONGEST) & (F.col("name") == c), F.col("n"))).cast("int")
    out["widths"] = _sums(found, [F.struct(table, F.lit(c).alias("column_name"), F.lit(w).alias("max_width"), _total(WIDE, c).alias("over_width"),
                                           longest(c).alias("longest")) for c, w in rules.widths.items()])
    if rules.nonnegative:
        out["ranges"] = found.agg(*[_total(NEGATIVE, c).alias(f"negative_{c}") for c in rules.nonnegative], _total(ROWS, "").alias("rows_checked"))
    if rules.keys:
        keys = found.filter(F.col("kind") == DUPLICATE).groupBy("key").agg(F.sum("n").alias("_n")).filter("_n > 1")
        out["pk_duplicates"] = keys.agg(F.count(F.lit(1)).alias("duplicate_keys"), F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("rows_involved")).select(
            table, F.lit(",".join(rules.keys)).alias("key_columns"), "duplicate_keys", "rows_involved")
    if rules.refs:
        noted = found.filter(F.col("kind") == ORPHAN)
        known = CK._union([_parent_keys(parents[name]).select(F.lit(name).alias("name"), "key") for name in rules.refs])
        left = noted.join(known, ["name", "key"], "left_anti")
        out["fk_orphans"] = _sums(left, [F.struct(F.lit(name).alias("fk_name"), _total(ORPHAN, name).alias("orphan_rows"),
                                                  F.count_distinct(F.when(F.col("name") == name, F.col("key"))).alias("orphan_keys")) for name in rules.refs])
    return out


def check_mart(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Bring the manifests of facts and log up to date and report on them and, whole, on the dimensions."""
    from .pipeline import read_mart
    mart = read_mart(spark, root)
    parents = {"fk_customer": mart["dim_customer"], "fk_product": mart["dim_product"], "fk_date": mart["dim_date"]}
    per_table = []
    for name, rules in RULES.items():
        place = os.path.join(root, name)
        check_table(spark, place, rules, parents)
        per_table.append(reports(spark, place, rules, parents))
    dims = {name: mart[name] for name in ("dim_customer", "dim_product", "dim_date")}
    key = {name: (df, [df.columns[0]]) for name, df in dims.items()}
    whole = {"pk_duplicates": CK.pk_duplicates(key), "not_null": CK.not_null({n: (df, K.NOT_NULL[n]) for n, df in dims.items()}),
             "widths": CK.widths({n: (df, K.WIDTHS[n]) for n, df in dims.items()})}
    kinds = dict.fromkeys(kind for part in [whole, *per_table] for kind in part)
    return {kind: CK._union([part[kind] for part in [whole, *per_table] if kind in part]) for kind in kinds}
