"""What a stream has met so far: one entry for each distinct raw row of each epoch.

A row that arrives again is told apart by this ledger.  Entries of the epoch itself do not count,
so an epoch that is replayed after a failure finds what it found the first time (a replay, no further log rows);
entries of earlier epochs make it a duplicate, which is logged as one batch over all files would log it.

``<root>/stream_ledger/run=<run>/rows/epoch=<n>`` holds the digest of the raw row, its number of copies, its source
position (file, block, position) and its pair key; ``facts/epoch=<n>`` the cleaned fact rows' keys and digests.  An
epoch's folders are written anew when it is replayed.  A later run of its own time starts a ledger of its own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..constants import PRODUCT_ID_PLACEHOLDERS, UNKNOWN
from ..functions.text import as_py_str, is_in, strip
from ..operators.joins import sized_broadcast
from ..schemas import FACT_COLUMNS, RAW_SALES_COLUMNS
from ..session import child_names, empty_table, path_exists, write_small

ROWS = T.StructType([T.StructField("row", T.BinaryType()), T.StructField("n", T.LongType()), T.StructField("file", T.StringType()), T.StructField("block", T.LongType()),
                     T.StructField("position", T.LongType()), T.StructField("transaction_id", T.StringType()), T.StructField("raw_product_id", T.StringType())])
FACTS = T.StructType([T.StructField("transaction_id", T.StringType()), T.StructField("product_id", T.StringType()), T.StructField("fact", T.BinaryType())])


#: Bytes of a SHA-256 that tell rows apart: 128 bits are enough for any number of rows, and digests, which no codec makes smaller, are most of a ledger.
DIGEST_BYTES = 16


def digest(columns: list[str], prefix: str = "") -> Column:
    """The first ``DIGEST_BYTES`` of the SHA-256 of the columns as JSON, nulls included."""
    return _short(F.unhex(F.sha2(F.to_json(F.struct(*[F.col(f"{prefix}{c}").alias(c) for c in columns]), {"ignoreNullFields": "false"}), 256)))


def _short(d: Column) -> Column:
    """A digest as it is compared; entries of earlier versions hold whole ones."""
    return F.substring(d, 1, DIGEST_BYTES)


def key_hash(transaction_id: Column, raw_product_id: Column) -> Column:
    """Hash of a row's cleaned transaction id and of its product id, which is cleaned here; a cleaned id stays as it is."""
    pid = strip(as_py_str(raw_product_id))
    return F.xxhash64(transaction_id, F.when(is_in(pid, PRODUCT_ID_PLACEHOLDERS), F.lit(UNKNOWN)).otherwise(pid))


@dataclass
class Ledger:
    """The entries of the epochs before ``epoch`` of one stream run."""

    spark: SparkSession
    root: str
    run: str
    epoch: int

    def _folder(self, part: str) -> str:
        return f"{self.root.rstrip('/')}/stream_ledger/run={self.run}/{part}"

    def _earlier(self, part: str, schema: T.StructType) -> DataFrame:
        folder = self._folder(part)
        names = [n for n in child_names(self.spark, folder) if n.startswith("epoch=") and int(n[6:]) < self.epoch] if path_exists(self.spark, folder) else []
        return self.spark.read.schema(schema).parquet(*[f"{folder}/{n}" for n in names]) if names else empty_table(self.spark, schema)

    def _rows(self, shared: DataFrame | None = None) -> DataFrame:
        """Entries of rows, of all or of the fact keys whose hashes are in ``shared`` (column ``_h``)."""
        rows = self._earlier("rows", ROWS).withColumn("row", _short(F.col("row")))
        return rows if shared is None else rows.withColumn("_h", key_hash(F.col("transaction_id"), F.col("raw_product_id"))).join(sized_broadcast(shared), "_h", "left_semi").drop("_h")

    def key_hashes(self) -> DataFrame:
        """(_h): hashes of the fact keys of earlier epochs' rows."""
        return self._earlier("rows", ROWS).select(key_hash(F.col("transaction_id"), F.col("raw_product_id")).alias("_h"))

    def copies(self, shared: DataFrame | None = None) -> DataFrame:
        """(row, before): how many copies of a raw row earlier epochs have met."""
        return self._rows(shared).groupBy("row").agg(F.sum("n").alias("before"))

    def pairs(self, shared: DataFrame | None = None) -> DataFrame:
        """Distinct (transaction id, raw product id) of earlier epochs; rows without an id have none."""
        return self._rows(shared).filter("transaction_id is not null").select("transaction_id", "raw_product_id").distinct()

    def facts(self, shared: DataFrame | None = None) -> DataFrame:
        """Distinct cleaned fact rows of earlier epochs: their key, and the digest of the row."""
        facts = self._earlier("facts", FACTS).withColumn("fact", _short(F.col("fact")))
        if shared is not None:
            facts = facts.withColumn("_h", key_hash(F.col("transaction_id"), F.col("product_id"))).join(sized_broadcast(shared), "_h", "left_semi").drop("_h")
        return facts.distinct()

    def record(self, rows: DataFrame, facts: DataFrame) -> None:
        """Write this epoch's entries (columns of ``ROWS`` and ``FACTS``)."""
        for part, df, schema in (("rows", rows, ROWS), ("facts", facts, FACTS)):
            write_small(df.select(*schema.fieldNames()), f"{self._folder(part)}/epoch={self.epoch:09d}", mode="overwrite")


def raw_digest() -> Column:
    return digest(RAW_SALES_COLUMNS)


def fact_digest() -> Column:
    return digest(FACT_COLUMNS)
