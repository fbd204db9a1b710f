"""A training-corpus pipeline over ``documents``: five stages, each one of the numbered operators.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept.  All but the last
return the columns of ``documents``.  Rows are told apart by their place in the files they are read from, so repeated rows,
null ids and ids shared by different texts are handled like any others; null and empty texts are texts
without letters, and leave at the first stage.  An empty table stays empty.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm import decontaminate, langid, packing, pii, simhash
from salesmart.llm.common import remainder, stage, table

#: A document goes if its best language is less likely than this.
MIN_LANGUAGE_SCORE = 0.4

ROW = "__row"


def _numbered(docs: DataFrame) -> DataFrame:
    """The documents with a name for each row: its place in the Parquet files they are read from.

    Documents that are not read straight from files are written once to give their rows such places.
    """
    place = F.concat_ws("#", "_metadata.file_path", F.lpad(F.col("_metadata.row_index").cast("string"), 12, "0"))
    try:
        return docs.withColumn(ROW, place)
    except AnalysisException:
        return stage(docs, "placed").withColumn(ROW, place)


def _plain(numbered: DataFrame) -> DataFrame:
    """(doc_id, text) for an operator, named by row."""
    return numbered.select(F.col(ROW).alias("doc_id"), "text")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or of no language with a score of ``MIN_LANGUAGE_SCORE``, go.

    The network is fitted on the labelled documents that the language query does not hold out.  Without
    any, only documents without a letter go.
    """
    fitting = docs.filter(F.coalesce(remainder(F.col("doc_id"), 4) != 2, F.lit(True)))
    net = langid.fit(fitting)
    if net is None:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    judged = langid.identify(docs, net, *docs.columns, names=("__language", "__score"))
    return judged.filter((F.col("__language") != langid.UNDETERMINED) & (F.col("__score") >= MIN_LANGUAGE_SCORE)).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of SimHash near-duplicates the document with the smallest id stays (null ids last)."""
    rows = _numbered(docs)
    groups = simhash.near_duplicates(_plain(rows)).select(F.col("doc_id").alias(ROW), "component_id")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", F.col(ROW).alias("row"))
    first = rows.select("doc_id", ROW).join(groups, ROW).groupBy("component_id").agg(F.min(order).alias("first"))
    return rows.join(first.select(F.col("first.row").alias(ROW)), ROW, "left_semi").select(*docs.columns)


def decontaminate_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a window of a benchmark item go."""
    rows = _numbered(docs)
    found = decontaminate.contamination(_plain(rows), table(spark, sf_dir, "benchmark"))
    dirty = found.filter("n_hit > 0").select(F.col("doc_id").alias(ROW))
    return rows.join(dirty, ROW, "left_anti").select(*docs.columns)


def sanitise_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and terms that reveal it are replaced in the texts; every document stays."""
    clean = pii.sanitise(_numbered(docs), ROW).select(*docs.columns)
    return clean.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else clean


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each piece of each document: where it lies in which sequence."""
    return packing.pack_documents(docs)


STAGES = [
    ("language id", identify_language),
    ("simhash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", decontaminate_documents),
    ("pii", sanitise_personal_data),
    ("best-fit packing", pack_sequences),
]

#: SQL cannot express the stages; tests/llm holds the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
