"""Benchmark decontamination with a distributed positional inverted index, in DataFrame functions only.

The index stores one posting (term, document, position) for every training token whose term the test
set uses, and an end posting for each document.  A test item is matched by intersecting
offset-adjusted lists: a posting at position p of a term at place i of an item lies on the diagonal
p - i, and an occurrence of a phrase is a run of places on one diagonal.  The lists of the rarest terms of
every window are intersected first; only diagonals that survive are intersected with the lists of all
other terms of the item.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.common import WORD_CLASS, ascii_lower, stage

WINDOW = 10
RAREST = 2
#: Sides up to these sizes are broadcast; beyond them the join is a shuffle join.
TERM_BYTES = 16_000_000
DOC_ROWS = 1_000_000


def words(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text.cast("string"), F.lit(""))), F.lit(f"{WORD_CLASS}+"), F.lit(0))


def _small_terms(terms: DataFrame) -> DataFrame:
    size = terms.agg(F.sum(F.octet_length("term") + 32)).first()[0] or 0
    return F.broadcast(terms) if size <= TERM_BYTES else terms


@dataclass
class Index:
    """postings: (term, rid, pos); the end posting of a document has term '', its word count as pos, and its doc_id.

    places: (iid, item_id, place, term, n) for every word of every item; n is the item's word count."""

    postings: DataFrame
    places: DataFrame


def build(docs: DataFrame, items: DataFrame) -> Index:
    """(doc_id, text) and (item_id, text) -> staged index.  Null texts have no words; items without words match nothing."""
    listed = items.select(F.monotonically_increasing_id().alias("iid"), F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), words(F.col("text")).alias("w"))
    places = stage(listed.select("iid", "item_id", F.size("w").alias("n"), F.posexplode("w").alias("place", "term")), "items")
    terms = places.select("term").union(places.sparkSession.sql("SELECT '' AS term")).distinct()
    with_end = F.concat(words(F.col("text")), F.array(F.lit("")))
    tokens = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", with_end.alias("w"))
    tokens = tokens.select("rid", "doc_id", F.posexplode("w").alias("pos", "term"))
    held = tokens.join(_small_terms(stage(terms, "terms")), "term", "left_semi")
    held = held.select("term", "rid", "pos", F.when(F.col("term") == "", F.col("doc_id")).alias("doc_id"))
    return Index(stage(held, "postings"), places)


def _windows(places: DataFrame, window: int) -> DataFrame:
    """(iid, start, place, term, n): the places of each window; an item shorter than a window is one window."""
    starts = F.sequence(F.greatest(F.lit(0), F.col("place") - window + 1), F.least(F.col("place"), F.greatest(F.lit(0), F.col("n") - window)))
    return places.select("iid", "n", "place", "term", F.explode(starts).alias("start"))


def _rarest(index: Index, window: int, rarest: int) -> DataFrame:
    """(iid, n, start, place, term, rank): the rarest places of each window of which all terms occur in training."""
    # Staged: its size is then known, so that a small one is broadcast and a hot term's side can be split.
    frequency = stage(index.postings.filter("term != ''").groupBy("term").agg(F.count("*").alias("times")), "frequency")
    seen = _windows(index.places, window).join(frequency, "term", "left")
    by_window = Window.partitionBy("iid", "start")
    ranked = seen.withColumn("least", F.min(F.coalesce("times", F.lit(0))).over(by_window)).filter("least > 0")
    ranked = ranked.withColumn("rank", F.row_number().over(by_window.orderBy("times", "place")))
    return ranked.filter(F.col("rank") <= rarest).select("iid", "n", "start", "place", "term", "rank")


def phrase_matches(index: Index, window: int = WINDOW, rarest: int = RAREST) -> DataFrame:
    """Exact matches: (rid, iid, start, length), maximal runs of at least a window of an item's words in a document.

    start is the run's first word in the document.
    """
    anchors = stage(_rarest(index, window, rarest).select("iid", "n", "place", "term").distinct(), "anchors")
    lists = index.postings.filter("term != ''").select("term", "rid", "pos").join(_small_terms(anchors), "term")
    diagonals = lists.select("rid", "iid", "n", (F.col("pos") - F.col("place")).alias("diagonal"))
    # An item of one word has one anchor; every other window has at least two.
    crossed = diagonals.groupBy("rid", "iid", "diagonal", "n").agg(F.count("*").alias("hits")).filter(F.col("hits") >= F.least(F.lit(rarest), F.col("n")))
    crossed = stage(crossed.select("rid", "iid", "diagonal"), "diagonals")
    found = stage(crossed.select("rid").distinct(), "candidate-docs")
    near = F.broadcast(found) if found.limit(DOC_ROWS + 1).count() <= DOC_ROWS else found
    wanted = crossed.join(index.places.select("iid", "n", "place", "term"), "iid").select("rid", "iid", "diagonal", "n", "place", "term", (F.col("diagonal") + F.col("place")).alias("pos"))
    postings = index.postings.filter("term != ''").select("rid", "pos", "term").join(near, "rid", "left_semi")
    hits = wanted.join(postings, ["rid", "pos", "term"])
    order = Window.partitionBy("rid", "iid", "diagonal").orderBy("place")
    islands = hits.withColumn("island", F.col("place") - F.row_number().over(order))
    runs = islands.groupBy("rid", "iid", "diagonal", "island").agg(F.min("pos").alias("start"), F.count("*").cast("int").alias("length"), F.first("n").alias("n"))
    return runs.filter(F.col("length") >= F.least(F.lit(window), F.col("n"))).select("rid", "iid", "start", "length")


def proximity_matches(index: Index, span: int = 20, window: int = WINDOW) -> DataFrame:
    """Proximity matches: (rid, iid, start, pos): all terms of an item's window, in any order, within ``span`` words of
    an occurrence (at pos) of its rarest term.

    Postings meet in buckets of ``span`` positions, so a frequent term is compared with near postings only.
    """
    rare = _rarest(index, window, 1).select("iid", "start", F.col("term").alias("rare"))
    terms = _windows(index.places, window).select("iid", "start", "term").distinct()
    needed = terms.groupBy("iid", "start").agg(F.count("*").alias("kinds"))
    postings = index.postings.filter("term != ''").select("term", "rid", "pos")
    seeds = postings.join(rare, postings.term == rare.rare).select("rid", "iid", "start", F.col("pos").alias("at"))
    bucket = F.floor(F.col("at") / span)
    wanted = seeds.join(terms, ["iid", "start"]).withColumn("bucket", F.explode(F.array(bucket - 1, bucket, bucket + 1)))
    near = wanted.join(postings.withColumn("bucket", F.floor(F.col("pos") / span)), ["rid", "term", "bucket"]).filter(F.abs(F.col("pos") - F.col("at")) <= span)
    kinds = near.groupBy("rid", "iid", "start", "at").agg(F.countDistinct("term").alias("seen"))
    return kinds.join(needed, ["iid", "start"]).filter("seen = kinds").select("rid", "iid", "start", F.col("at").alias("pos"))


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Documents and items -> doc_id, n_words, n_hit, items (sorted ids), hit_words (start, length of matched runs); one row a document.

    A word inside several matches counts once.  Repeated document rows and null ids keep their own
    rows; items of the same id are one item, a null item id is written as empty text.  Either table may
    be empty.  Columns other than id and text are ignored.
    """
    index = build(docs.select("doc_id", "text"), items.select("item_id", "text"))
    ends = index.postings.filter("term = ''").select("rid", "doc_id", F.col("pos").cast("long").alias("n_words"))
    matches = stage(phrase_matches(index, window), "matches")
    covered = matches.select("rid", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("length") - 1)).alias("pos")).distinct()
    counted = covered.groupBy("rid").agg(F.count("*").alias("n_hit"))
    named = matches.join(index.places.select("iid", "item_id").distinct(), "iid")
    listed = named.groupBy("rid").agg(F.array_sort(F.collect_set("item_id")).alias("items"), F.array_sort(F.collect_set(F.struct("start", "length"))).alias("hit_words"))
    out = ends.join(counted, "rid", "left").join(listed, "rid", "left")
    return out.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"), "hit_words")
