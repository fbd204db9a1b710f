"""Personal data: pattern spans, and information-theoretic sanitisation of terms that reveal them.

Everything is DataFrame functions.  Base spans come from four fixed patterns.  Then the corpus says which
ordinary terms give a protected entity away: for each distinct value and each term in a sentence with it, the
share of the term's distinct uses that stand with that value estimates P(entity | term), and log2 of
it over the entity's prior is the information a reader of the term gains.  Terms above the disclosure
threshold become spans wherever they stand, in all documents: generalised, or removed if they are near
certain.  A use is a term with its two neighbours in the sentence, so copies of a text are one use.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.common import bounded, stage

#: Kinds in their order, and the patterns of the contract.  Look-behinds and possessive
#: quantifiers only keep the search linear; they match the same spans.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: A text that does not fit these has no match of the kind.
MAY_HAVE = {"email": r"@", "ip": r"[0-9]\.[0-9]++\.[0-9]", "card": r"[0-9](?:[ -]?[0-9]){11}", "phone": r"\+[0-9]"}
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
TERM = "term"

MIN_USES = 3
GENERALISE = 0.5
REMOVE = 0.9
#: Terms and row numbers are broadcast up to so many rows; beyond them the joins shuffle.
TERM_ROWS = 500_000
ROW_NUMBERS = 1_000_000


def _found(text: Column, number: int, kind: str) -> Column:
    """All pattern matches of one kind as structs: kind, k, gap (code points since the last match), value."""
    pattern = F.lit(PATTERNS[kind])
    values, between = F.regexp_extract_all(text, pattern, F.lit(0)), F.split(text, PATTERNS[kind], -1)
    at = lambda a, i: F.element_at(a, i + 1)
    one = lambda i: F.struct(
        F.lit(number).alias("kind"), i.alias("k"), F.char_length(at(between, i)).alias("gap"), at(values, i).alias("value"))
    each = F.transform(F.sequence(F.lit(0), F.size(values) - 1), one)
    has = F.col("text").contains("@") if kind == "email" else F.col("text").rlike(MAY_HAVE[kind])
    return F.when(has, F.when(F.size(values) > 0, each))


def _luhn(digits: Column) -> Column:
    d = F.reverse(F.split(digits, ""))
    doubled = F.transform(d, lambda c, i: F.when(i % 2 == 1, c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)).otherwise(c.cast("int")))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid() -> Column:
    digits = F.regexp_replace("value", "[^0-9]", "")
    n = F.length(digits)
    return (F.when(F.col("kind") == 0, True).when(F.col("kind") == 1, F.col("value").rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$"))
            .when(F.col("kind") == 2, F.when(n.between(12, 19), _luhn(digits)).otherwise(False)).when(F.col("kind") == 3, n.between(9, 15)).otherwise(False))


def matches(docs: DataFrame) -> DataFrame:
    """(rid, doc_id, text) -> staged (rid, doc_id, kind, start, end, value).

    One row of kind -1 for each document, and one for each valid match; start and end in code points.
    """
    text = F.col("text")
    lists = [F.coalesce(_found(text, i, kind), F.array().cast("array<struct<kind:int,k:int,gap:int,value:string>>")) for i, kind in enumerate(KINDS)]
    end = F.array(F.struct(F.lit(-1).alias("kind"), F.lit(0).alias("k"), F.lit(0).alias("gap"), F.lit("").alias("value")))
    whole = docs.select("rid", "doc_id", F.coalesce(text.cast("string"), F.lit("")).alias("text"))
    raw = stage(whole.select("rid", "doc_id", F.inline(F.concat(end, *lists))), "pii-raw")
    of_kind = Window.partitionBy("rid", "kind").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    placed = raw.withColumn("end", F.sum(F.col("gap") + F.char_length("value")).over(of_kind).cast("int")).withColumn("start", F.col("end") - F.char_length("value"))
    valid = placed.filter((F.col("kind") == -1) | _valid())
    return stage(valid.select("rid", "doc_id", "kind", "start", "end", "value"), "pii-matches")


_WORD = r"\p{L}{3,}"


#: Between two sentences; it takes no characters away.
_SENTENCE = r"(?<=[.!?\x{2026}]\s)|(?<=[\n\x{3002}\x{FF01}\x{FF1F}])"


def _text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def _words(part: Column) -> Column:
    """Lower-cased words of a sentence, those of its email addresses left out."""
    plain = F.when(part.contains("@"), F.regexp_replace(part, PATTERNS["email"], "@")).otherwise(part)
    return F.transform(F.regexp_extract_all(plain, F.lit(_WORD), F.lit(0)), F.lower)


def _use(words: Column, i: Column) -> Column:
    """Hash of a word (place i from 1) with its neighbours."""
    side = lambda j: F.coalesce(F.get(words, j - 1), F.lit(""))
    return F.xxhash64(side(i - 1), side(i), side(i + 1))


def _uses(parts: DataFrame, *keep: str) -> DataFrame:
    """(part, columns ``keep``) -> these columns, term, use; one row for each word of each sentence."""
    each = parts.select(*keep, _words(F.col("part")).alias("w")).select(*keep, "w", F.posexplode("w").alias("i", "term"))
    return each.select(*keep, "term", _use(F.col("w"), F.col("i") + 1).alias("use"))


def contexts(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Distinct uses of terms in a sentence with a match: (kind, value, term, use), whatever else stands between."""
    spans = found.filter("kind >= 0").select("rid", "kind", F.lower("value").alias("value"), "start", "end")
    holding = docs.select("rid", _text().alias("text")).join(bounded(spans.select("rid").distinct(), ROW_NUMBERS), "rid", "left_semi")
    parts = holding.select("rid", F.posexplode(F.split("text", _SENTENCE, -1)).alias("k", "part"))
    upto = F.sum(F.char_length("part")).over(Window.partitionBy("rid").orderBy("k").rowsBetween(Window.unboundedPreceding, 0))
    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    begins = parts.select("rid", (upto - F.char_length("part")).cast("int").alias("at"), none("int", "kind"), none("string", "value"), "part")
    # A match may reach over the end of a sentence; only its ends can have words beside them.
    ends = spans.select("rid", F.explode(F.array("start", F.col("end") - 1)).alias("at"), "kind", "value", none("string", "part"))
    by_place = Window.partitionBy("rid").orderBy("at", F.col("kind").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    beside = begins.union(ends).withColumn("part", F.last("part", ignorenulls=True).over(by_place)).filter("kind is not null")
    return _uses(beside.select("kind", "value", "part").distinct(), "kind", "value").distinct()


def disclosing(docs: DataFrame, uses: DataFrame, min_uses: int = MIN_USES, threshold: float = GENERALISE) -> DataFrame:
    """(kind, value, term, posterior, bits) of the terms whose uses in the corpus point to one protected value.

    uses: staged ``contexts`` of the corpus.  Uses are counted over all documents.  A term's uses beside any value bound
    its corpus uses from below, so only terms that can still pass are counted in the whole corpus.
    """
    pairs = uses.groupBy("kind", "value", "term").agg(F.count("*").alias("with"))
    beside = uses.select("term", "use").distinct().groupBy("term").agg(F.count("*").alias("least"))
    able = stage(pairs.filter(F.col("with") >= min_uses).join(beside, "term").filter(F.col("with") >= F.lit(threshold) * F.col("least")), "pii-pairs")
    terms = able.select("term").distinct()
    terms = F.broadcast(terms) if terms.limit(TERM_ROWS + 1).count() <= TERM_ROWS else terms
    tokens = _uses(docs.select(F.explode(F.split(_text(), _SENTENCE, -1)).alias("part"))).join(terms, "term")
    all_uses = tokens.distinct().groupBy("term").agg(F.count("*").alias("all"))
    total = uses.count()
    by_value = uses.groupBy("kind", "value").agg(F.count("*").alias("of_value"))
    judged = able.join(all_uses, "term", "left").join(by_value, ["kind", "value"])
    posterior = F.col("with") / F.greatest("with", "least", F.coalesce("all", F.lit(0)))
    bits = F.log2(F.col("posterior") / (F.col("of_value") / F.lit(max(1, total))))
    return judged.withColumn("posterior", posterior).filter(F.col("posterior") >= threshold).select("kind", "value", "term", "posterior", bits.alias("bits"))


def occurrences(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Every place of the terms (term, posterior) in the documents: (rid, start, end, posterior)."""
    terms = bounded(terms, TERM_ROWS)
    words = docs.select("rid", F.posexplode(F.regexp_extract_all(_text(), F.lit(_WORD), F.lit(0))).alias("i", "word"))
    hits = stage(words.withColumn("term", F.lower("word")).join(terms, "term").select("rid", "i", F.char_length("word").alias("n"), "posterior"), "pii-hits")
    concerned = docs.select("rid", _text().alias("text")).join(bounded(hits.select("rid").distinct(), ROW_NUMBERS), "rid", "left_semi")
    listed = hits.groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("i", "n", "posterior"))).alias("hits"))
    word, gap = F.regexp_extract_all("text", F.lit(_WORD), F.lit(0)), F.split("text", _WORD, -1)
    sizes = F.zip_with(word, F.slice(gap, F.lit(1), F.size(word)), lambda w, g: F.char_length(w) + F.char_length(g))
    empty = F.array().cast("array<struct<start:int,end:int,posterior:double>>")

    def step(acc: Column, hit: Column) -> Column:  # ``sizes`` is carried along, so it is made once a document
        end = F.aggregate(F.slice(acc["sizes"], acc["next"] + 1, hit["i"] - acc["next"] + 1), acc["end"], lambda a, x: a + x)
        place = F.struct((end - hit["n"]).alias("start"), end.alias("end"), hit["posterior"].alias("posterior"))
        return F.struct(acc["sizes"].alias("sizes"), (hit["i"] + 1).alias("next"), end.alias("end"), F.concat(acc["out"], F.array(place)).alias("out"))

    begin = F.struct(sizes.alias("sizes"), F.lit(0).alias("next"), F.lit(0).alias("end"), empty.alias("out"))
    return concerned.join(listed, "rid").select("rid", F.inline(F.aggregate("hits", begin, step, lambda acc: acc["out"])))


def spans(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents (rid, doc_id, text) -> staged matches (see ``matches``) and term spans (rid, start, end, action).

    ``rid`` must name the same row whenever ``docs`` is read.
    """
    found = matches(docs)
    uses = stage(contexts(docs, found), "pii-uses")
    terms = stage(disclosing(docs, uses).groupBy("term").agg(F.max("posterior").alias("posterior")), "pii-terms")
    emails = found.filter("kind = 0").select(F.col("rid").alias("r"), F.col("start").alias("a"), F.col("end").alias("z"))
    free = occurrences(docs, terms).join(emails, (F.col("rid") == F.col("r")) & (F.col("start") < F.col("z")) & (F.col("end") > F.col("a")), "left_anti")
    return found, free.select("rid", "start", "end", F.when(F.col("posterior") >= REMOVE, "remove").otherwise("generalise").alias("action"))


def _placed(docs: DataFrame) -> DataFrame:
    """The documents with a rid that is the same at every reading: the row's place in its Parquet file, written once if it has none."""
    place = F.concat_ws("#", "_metadata.file_path", "_metadata.row_index")
    try:
        return docs.withColumn("rid", place)
    except AnalysisException:
        return stage(docs, "pii-docs").withColumn("rid", place)


def report(docs: DataFrame) -> DataFrame:
    """Documents (doc_id, text, ...) -> doc_id and spans, an array of (start, number, end, kind) in order; one row a document.

    Null and empty texts have no spans; repeated rows and null ids keep their rows; other columns are ignored.
    """
    found, terms = spans(_placed(docs.select("doc_id", "text")))
    names = F.element_at(F.array(*map(F.lit, KINDS)), F.col("kind") + 1)
    base = found.filter("kind >= 0").select("rid", F.struct("start", F.col("kind").alias("number"), "end", names.alias("kind")).alias("s"))
    more = terms.select("rid", F.struct("start", F.lit(len(KINDS)).alias("number"), "end", F.lit(TERM).alias("kind")).alias("s"))
    listed = base.union(more).groupBy("rid").agg(F.array_sort(F.collect_list("s")).alias("spans"))
    ids = found.filter("kind = -1").select("rid", "doc_id")
    return ids.join(listed, "rid", "left").select("doc_id", F.coalesce("spans", F.array().cast("array<struct<start:int,number:int,end:int,kind:string>>")).alias("spans"))


def sanitise(docs: DataFrame, row: str | None = None) -> DataFrame:
    """Documents (doc_id, text, other columns) -> the same columns and rows, with personal data and revealing terms replaced.

    row: a column that names each row, the same whenever ``docs`` is read; without one the documents are written once
    to number them.

    A base span becomes its kind in brackets, a generalised term [TERM], a removed term nothing; of
    overlapping spans the first counts and the rest of the others is covered by it.  A null text stays null.
    """
    held = docs.withColumn("__rid", F.col(row)) if row else stage(docs.withColumn("__rid", F.monotonically_increasing_id()), "pii-docs")
    found, terms = spans(held.select(F.col("__rid").alias("rid"), "doc_id", "text"))
    names = F.element_at(F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS]), F.col("kind") + 1)
    base = found.filter("kind >= 0").select("rid", "start", "end", names.alias("mark"))
    marks = base.union(terms.select("rid", "start", "end", F.when(F.col("action") == "remove", "").otherwise("[TERM]")))
    by_start = Window.partitionBy("rid").orderBy("start", "end", "mark").rowsBetween(Window.unboundedPreceding, -1)
    free = marks.withColumn("from", F.greatest("start", F.coalesce(F.max("end").over(by_start), F.lit(0)))).filter(F.col("end") > F.col("from"))
    kept = free.withColumn("mark", F.when(F.col("from") > F.col("start"), "").otherwise(F.col("mark")))
    listed = kept.groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("from", "end", "mark"))).alias("__marks"))
    joined = held.join(listed.withColumnRenamed("rid", "__rid"), "__rid", "left")
    text, m = F.col("text").cast("string"), F.col("__marks")
    before = lambda i: F.when(i > 0, F.element_at(m, F.greatest(i, F.lit(1)))["end"]).otherwise(0)
    part = F.transform(m, lambda x, i: F.concat(F.substring(text, before(i) + 1, x["from"] - before(i)), x["mark"]))
    tail = F.substring(text, F.element_at(m, -1)["end"] + 1, F.char_length(text))
    return joined.withColumn("text", F.when(m.isNull(), text).otherwise(F.concat(F.array_join(part, ""), tail))).drop("__rid", "__marks").select(*docs.columns)
