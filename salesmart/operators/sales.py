"""Sales cleaning and load preparation.

``SalesRun`` builds the stages of one run over a flat raw frame:

1. full-row dedup (W1) -- one aggregate over all columns;
2. transaction id: strip, drop missing (C1);
3. keep-first per (transaction id, raw product id) (W2);
4. all column rules in one projection (C2-C10), each also emitting an issue;
5. fact projection: distinct (W4), keep-first per key (W3), casts (C11);
6. product extract: not Unknown, one row per product, first wins (C12, C13, W5).

A run that writes stages first finds the rows whose fact key (cleaned ids) no other row has: one exchange of hashes.  They
are distinct, first of their pair and first of their fact key, so steps 1, 3 and 5 compare the few other rows only, and no wide
row is shuffled.  The rows that survive need none of the flags: a full-row duplicate is always a
pair duplicate, so one keep-first aggregate on (cleaned id, raw product id) over
the raw rows gives them.  The flagged frame behind the log and the counters
is built beside it.  Raw values travel in ``_raw``, so a log record shows
the input as it arrived, except for the load's own decisions (duplicate key,
unknown reference), which show the cleaned fact row.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from .. import constants as K
from ..functions.dates import date_key_of, date_kind, parse_by_kind
from ..functions.numeric import coerce_number, stripped_number
from ..functions.text import as_py_str, is_in, strip
from ..schemas import FACT_COLUMNS, RAW_SALES_COLUMNS
from ..session import delete_folder, scratch_path, write_stage
from ..streaming.ledger import fact_digest, key_hash, raw_digest
from . import dedup as DD
from .joins import fits_broadcast, sized_broadcast
from .quality import issue_when, log_rows, record_json

ORD = DD.ORD
RAW = RAW_SALES_COLUMNS
FACT_KEYS = ["transaction_id", "product_id"]


def with_order(df: DataFrame, order_cols=None) -> DataFrame:
    """Attach the source order ``_ord``; by default the row's own columns in source order."""
    if ORD in df.columns:
        return df
    return df.withColumn(ORD, F.struct(*[F.col(c) for c in (order_cols or RAW)]))


def flatten_product(nested: DataFrame) -> DataFrame:
    """``product.{id,name,category,price}`` -> flat columns."""
    rest = [c for c in nested.columns if c not in ("product",)]
    flat = nested.select(*rest, F.col("product.id").alias("product_id"), F.col("product.name").alias("product_name"),
                         F.col("product.category").alias("category"), F.col("product.price").alias("price"))
    extra = [c for c in flat.columns if c not in RAW]
    return flat.select(*RAW, *extra)


# ------------------------------------------------------------------ column rules
def clean_txn(c: Column) -> Column:
    return strip(as_py_str(c))


def txn_missing(txn: Column) -> Column:
    return (txn == "") | F.lower(txn).isin(list(K.TXN_MISSING_LOWER))


def fact_key_hash() -> Column:
    """Hash of a raw row's fact key: its cleaned ids; rows without a transaction id have a null there, whatever it reads."""
    txn = clean_txn(F.col("transaction_id"))
    return key_hash(F.when(~txn_missing(txn), txn), F.col("product_id"))


def placeholder_rule(raw: Column, placeholders) -> tuple[Column, Column]:
    """(cleaned, was_missing): strip; a placeholder (or null) becomes Unknown."""
    return stripped_placeholder_rule(strip(as_py_str(raw)), placeholders)


def stripped_placeholder_rule(s: Column, placeholders) -> tuple[Column, Column]:
    missing = is_in(s, placeholders)
    return F.when(missing, F.lit(K.UNKNOWN)).otherwise(s), missing


def number_rule(raw: Column) -> tuple[Column, Column, Column]:
    """(cleaned, missing_or_unparsable, negative): non-numbers and negatives become 0."""
    return coerced_number_rule(coerce_number(raw))


def coerced_number_rule(n: Column) -> tuple[Column, Column, Column]:
    missing = n.isNull()
    negative = F.coalesce(n < 0, F.lit(False))
    return F.when(missing | negative, F.lit(0.0)).otherwise(n), missing, negative


PARSED = "_parsed_date"


def with_parsed_date(df: DataFrame, raw: Column) -> DataFrame:
    """Parse the raw date once into its own column (the parse is referenced several times later), its stripped text and kind likewise."""
    text, kind = F.col("_date_text"), F.col("_date_kind")
    return df.withColumn("_date_text", strip(raw)).withColumn("_date_kind", date_kind(text)).withColumn(PARSED, parse_by_kind(text, kind)).drop("_date_text", "_date_kind")


def date_rule(raw: Column, parsed: Column | None = None) -> tuple[Column, Column, Column]:
    """(date_key, missing, invalid): unparsable or missing dates become 19900101.

    ``parsed`` should be a column computed by ``with_parsed_date``; the parse
    is large, and a conditional expression would otherwise repeat it.
    """
    missing = raw.isNull() | (strip(raw) == "")
    parsed = F.col(PARSED) if parsed is None else parsed
    invalid = ~missing & parsed.isNull()
    key = F.when(missing | invalid, F.lit(K.SENTINEL_DATE_KEY)).otherwise(date_key_of(parsed)).cast("int")
    return key, missing, invalid


def _one_row(spark, counters: dict[str, int]) -> DataFrame:
    return spark.createDataFrame([tuple(counters.values())], ", ".join(f"{c} long" for c in counters))


class SalesRun:
    """Stages of one sales load.  ``raw`` has the flat raw columns (all strings).

    Without an ``_ord`` column the source order is the row's own columns; the
    full-row dedup then needs no order aggregate and stays a hash aggregate.
    With ``materialize=True`` the raw rows (unless they are ``staged`` already) and the few rows that may share a fact
    key are written as Parquet to the run's own folder below the shared checkpoint
    folder when they are first asked for; ``close`` deletes that folder.  The annotated frame (all
    distinct rows with every flag) is made of them where it is read: written, it would hold every row once more.  Its
    counters are counted over it, if they are asked for.
    With a ``ledger`` (of a stream) rows, pairs and facts of earlier epochs come before all of ``raw``'s.
    """

    def __init__(self, raw: DataFrame, run_id: str, run_ts: Column, order_cols=None, materialize: bool = False, ledger=None, staged: bool = False):
        self.ledger = ledger
        self.staged = staged
        if ORD in raw.columns:
            self.own_order, self.raw = False, raw.select(*RAW, ORD)
        elif order_cols is None:
            self.own_order, self.raw = True, raw.select(*RAW)
        else:
            self.own_order, self.raw = False, with_order(raw.select(*RAW), order_cols)
        self.run_id = run_id
        self.run_ts = run_ts
        self.materialize = materialize

    @cached_property
    def folder(self) -> str:
        return scratch_path(self.raw.sparkSession, "sales-run")

    def close(self) -> None:
        """Delete the stages this run has written; its frames cannot be used afterwards."""
        if "folder" in self.__dict__:
            delete_folder(self.raw.sparkSession, self.folder)

    # ---- rows whose fact key no other row has, and the others
    @cached_property
    def _written_raw(self) -> DataFrame:
        return self.raw if self.staged else write_stage(self.raw, "raw", self.folder)

    @cached_property
    def _shared(self) -> DataFrame:
        """Hashes of the fact keys of more than one row, those of earlier epochs included: equal rows, pairs and facts have equal fact keys."""
        met = self.ledger.key_hashes() if self.ledger else None
        return DD.shared_hashes(self._written_raw, fact_key_hash(), self.folder, "shared_hashes", met)

    def _by_sharing(self, how: str) -> DataFrame:
        return self._written_raw.withColumn("_h", fact_key_hash()).join(sized_broadcast(self._shared), "_h", how).drop("_h")

    # ---- W1
    @cached_property
    def _lone_rows(self) -> DataFrame:
        """Distinct rows of fact keys of their own, in the columns of ``_compared_rows``."""
        rows = self._by_sharing("left_anti")
        if not fits_broadcast(self._shared):  # the join shuffles: once
            rows = write_stage(rows, "lone_rows", self.folder)
        g = rows.withColumn("_n", F.lit(1).cast("long"))
        if self.ledger:
            g = g.withColumn("row", raw_digest()).withColumn("_before", F.lit(0).cast("long"))
        return with_order(g) if self.own_order else g

    @cached_property
    def _compared_rows(self) -> DataFrame:
        """Distinct rows of the others, with their numbers of copies; a run with stages writes them."""
        g = DD.count_copies(self._by_sharing("left_semi") if self.materialize else self.raw, RAW)
        if self.ledger:
            g = g.withColumn("row", raw_digest()).join(self.ledger.copies(self._shared), "row", "left").withColumn("_before", F.coalesce("before", F.lit(0).cast("long"))).drop("before")
        if self.materialize:
            g = write_stage(g, "distinct_rows", self.folder)
        return with_order(g) if self.own_order else g

    @cached_property
    def full_row_groups(self) -> DataFrame:
        return self._compared_rows.unionByName(self._lone_rows) if self.materialize else self._compared_rows

    @cached_property
    def full_row_survivors(self) -> DataFrame:
        """The distinct rows that no earlier epoch has met."""
        return self._unmet(self.full_row_groups).drop("_n", "_before", "row")

    def _unmet(self, groups: DataFrame) -> DataFrame:
        return groups.filter("_before = 0") if self.ledger else groups

    @cached_property
    def full_row_rejects(self) -> DataFrame:
        return DD.extra_copies(self._compared_rows, RAW)

    # ---- C1 + W2 + C2-C10 on every distinct row, in one frame
    @cached_property
    def annotated(self) -> DataFrame:
        return self._compared.unionByName(self._lone) if self.materialize else self._compared

    def _identified(self, groups: DataFrame) -> DataFrame:
        """Distinct rows with their cleaned transaction id."""
        df = groups.select(F.struct(*RAW).alias("_raw"), ORD, "_n", *RAW)
        txn = clean_txn(F.col("_raw.transaction_id"))
        return df.withColumn("transaction_id", txn).withColumn("_txn_missing", txn_missing(txn))

    @cached_property
    def _lone(self) -> DataFrame:
        """The annotated rows of fact keys of their own: each with an id and a place is the first of its pair."""
        df = self._identified(self._lone_rows)
        df = df.withColumn("_is_first", F.when(F.col("_txn_missing"), F.lit(False)).otherwise(F.col(ORD) == F.col(ORD)))
        return self._with_rules(with_parsed_date(df, F.col("_raw.date")), "_n", "_txn_missing", "_is_first")

    @cached_property
    def _compared(self) -> DataFrame:
        """The annotated rows of the others; a run with stages writes them."""
        df = self._identified(self._unmet(self._compared_rows))
        # First position per (cleaned transaction id, raw product id) among rows with an id.
        # Rows without an id can never match: they stay out of the join, or they would be one hot key of it.
        named, nameless = df.filter(~F.col("_txn_missing")), df.filter("_txn_missing")
        j = self._flag_pairs(named)
        if self.ledger:
            met = self.ledger.pairs(self._shared).select(F.col("transaction_id").alias("_k0"), F.col("raw_product_id").alias("_k1"), F.lit(True).alias("_met"))
            j = j.join(met, (j["transaction_id"] == met["_k0"]) & j["product_id"].eqNullSafe(met["_k1"]), "left")
            j = j.withColumn("_is_first", F.col("_is_first") & F.col("_met").isNull()).drop("_k0", "_k1", "_met")
        j = j.unionByName(nameless.withColumn("_is_first", F.lit(False)))
        out = self._with_rules(with_parsed_date(j, F.col("_raw.date")), "_n", "_txn_missing", "_is_first")
        return write_stage(out, "annotated", self.folder) if self.materialize else out

    @cached_property
    def _observed(self) -> dict[str, int]:
        """The counters of the annotated frame of a run with stages."""
        return self.annotated.agg(*self._counters).first().asDict()

    def _flag_pairs(self, named: DataFrame) -> DataFrame:
        """Rows with an id, flagged as first or not of their pair; written distinct rows are shuffled only where many share a pair."""
        keys = ["transaction_id", "product_id"]
        if self.materialize:
            return DD.flag_first_of_shared(named, DD.shared_keys(named, keys, self.folder, "shared_pairs"), keys)
        # The pair's raw row count (``_pair_rows``) keeps ``_n`` alive on this side too, so both
        # join sides share one full-row aggregate and Spark reuses its exchange.
        firsts = named.groupBy(*keys).agg(F.min(ORD).alias("_first"), F.sum("_n").alias("_pair_rows"))
        right = firsts.select(F.col("transaction_id").alias("_k0"), F.col("product_id").alias("_k1"), "_first",
                              "_pair_rows")
        cond = (named["transaction_id"] == right["_k0"]) & named["product_id"].eqNullSafe(right["_k1"])
        j = named.join(right, cond).withColumn("_is_first", F.col(ORD) == F.col("_first"))
        return j.drop("_k0", "_k1", "_first", "_pair_rows")

    @staticmethod
    def _with_rules(df: DataFrame, *keep: str) -> DataFrame:
        """All column rules over ``_raw``, ``_ord``, ``transaction_id`` and the columns ``keep``.

        Stripped texts and numbers, which the rules use several times, are columns of their own first, so that each is made once and code stays short.
        """
        r = lambda c: F.col(f"_raw.{c}")
        text, number = (lambda c: F.col(f"_{c}_text")), (lambda c: F.col(f"_{c}_number"))
        numbers = ("price", "quantity", "discount")
        df = df.withColumns({f"_{c}_text": strip(as_py_str(r(c))) for c in ("customer_id", "product_id", "product_name", "category", "region")}
                            | {f"_{c}_text": strip(r(c)) for c in numbers})
        df = df.withColumns({f"_{c}_number": stripped_number(text(c)) for c in numbers})
        cust, cust_m = stripped_placeholder_rule(text("customer_id"), K.CUSTOMER_PLACEHOLDERS)
        pid, pid_m = stripped_placeholder_rule(text("product_id"), K.PRODUCT_ID_PLACEHOLDERS)
        pname, pname_m = stripped_placeholder_rule(text("product_name"), K.PRODUCT_NAME_PLACEHOLDERS)
        cat, cat_m = stripped_placeholder_rule(text("category"), K.CATEGORY_PLACEHOLDERS)
        price, price_m, price_n = coerced_number_rule(number("price"))
        qty, qty_m, qty_n = coerced_number_rule(number("quantity"))
        disc, disc_m, disc_n = coerced_number_rule(number("discount"))
        region, region_m = stripped_placeholder_rule(text("region"), K.REGION_PLACEHOLDERS)
        dkey, date_m, date_i = date_rule(r("date"))
        flags = F.struct(cust_m.alias("customer_missing"), pid_m.alias("product_id_missing"),
                         pname_m.alias("product_name_missing"), cat_m.alias("category_missing"),
                         (price_m | price_n).alias("price_invalid"),
                         qty_m.alias("quantity_missing"), qty_n.alias("quantity_negative"),
                         disc_m.alias("discount_missing"), disc_n.alias("discount_negative"),
                         date_m.alias("date_missing"), date_i.alias("date_invalid"),
                         region_m.alias("region_missing"))
        return df.select(
            "_raw", ORD, *keep, "transaction_id",
            cust.alias("customer_id"), pid.alias("product_id"), pname.alias("product_name"),
            cat.alias("category"), price.alias("price"), qty.alias("quantity"), disc.alias("discount"),
            dkey.alias("date_key"), region.alias("region"), flags.alias("_flags"))

    # ---- survivors: C1, W1 and W2 in one aggregate over the raw rows
    @cached_property
    def _first_rows(self) -> DataFrame:
        raw = with_order(self.raw) if self.own_order else self.raw
        df = raw.select(*RAW, ORD, clean_txn(F.col("transaction_id")).alias("_txn")).filter(~txn_missing(F.col("_txn")))
        keys = ["_txn", "product_id"]
        if self._by_place and not self.materialize:  # few rows share a pair: the others are neither shuffled nor sorted
            first = self._firsts_of_shared(df, keys, "shared_pairs")
        else:  # one pass that writes nothing
            first = DD.first_row_per_key(df, keys, [c for c in RAW if c != "product_id"], one_pass=True)
        return first.select(F.struct(*RAW).alias("_raw"), ORD, F.col("_txn").alias("transaction_id"))

    @property
    def _by_place(self) -> bool:
        """True if the source order is one long, a row's own place."""
        return not self.own_order and isinstance(self.raw.schema[ORD].dataType, T.LongType)

    def _firsts_of_shared(self, df: DataFrame, keys: list[str], name: str) -> DataFrame:
        shared = DD.shared_keys(df, keys, self.folder, name)
        return DD.flag_first_of_shared(df, shared, keys).filter("_is_first").drop("_is_first")

    @cached_property
    def pair_survivors(self) -> DataFrame:
        return self._first_rows.select("_raw", ORD, "transaction_id", *[F.col(f"_raw.{c}").alias(c) for c in RAW[1:]])

    @cached_property
    def pair_rejects(self) -> DataFrame:
        return self.annotated.filter(~F.col("_txn_missing") & ~F.col("_is_first")).select(
            "_raw", ORD, "transaction_id", *[F.col(f"_raw.{c}").alias(c) for c in RAW[1:]])

    @cached_property
    def cleaned(self) -> DataFrame:
        if self.ledger or self._staged_facts:
            return self.annotated.filter("_is_first")
        return self._with_rules(with_parsed_date(self._first_rows, F.col("_raw.date")))

    @cached_property
    def clean_rows(self) -> DataFrame:
        """Cleaned rows without bookkeeping columns."""
        return self.cleaned.select("transaction_id", "customer_id", "product_id", "product_name", "category",
                                   "price", "quantity", "discount", "date_key", "region")

    # ---- W4 + W3 + C11
    def _compared_survivors(self) -> DataFrame:
        """Surviving rows that may share a fact key: all of them in a run without stages."""
        return self._compared.filter("_is_first") if self.materialize else self.cleaned

    def _lone_facts(self) -> DataFrame:
        """Facts of keys of their own, flagged."""
        return self._lone.filter("_is_first").select(*FACT_COLUMNS, ORD, F.col("_is_first"))

    @cached_property
    def _compared_facts(self) -> DataFrame:
        """The distinct facts among the others."""
        rows = DD.count_copies(self._compared_survivors().select(*FACT_COLUMNS, ORD), FACT_COLUMNS).drop("_n")
        if self.ledger:  # a fact row that an earlier epoch has had is the same row once more
            rows = rows.withColumn("fact", fact_digest()).join(self.ledger.facts(self._shared), ["transaction_id", "product_id", "fact"], "left_anti").select(*rows.columns)
        return rows

    @cached_property
    def _compared_flags(self) -> DataFrame:
        flagged = DD.flag_first(self._compared_facts, FACT_KEYS)
        if not self.ledger:
            return flagged
        met = self.ledger.facts(self._shared).select(*FACT_KEYS).distinct().withColumn("_met", F.lit(True))
        return flagged.join(met, FACT_KEYS, "left").withColumn("_is_first", F.col("_is_first") & F.col("_met").isNull()).select(*flagged.columns)

    @cached_property
    def fact_distinct(self) -> DataFrame:
        if self.materialize:
            return self._compared_facts.unionByName(self._lone_facts().drop("_is_first"))
        return self._compared_facts

    @cached_property
    def fact_key_flagged(self) -> DataFrame:
        return self._compared_flags.unionByName(self._lone_facts()) if self.materialize else self._compared_flags

    _staged_facts = property(lambda self: "_observed_facts" in self.__dict__)

    def stage_fact_flags(self) -> None:
        """Write the flagged facts once for a load, whose facts, log, counters and ledger all read them; their counters are observed meanwhile."""
        seen = Observation()
        self.fact_key_flagged = write_stage(self.fact_key_flagged.observe(seen, *self._fact_counters), "fact_flags", self.folder)
        self.fact_distinct = self.fact_key_flagged.drop("_is_first")
        self._observed_facts = seen.get

    @cached_property
    def fact_key_rejects(self) -> DataFrame:
        flagged = self.fact_key_flagged if self._staged_facts else self._compared_flags
        return flagged.filter(~F.col("_is_first")).drop("_is_first")

    @cached_property
    def fact_deduped(self) -> DataFrame:
        """W4 then W3 survivors: per key, the values of the first row (one aggregate, no join; none of staged flags)."""
        if self._staged_facts:
            return self.fact_key_flagged.filter("_is_first").select(*FACT_COLUMNS, ORD)
        proj = self.cleaned.select(*FACT_COLUMNS, ORD)
        if self.ledger:
            proj = proj.join(self.ledger.facts().select(*FACT_KEYS), FACT_KEYS, "left_anti").select(*proj.columns)
        if self._by_place and not self.ledger:
            staged = write_stage(proj, "clean_facts", self.folder)  # read twice
            return self._firsts_of_shared(staged, FACT_KEYS, "shared_facts").select(*FACT_COLUMNS, ORD)
        values = [c for c in FACT_COLUMNS if c not in ("transaction_id", "product_id")]
        return DD.first_row_per_key(proj, ["transaction_id", "product_id"], values).select(*FACT_COLUMNS, ORD)

    @cached_property
    def fact_typed(self) -> DataFrame:
        """C11: cast to the fact's column types."""
        return self.fact_deduped.select(
            "transaction_id", "product_id", "customer_id", "date_key",
            F.col("quantity").cast("int").alias("quantity"),
            F.col("discount").cast("decimal(5,2)").alias("discount"),
            "region", ORD)

    def record(self) -> None:
        """Enter this epoch's rows and facts into the ledger."""
        place = [F.col(f"{ORD}.{c}").alias(c) for c in ("file", "block", "position")]
        txn = clean_txn(F.col("transaction_id"))
        rows = self.full_row_groups.select("row", F.col("_n").alias("n"), *place, F.when(~txn_missing(txn), txn).alias("transaction_id"), F.col("product_id").alias("raw_product_id"))
        self.ledger.record(rows, self.fact_distinct.select(*FACT_KEYS, fact_digest().alias("fact")))

    # ---- product extract (C13, W4, W5) and its cast
    @cached_property
    def product_extract(self) -> DataFrame:
        src = self.cleaned.filter(F.col("product_id") != K.UNKNOWN).select(
            "product_id", "product_name", "category", "price", ORD)
        first = DD.first_row_per_key(src, ["product_id"], ["product_name", "category", "price"])
        return first.select("product_id", "product_name", "category", "price")

    @cached_property
    def product_typed(self) -> DataFrame:
        return self.product_extract.select("product_id", "product_name", "category",
                                           F.col("price").cast("decimal(10,2)").alias("price"))

    # ---- bad-data log
    def _log(self, df: DataFrame, issues: Column, record_id: Column, original: Column,
             copy_no: Column | None = None) -> DataFrame:
        return log_rows(df, issues, record_id, original, self.run_id, self.run_ts, K.SOURCE_SALES, copy_no)

    @cached_property
    def bad_data_log(self) -> DataFrame:
        """All log rows of the run: full-row copies, then one pass for C1, W2 and every column rule."""
        raw_json = F.to_json(F.col("_raw"), {"ignoreNullFields": "false"})
        w1 = self._log(self.full_row_rejects, F.array(issue_when(F.lit(True), "duplicate_full_row")),
                       F.col("transaction_id"), record_json(RAW), F.col("_copy"))
        f = F.col("_flags")
        first = F.col("_is_first")
        rules = F.array(
            issue_when(F.col("_txn_missing"), "txn_missing"),
            issue_when(~F.col("_txn_missing") & ~first, "txn_product_dup"),
            issue_when(first & f.customer_missing, "customer_missing"),
            issue_when(first & f.product_id_missing, "product_id_missing"),
            issue_when(first & f.product_name_missing, "product_name_missing"),
            issue_when(first & f.category_missing, "category_missing"),
            issue_when(first & f.price_invalid, "price_invalid"),
            issue_when(first & (f.quantity_missing | f.quantity_negative), "quantity_invalid"),
            issue_when(first & (f.discount_missing | f.discount_negative), "discount_invalid"),
            issue_when(first & f.date_missing, "date_missing"),
            issue_when(first & f.date_invalid, "date_invalid"),
            issue_when(first & f.region_missing, "region_missing"),
        )
        rows = self._log(self.annotated, rules, F.col("transaction_id"), raw_json)
        w3 = self._log(self.fact_key_rejects, F.array(issue_when(F.lit(True), "fact_key_dup")),
                       F.col("transaction_id"), record_json(FACT_COLUMNS))
        return w1.unionByName(rows).unionByName(w3)

    # ---- counters
    @property
    def _counters(self) -> list[Column]:
        """Counters of the annotated frame."""
        f = F.col("_flags")
        first = F.col("_is_first")
        return [
            *([] if self.ledger else [F.sum("_n").alias("rows_in"), F.sum(F.col("_n") - 1).alias("full_row_duplicates")]),
            F.count_if("_txn_missing").alias("missing_transaction_id"),
            F.count_if(~F.col("_txn_missing") & ~first).alias("duplicate_transaction_product"),
            F.count_if(first).alias("rows_clean"),
            *[F.count_if(first & getattr(f, n)).alias(n) for n in
              ("customer_missing", "product_id_missing", "product_name_missing", "category_missing",
               "price_invalid", "quantity_missing", "quantity_negative", "discount_missing",
               "discount_negative", "date_missing", "date_invalid", "region_missing")],
            F.count_if(first & (f.quantity_missing | f.quantity_negative)).alias("quantity_invalid"),
            F.count_if(first & (f.discount_missing | f.discount_negative)).alias("discount_invalid"),
            F.count_if(first & (F.col("region") == K.UNKNOWN)).alias("region_unknown_total"),
            F.count_if(first & (F.col("customer_id") == K.UNKNOWN)).alias("customer_unknown_total")]

    _fact_counters = property(lambda self: [F.count_if(~F.col("_is_first")).alias("duplicate_fact_key"), F.count_if("_is_first").alias("fact_rows")])

    @cached_property
    def metrics(self) -> DataFrame:
        from .quality import fold_rows
        if self.materialize:
            one = _one_row(self.raw.sparkSession, self._observed)
        else:
            one = self.annotated.agg(*self._counters)
        k = _one_row(self.raw.sparkSession, self._observed_facts) if self._staged_facts else self.fact_key_flagged.agg(*self._fact_counters)
        if self.ledger:  # copies of rows that earlier epochs have met count here only
            one = fold_rows(self.full_row_groups.agg(F.sum("_n").alias("rows_in"), (F.sum("_n") - F.count_if(F.col("_before") == 0)).alias("full_row_duplicates")), one)
        row = fold_rows(one, k)
        return row.select(*[F.col(x).cast("bigint").alias(x) for x in row.columns])
