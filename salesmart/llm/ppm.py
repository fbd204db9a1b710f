"""Language-model scoring by prediction by partial matching (PPM) over bytes, and a unigram base score.

Training counts every run of ``order + 1`` symbols (bytes, and one symbol for the text's border) of
all training texts, and every word.  The runs form the context trie: shorter contexts are sums over
their extensions.  A symbol's probability starts at the longest context the trie has; if the symbol
was not seen there, the escape probability of that context (method C: distinct / (total + distinct))
is paid and the next shorter context is tried, with the symbols already refused left out of its
counts (exclusion), down to a uniform guess over the symbols that no context has.

The symbols refused on the way down are exactly those seen in the next longer context, so totals
after exclusion belong to a context and are computed once for the trie, not once for each symbol.

A trie too large to send stays in its staged table, whole.  The frequent runs are sent with their
probabilities, taken from the totals of all runs; all other runs of the documents meet the trie in Spark,
dealt by the end of their context, so that a part holds every run of its longer contexts.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import raw_bytes, slices, stage

ORDER = 5
BORDER = 256  # the symbol before and after a text
SYMBOLS = 257
BITS = 9
#: The largest trie, in runs of order + 1 symbols, that is sent to every executor.  Of a larger one only frequent runs
#: are sent; all others are looked up in the staged table, about ``PART_RUNS`` at a time.
MAX_RUNS = 6_000_000
PART_RUNS = 1_000_000
#: The most frequent words that are sent to every executor; all other words meet their counts in a join.
FREQUENT = 100_000
FREQUENT_BYTES = 64


def symbols(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one array of symbols, each preceded by ``order`` borders and ended by one; and the texts' lengths."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    if not len(texts):
        return np.zeros(0, np.uint64), sizes
    flat = np.frombuffer(b"".join(texts), np.uint8)
    out = np.full(int(sizes.sum()) + (order + 1) * len(texts), BORDER, np.uint64)
    gap = np.arange(1, len(texts) + 1) * (order + 1) - 1
    out[np.arange(len(flat)) + np.repeat(gap, sizes)] = flat
    return out, sizes


def runs(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the run of ``order + 1`` symbols that ends at each symbol of each text (its end border included)."""
    s, sizes = symbols(texts, order)
    if not len(sizes):
        return np.zeros(0, np.uint64), sizes
    code = np.zeros(max(0, len(s) - order), np.uint64)
    for j in range(order + 1):
        code = (code << np.uint64(BITS)) | s[j:len(s) - order + j]
    # The runs that start in the last ``order`` places before the next text end in its leading borders.
    following = np.cumsum(sizes + order + 1)[:-1]
    keep = np.ones(len(code), bool)
    keep[(following[:, None] - order + np.arange(order)[None, :]).ravel()] = False
    return code[keep], sizes + 1


def words_of(text: bytes) -> list[bytes]:
    """Words with A-Z lower-cased; a word of more than 64 bytes is named by a 128-bit digest, so names stay short."""
    words = text.lower().split()
    if words and len(max(words, key=len)) > FREQUENT_BYTES:
        import xxhash

        words = [w if len(w) <= FREQUENT_BYTES else b"\x00" + xxhash.xxh3_128_hexdigest(w).encode() for w in words]
    return words


def _merge(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    first = np.nonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))[0] if len(codes) else np.zeros(0, np.int64)
    return codes[first], np.add.reduceat(counts, first) if len(first) else counts


def corpus_counts(training: DataFrame, order: int = ORDER) -> DataFrame:
    """Training texts (column text) -> staged (word binary, code long, n long).

    Rows with a word count words, the empty word counting text ends; rows with a code count runs.
    Each task aggregates before the shuffle, so a word or run that fills the corpus is one row a task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter[bytes] = Counter()
        held, size, codes, counts = [], 0, np.zeros(0, np.uint64), np.zeros(0, np.int64)

        def rows_of_words() -> pa.RecordBatch:
            n = len(words)
            out = pa.RecordBatch.from_arrays([pa.array(list(words), pa.binary()), pa.nulls(n, pa.int64()), pa.array(list(words.values()), pa.int64())], ["word", "code", "n"])
            words.clear()
            return out

        def rows_of_runs() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.nulls(len(codes), pa.binary()), pa.array(codes.view(np.int64)), pa.array(counts)], ["word", "code", "n"])

        def gather() -> None:
            nonlocal held, size, codes, counts
            new = np.sort(runs(held, order)[0])
            first = np.nonzero(np.concatenate([[True], new[1:] != new[:-1]]))[0]
            fresh = np.diff(np.append(first, len(new)))
            codes, counts = _merge(np.concatenate([codes, new[first]]), np.concatenate([counts, fresh]))
            held, size = [], 0

        for b in slices(batches):
            for text in raw_bytes(b, "text"):
                text = text or b""
                words.update(words_of(text))
                words[b""] += 1
                held.append(text)
                size += len(text)
                if size > 2_000_000:
                    gather()
                    if len(codes) > 1_500_000:
                        yield rows_of_runs()
                        codes, counts = codes[:0], counts[:0]
                if len(words) > 200_000:
                    yield rows_of_words()
        if held:
            gather()
        yield rows_of_words()
        yield rows_of_runs()

    got = training.select(F.col("text").cast("string")).mapInArrow(run, "word binary, code long, n long")
    return stage(got.groupBy("word", "code").agg(F.sum("n").alias("n")), "lm-counts")


class Table:
    """Open-addressing hash table from codes to their places in an array."""

    EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)

    def __init__(self, codes: np.ndarray) -> None:
        self.bits = max(4, (2 * len(codes)).bit_length())
        self.keys = np.full(1 << self.bits, self.EMPTY)
        self.place = np.zeros(1 << self.bits, np.int32)
        left, slot = np.arange(len(codes)), self._slot(codes)
        while len(left):
            free = self.keys[slot] == self.EMPTY
            self.keys[slot[free]] = codes[left[free]]  # the last of several wins
            won = self.keys[slot] == codes[left]
            self.place[slot[won]] = left[won]
            left, slot = left[~won], (slot[~won] + 1) & (len(self.keys) - 1)

    def _slot(self, codes: np.ndarray) -> np.ndarray:
        return ((codes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, codes: np.ndarray) -> np.ndarray:
        """Place of each code, -1 if it is absent."""
        slot = self._slot(codes)
        key = self.keys[slot]
        out = np.where(key == codes, self.place[slot], np.int32(-1))
        left = np.nonzero((key != codes) & (key != self.EMPTY))[0]
        slot = slot[left]
        while len(left):
            slot = (slot + 1) & (len(self.keys) - 1)
            key = self.keys[slot]
            hit = key == codes[left]
            out[left[hit]] = self.place[slot[hit]]
            go = ~hit & (key != self.EMPTY)
            left, slot = left[go], slot[go]
        return out


def _log(x: np.ndarray) -> np.ndarray:
    """log10, 0 where x is 0 (an escape from a context that excludes all of its symbols costs nothing)."""
    return np.log10(np.where(x > 0, x, 1.0))


@dataclass
class Level:
    """One context length: its runs with log counts, its contexts with log totals and log escapes."""

    grams: Table
    log_count: np.ndarray
    contexts: Table
    log_total: np.ndarray  # T + d
    log_escape: np.ndarray  # d / (T + d)
    #: For the next shorter context after an escape from here, with this context's symbols excluded:
    below_total: np.ndarray
    below_escape: np.ndarray


class Model:
    """The trie as one ``Level`` for each context length 0 .. order.

    below: a model of the shorter contexts, made with ``open_top``; its levels are taken over and ``codes`` only give
    the longer ones.  They must hold all runs of each of their contexts.
    """

    def __init__(self, codes: np.ndarray, counts: np.ndarray, order: int = ORDER, below: Model | None = None, open_top: bool = False) -> None:
        self.order, self.levels = order, list(below.levels) if below else []
        last: tuple = below.last if below else ()
        self.log_unseen = below.log_unseen if below else 0.0
        distinct = np.zeros(0, np.int64)
        for j in range(len(self.levels), order + 1):
            grams, n = _merge(codes & np.uint64((1 << BITS * (j + 1)) - 1), counts)
            context = grams >> np.uint64(BITS)
            first = np.nonzero(np.concatenate([[True], context[1:] != context[:-1]]))[0] if len(grams) else np.zeros(0, np.int64)
            distinct = np.diff(np.append(first, len(grams)))
            total = np.add.reduceat(n, first) if len(first) else np.zeros(0, np.int64)
            contexts = Table(context[first])
            below_total = below_escape = np.zeros(len(first))
            if j:
                low = self.levels[j - 1]
                low_n, low_total, low_distinct = last
                seen = low_n[low.grams.find(grams & np.uint64((1 << BITS * j) - 1))]
                parent = low.contexts.find(context[first] & np.uint64((1 << BITS * (j - 1)) - 1))
                rest = low_total[parent] - np.add.reduceat(seen, first) if len(first) else np.zeros(0)
                kinds = low_distinct[parent] - distinct if len(first) else np.zeros(0)
                below_total, below_escape = _log(rest + kinds), _log(kinds / np.maximum(rest + kinds, 1))
            else:
                self.log_unseen = -np.log10(max(1, SYMBOLS - (distinct[0] if len(distinct) else 0)))
            self.levels.append(Level(Table(grams), np.log10(np.maximum(n, 1)), contexts, _log(total + distinct), _log(distinct / np.maximum(total + distinct, 1)), below_total, below_escape))
            last = n, total, distinct
        self.last = last if open_top else ()
        top = self.levels[order]
        owner = np.repeat(np.arange(len(distinct)), distinct)
        self.log_top = (top.log_count - top.log_total[owner]) if len(owner) else np.zeros(0)

    def log_probabilities(self, codes: np.ndarray) -> np.ndarray:
        """log10 probability of the last symbol of each run, given the symbols before it."""
        place = self.levels[self.order].grams.find(codes)
        out = np.zeros(len(codes))
        hit = place >= 0
        out[hit] = self.log_top[place[hit]]
        left = np.nonzero(~hit)[0]
        longer = np.full(len(left), -1, np.int64)  # place of the context escaped from, one level up
        for j in range(self.order, -1, -1):
            if not len(left):
                return out
            level = self.levels[j]
            run = codes[left] & np.uint64((1 << BITS * (j + 1)) - 1)
            context = level.contexts.find(run >> np.uint64(BITS)).astype(np.int64)
            place = level.grams.find(run) if j < self.order else np.full(len(left), -1)
            here = context >= 0
            total, escape = np.zeros(len(left)), np.zeros(len(left))
            total[here], escape[here] = level.log_total[context[here]], level.log_escape[context[here]]
            came = longer >= 0
            if came.any():
                above = self.levels[j + 1]
                total[came], escape[came] = above.below_total[longer[came]], above.below_escape[longer[came]]
            hit = place >= 0
            out[left[hit]] += level.log_count[place[hit]] - total[hit]
            out[left[~hit]] += escape[~hit]
            left, longer = left[~hit], context[~hit]
        out[left] += self.log_unseen
        return out

    def scores(self, texts: list[bytes], limit: int = 300_000) -> np.ndarray:
        """log10 probability of each text, its end included."""
        out, at = np.zeros(len(texts)), 0
        while at < len(texts):
            size, to = 0, at
            while to < len(texts) and (to == at or size + len(texts[to]) <= limit):
                size += len(texts[to])
                to += 1
            codes, n = runs(texts[at:to], self.order)
            total = 0.0
            if len(codes) <= 2 * limit:
                out[at:to] = np.add.reduceat(self.log_probabilities(codes), np.concatenate([[0], np.cumsum(n)[:-1]]))
            else:  # one very long text
                total = sum(self.log_probabilities(codes[i:i + limit]).sum() for i in range(0, len(codes), limit))
                out[at] = total
            at = to
        return out


class Frequent:
    """Frequent runs with their log10 probabilities; the other runs of a text are handed back."""

    def __init__(self, codes: np.ndarray, logs: np.ndarray, order: int) -> None:
        self.place, self.logs, self.order = Table(codes), logs, order

    def scores(self, texts: list[bytes]) -> tuple[np.ndarray, list[np.ndarray]]:
        out, left = np.zeros(len(texts)), []
        for i, text in enumerate(texts):
            codes = runs([text], self.order)[0]
            place = self.place.find(codes)
            out[i] = self.logs[place[place >= 0]].sum()
            left.append(codes[place < 0].view(np.int64))
        return out, left


@dataclass
class Part:
    """What is sent of a trie beyond the bound, all of it counted over the whole trie."""

    runs: int  # of the whole trie
    codes: np.ndarray  # the frequent runs
    logs: np.ndarray
    length: int  # symbols of the longest shorter runs that fit
    low_codes: np.ndarray
    low_counts: np.ndarray


def _part(trie: DataFrame, size: int, order: int, bound: int) -> Part:
    """Frequent runs (as many whole counts as fit into ``bound``) and the shorter runs of the greatest length that fits."""
    times = trie.groupBy("n").agg(F.count("*").alias("kinds")).orderBy(F.desc("n")).toArrow()
    fits = int(np.searchsorted(np.cumsum(times.column("kinds").to_numpy()), bound, "right"))
    least = times.column("n")[fits - 1].as_py() if fits else None
    of = F.shiftright("code", BITS).alias("context")
    contexts = trie.groupBy(of).agg((F.sum("n") + F.count("*")).alias("size"))
    kept = trie.filter(F.col("n") >= least if fits else F.lit(False)).select("code", "n", of).join(contexts, "context")
    top = kept.select("code", (F.log10("n") - F.log10("size")).alias("log")).toArrow()
    for length in range(order, 0, -1):
        short = trie.groupBy(F.col("code").bitwiseAND(F.lit((1 << BITS * length) - 1).cast("long")).alias("code")).agg(F.sum("n").alias("n"))
        if length == 1 or short.count() <= bound:  # single symbols are at most SYMBOLS
            break
    low = short.toArrow()
    return Part(size, top.column("code").to_numpy().view(np.uint64), top.column("log").to_numpy(), length, low.column("code").to_numpy().view(np.uint64), low.column("n").to_numpy())


def _looked_up(asked: DataFrame, n_asked: int, trie: DataFrame, part: Part, order: int) -> DataFrame:
    """Runs (code) -> (code, log): log10 of the probability of the last symbol, from all runs of the trie."""
    shared = asked.sparkSession.sparkContext.broadcast((part.low_codes, part.low_counts, part.length))
    token = uuid.uuid4().hex
    # The last symbols of the context decide: what ends alike, longer contexts and shorter ones, comes into one part.
    end = F.shiftright("code", BITS).bitwiseAND(F.lit((1 << BITS * part.length) - 1).cast("long"))
    dealt = F.pmod(F.xxhash64(end), F.lit(1 + max(part.runs, n_asked) // PART_RUNS)).alias("part")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        import builtins

        held = builtins.__dict__.setdefault("_llm_ppm", {})
        asked_for = left.column("code").to_numpy()
        log = np.zeros(len(asked_for))
        if len(asked_for):
            if token not in held:
                held.clear()
                codes, counts, length = shared.value
                held[token] = Model(codes, counts, length - 1, open_top=True)
            model = Model(right.column("code").to_numpy().view(np.uint64), right.column("n").to_numpy(), order, held[token])
            for at in range(0, len(log), 300_000):
                log[at:at + 300_000] = model.log_probabilities(asked_for[at:at + 300_000].view(np.uint64))
        return pa.table({"code": pa.array(asked_for, pa.int64()), "log": pa.array(log)})

    return asked.select("code", dealt).groupBy("part").cogroup(trie.select("code", "n", dealt).groupBy("part")).applyInArrow(run, "code long, log double")


@dataclass
class Fitted:
    """What scoring needs: word totals, the frequent words' counts, the trie's runs or the part that is sent, and the staged counts."""

    tokens: int
    distinct: int
    frequent: dict[bytes, int]
    codes: np.ndarray
    counts: np.ndarray
    table: DataFrame
    order: int
    part: Part | None = None


def fit(training: DataFrame, order: int = ORDER, max_runs: int = MAX_RUNS, frequent: int = FREQUENT) -> Fitted:
    """Count all training texts; gather the bounded parts (frequent words, trie) for the executors."""
    table = corpus_counts(training, order)
    n, v = table.filter("word is not null").agg(F.sum("n"), F.count("*")).first()
    top = table.filter("word is not null").orderBy(F.desc("n"), "word").limit(frequent).select("word", "n").toArrow()
    trie = table.filter("code is not null").select("code", "n")
    size, words = trie.count(), dict(zip(top.column("word").to_pylist(), top.column("n").to_pylist(), strict=True))
    if size > max_runs:
        none = np.zeros(0, np.int64)
        return Fitted(n or 0, v, words, none.view(np.uint64), none, table, order, _part(trie, size, order, max_runs // 2))
    all_runs = trie.toArrow()
    codes, counts = all_runs.column("code").to_numpy().view(np.uint64), all_runs.column("n").to_numpy()
    by_code = np.argsort(codes)
    return Fitted(n or 0, v, words, codes[by_code], counts[by_code], table, order)


def score(docs: DataFrame, fitted: Fitted) -> DataFrame:
    """Documents (doc_id, text, held_out) -> doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    One row for each input row.  A null text is empty: its only token is the end.  Without training
    texts every token is unknown and every symbol has the same probability.
    """
    spark = docs.sparkSession
    part, order = fitted.part, fitted.order
    shared = spark.sparkContext.broadcast((fitted.frequent, part.codes, part.logs) if part else (fitted.frequent, fitted.codes, fitted.counts))
    whole = part is None
    token = uuid.uuid4().hex  # names the model built once in each Python worker
    half = 0.5
    scale = fitted.tokens + half * (fitted.distinct + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import builtins
        import math

        frequent, codes, counts = shared.value
        held = builtins.__dict__.setdefault("_llm_ppm", {})
        if token not in held:
            held.clear()
            held[token] = Model(codes, counts, order) if whole else Frequent(codes, counts, order), {w: math.log10((c + half) / scale) for w, c in frequent.items()}
        model, logs = held[token]
        rid = TaskContext.get().partitionId() << 36
        for b in slices(batches):
            texts = [t or b"" for t in raw_bytes(b, "text")]
            base, tokens, known, rare = [], [], [], []
            for t in texts:
                words = words_of(t)
                words.append(b"")
                got = [logs.get(w) for w in words]
                if None in got:
                    rare.append([w for w, g in zip(words, got, strict=True) if g is None])
                    got = [g for g in got if g is not None]
                else:
                    rare.append([])
                base.append(math.fsum(got))
                tokens.append(len(words))
                known.append(len(got))
            n = b.num_rows
            scores, left = (model.scores(texts), [[]] * n) if whole else model.scores(texts)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(rid, rid + n)), b.column(0), b.column(1), pa.array(tokens, pa.int64()), pa.array(known, pa.int64()), pa.array(base, pa.float64()), pa.array(scores), pa.array(rare, pa.list_(pa.binary())), pa.array(left, pa.list_(pa.int64()))],
                                             ["rid", "doc_id", "held_out", "n_tokens", "known", "base", "score", "rare", "left"])
            rid += n

    first = stage(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("held_out").cast("boolean").alias("held_out"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "rid long, doc_id long, held_out boolean, n_tokens long, known long, base double, score double, rare array<binary>, left array<long>"), "lm-first")
    words = first.select("rid", F.explode("rare").alias("word")).groupBy("rid", "word").agg(F.count("*").alias("times"))
    counts = fitted.table.filter("word is not null").select("word", "n")
    met = words.join(counts, "word", "left").select("rid", "times", F.coalesce("n", F.lit(0)).alias("n"))
    log = F.log10((F.col("n") + F.lit(half)) / F.lit(scale))
    rest = met.groupBy("rid").agg(F.sum(F.col("times") * log).alias("more"), F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("also"))
    joined = first.drop("rare", "left").join(rest, "rid", "left")
    if part:
        asked, n_asked = first.select("rid", F.explode("left").alias("code")), first.agg(F.sum(F.size("left"))).first()[0] or 0
        logs = _looked_up(asked.select("code").distinct(), n_asked, fitted.table.filter("code is not null"), part, order)
        spelt = asked.groupBy("rid", "code").agg(F.count("*").alias("times")).join(logs, "code").groupBy("rid").agg(F.sum(F.col("times") * F.col("log")).alias("spelt"))
        joined = joined.join(spelt, "rid", "left").withColumn("score", F.col("score") + F.coalesce("spelt", F.lit(0.0)))
    return joined.select("doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("also", F.lit(0))).alias("n_known"), F.lit(fitted.tokens).cast("long").alias("train_tokens"),
                         (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"), "score")
