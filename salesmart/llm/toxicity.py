"""Toxicity scoring by a weighted finite-state grammar over clauses.

Four letter transducers read a clause's word classes one after another: negation marks the insults and
threats it reaches, threat marks the target that completes one, report marks the end of a clause that
quotes, and the clause transducer names the pattern at its end.  ``compose`` makes one machine of them; its
arcs carry weights of the max semiring (an insult's arc the weight of its lexicon entry), so a matched
clause comes with the weight of its strongest arc.  Insults are a lexicon learned from labelled texts, as
whole words and as word beginnings.  A document is scored by its matched clauses with weights fitted by
logistic regression on the labelled texts; isolated words outside any pattern do not count.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.llm.common import slices, stage

TARGETS = frozenset("you your yours yourself u ur they them he him she her we us du dich dir ihr euch sie er tu te toi vous il elle ils tú usted ustedes él ella ellos".split())
NEGATIONS = frozenset("not never no nobody nothing without isn aren wasn don doesn nicht kein keine keinen nie niemals pas jamais sans nunca jamás ni sin".split())
REPORTS = frozenset("said says say wrote writes called calls claimed claims quoted quote according asked told sagte schrieb nannte laut dit dites écrit selon dijo dice escribió según llamó".split())
THREATS = frozenset("kill hurt destroy shoot stab burn attack beat murder hang töten umbringen verletzen tuer frapper détruire matar golpear destruir".split())
#: Candidates and lexicon entries up to this number are sent to the tasks; more are joined as a table.
SENT = 200_000
#: Shares of the other texts (one in so many) in which entries are refuted before all of them are read.
REFUTING = (64, 8)
#: Lengths of a word's beginnings, and how much evidence an entry needs.
BEGINNINGS = (4, 5, 6, 7)
MIN_TEXTS = 5
MIN_SHARE = 0.8
REACH = 4  # words between a negation and what it negates, or a threat and its target
#: Uses that a task remembers before it starts to forget them.
REMEMBERED = 1_000_000

_TOKEN = re.compile(r"[^\W\d_]+|[.,;:!?\n]")
_BREAKS = frozenset(".,;:!?\n")
#: Patterns a clause can match; the features of a document.
PATTERNS = ("insult", "aimed", "threat", "insult-negated", "aimed-negated", "threat-negated", "insult-reported", "aimed-reported", "threat-reported")


def tokens(text: str | None) -> list[str]:
    return _TOKEN.findall(text.lower()) if text else []


def entry_names(word: str) -> list[str]:
    """A word's lexicon names: itself, and its beginnings marked by a dash."""
    return [word, *(f"{word[:n]}-" for n in BEGINNINGS if len(word) > n)]


class Lexer:
    """Word -> (class, weight); remembers what it has seen, up to a bound.  ``hot``: the words seen that can start a pattern."""

    def __init__(self, lexicon: dict[str, float]) -> None:
        self.lexicon = lexicon
        self._forget()

    def _forget(self) -> None:
        self.seen: dict[str, tuple[str, float]] = {b: ("/", 0.0) for b in _BREAKS}
        self.hot: set[str] = set()

    def __call__(self, word: str) -> tuple[str, float]:
        self.learn({word})
        return self.seen[word]

    def learn(self, words: set[str]) -> None:
        """See to it that all of these words are in ``seen``."""
        new = words.difference(self.seen)
        if len(self.seen) + len(new) > 300_000:
            self._forget()
            new = words.difference(self.seen)
        for word in new:
            weight = max((self.lexicon.get(n, 0.0) for n in entry_names(word)), default=0.0)
            kind = "I" if weight else "T" if word in TARGETS else "N" if word in NEGATIONS else "R" if word in REPORTS else "V" if word in THREATS else "-"
            self.seen[word] = (kind, weight)
            if kind in "IV":
                self.hot.add(word)


#: An arc's weight: how the word's own weight counts, and a constant; the larger is taken.
Weight = tuple[float, float]
FREE: Weight = (0.0, 0.0)


@dataclass
class Transducer:
    """A deterministic letter transducer: (state, letter) -> (state, letter written, weight)."""

    start: object
    arcs: dict[tuple[object, str], tuple[object, str, Weight]]

    @staticmethod
    def build(start: object, letters: str | list[str], arc) -> Transducer:
        """All states that ``arc(state, letter)`` reaches from the start."""
        arcs, open_, known = {}, [start], {start}
        while open_:
            state = open_.pop()
            for x in letters:
                arcs[state, x] = arc(state, x)
                after = arcs[state, x][0]
                if after not in known:
                    known.add(after)
                    open_.append(after)
        return Transducer(start, arcs)

    def letters(self) -> list[str]:
        return list(dict.fromkeys(x for _, x in self.arcs))

    def numbered(self) -> Transducer:
        """The same machine with numbers for states."""
        number = {state: k for k, state in enumerate(dict.fromkeys([self.start, *(p for p, _ in self.arcs)]))}
        return Transducer(0, {(number[p], x): (number[q], y, w) for (p, x), (q, y, w) in self.arcs.items()})


def compose(first: Transducer, second: Transducer) -> Transducer:
    """The machine that reads what ``first`` reads and writes what ``second`` makes of it; weights combine by max."""

    def arc(state, x):
        p, q = state
        p, y, (a, b) = first.arcs[p, x]
        q, z, (c, d) = second.arcs[q, y]
        return (p, q), z, (max(a, c), max(b, d))

    return Transducer.build((first.start, second.start), first.letters(), arc)


def _later(since: int) -> int:
    """One word further from something; beyond ``REACH`` it no longer counts."""
    return min(since + 1, REACH + 1)


def _negation(since: int, x: str) -> tuple[int, str, Weight]:
    """State: words since a negation.  Insults and threats in its reach are written small."""
    if x == "/":
        return REACH + 1, x, FREE
    since = 0 if x == "N" else _later(since)
    weight = (1.0, 0.0) if x == "I" else FREE
    return since, x.lower() if x in "IV" and since <= REACH else x, weight


def _threat(since: int, x: str) -> tuple[int, str, Weight]:
    """State: words since a threat.  A target in its reach is written H and weighs one."""
    if x == "/":
        return REACH + 1, x, FREE
    since = 0 if x in "Vv" else _later(since)
    return (since, "H", (0.0, 1.0)) if x == "T" and since <= REACH else (since, x, FREE)


def _report(reported: bool, x: str) -> tuple[bool, str, Weight]:
    """State: whether the clause has a word of speech.  The end of one that has is written Q."""
    return (False, "Q" if reported else x, FREE) if x == "/" else (reported or x == "R", x, FREE)


def _clause(state: tuple[bool, bool, bool, bool], x: str) -> tuple[tuple[bool, bool, bool, bool], str, Weight]:
    """State: insult, threat, target and negation seen.  The clause's end is written as its pattern, all else as nothing."""
    insult, threat, target, negated = state
    if x in "/Q":
        name = "aimed" if insult and target else "insult" if insult else "threat" if threat else ""
        return (False,) * 4, name and name + ("-reported" if x == "Q" else "-negated" if negated else ""), FREE
    return (insult or x in "Ii", threat or x == "H", target or x in "TH", negated or x in "iv"), "", FREE


def grammar_machine() -> Transducer:
    """negation o threat o report o clause, over the classes I (insult), V (threat), T (target), N, R, - (other) and / (end)."""
    negation = Transducer.build(REACH + 1, "IVTNR-/", _negation)
    threat = Transducer.build(REACH + 1, "IiVvTNR-/", _threat)
    report = Transducer.build(False, "IiVvTHNR-/", _report)
    clause = Transducer.build((False,) * 4, "IiVvTHNR-/Q", _clause)
    return compose(compose(compose(negation, threat), report), clause).numbered()


MACHINE = grammar_machine()


def clauses(classes: list[tuple[str, float]]) -> Iterator[tuple[str, float]]:
    """Classes of a text's words -> (pattern, weight) of each matched clause, read by the composed machine."""
    arcs, state, best = MACHINE.arcs, MACHINE.start, 0.0
    for kind, weight in [*classes, ("/", 0.0)]:
        state, written, (scale, constant) = arcs[state, kind]
        best = max(best, scale * weight, constant)
        if kind == "/":
            if written:
                yield written, best
            best = 0.0


#: Matched clauses per word from which a text counts as fairly, and as densely, matched.
DENSE = (0.004, 0.01)
#: Lexicon weight from which an entry is strong evidence by itself (about one clean use in fifty).
STRONG = 4.0


def features(lexer: Lexer, text: str | None) -> tuple[int, ...]:
    """Which patterns the clauses match, then how densely (0 to 3), whether by a strong entry, and whether only once.

    A word beginning that harmless words share by chance matches thinly; insults come in numbers.  There
    are at most 2 ** 9 * 4 * 2 * 2 feature vectors.
    """
    found = tokens(text)
    lexer.learn(set(found))
    classes = [lexer.seen[w] for w in found] if not lexer.hot.isdisjoint(found) else []
    matched = list(clauses(classes))
    if not matched:
        return (0,) * (len(PATTERNS) + 3)
    words = sum(k != "/" for k, _ in classes)
    seen = {p for p, _ in matched}
    level = 1 + sum(len(matched) >= d * words for d in DENSE)
    return (*(int(p in seen) for p in PATTERNS), level, int(max(w for _, w in matched) >= STRONG), int(len(matched) == 1))


def _design(x: tuple[int, ...] | list[int]) -> list[int]:
    """Feature vector -> regression inputs: pattern bits, one bit for each level, strong, single."""
    n = len(PATTERNS)
    return [*x[:n], *(int(x[n] == level) for level in range(1, len(DENSE) + 2)), *x[n + 1:]]


@dataclass
class Grammar:
    lexicon: dict[str, float] | DataFrame  # a staged table (entry, weight) if it is too large to send
    weights: np.ndarray  # of the regression inputs, then the bias

    def probability(self, x: tuple[int, ...]) -> float:
        z = float(np.dot(self.weights[:-1], _design(x)) + self.weights[-1])
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, z))))


def _word_counts(texts: DataFrame) -> DataFrame:
    """(text) -> (word, n): how many of the texts hold the word, added up before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: Counter[str] = Counter()

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(count), pa.string()), pa.array(list(count.values()), pa.int64())], ["word", "n"])

        for b in slices(batches):
            for text in b.column(0).to_pylist():
                count.update(set(tokens(text)) - _BREAKS)
            if len(count) > 500_000:
                yield rows()
                count.clear()
        yield rows()

    got = texts.mapInArrow(run, "word string, n long")
    return got.groupBy("word").agg(F.sum("n").alias("n"))


def _distinct_uses(texts: DataFrame, candidates: DataFrame, name: str) -> DataFrame:
    """(text) and staged candidates (entry, most) -> (entry, ``name``): distinct surroundings of the entry's uses.

    The surroundings are the words around, so copies count once.  Beyond ``most`` (null: no end) the number is only
    known to be larger: a task that has seen so many of an entry is done with it.  A task hands on each use it
    remembers once; when it remembers too many it forgets uses (and may hand them on again), never which entries it is done with.
    """
    few = candidates.limit(SENT + 1).count() <= SENT
    sent = dict(zip(*candidates.toArrow().select(["entry", "most"]).to_pydict().values(), strict=True)) if few else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[str, list[str]] = {}
        seen: dict[str, set[int]] = {}
        held, over = 0, set()
        for b in slices(batches):
            entries: list[str] = []
            hashes: list[int] = []
            for text in b.column(0).to_pylist():
                words = [w for w in tokens(text) if w not in _BREAKS]
                new = set(words).difference(names)
                if len(names) + len(new) > 300_000:
                    names.clear()
                    new = set(words)
                for w in new:
                    names[w] = [n for n in entry_names(w) if sent is None or n in sent]
                for i, w in enumerate(words):
                    mine = names[w]
                    if not mine:
                        continue
                    around = xxhash.xxh64_intdigest(" ".join([*words[max(0, i - 2):i], "", *words[i + 1:i + 3]]).encode(), 1) >> 1
                    for n in mine:
                        if n in over or around in (of := seen.setdefault(n, set())):
                            continue
                        of.add(around)
                        held += 1
                        entries.append(n)
                        hashes.append(around)
                        if sent is not None and sent[n] is not None and len(of) > sent[n]:
                            over.add(n)
                            held -= len(seen.pop(n))
                    if not over.isdisjoint(mine):
                        names[w] = [n for n in mine if n not in over]
            if held > REMEMBERED:
                seen.clear()
                held = 0
            if entries:
                yield pa.RecordBatch.from_arrays([pa.array(entries, pa.string()), pa.array(hashes, pa.int64())], ["entry", "around"])

    uses = texts.mapInArrow(run, "entry string, around long")
    uses = uses if few else uses.join(candidates.select("entry"), "entry", "left_semi")
    return uses.groupBy("entry", "around").agg(F.count("*").alias("n")).groupBy("entry").agg(F.count("*").alias(name))


def _names(word: Column) -> Column:
    """A word column's lexicon names, as ``entry_names`` gives them."""
    return F.array_compact(F.array(word, *[F.when(F.length(word) > n, F.concat(F.substring(word, 1, n), F.lit("-"))) for n in BEGINNINGS]))


def learn_lexicon(training: DataFrame) -> DataFrame:
    """Words and word beginnings that stand mostly in toxic texts -> staged (entry, weight), the weight being log odds.

    Words and beginnings of enough different toxic texts are candidates.  Their distinct surroundings are
    counted, first in the toxic texts, then in the others, so a text with many copies is one piece of
    evidence for either side.  What growing shares of the other texts refute is refuted for good, as a count over a share
    is never above the whole; the rest is counted in all of them.
    """
    toxic, other = training.filter("toxic > 0").select("text"), training.filter("toxic <= 0").select("text")
    counts = stage(_word_counts(toxic.distinct()), "toxic-words")
    entries = counts.select(F.explode(_names(F.col("word"))).alias("entry"), "n").groupBy("entry").agg(F.sum("n").alias("n"))
    candidates = stage(entries.filter(F.col("n") >= MIN_TEXTS).select("entry", F.lit(None).cast("long").alias("most")), "toxic-candidates")
    # From so many other uses on an entry's share is too small.
    most = F.floor(F.col("bad") * ((1 - MIN_SHARE) / MIN_SHARE)) + 1
    bad = stage(_distinct_uses(toxic, candidates, "bad").filter(F.col("bad") >= MIN_TEXTS).withColumn("most", most), "toxic-uses")
    for share in REFUTING:
        part = other.filter(F.pmod(F.xxhash64("text"), F.lit(REFUTING[0])) < REFUTING[0] // share)
        refuted = bad.join(_distinct_uses(part, bad, "good"), "entry").filter(F.col("good") > F.col("most")).select("entry")
        bad = stage(bad.join(refuted, "entry", "left_anti"), f"toxic-left-{share}")
    both = bad.join(_distinct_uses(other, bad, "good"), "entry", "left").select("entry", "bad", F.coalesce("good", F.lit(0)).alias("good"))
    proven = both.filter(F.col("bad") / (F.col("bad") + F.col("good")) >= MIN_SHARE)
    return stage(proven.select("entry", F.log((F.col("bad") + 0.5) / (F.col("good") + 0.5)).alias("weight")), "lexicon")


def _featured(docs: DataFrame, lexicon: dict[str, float] | DataFrame, make, schema: T.StructType) -> DataFrame:
    """Rows whose last column is a text -> ``make(batch, feature vectors)``.

    With a lexicon that is a table, each text brings the weights of its own words, joined by row.
    """
    if isinstance(lexicon, DataFrame):
        columns = [f"c{k}" for k in range(len(docs.columns) - 1)]
        rows = stage(docs.toDF(*columns, "text").withColumn("row", F.monotonically_increasing_id()), "toxic-rows")

        def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in slices(batches):
                row, word = [], []
                for r, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                    own = set(tokens(text)) - _BREAKS
                    row += [r] * len(own)
                    word += own
                yield pa.RecordBatch.from_arrays([pa.array(row, pa.int64()), pa.array(word, pa.string())], ["row", "word"])

        named = rows.select("row", "text").mapInArrow(words, "row long, word string").select("row", "word", F.explode(_names(F.col("word"))).alias("entry"))
        weighed = named.join(lexicon, "entry").groupBy("row", "word").agg(F.max("weight").alias("weight"))
        own = weighed.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("word", "weight"))).alias("weights"))
        docs, lexicon = rows.join(own, "row", "left").select(*columns, "weights", "text"), None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexer = Lexer(lexicon or {})
        for b in slices(batches):
            texts = b.column(b.num_columns - 1).to_pylist()
            if lexicon is None:
                x = [features(Lexer(dict(own or [])), t) for own, t in zip(b.column(b.num_columns - 2).to_pylist(), texts, strict=True)]
                yield make(b.columns[:-2], x)
            else:
                yield make(b.columns[:-1], [features(lexer, t) for t in texts])

    return docs.mapInArrow(run, schema)


def fit(training: DataFrame, ridge: float = 0.05) -> Grammar:
    """Training rows (text, toxic) -> lexicon and pattern weights.  No rows: an empty grammar with score one half.

    Rows without a label teach nothing; a text with both labels is evidence for both.
    """
    training = training.select(F.col("text").cast("string").alias("text"), F.col("toxic").cast("int").alias("toxic")).filter("toxic is not null")
    learned = learn_lexicon(training)
    lexicon = learned if learned.limit(SENT + 1).count() > SENT else {r.entry: r.weight for r in learned.collect()}
    rows = training.select((F.col("toxic") > 0).cast("int").alias("y"), "text")
    schema = T.StructType().add("y", T.IntegerType()).add("x", T.ArrayType(T.IntegerType()))
    made = _featured(rows, lexicon, lambda kept, x: pa.RecordBatch.from_arrays([*kept, pa.array(x, pa.list_(pa.int32()))], ["y", "x"]), schema)
    table = made.groupBy("x", "y").agg(F.count("*").alias("n")).collect()
    prior = np.array([2.0, 2.5, 2.5, 0.5, 1.0, 1.0, 0.5, 1.0, 1.0, -1.0, 0.0, 1.0, 2.0, -1.0, -2.0])
    if not table:
        return Grammar(lexicon, prior)
    x = np.array([[*_design(r.x), 1] for r in table], float)
    y, n = np.array([r.y for r in table], float), np.array([r.n for r in table], float)
    w, pull = prior.copy(), np.full(len(prior), ridge)
    pull[-1] = 1e-6
    for _ in range(50):  # Newton steps, damped, towards the prior where the texts say nothing
        p = 1 / (1 + np.exp(-np.clip(x @ w, -60, 60)))
        gradient = x.T @ (n * (p - y)) + pull * (w - prior)
        hessian = (x * (n * p * (1 - p))[:, None]).T @ x + np.diag(pull)
        move = np.linalg.solve(hessian, gradient)
        move *= min(1, 2 / max(1e-9, np.abs(move).max()))
        w = w - move
        if np.abs(move).max() < 1e-8:
            break
    return Grammar(lexicon, w)


def score(docs: DataFrame, grammar: Grammar, *keep: str | Column) -> DataFrame:
    """Documents with a column text -> the columns ``keep``, score (0 to 1) and matched (the patterns found); one row each.

    Null, empty and letterless texts match no clause and get the score of a text without matches.
    """
    text = F.col("text").cast("string")
    schema = T.StructType(docs.select(*keep).schema.fields)
    names = schema.fieldNames()
    schema = schema.add("score", "double").add("matched", T.MapType(T.StringType(), T.IntegerType()))

    def make(kept: list, x: list[tuple[int, ...]]) -> pa.RecordBatch:
        p = [grammar.probability(v) for v in x]
        hit = [[(k, c) for k, c in zip(PATTERNS, v, strict=False) if c] for v in x]
        return pa.RecordBatch.from_arrays([*kept, pa.array(p, pa.float64()), pa.array(hit, pa.map_(pa.string(), pa.int32()))], [*names, "score", "matched"])

    # Tasks get the pattern weights alone, not a lexicon table.
    lexicon, grammar = grammar.lexicon, Grammar({}, grammar.weights)
    return _featured(docs.select(*keep, text), lexicon, make, schema)
