import math
import random
import zlib

import pytest

from salesmart.llm import queries, toxicity

SF = "/root/testdata/sf0.01"


def test_held_out_quality(spark):
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = queries.op5_toxicity(spark, SF).collect()
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    held = [(r.predicted, toxic[r.doc_id]) for r in got if r.held_out and r.doc_id in toxic]
    assert sum(p for p, t in held if t) >= 0.8 * sum(t for _, t in held)
    assert sum(p for p, t in held if not t) <= 0.05 * sum(1 - t for _, t in held)


def entries(lexicon):
    return {r.entry: r.weight for r in lexicon.collect()}


def test_clause_patterns():
    lexer = toxicity.Lexer({"idiot": 3.0, "scum-": 2.0, "scumm-": 2.0})
    read = lambda text: sorted(p for p, _ in toxicity.clauses([lexer(w) for w in toxicity.tokens(text)]))
    assert read("The idiot came. Fine day.") == ["insult"]
    assert read("You idiot!") == ["aimed"]
    assert read("He is not an idiot") == ["aimed-negated"]
    assert read("she said: idiot") == ["insult"]  # the colon ends the reporting clause
    assert read("they wrote that an idiot came") == ["aimed-reported"]
    assert read("I will kill you") == ["threat"] and read("never hurt them") == ["threat-negated"]
    assert read("kill time. you rest") == [] and read("you and kill") == []
    assert read("scummy idiot, idiot") == ["insult", "insult"]
    assert toxicity.features(lexer, None) == toxicity.features(lexer, "") == (0,) * 12
    assert toxicity.features(lexer, "idiot. " * 2)[9:] == (3, 0, 0) and toxicity.features(lexer, "idiot " + "fine " * 999)[9:] == (1, 0, 1)


def test_awkward_rows(spark, docs_frame, prose):
    rows = [(i, prose(i, 20) + (" vilewort" + "abc"[i % 3] if i % 2 else "") + " " + prose(1000 + i, 20)) for i in range(60)]
    labelled = spark.createDataFrame([(t, i % 2) for i, t in rows] + [(None, 1), ("", 0), (prose(5, 5), None)], "text string, toxic int")
    grammar = toxicity.fit(labelled)
    assert any(k.startswith("vilew") or k.startswith("vile") for k in grammar.lexicon)
    extra = [(100, None), (101, ""), (102, "Vilewortz here"), (103, prose(1, 20_000)), (None, "vileworta"), (104, "x"), (104, "x")]
    got = toxicity.score(docs_frame(extra), grammar, "doc_id", "term").collect()
    by = {r.doc_id: r.score for r in got}
    assert len(got) == len(extra) and by[102] > 0.7 and by[None] > 0.7 and all(by[i] < 0.5 for i in (100, 101, 103, 104))
    empty = toxicity.fit(labelled.limit(0))
    assert empty.lexicon == {} and toxicity.score(docs_frame([]), empty).collect() == []


def test_copies_are_one_piece_of_evidence(spark, prose):
    copy = prose(7, 30)
    rows = [(copy, 1)] * 50 + [(prose(i, 30), 0) for i in range(50)]
    assert toxicity.fit(spark.createDataFrame(rows, "text string, toxic int")).lexicon == {}


@pytest.mark.parametrize("sent", [toxicity.SENT, 3])
def test_copies_of_a_clean_text_are_one_piece_of_evidence(spark, prose, monkeypatch, sent):
    monkeypatch.setattr(toxicity, "SENT", sent)
    rows = [(f"{prose(i, 10)} vileword {prose(500 + i, 10)}", 1) for i in range(60)]
    rows += [(f"{prose(900, 10)} vileword {prose(901, 10)}", 0)] * 400
    lexicon = entries(toxicity.learn_lexicon(spark.createDataFrame(rows, "text string, toxic int")))
    assert lexicon["vileword"] == lexicon["vile-"] == pytest.approx(math.log(60.5 / 1.5), rel=1e-12)


def test_no_candidate_is_left_out_before_its_uses_are_counted(spark, prose):
    # The many-copied common words come first by row count.
    clean = [" ".join(f"usual{'abcdefghij'[k]} {prose(i * 10 + k, 2)}" for k in range(10)) for i in range(10)]
    rows = [(t, 1) for t in clean for _ in range(50)] + [(t + f" {prose(i, 1)}", 0) for t in clean for i in range(9)]
    rows += [(f"{prose(2000 + i, 4)} zyxwvuts {prose(3000 + i, 4)}", 1) for i in range(8)]
    lexicon = entries(toxicity.learn_lexicon(spark.createDataFrame(rows, "text string, toxic int")))
    assert set(lexicon) == set(toxicity.entry_names("zyxwvuts"))


def reference_clauses(classes):
    """What the grammar means, read off the words of one clause at a time."""
    out, clause = [], []
    for kind, weight in [*classes, ("/", 0.0)]:
        if kind != "/":
            clause.append((kind, weight))
            continue
        kinds = "".join(k for k, _ in clause)
        near = lambda i, of: any(k == of for k in kinds[max(0, i - toxicity.REACH):i])
        threat = any(k == "T" and near(i, "V") for i, k in enumerate(kinds))
        negated = any(k in "IV" and near(i, "N") for i, k in enumerate(kinds))
        name = "aimed" if "I" in kinds and "T" in kinds else "insult" if "I" in kinds else "threat" if threat else ""
        if name:
            out.append((name + ("-reported" if "R" in kinds else "-negated" if negated else ""), max([w for k, w in clause if k == "I"] + [1.0] * threat)))
        clause = []
    return out


def test_composed_machine_against_its_meaning():
    rng = random.Random(1)
    for _ in range(4000):
        classes = [(k, rng.choice([0.3, 2.0, 5.0]) if k == "I" else 0.0) for k in rng.choices("IVTNR-/", [1, 2, 2, 2, 1, 6, 1], k=rng.randrange(30))]
        assert list(toxicity.clauses(classes)) == reference_clauses(classes), classes


def test_composition_is_one_machine_after_the_other():
    once = toxicity.Transducer.build(0, "ab", lambda q, x: ((q + 1) % 2, "b" if q else x, (0.0, float(q))))
    twice = toxicity.Transducer.build(0, "ab", lambda q, x: (0, "a" if x == "b" else "b", (1.0, 0.5)))
    both = toxicity.compose(once, twice)
    assert both.arcs[(0, 0), "a"] == ((1, 0), "b", (1.0, 0.5)) and both.arcs[(1, 0), "a"] == ((0, 0), "a", (1.0, 1.0))
    assert both.numbered().arcs[1, "a"] == (0, "a", (1.0, 1.0))


@pytest.mark.parametrize("remembered", [0, 20, toxicity.REMEMBERED])
def test_uses_against_brute_force(spark, prose, monkeypatch, remembered):
    monkeypatch.setattr(toxicity, "REMEMBERED", remembered)
    texts = [prose(i % 50, 30, 9) for i in range(200)]
    uses: dict[str, set] = {}
    for t in texts:
        w = toxicity.tokens(t)
        for i, word in enumerate(w):
            for n in toxicity.entry_names(word):
                uses.setdefault(n, set()).add((*w[max(0, i - 2):i], "", *w[i + 1:i + 3]))
    for most in (None, 3):
        candidates = spark.createDataFrame([(n, most) for n in uses], "entry string, most long")
        got = {r.entry: r.good for r in toxicity._distinct_uses(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3), candidates, "good").collect()}
        assert got.keys() == uses.keys()
        assert all(got[n] == len(u) if most is None or len(u) <= most else got[n] > most for n, u in uses.items())


def test_long_words_and_large_lexicons_are_whole(spark, docs_frame, prose, monkeypatch):
    long_word = "vile" * 40
    rows = [(f"{prose(i, 10)} {long_word if i % 2 else ''} {prose(500 + i, 10)}", i % 2) for i in range(60)]
    training = spark.createDataFrame(rows, "text string, toxic int")
    docs = docs_frame([(1, f"you {long_word}!"), (2, f"no {long_word}."), (3, None), (4, prose(1, 50)), (4, prose(1, 50))])
    small = toxicity.fit(training)
    assert long_word in small.lexicon
    monkeypatch.setattr(toxicity, "SENT", 2)
    large = toxicity.fit(training)
    assert entries(large.lexicon) == small.lexicon and not isinstance(large.lexicon, dict)
    scores = lambda g: sorted((r.doc_id, r.rid, r.score, r.matched) for r in toxicity.score(docs, g, "doc_id", "rid").collect())
    assert [(a, b, d) for a, b, _, d in scores(large)] == [(a, b, d) for a, b, _, d in scores(small)]
    assert [s for *_, s, _ in scores(large)] == pytest.approx([s for *_, s, _ in scores(small)])


def test_a_text_with_both_labels_is_evidence_for_both(spark, prose):
    rows = [(f"{prose(i, 10)} vileword {prose(500 + i, 10)}", label) for i in range(40) for label in (0, 1)]
    assert toxicity.fit(spark.createDataFrame(rows, "text string, toxic int")).lexicon == {}
