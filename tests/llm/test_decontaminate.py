import hashlib
import re

from pyspark.sql import functions as F

from salesmart.llm import decontaminate, queries

SF = "/root/testdata/sf0.001"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window=10):
    """[(doc_id, n_words, n_hit, sorted item ids)] in any order."""
    listed = {}
    for i, text in items:
        w = words(text)
        k = min(window, len(w))
        for a in range(len(w) - k + 1 if k else 0):
            listed.setdefault(tuple(w[a:a + k]), set()).add("" if i is None else str(i))
    out = []
    for i, text in docs:
        w, hit, ids = words(text), set(), set()
        for k in {len(x) for x in listed}:
            for a in range(len(w) - k + 1):
                if got := listed.get(tuple(w[a:a + k])):
                    ids |= got
                    hit |= set(range(a, a + k))
        out.append((i, len(w), len(hit), tuple(sorted(ids))))
    return sorted(out, key=str)


def test_query_matches_brute_force(spark, real):
    want = [(i, n, h, len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), h > 0) for i, n, h, ids in brute(real("documents", "doc_id", "text"), real("benchmark", "item_id", "text"))]
    got = [(r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in queries.op1_decontaminate(spark, SF).collect()]
    assert sorted(got) == sorted(want) and any(w[5] for w in want)


def test_awkward_rows(spark, docs_frame, prose):
    q = [prose(s, 25) for s in range(4)]
    items = [(1, q[0]), (2, q[1] + " " + q[0]), (10, "Only four Words here"), (3, "single"), (4, None), (5, " .,"), (None, q[2]), (1, q[3]), (6, "the the the the the the the the the the the the")]
    docs = [(1, None), (2, ""), (3, q[0].upper() + "."), (4, prose(9, 30) + " " + " ".join(q[0].split()[3:14]) + " end"), (5, "x " + " ".join(q[1].split()[:9])), (6, "only, four -- WORDS here! and single"),
            (7, q[2] + " " + q[3]), (7, q[2] + " " + q[3]), (None, q[1]), (8, "the " * 30), (9, "É é words"), (10, prose(11, 8000) + " " + q[1] + " " + prose(12, 8000)), (11, q[0] + " " + q[0])]
    bench = spark.createDataFrame([(*i, "x", 1) for i in items], "item_id long, text string, term string, place long")
    got = decontaminate.contamination(docs_frame(docs), bench)
    assert sorted(((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in got.collect()), key=str) == brute(docs, items)
    empty = bench.limit(0)
    assert {(r.doc_id, r.n_hit) for r in decontaminate.contamination(docs_frame(docs[:4]), empty).collect()} == {(1, 0), (2, 0), (3, 0), (4, 0)}
    assert decontaminate.contamination(docs_frame([]), bench).collect() == []


def test_joins_without_broadcast_give_the_same(spark, docs_frame, prose, monkeypatch):
    monkeypatch.setattr(decontaminate, "TERM_BYTES", -1)
    monkeypatch.setattr(decontaminate, "DOC_ROWS", -1)
    docs, items = [(i, prose(i, 30) + " " + prose(99, 15)) for i in range(6)], [(1, prose(99, 15)), (2, prose(3, 30))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contamination(docs_frame(docs), bench)
    assert sorted(((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in got.collect()), key=str) == brute(docs, items)


def test_proximity(spark, docs_frame, prose):
    q = prose(1, 10).split()
    shuffled = [*q[5:], "x", *q[:5]]
    far = [*q[:5], *prose(5, 50).split(), *q[5:]]
    docs = [(1, " ".join(shuffled)), (2, " ".join(far)), (3, " ".join(q[:9]))]
    index = decontaminate.build(docs_frame(docs), spark.createDataFrame([(7, " ".join(q))], "item_id long, text string"))
    ids = index.postings.filter("term = ''").select("rid", "doc_id")
    got = decontaminate.proximity_matches(index, span=12).join(ids, "rid").select("doc_id").distinct().collect()
    assert [r.doc_id for r in got] == [1]
    assert decontaminate.proximity_matches(index, span=100).join(ids, "rid").select("doc_id").distinct().agg(F.sum("doc_id")).first()[0] == 3
    assert decontaminate.phrase_matches(index).collect() == []


def test_plans_have_no_python(spark):
    plan = queries.op1_decontaminate(spark, SF)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
