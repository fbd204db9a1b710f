import re

import corpus_pipeline
from salesmart.llm import langid
from salesmart.llm.common import stage
from test_decontaminate import brute as brute_items
from test_packing import check
from test_pii import base
from test_simhash import brute_groups, brute_print

SF = "/root/testdata/sf0.001"


def test_registered_and_named():
    import __spark_entry__ as entry

    assert "pipeline" in entry.queries() and [n.split("_")[0] for n in entry.queries() if re.match(r"op\d+_", n)] == [f"op{i}" for i in range(1, 14)]
    assert len(corpus_pipeline.STAGES) == 5


def test_stages_match_a_brute_force_pipeline(spark, real):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    results = []
    for name, apply in corpus_pipeline.STAGES:
        docs = stage(apply(spark, docs, SF), "test")
        results.append(docs)
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    assert all(r.columns == columns for r in results[:-1])
    kept = {r.doc_id: r.text for r in results[0].collect()}
    assert kept.items() <= rows.items() and len(kept) >= 0.98 * len(rows)
    assert all(not langid._LETTER.search(rows[i]) or len(set(rows[i].split())) < 60 for i in rows.keys() - kept.keys())
    groups = brute_groups({i: brute_print(t) for i, t in kept.items()})
    kept = {i: t for i, t in kept.items() if groups[i] == i}
    assert {r.doc_id: r.text for r in results[1].collect()} == kept
    hit = {i: n for i, _, n, _ in brute_items(list(kept.items()), real("benchmark", "item_id", "text"))}
    kept = {i: t for i, t in kept.items() if not hit[i]}
    assert {r.doc_id: r.text for r in results[2].collect()} == kept
    for r in results[3].collect():
        text, out, at = kept[r.doc_id], "", 0
        for a, k, z in base(text):
            if a >= at:
                out, at = out + text[at:a] + f"[{k.upper()}]", z
        assert r.text == out + text[at:] and r.n_chars == len(r.text)
        kept[r.doc_id] = r.text
    assert results[3].count() == len(kept)
    check(results[4].collect(), list(kept.items()))


def test_awkward_rows(spark, docs_frame, prose):
    text = "Das ist ein Haus und die Katze liegt auf der Matte " * 4
    rows = [(1, None, "de"), (2, "", "de"), (3, "12 34", None), (None, text, None), (None, text, None), (4, text + "mail a@b.cd", "de"), (4, prose(3, 60), "xx"), (4, prose(3, 60), "xx"), (5, prose(4, 5000), "xx"), (6, prose(6, 40), "xx")]
    docs = docs_frame(rows)
    for name, apply in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = stage(apply(spark, docs, SF), "test")
        assert docs.columns == before.columns and docs.count() <= before.count()
    ids = sorted((r.doc_id for r in docs.collect()), key=str)
    assert ids == [4, 4, 5, 6] or ids == [4, 5, 6, None]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in packed.collect()} == set(ids)
    empty = docs_frame([])
    for name, apply in corpus_pipeline.STAGES:
        empty = stage(apply(spark, empty, SF), "test")
        assert empty.count() == 0
