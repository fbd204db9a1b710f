import re

import pytest

from salesmart.llm import licenses, queries

SF = "/root/testdata/sf0.01"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def places(text):
    w = words(text)
    return len(w), sorted((k, label) for phrase, label in licenses.PHRASES.items() for p in [phrase.split()] for k in range(len(w) - len(p) + 1) if w[k:k + len(p)] == p)


def test_query_matches_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in queries.op8_licenses(spark, SF).collect()}
    assert len(got) == len(rows)
    for doc_id, text in rows:
        n, hits = places(text)
        r = got[doc_id]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (n, len(hits), hits[0][0] if hits else None, hits[-1][0] if hits else None, ",".join(sorted({x for _, x in hits})))
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1
    assert any("mit" in r.labels for r in got.values())


def test_awkward_rows(spark, docs_frame, prose):
    mit = next(t for _, t in licenses.TEMPLATES if t.startswith("Permission"))
    rows = [(1, None), (2, ""), (3, "CC-BY cc by CC"), (4, prose(1, 20_000) + " all rights reserved"), (5, mit.replace("free of", "free  OF\n")), (6, " ".join(mit.split()[:4])), (7, "all rights not reserved"),
            (8, "GNU General Public License, General Public License"), (8, "GNU General Public License, General Public License"), (None, "cc by"), (9, "ccé by cc by by")]
    got = licenses.license_spans(docs_frame(rows)).collect()
    assert len(got) == len(rows)
    for r, (i, text) in zip(sorted(got, key=str), sorted(rows, key=lambda r: str(r)), strict=False):
        pass
    by = {}
    for r in got:
        by.setdefault(r.doc_id, r)
    for i, text in rows:
        n, hits = places(text)
        assert (by[i].n_words, sorted((p.start, p.label) for p in by[i].phrases)) == (n, hits)
    assert [s.label for s in by[5].spans] == ["mit"] and by[5].spans[0].share > 0.9 and by[6].spans == [] and by[1].spans == []
    assert licenses.license_spans(docs_frame([])).collect() == []
    with pytest.raises(ValueError):
        licenses.license_spans(docs_frame(rows), phrases={"--": "none"})


def test_matching_statistics_against_brute_force():
    import random

    rng = random.Random(2)
    for _ in range(60):
        templates = [(str(k), [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randrange(1, 9))]) for k in range(4)]
        auto = licenses.Automaton(templates)
        text = [rng.choice([b"a", b"b", b"c", b"z"]) for _ in range(40)]
        stats = {i: (s, run) for i, s, run in auto.statistics(text)}
        inside = lambda part: [(t, p + len(part) - 1) for t, (_, w) in enumerate(templates) for p in range(len(w) - len(part) + 1) if w[p:p + len(part)] == part]
        for i in range(len(text)):
            best = max((n for n in range(i + 2) if n == 0 or inside(text[i + 1 - n:i + 1])), default=0)
            state, run = stats.get(i, (0, 0))
            assert run == best
            if run:
                assert auto.ends[state] == sorted(inside(text[i + 1 - run:i + 1]))
                whole = {t for t, (_, w) in enumerate(templates) if text[i + 1 - len(w):i + 1] == w and len(w) <= i + 1}
                assert {t for t in auto.whole[state] if len(templates[t][1]) <= run} == whole


def test_chains_join_matches_with_small_gaps():
    assert licenses._chain([(0, 0, 4), (6, 5, 5)], 10, 4) == [(0, 11, 0.9)]
    assert licenses._chain([(0, 0, 4), (60, 5, 5)], 10, 4) == [(0, 4, 0.4), (60, 65, 0.5)]
