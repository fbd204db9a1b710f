import collections
import hashlib
import random
import re

import numpy as np
import pytest

from salesmart.llm import queries, suffix_dedup

SF = "/root/testdata/sf0.001"


def brute(rows, length):
    count = collections.Counter()
    data = [(i, (t or "").encode()) for i, t in rows]
    for _, b in data:
        count.update(b[k:k + length] for k in range(len(b) - length + 1))
    out = []
    for i, b in data:
        covered, done = bytearray(len(b)), 0
        for k in range(len(b) - length + 1):
            if count[b[k:k + length]] > 1:
                for x in range(max(k, done), k + length):
                    covered[x] = 1
                done = k + length
        spans = [k for k in range(len(b)) if covered[k] and (k == 0 or not covered[k - 1])]
        out.append((i, len(b), sum(covered), len(spans), bytes(x for x, c in zip(b, covered) if not c)))
    return sorted(out, key=lambda r: (r[0] is None, r))


def found(df):
    rows = [(r.doc_id, r.n_bytes, r.n_bytes - len(r.kept), len(r.spans), bytes(r.kept)) for r in df.collect()]
    return sorted(rows, key=lambda r: (r[0] is None, r))


def test_query_matches_brute_force(spark, real):
    want = [(*r[:4], hashlib.sha256(r[4]).hexdigest()) for r in brute(real("documents", "doc_id", "text"), 400)]
    got = queries.op4_suffix_dedup(spark, SF).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == sorted(want)
    assert sum(r[2] for r in want) > 0


@pytest.mark.parametrize("hot", [20_000, 1])
def test_awkward_rows(spark, docs_frame, prose, hot):
    rng = random.Random(4)
    passage, other = prose(1, 60), prose(2, 40)
    rows = [(1, None), (2, ""), (3, "ab"), (4, "a" * 300), (5, "ab" * 200), (6, prose(3, 80) + passage + prose(4, 80)), (7, passage), (8, other + prose(5, 10) + other),
            (9, "é" * 50 + passage[20:200]), (10, "tail " + passage[100:]), (10, "tail " + passage[100:]), (None, prose(6, 30)), (None, prose(6, 30)), (11, prose(7, 5000))]
    near = prose(8, 120)
    for k in range(12):  # near copies: the same anchors in different surroundings
        at = rng.randrange(len(near))
        rows.append((20 + k, near[:at] + "#" * (k % 3 + 1) + near[at + k % 2:]))
    assert found(suffix_dedup.remove_repeats(docs_frame(rows), length=50, gram=16, hot=hot)) == brute(rows, 50)
    assert suffix_dedup.remove_repeats(docs_frame([]), length=50, gram=16).collect() == []


def test_long_texts_are_cut_without_losing_windows(spark, docs_frame, monkeypatch, prose):
    monkeypatch.setattr(suffix_dedup, "PLACE_BITS", 12)
    passage = prose(1, 60)
    rows = [(1, prose(2, 1500) + passage + prose(3, 700)), (2, prose(4, 900) + passage), (3, prose(5, 20))]
    assert found(suffix_dedup.remove_repeats(docs_frame(rows), length=100, gram=32)) == brute(rows, 100)


@pytest.mark.parametrize("length", [8, 13, 24])
def test_radix_passes_find_exactly_the_equal_windows(length):
    rng = np.random.default_rng(length)
    data = rng.integers(97, 99, 3000, dtype=np.uint8)
    data[500:560] = data[1500:1560]
    start = np.arange(len(data) - length + 1)
    text = data.tobytes()
    count = collections.Counter(text[s:s + length] for s in start)
    want = np.array([count[text[s:s + length]] > 1 for s in start])
    got = suffix_dedup.radix_groups(np.frombuffer(text + bytes(8), np.uint8), start, np.zeros(len(start), np.int64), np.ones(len(start)), length)
    assert (got == want).all()


def shared_words(rows, words):
    """Per row: the maximal runs of words in any ``words`` consecutive words that also stand in another row."""
    held = collections.defaultdict(set)
    data = [(i, re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())) for i, t in rows]
    for r, (_, w) in enumerate(data):
        for k in range(len(w) - words + 1):
            held[tuple(w[k:k + words])].add(r)
    out = []
    for i, w in data:
        runs = []
        for k in range(len(w) - words + 1):
            if len(held[tuple(w[k:k + words])]) > 1:
                if runs and k <= runs[-1][1]:
                    runs[-1][1] = k + words
                else:
                    runs.append([k, k + words])
        out.append((i, [tuple(r) for r in runs]))
    return sorted(out, key=lambda r: (r[0] is None, r))


@pytest.mark.parametrize("hot", [20_000, 1])
def test_passages_of_words_across_documents(spark, docs_frame, prose, hot):
    passage, line = prose(1, 14), prose(2, 12)
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, prose(3, 30) + " " + passage + " " + prose(4, 30)), (5, passage.replace(" ", "\n ", 4)), (6, prose(5, 11)),
            (7, f"{line} {prose(6, 5)} {line}"), (8, f"{passage} {prose(7, 9)} {passage} é"), (9, "é " * 40), (10, "x " + "é " * 15), (11, line[:-1]),
            (12, prose(8, 20)), (12, prose(8, 20)), (None, prose(9, 15)), (None, prose(9, 15)), (13, "a" * 5000), (14, prose(10, 9))]
    near = prose(11, 60).split()
    for k in range(9):  # the same anchors in different surroundings, also twice in one document
        cut = [*near[:7 * k], f"#{k % 3}", *near[7 * k:]]
        rows.append((20 + k, " ".join(cut if k % 2 else cut + ["|"] + cut)))
    alone = prose(12, 40).split()
    rows.append((40, " ".join([*alone, "#", *alone[:20], "#", *alone[10:]])))
    got = suffix_dedup.remove_repeats(docs_frame(rows), length=50, gram=16, hot=hot, words=10, word_gram=3).collect()
    assert sorted(((r.doc_id, [(p.start, p.end) for p in r.passages]) for r in got), key=lambda r: (r[0] is None, r)) == shared_words(rows, 10)


def test_query_reports_short_passages_of_over_50_words(spark, tmp_path, docs_frame, prose):
    passage = " ".join(random.Random(1).choice(["ab", "cde", "fghi", "k", "lm"]) for _ in range(52))
    rows = [(1, prose(1, 40) + " " + passage + " " + prose(2, 40)), (2, prose(3, 60) + " " + passage), (3, prose(4, 200)), (4, prose(5, 60) + " " + " ".join(passage.split()[:50]) + " " + prose(6, 9))]
    docs_frame(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.op4_suffix_dedup(spark, str(tmp_path)).collect()}
    assert len(passage.encode()) < 400 and all(r.n_removed == 0 for r in got.values())
    assert {i: r.n_shared_words for i, r in got.items()} == {1: 52, 2: 52, 3: 0, 4: 0}


def test_query_counts_shared_words_of_the_given_table(spark, real):
    want = [(i, sum(z - a for a, z in runs)) for i, runs in shared_words(real("documents", "doc_id", "text"), 51)]
    assert sorted((r.doc_id, r.n_shared_words) for r in queries.op4_suffix_dedup(spark, SF).collect()) == want
    assert sum(n for _, n in want) > 0
