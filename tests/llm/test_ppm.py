import collections
import math
import re
import zlib

import numpy as np
import pytest

from salesmart.llm import ppm, queries

SF = "/root/testdata/sf0.001"


class Brute:
    """PPM, method C, with exclusion, one symbol at a time."""

    def __init__(self, texts, order):
        self.order, self.count = order, [collections.defaultdict(collections.Counter) for _ in range(order + 1)]
        for t in texts:
            s = self.symbols(t)
            for p in range(order, len(s)):
                for j in range(order + 1):
                    self.count[j][tuple(s[p - j:p])][s[p]] += 1

    def symbols(self, text):
        return [256] * self.order + list(text) + [256]

    def score(self, text):
        s, total = self.symbols(text), 0.0
        for p in range(self.order, len(s)):
            refused = set()
            for j in range(self.order, -1, -1):
                seen = self.count[j].get(tuple(s[p - j:p]))
                if not seen:
                    continue
                left = {c: n for c, n in seen.items() if c not in refused}
                size = sum(left.values()) + len(left)
                if s[p] in left:
                    total += math.log10(left[s[p]] / size)
                    break
                if size:
                    total += math.log10(len(left) / size)
                refused = set(seen)
            else:
                total -= math.log10(257 - len(self.count[0].get((), ())))
        return total


def tokens(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())) + [b""]


def expected(rows, training):
    count = collections.Counter(w for t in training for w in tokens(t))
    n, v = sum(count.values()), len(count)
    model = Brute([(t or "").encode() for t in training], ppm.ORDER)
    return n, {(i, t): (len(tokens(t)), sum(count[w] > 0 for w in tokens(t)), sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens(t)), model.score((t or "").encode())) for i, t in rows}


def test_query_matches_brute_force(spark, real):
    rows = real("documents", "doc_id", "text")
    rows = [(i, t) for i, t in rows]
    held = {i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 1}
    n, want = expected(rows, [t for i, t in rows if i not in held])
    texts = dict(rows)
    for r in queries.op10_ppm(spark, SF).collect():
        known = want[r.doc_id, texts[r.doc_id]]
        assert (r.held_out, r.train_tokens, r.n_tokens, r.n_known) == (r.doc_id in held, n, *known[:2])
        assert r.base_score == pytest.approx(known[2], rel=1e-9) and r.score == pytest.approx(known[3], rel=1e-9)


def test_awkward_rows(spark, docs_frame, prose, monkeypatch):
    monkeypatch.setattr(ppm, "FREQUENT", 5)
    training = ["", None, prose(1, 300), "Long " + "x" * 200 + " word", "É a b"]
    rows = [(1, None), (2, ""), (3, "x" * 200), (4, "X" * 200 + " \x0b word"), (5, prose(1, 40) + " new"), (6, prose(2, 20_000)), (7, "same new same"), (7, "same new same"), (None, "é É b"), (8, "\x00 \x85")]
    fitted = ppm.fit(docs_frame([(i, t) for i, t in enumerate(training)]), frequent=5)
    n, want = expected([r for r in rows if r[0] != 6], training)
    docs = docs_frame(rows)
    got = ppm.score(docs.selectExpr("doc_id", "text", "true as held_out"), fitted).collect()
    assert len(got) == len(rows)
    texts = dict(rows)
    for r in got:
        if r.doc_id != 6:
            k = want[r.doc_id, texts[r.doc_id]]
            assert (r.n_tokens, r.n_known, r.train_tokens) == (*k[:2], n) and r.base_score == pytest.approx(k[2]) and r.score == pytest.approx(k[3])
    empty = ppm.fit(docs_frame([]))
    r = ppm.score(docs.filter("doc_id = 8").selectExpr("doc_id", "text", "false as held_out"), empty).first()
    assert (r.n_known, r.train_tokens, r.base_score) == (0, 0, 0.0) and r.score == pytest.approx(-5 * math.log10(257))
    assert ppm.score(docs_frame([]).selectExpr("doc_id", "text", "false as held_out"), fitted).collect() == []


@pytest.mark.parametrize("max_runs", [3, 700, 4000])
def test_trie_beyond_the_bound_keeps_all_runs(spark, docs_frame, prose, max_runs, monkeypatch):
    monkeypatch.setattr(ppm, "PART_RUNS", 500)
    training = [prose(i, 60) for i in range(12)] + [prose(1, 60)] * 5 + ["Ω漢字 だけ", None]
    rows = [(1, prose(1, 60)), (2, prose(50, 80) + " Ω漢字"), (3, None), (4, "\x00ÿ"), (5, "だけ"), (5, "だけ"), (None, prose(2, 30))]
    fitted = ppm.fit(docs_frame(list(enumerate(training))), max_runs=max_runs)
    assert fitted.part and fitted.part.runs > max_runs and len(fitted.part.codes) <= max_runs // 2
    _, want = expected(rows, training)
    texts, got = dict(rows), ppm.score(docs_frame(rows).selectExpr("doc_id", "text", "true as held_out"), fitted).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.score == pytest.approx(want[r.doc_id, texts[r.doc_id]][3], rel=1e-9)


def test_probabilities_of_all_symbols_sum_to_one_at_most():
    texts = [b"abracadabra", b"abc", b"\xff\x00"]
    codes, counts = np.unique(np.concatenate([ppm.runs([t], 3)[0] for t in texts]), return_counts=True)
    model = ppm.Model(codes, counts, 3)
    for context in ([256, 256, 256], [97, 98, 114], [1, 2, 3], [1, 97, 98]):
        base = 0
        for c in context:
            base = base << ppm.BITS | c
        p = 10 ** model.log_probabilities(np.array([base << ppm.BITS | s for s in range(257)], np.uint64))
        assert p.sum() == pytest.approx(1)
