import math

import numpy as np
from pyspark.sql import functions as F

from salesmart.llm import queries, topk

SF = "/root/testdata/sf0.001"


def brute(rows, every, k=5):
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (q, x) in enumerate(ok):
        if q % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(x, y)), i) for m, (i, y) in enumerate(ok) if m != n and len(y) == len(x))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def test_query_matches_brute_force(spark, real):
    rows = real("embeddings", "vec_id", "embedding")
    assert sorted(map(tuple, queries.op7_topk(spark, SF).select("query_id", "rank", "vec_id", "score").collect())) == brute(rows, 50)


def test_awkward_rows_and_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_NUMBERS", 64)
    monkeypatch.setattr(topk, "BATCH_NUMBERS", 64)
    monkeypatch.setattr(topk, "WAVE_BATCHES", 2)
    rng = np.random.default_rng(1)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(0, 0.2, 6)]) for i in range(300)]
    rows += [(500 + i, rows[50][1]) for i in range(20)] + [(100, rows[3][1]), (100, rows[3][1])]  # ties, repeated ids
    rows += [(600, None), (601, []), (602, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (650, [math.nan] * 6), (651, [math.inf] * 6), (None, rows[0][1]), (700, [1.0, 2.0]), (701, [0.5, -3.0]), (750, [9.0])]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, rid long, score long")
    got = topk.top_k(df, F.col("vec_id") % 50 == 0)
    assert sorted(map(tuple, got.collect())) == brute(rows, 50)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 50 == 0).collect() == []


def test_large_components_are_exact(spark):
    rows = [(i, [1e9 * (i + 1) + 0.25, -3e8 * i]) for i in range(8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(map(tuple, topk.top_k(df, F.col("vec_id") % 4 == 0).collect()))
    clamp = lambda s: max(-(1 << 63), min((1 << 63) - 1, s))
    ints = [(i, [math.floor(256 * x) for x in v]) for i, v in rows]
    want = []
    for q, x in ints:
        if q % 4 == 0:
            scored = sorted((-clamp(sum(a * b for a, b in zip(x, y))), i) for i, y in ints if i != q)
            want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:5])]
    assert got == sorted(want)


def test_index_holds_every_posting_once_and_stops_early():
    rng = np.random.default_rng(4)
    x = np.floor(256 * rng.normal(0, 0.3, (400, 24)) * (rng.random((400, 24)) < 0.6))
    x[7] = x[90] = x[300]  # ties
    x[200:260] *= 40  # a few vectors far above the others
    index = topk.BlockIndex(x)
    back, tops = np.zeros_like(x), []
    for segments, rest in index.levels:
        for d, vecs, impact in segments:
            assert len(set(vecs.tolist())) == len(vecs) and not back[vecs, d].any()
            back[vecs, d] = impact
            tops.append(int(np.abs(impact).max()).bit_length())
            assert int(np.abs(impact).min()).bit_length() == tops[-1]
        assert np.allclose(rest, np.sqrt(((x - back) ** 2).sum(1)))
    assert (back == x).all() and tops == sorted(tops, reverse=True)
    q, ids, own = x[::9], rng.permutation(400), np.arange(0, 400, 9)
    for i, (at, scores) in enumerate(index.top(q, own, 5, ids)):
        every = sorted((-int(x[j] @ q[i]), int(ids[j])) for j in range(400) if j != own[i])[:5]
        assert [(-int(s), int(ids[j])) for j, s in zip(at, scores, strict=True)] == every
    strong = np.zeros((1, 24))
    strong[0, 0] = 1.0
    lone = np.zeros((400, 24))
    lone[:, 0] = np.arange(400) % 2 + 1.0
    lone[:5, 0] = 1 << 14
    single = topk.BlockIndex(lone)
    single.levels[1:] = [(None, r) for _, r in single.levels[1:]]  # would raise if it were added
    assert sorted(single.top(strong, np.array([-1]), 5, ids)[0][0].tolist()) == [0, 1, 2, 3, 4]
