import random
import re

import numpy as np
import pytest
import xxhash

from salesmart.llm import components, queries, simhash

SF = "/root/testdata/sf0.001"


def brute_print(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if ones[b] * 2 > len(shingles))


def brute_groups(prints, radius=4):
    """{id: fingerprint} -> {id: smallest reachable id}."""
    parent = {i: i for i in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(prints)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            if bin(prints[a] ^ prints[b]).count("1") <= radius:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_query_matches_brute_force(spark, real):
    prints = {i: brute_print(t) for i, t in real("documents", "doc_id", "text")}
    groups = brute_groups(prints)
    got = queries.op6_simhash(spark, SF).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in got} == {(i, f"{f:016x}", groups[i]) for i, f in prints.items()}


def test_awkward_rows(spark, docs_frame, prose):
    long = prose(1, 30_000)
    rows = [(5, None), (3, ""), (9, " \t\n"), (7, "One two"), (8, "one TWO"), (4, long), (6, long + " tail"), (6, long + " tail"), (None, "one two"), (2, "É é"), (1, prose(2, 50))]
    got = simhash.near_duplicates(docs_frame(rows)).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append((r.fp, r.component_id))
    assert by[5] == by[3] == by[9] == [(0, 3)]
    assert by[7] == by[8] == [(by[7][0][0], 7)] and by[None] == by[7]
    assert by[4][0][1] == 4 and [c for _, c in by[6]] == [4, 4]
    assert by[2][0][1] == 2 and by[1][0][1] == 1
    assert simhash.near_duplicates(docs_frame([])).collect() == []


@pytest.mark.parametrize(("cap", "levels"), [(32_768, 3), (6, 2), (2, 1), (4, 3)])
def test_links_are_exact_when_buckets_are_refined_or_tiled(spark, cap, levels):
    rng = random.Random(3)
    prints = [rng.getrandbits(64) for _ in range(60)] + [0]
    for f in prints[:25]:
        prints += [f ^ sum(1 << b for b in rng.sample(range(64), rng.choice([1, 4, 4, 5, 6]))) for _ in range(3)]
    prints = sorted(set(prints))
    signed = {p - (1 << 64) if p >> 63 else p: p for p in prints}
    df = spark.createDataFrame([(s,) for s in signed], "fp long")
    roots = {signed[r.node]: signed[r.root] for r in components.components(simhash.near_links(df, cap=cap, levels=levels)).collect()}
    expected = brute_groups({p: p for p in prints})
    classes = lambda of: {frozenset(p for p in prints if of(p) == r) for r in {of(p) for p in prints}}
    assert classes(lambda p: roots.get(p, p)) == classes(expected.get)


def test_bit_sliced_counts_match_popcounts():
    rng = np.random.default_rng(1)
    fps = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    fps[100:200] = fps[:100] ^ (np.uint64(1) << rng.integers(0, 64, 100).astype(np.uint64)) ^ np.uint64(5)
    planes = simhash.planes_of(fps)
    for radius in (0, 1, 3, 4, 7):
        pair, word = simhash.within(planes, np.tile(np.arange(len(planes)), len(fps)), np.repeat(fps, len(planes)), radius)
        p, lane = simhash._lanes(pair, word)
        got = {(int(a) // len(planes), int(a) % len(planes) * 64 + int(b)) for a, b in zip(p, lane)}
        want = {(i, j) for i in range(300) for j in range(300) if bin(int(fps[i] ^ fps[j])).count("1") <= radius}
        assert {x for x in got if x[1] < 300} == want
    some = sorted({tuple(sorted(e)) for e in simhash._large(fps, 4)})
    assert some and all(bin(a ^ b).count("1") <= 64 for a, b in some)


def test_large_bucket_search_finds_the_same_components():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 63, 30, dtype=np.uint64)
    fps = np.unique(np.concatenate([base ^ (np.uint64(1) << np.uint64(b)) for b in range(0, 40, 2)]))
    expected = brute_groups({int(f): int(f) for f in fps})
    parent = {int(f): int(f) for f in fps}
    for a, b in simhash._large(fps, 4):
        x, y = simhash._find(parent, a), simhash._find(parent, b)
        parent[max(x, y)] = min(x, y)
    assert {f: simhash._find(parent, f) for f in parent} == expected


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(1, i) for i in range(2, 30)] + [(50, 50), (60, 61), (60, 61)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 100 for i in range(101, 141)}, **{i: 1 for i in range(2, 30)}, 61: 60}
