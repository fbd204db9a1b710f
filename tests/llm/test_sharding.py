import hashlib
import zlib
from collections import defaultdict

from salesmart.llm import queries, sharding

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]


def brute(rows, shards=24):
    """(doc_id, text) -> result rows, by one loop over the sorted documents."""
    ordered = sorted(rows, key=lambda r: (hashlib.sha256((r[1] or "").encode()).hexdigest(), r[0] is not None, r[0]))
    size = [len((t or "").encode()) + 8 for _, t in ordered]
    total, at, used, out = sum(size), 0, defaultdict(int), []
    for (doc, text), n in zip(ordered, size, strict=True):
        shard = (2 * at + n) * shards // (2 * total)
        out.append((doc, n, zlib.crc32((text or "").encode()), "bytes", shard, used[shard], None))
        used[shard] += 1
        at += n
    return out


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[4], r[5]))


def test_query_matches_brute_force_and_shards_are_near_equal(spark, real):
    got = queries.op13_sharding(spark, SF)
    assert got.columns == COLUMNS
    rows = ordered(got.collect())
    assert rows == ordered(brute(real("documents", "doc_id", "text")))
    filled = defaultdict(int)
    for r in rows:
        filled[r[4]] += r[1]
    share, largest = sum(filled.values()) / 24, max(r[1] for r in rows)
    assert set(filled) <= set(range(24)) and all(abs(n - share) <= largest for n in filled.values())


def test_awkward_rows(spark, docs_frame, prose):
    rows = [(None, None), (None, None), (3, None), (3, ""), (4, "é\x00ß"), (5, "copy me"), (5, "copy me"), (None, "copy me"), (6, prose(1, 30_000))]
    rows += [(100 + i, "copy me") for i in range(60)] + [(200 + i, prose(i, 40)) for i in range(40)]
    assert ordered(sharding.shard_by_bytes(docs_frame(rows)).collect()) == ordered(brute(rows))
    assert ordered(sharding.shard_by_bytes(docs_frame(rows), 3).collect()) == ordered(brute(rows, 3))
    assert sharding.shard_by_bytes(docs_frame(rows).limit(0)).collect() == []
    one = sharding.shard_by_bytes(docs_frame([(9, "alone")])).collect()
    assert [tuple(r) for r in one] == brute([(9, "alone")])


def test_same_rows_from_any_layout(spark, docs_frame, prose):
    rows = [(i, prose(i % 7, 5 + i % 11)) for i in range(300)]
    docs = docs_frame(rows)
    want = ordered(brute(rows))
    for n in (1, 2, 13):
        assert ordered(sharding.shard_by_bytes(docs.repartition(n)).collect()) == want


def test_no_python_and_no_texts_in_the_plan(spark, docs_frame):
    plan = sharding.shard_by_bytes(docs_frame([(1, "a")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "text#" not in plan
