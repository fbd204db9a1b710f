import zlib

import numpy as np
import public_tokenizers as public
from tokenizers import Tokenizer

from salesmart.llm import packing, queries

SF = "/root/testdata/sf0.001"


def expected_pieces(rows, size=2048):
    tok = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    out = []
    for i, text in rows:
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 0]
        n = len(ids)
        cuts = [0, n] if n <= size else [0, *range(n % size or size, n + 1, size)]
        out += [(i, k, a, z - a, zlib.crc32(np.array(ids[a:z], "<u4").tobytes())) for k, (a, z) in enumerate(zip(cuts, cuts[1:]))]
    return out


def check(got, rows, size=2048):
    key = lambda t: tuple((x is None, x) for x in t)
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=key) == sorted(expected_pieces(rows, size), key=key)
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= size
    return len(bins)


def test_query_round_trip_and_quality(spark, real):
    rows = real("documents", "doc_id", "text")
    got = queries.op3_packing(spark, SF).collect()
    bins = check(got, rows)
    assert bins <= -(-sum(r.length for r in got) // 2048) + 2


def test_awkward_rows(spark, docs_frame, prose):
    rows = [(1, None), (2, ""), (3, "a  b\n c"), (4, "x <|endoftext|> y"), (5, prose(1, 6000)), (6, "Ünï çode 漢字  z"), (7, " lead"), (8, "trail "), (9, "can't\tdo\r\n12,000"), (10, "same"), (10, "same"), (None, "no id")]
    check(packing.pack_documents(docs_frame(rows)).collect(), rows)
    assert packing.pack_documents(docs_frame([])).collect() == []


def test_exact_multiples_and_small_blocks(spark, docs_frame):
    rows = [(i, " a" * n) for i, n in enumerate([15, 16, 31, 32, 47, 3, 5, 7, 1, 12, 9, 8, 2, 14] * 6)]
    got = packing.pack_documents(docs_frame(rows), sequence=16, block=20).collect()
    check(got, rows, 16)


def test_crossover_keeps_every_item_once():
    import random

    rng = random.Random(5)
    length = [rng.randrange(1, 100) for _ in range(300)]
    best = packing.evolve(length, 100, [], seed=1)
    assert sorted(i for b in best for i in b) == list(range(300)) and all(sum(length[i] for i in b) <= 100 for b in best)
    down = packing._fresh(sorted(range(300), key=lambda i: -length[i]), length, 100)
    assert len(best) <= len(down)
    other = packing._fresh(list(range(300)), length, 100)
    child = packing._cross(down, other, length, 100, rng)
    assert sorted(i for b in child for i in b) == list(range(300)) and all(sum(length[i] for i in b) <= 100 for b in child)


def sequences(rows, size):
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= size
    return len(bins)


def test_badly_filled_bins_of_all_blocks_meet_until_one_block_is_left(spark):
    import random

    rng = random.Random(2)
    items = [(i, rng.randrange(1, 40)) for i in range(3000)]
    got = packing.pack(spark.createDataFrame(items, "uid long, length long"), 100, block=12)
    rows = got.join(spark.createDataFrame(items, "uid long, length long"), "uid").collect()
    assert len(rows) == 3000 and {r.uid for r in rows} == set(range(3000))
    bound, alone = -(-sum(n for _, n in items) // 100), 3000 / 12 * 0.5
    assert sequences(rows, 100) <= bound + alone / 3  # blocks left alone waste about half a bin each


def test_rounds_end_when_nothing_can_be_saved(spark):
    items = spark.createDataFrame([(i, 60) for i in range(500)], "uid long, length long")
    rows = packing.pack(items, 100, block=20).join(items, "uid").collect()
    assert len(rows) == 500 and sequences(rows, 100) == 500


def test_ids_of_any_type(spark):
    docs = spark.createDataFrame([("a-1", "one two"), ("b", None), (None, "three")], "doc_id string, text string")
    got = packing.pack_documents(docs)
    assert dict(got.dtypes)["doc_id"] == "string"
    check(got.collect(), [("a-1", "one two"), ("b", None), (None, "three")])
