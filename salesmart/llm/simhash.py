"""SimHash near-duplicates: 64-bit fingerprints compared bit-sliced inside shared-bit buckets.

Two fingerprints at most ``radius`` bits apart agree on at least one of ``radius + 1`` blocks of
bits, so every linked pair meets in a bucket (block, value).  A bucket of more than ``cap``
distinct fingerprints is split again by the same argument on its remaining bits; buckets that stay
large at the last level are compared tile by tile.  Nothing is capped or dropped.

Inside a bucket the fingerprints are stored vertically: plane b holds bit b of 64 fingerprints in
one machine word.  A query flips planes, carry-save adders count the differing bits of all 64 at
once, and a block is abandoned as soon as every lane's count exceeds the radius.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import raw_bytes, slices, sorted_groups, stage
from salesmart.llm.components import components

CAP = 32_768
LEVELS = 3
_ALL = (1 << 64) - 1


def fingerprint(text: bytes | None, words: int = 4, seed: int = 42) -> int:
    """64-bit SimHash of a UTF-8 text; 0 if it has no word (null, empty or only white space)."""
    tokens = text.lower().split() if text else []  # bytes: ASCII letters and ASCII white space only
    n = len(tokens)
    if not n:
        return 0
    joined = b" ".join(tokens)
    if n <= words:
        return xxhash.xxh64_intdigest(joined, seed)
    ends = list(accumulate(map(len, tokens)))
    view, digest = memoryview(joined), xxhash.xxh64_digest
    # A word's place is the bytes before it plus one space for each word before it.
    starts = [0, *(e + i for i, e in enumerate(ends, 1))]
    total = np.zeros(64, np.int64)
    m = n - words + 1
    for at in range(0, m, 16_384):
        hashes = b"".join([digest(view[starts[i]:starts[i + words] - 1], seed) for i in range(at, min(m, at + 16_384))])
        total += np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(total * 2 > m).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = 4, seed: int = 42) -> DataFrame:
    """(doc_id, text) -> (doc_id, fp long): one row for each input row; ids may have any type."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            fps = np.fromiter((fingerprint(t, words, seed) for t in raw_bytes(b, "text")), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    chosen = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(run, chosen.drop("text").schema.add("fp", "long"))


def split_mask(mask: int, parts: int) -> list[int]:
    """``mask`` extended by each of ``parts`` runs of the bits it leaves free."""
    free = [b for b in range(64) if not mask >> b & 1]
    cuts = [round(i * len(free) / parts) for i in range(parts + 1)]
    return [mask | sum(1 << b for b in free[a:z]) for a, z in zip(cuts, cuts[1:], strict=False)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def planes_of(fps: np.ndarray) -> np.ndarray:
    """(blocks, 64) words: word [k, b] holds bit b of fingerprints 64 k .. 64 k + 63 (lane = bit)."""
    padded = np.zeros(-(-len(fps) // 64) * 64, np.uint64)
    padded[: len(fps)] = fps
    bits = (padded.reshape(-1, 64, 1) >> np.arange(64, dtype=np.uint64)) & np.uint64(1)  # block, lane, bit
    return np.bitwise_or.reduce(bits << np.arange(64, dtype=np.uint64).reshape(1, 64, 1), axis=1)


def within(planes: np.ndarray, block: np.ndarray, query: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """For pairs (block index, query fingerprint): pair numbers and lane words within ``radius`` bits.

    Counters have one bit plane for each binary digit up to ``radius``; a carry out of the top one
    sticks.  After every eight planes the pairs of which all lanes exceed the radius are abandoned.
    """
    digits = max(1, radius.bit_length())
    alive = np.arange(len(block))
    count = [np.zeros(len(block), np.uint64) for _ in range(digits)]
    over = np.zeros(len(block), np.uint64)
    bad = over
    one = np.uint64(1)

    def add(carry: np.ndarray, digit: int) -> None:
        for d in range(digit, digits):
            count[d], carry = count[d] ^ carry, count[d] & carry
        np.bitwise_or(over, carry, out=over)

    for at in range(0, 64, 8):
        for b in range(at, at + 8, 2):  # two planes at a time through a full adder
            x = planes[block, b] ^ (np.uint64(0) - (query >> np.uint64(b) & one))
            y = planes[block, b + 1] ^ (np.uint64(0) - (query >> np.uint64(b + 1) & one))
            half = x ^ y
            carry = (x & y) | (half & count[0])
            count[0] = count[0] ^ half
            add(carry, 1)
        # lanes whose count is above the radius, from the top digit down
        equal, above = np.full(len(block), _ALL, np.uint64), np.zeros(len(block), np.uint64)
        for d in reversed(range(digits)):
            if radius >> d & 1:
                equal = equal & count[d]
            else:
                above = above | (equal & count[d])
                equal = equal & ~count[d]
        bad = over | above
        keep = bad != np.uint64(_ALL)
        if not keep.all():
            alive, block, query, over, bad = alive[keep], block[keep], query[keep], over[keep], bad[keep]
            count = [c[keep] for c in count]
            if not len(alive):
                break
    return alive, ~bad


def _find(parent: dict, x: int) -> int:
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def _lanes(pair: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every set lane of the words, as (pair number, lane)."""
    bits = np.unpackbits(word.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    row, lane = np.nonzero(bits)
    return pair[row], lane


def _small(fps: np.ndarray, start: np.ndarray, size: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Star edges of the components inside many small buckets, all buckets compared in the same passes."""
    blocks = -(-size // 64)
    first = np.concatenate([[0], np.cumsum(blocks)])
    planes = np.concatenate([planes_of(fps[s:s + n]) for s, n in zip(start, size, strict=True)])
    member_bucket = np.repeat(np.arange(len(size)), size)
    member = np.concatenate([np.arange(s, s + n) for s, n in zip(start, size, strict=True)])
    reps = blocks[member_bucket]
    pair_member = np.repeat(member, reps)
    inner = np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps)
    pair_block = np.repeat(first[member_bucket], reps) + inner
    other0 = np.repeat(start[member_bucket], reps) + inner * 64
    last = np.repeat((start + size)[member_bucket], reps)
    parent: dict[int, int] = {}
    for at in range(0, len(pair_member), 200_000):
        z = slice(at, at + 200_000)
        pair, word = within(planes, pair_block[z], fps[pair_member[z]], radius)
        pair, lane = _lanes(pair + at, word)
        a, b = pair_member[pair], other0[pair] + lane
        ok = (b < last[pair]) & (b < a)
        for x, y in zip(a[ok].tolist(), b[ok].tolist(), strict=True):
            x, y = _find(parent, parent.setdefault(x, x)), _find(parent, parent.setdefault(y, y))
            if x != y:
                parent[max(x, y)] = min(x, y)
    return [(int(fps[x]), int(fps[_find(parent, x)])) for x in parent if parent[x] != x]


def _large(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Star edges of the components inside one large bucket: a search in which each member is a query once."""
    planes, n = planes_of(fps), len(fps)
    blocks = np.arange(len(planes))
    fresh = np.zeros(len(planes), np.uint64)
    np.bitwise_or.at(fresh, np.arange(n) // 64, np.uint64(1) << (np.arange(n) % 64).astype(np.uint64))
    edges, at = [], 0
    step = max(1, 100_000 // len(planes))
    while at < n:
        if not int(fresh[at // 64]) >> at % 64 & 1:
            at += 1
            continue
        fresh[at // 64] &= np.uint64(~(1 << at % 64) & _ALL)
        todo, root = [at], at
        while todo:
            part, todo = todo[:step], todo[step:]
            pair, word = within(planes, np.tile(blocks, len(part)), np.repeat(fps[part], len(planes)), radius)
            hit = np.zeros(len(planes), np.uint64)
            np.bitwise_or.at(hit, pair % len(planes), word)
            new = hit & fresh
            fresh &= ~new
            k = np.nonzero(new)[0]
            blk, lane = _lanes(k, new[k])
            found = (blk * 64 + lane).tolist()
            edges += [(int(fps[x]), int(fps[root])) for x in found]
            todo += found
    return edges


def _links(batches: Iterator[pa.RecordBatch], radius: int, many: int = 1024) -> Iterator[pa.RecordBatch]:
    """Buckets, sorted by (mask, val, tile) -> star edges of the links inside each of them."""
    for t in sorted_groups(batches, ["mask", "val", "tile"]):
        key = [t.column(k).to_numpy() for k in ("mask", "val", "tile")]
        fps = t.column("fp").to_numpy().view(np.uint64)
        cut = np.concatenate([[0], np.nonzero(np.any([k[1:] != k[:-1] for k in key], axis=0))[0] + 1, [len(fps)]])
        start, size = cut[:-1], np.diff(cut)
        few = (size > 1) & (size <= many)
        edges = _small(fps, start[few], size[few], radius) if few.any() else []
        for s, n in zip(start[size > many], size[size > many], strict=True):
            edges += _large(fps[s:s + n], radius)
        if edges:
            u, v = np.array(edges, np.uint64).view(np.int64).T
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])


def near_links(prints: DataFrame, radius: int = 4, cap: int = CAP, levels: int = LEVELS) -> DataFrame:
    """Distinct fingerprints (column fp) -> edges (u, v) that connect all pairs at most ``radius`` bits apart.

    Each bucket contributes the star edges of its own components, not its pairs.  Buckets above
    ``cap`` rows are refined up to ``levels`` times; what is still above is cut into tiles of
    ``cap / 2`` rows and each pair of tiles is one bucket.
    """
    spark, parts = prints.sparkSession, radius + 1
    masks = split_mask(0, parts)
    rows = prints.select("fp", F.explode(F.array(*[F.lit(_signed(m)) for m in masks])).alias("mask"))
    rows = rows.withColumn("val", F.col("fp").bitwiseAND(F.col("mask")))
    edges = None
    for level in range(1, levels + 1):
        hot = stage(rows.groupBy("mask", "val").agg(F.count("*").alias("n")).filter(F.col("n") > cap), "hot-buckets")
        any_hot = bool(hot.head(1))
        cold = rows.join(hot, ["mask", "val"], "left_anti") if any_hot else rows
        compared = _compare(cold.withColumn("tile", F.lit("")), radius)
        edges = compared if edges is None else edges.union(compared)
        if not any_hot:
            return edges
        rows = rows.join(hot.select("mask", "val"), ["mask", "val"], "left_semi")
        if level < levels:
            finer = spark.createDataFrame([(_signed(m), _signed(f)) for m in masks for f in split_mask(m, parts)], "mask long, finer long")
            rows = rows.join(F.broadcast(finer), "mask").select("fp", F.col("finer").alias("mask"))
            rows = stage(rows.withColumn("val", F.col("fp").bitwiseAND(F.col("mask"))), "finer-buckets")
            masks = [f for m in masks for f in split_mask(m, parts)]
    sized = rows.join(hot, ["mask", "val"]).withColumn("tiles", F.ceil(F.col("n") * 2 / cap).cast("int"))
    mine = F.pmod(F.xxhash64("fp"), F.col("tiles").cast("long")).cast("int")
    tiled = sized.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    name = F.concat_ws("-", F.least("mine", "other"), F.greatest("mine", "other"))
    return edges.union(_compare(tiled.select("fp", "mask", "val", name.alias("tile")), radius))


def _compare(rows: DataFrame, radius: int) -> DataFrame:
    dealt = rows.select("mask", "val", "tile", "fp").repartition("mask", "val", "tile").sortWithinPartitions("mask", "val", "tile")
    return dealt.mapInArrow(lambda batches: _links(batches, radius), "u long, v long")


def near_duplicates(docs: DataFrame, words: int = 4, radius: int = 4, seed: int = 42, cap: int = CAP,
                    levels: int = LEVELS) -> DataFrame:
    """Documents (doc_id, text, ...) -> (doc_id, fp, component_id), one row for each input row.

    component_id is the smallest doc_id whose fingerprint is reachable over links of at most
    ``radius`` bits, the document itself included.  Texts without words (null, empty) share
    fingerprint zero and are linked like any other; repeated rows stay repeated; a null doc_id gets
    the smallest id of its component, or null if there is none.  Other columns are ignored; an empty
    table gives an empty result.
    """
    prints = stage(fingerprints(docs, words, seed), "simhash")
    nodes = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "simhash-nodes")
    roots = components(near_links(nodes.select("fp"), radius, cap, levels))
    rooted = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "least_id", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")
