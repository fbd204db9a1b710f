"""Best-fit packing of tokenised documents into fixed-length sequences by a grouping genetic algorithm.

Documents longer than a sequence are cut so that every piece but the first is a full sequence.  The
remaining short pieces are dealt by a hash to blocks of a few thousand; each block is evolved on
several islands.  An individual is a list of bins.  Crossover injects whole well-filled bins of one
parent into the other, removes the bins that now hold duplicates, and best-fits the displaced
pieces.  Between epochs each island's elite migrates to the next island of its block.  Bins of a
round that are not well filled are unpacked, dealt to new blocks and evolved again in a smaller round,
until one block is left or a round saves no sequence.
"""

from __future__ import annotations

import random
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import slices, stage

SEQUENCE = 2048
BLOCK = 2000
ISLANDS = 2
EPOCHS = 2
WELL_FILLED = 0.995


class Encoder:
    """Byte-level BPE ids of whole texts as little-endian uint32 bytes.

    Texts are encoded by the rank form of the tokenizer's vocabulary, which gives the same ids in a
    fraction of the time; a text that names a special token goes through the tokenizers file itself.
    """

    def __init__(self, tokenizer_path: str, ranks_path: str, pattern: str) -> None:
        import base64

        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(ranks_path, "rb"))}
        self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.path, self.whole = tokenizer_path, None

    def encode(self, text: str) -> bytes:
        if "<|" in text:
            if self.whole is None:
                from tokenizers import Tokenizer

                self.whole = Tokenizer.from_file(self.path)
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return np.array(self.fast.encode_ordinary(text), "<u4").tobytes()


def _encoder(tokenizer_path: str, ranks_path: str, pattern: str) -> Encoder:
    """One encoder for each Python worker, so that its tasks load the vocabulary once."""
    import builtins

    held = builtins.__dict__.setdefault("_llm_encoders", {})
    if tokenizer_path not in held:
        held[tokenizer_path] = Encoder(tokenizer_path, ranks_path, pattern)
    return held[tokenizer_path]


def pieces(docs: DataFrame, tokenizer_path: str, ranks_path: str, pattern: str, sequence: int = SEQUENCE, end_id: int = 0) -> DataFrame:
    """(doc_id, text) -> one row for each piece: uid, doc_id, piece, start, length, ids_crc32.

    A null text is empty and gives the one-token piece of ``end_id``.  uid is unique among the rows
    once the result is staged.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(tokenizer_path, ranks_path, pattern)
        uid = TaskContext.get().partitionId() << 36
        tail = np.array([end_id], "<u4").tobytes()
        for b in slices(batches):
            rows: list[tuple] = []
            for doc, text in enumerate(b.column(1).to_pylist()):
                ids = (enc.encode(text) if text else b"") + tail
                n = len(ids) // 4
                cuts = [0, *range(n % sequence or sequence, n + 1, sequence)] if n > sequence else [0, n]
                for k, (a, z) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    rows.append((uid, doc, k, a, z - a, zlib.crc32(ids[a * 4:z * 4])))
                    uid += 1
            if rows:
                uids, of, *rest = (pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True))
                yield pa.RecordBatch.from_arrays([uids, b.column(0).take(of), *rest], ["uid", "doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(
        run, f"uid long, doc_id {docs.schema['doc_id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long")


# ---- one block: bins are lists of item numbers -------------------------------------------------

def _best_fit(bins: list[list[int]], room: list[tuple[int, int]], items: list[int], length: list[int], size: int) -> None:
    """Put each item into the fullest bin that takes it, else into a new one.  room: sorted (space left, bin)."""
    for i in items:
        need = length[i]
        k = bisect_left(room, (need, -1))
        if k < len(room):
            space, b = room.pop(k)
            bins[b].append(i)
        else:
            space, b = size, len(bins)
            bins.append([i])
        if space > need:
            insort(room, (space - need, b))


def _fresh(order: list[int], length: list[int], size: int) -> list[list[int]]:
    bins: list[list[int]] = []
    _best_fit(bins, [], order, length, size)
    return bins


def _fitness(bins: list[list[int]], length: list[int], size: int) -> float:
    """Mean squared fill: fewer and more unevenly filled bins are better."""
    return sum((sum(length[i] for i in b) / size) ** 2 for b in bins) / len(bins)


def _cross(a: list[list[int]], b: list[list[int]], length: list[int], size: int, rng: random.Random) -> list[list[int]]:
    """Whole well-filled bins of ``b`` go into ``a``; bins of ``a`` with duplicates go, their other items are best-fitted."""
    full = sorted(b, key=lambda x: -sum(length[i] for i in x))
    top = full[: max(1, len(full) // 2)]
    taken = [list(x) for x in rng.sample(top, max(1, int(len(top) * rng.uniform(0.2, 0.8))))]
    held = {i for x in taken for i in x}
    kept, loose = [], []
    for x in a:
        if held.isdisjoint(x):
            kept.append(list(x))
        else:
            loose += [i for i in x if i not in held]
    bins = taken + kept
    # The worst-filled bins are opened as well: a mutation that gives best fit something to combine.
    bins.sort(key=lambda x: -sum(length[i] for i in x))
    for x in bins[len(bins) - max(1, len(bins) // 50):]:
        loose += x
    del bins[len(bins) - max(1, len(bins) // 50):]
    room = sorted((s, k) for k, x in enumerate(bins) if (s := size - sum(length[i] for i in x)))
    _best_fit(bins, room, sorted(loose, key=lambda i: -length[i]), length, size)
    return bins


def evolve(length: list[int], size: int, seeds: list[list[list[int]]], seed: int, population: int = 5, steps: int = 12) -> list[list[int]]:
    """Best bins found for one block.  seeds: individuals to start from (an island's own elite, immigrants)."""
    rng = random.Random(seed)
    down = sorted(range(len(length)), key=lambda i: -length[i])
    people = list(seeds) or [_fresh(down, length, size)]
    bound = -(-sum(length) // size)
    while len(people) < population:
        jitter = sorted(down, key=lambda i: -length[i] * rng.uniform(0.7, 1.0))
        people.append(_fresh(jitter, length, size))
    ranked = sorted(((len(p), -_fitness(p, length, size), k, p) for k, p in enumerate(people)))
    for step in range(steps):
        if ranked[0][0] == bound:
            break
        a, b = ranked[0], ranked[1 + rng.randrange(len(ranked) - 1)]
        if rng.random() < 0.5:
            a, b = b, a
        child = _cross(a[3], b[3], length, size, rng)
        ranked = sorted([*ranked, (len(child), -_fitness(child, length, size), population + step, child)])[:population]
    return ranked[0][3]


def _pack_block(size: int, turn: int, epoch: int):
    def run(key: tuple, t: pa.Table) -> pa.Table:
        """One island of one block: rows (uid, length, bin, origin); origin 0 own elite, 1 immigrants, null none yet."""
        pdf = t.to_pandas().sort_values(["origin", "uid"], kind="stable")
        own = pdf[pdf.origin != 1]
        uids, length = own.uid.to_numpy(), own.length.tolist()
        number = {u: i for i, u in enumerate(uids.tolist())}
        seeds = []
        for origin, part in pdf.groupby("origin"):
            if origin >= 0:
                bins: dict[int, list[int]] = {}
                for u, b in zip(part.uid.tolist(), part.bin.tolist(), strict=True):
                    bins.setdefault(b, []).append(number[u])
                seeds.append(list(bins.values()))
        block, island = int(key[0].as_py()), int(key[1].as_py())
        best = evolve(length, size, seeds, seed=hash((block, island, turn, epoch)))
        rows = [(int(uids[i]), length[i], k, off) for k, b in enumerate(best) for i, off in zip(b, np.cumsum([0, *[length[i] for i in b]])[:-1].tolist(), strict=True)]
        fit = -_fitness(best, length, size)
        u, n, k, off = zip(*rows, strict=True)
        same = len(rows)
        return pa.table({"block": pa.array([block] * same, pa.int64()), "island": pa.array([island] * same, pa.int32()), "uid": pa.array(u, pa.int64()), "length": pa.array(n, pa.int64()),
                         "bin": pa.array(k, pa.int64()), "offset": pa.array(off, pa.int64()), "bins": pa.array([len(best)] * same, pa.int64()), "unfit": pa.array([fit] * same, pa.float64())})

    return run


_ELITE = "block long, island int, uid long, length long, bin long, offset long, bins long, unfit double"


def pack(items: DataFrame, size: int = SEQUENCE, block: int = BLOCK, islands: int = ISLANDS, epochs: int = EPOCHS) -> DataFrame:
    """Items (uid unique, length 1 .. size) -> (uid, sequence_id, offset); sequence_id is the smallest uid in the bin.

    A round deals the items to blocks by a hash of their own; what lies in badly filled bins goes into the
    next one.  The last round is that of a single block, or one that leaves as many bins as its items filled before.
    """
    done: DataFrame | None = None
    left = items.select("uid", "length")
    turn, bins_before = 0, None
    while n := left.count():
        blocks = -(-n // block)
        elite = left.withColumn("block", F.pmod(F.xxhash64("uid", F.lit(turn)), F.lit(blocks))).withColumn("island", F.explode(F.array(*[F.lit(i) for i in range(islands)])))
        elite = elite.select("block", "island", "uid", "length", F.lit(None).cast("long").alias("bin"), F.lit(-1).alias("origin"))
        for epoch in range(epochs):
            run = elite.groupBy("block", "island").applyInArrow(_pack_block(size, turn, epoch), _ELITE)
            solved = stage(run, f"pack-{turn}-{epoch}")
            own = solved.select("block", "island", "uid", "length", "bin", F.lit(0).alias("origin"))
            guests = solved.select("block", F.pmod(F.col("island") + 1, F.lit(islands)).alias("island"), "uid", "length", "bin", F.lit(1).alias("origin"))
            elite = own.union(guests)
        best = solved.groupBy("block").agg(F.min(F.struct("bins", "unfit", "island")).alias("b")).select("block", F.col("b.island").alias("island"))
        won = solved.join(best, ["block", "island"])
        bins = won.groupBy("block", "bin").agg(F.min("uid").alias("sequence_id"), F.sum("length").alias("fill"))
        placed = stage(won.join(bins, ["block", "bin"]).select("uid", "length", "sequence_id", "offset", "fill"), f"packed-{turn}")
        poor = F.col("fill") < WELL_FILLED * size
        # Each bin has one piece at offset 0.
        bins_now, poor_now = placed.filter("offset = 0").agg(F.count("*"), F.count_if(poor)).first()
        if blocks == 1 or bins_before is not None and bins_now >= bins_before:
            done = placed if done is None else done.union(placed)
            break
        kept = placed.filter(~poor)
        done = kept if done is None else done.union(kept)
        left, bins_before, turn = placed.filter(poor).select("uid", "length"), poor_now, turn + 1
    out = done if done is not None else items.select("uid", "length", F.col("uid").alias("sequence_id"), F.lit(0).cast("long").alias("offset"), F.col("length").alias("fill")).limit(0)
    return out.select("uid", "sequence_id", "offset")


def pack_documents(docs: DataFrame, tokenizer_path: str | None = None, ranks_path: str | None = None, pattern: str | None = None,
                   sequence: int = SEQUENCE, **options: int) -> DataFrame:
    """Documents (doc_id, text, ...) -> one row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are one end token.  Repeated rows are packed each on their own; null ids stay
    null; other columns are ignored; an empty table gives an empty result.
    """
    import public_tokenizers as public

    cut = stage(pieces(docs, tokenizer_path or public.path("byte_bpe_50k.json"), ranks_path or public.path("byte_bpe_50k.tiktoken"), pattern or public.PATTERN, sequence), "pieces")
    short = cut.filter(F.col("length") < sequence)
    full = cut.filter(F.col("length") == sequence).withColumn("sequence_id", F.col("uid")).withColumn("offset", F.lit(0).cast("long"))
    placed = short.join(pack(short, sequence, **options), "uid")
    columns: list[str | Column] = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return full.select(*columns).union(placed.select(*columns))
