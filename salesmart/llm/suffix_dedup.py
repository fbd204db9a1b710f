"""Exact removal of repeated byte strings by a depth-limited radix sort of suffixes.

Only the first ``length`` bytes of a suffix matter: suffixes that agree on them are one group, and a group
of two or more is exactly a repeated window.  Sorting runs by most-significant-digit passes and a suffix
leaves as soon as it is alone in its group.

The first passes are done by Spark on few suffixes.  Every window of ``length`` bytes names an anchor,
its least hashed run of ``GRAM`` bytes, which depends on nothing but the window's bytes, so equal windows
have equal anchors at equal distances.  Neighbouring windows share an anchor; about one suffix in 140 is one.
Anchors are grouped by their run (one wide digit); an anchor that is alone rules out all of its windows.
Then they are grouped by the bytes of all of their windows: equal ones are repeated as a whole.  What is
left, windows whose anchor recurs in other surroundings, is sorted by digits of eight bytes.

The same passes find passages of words: a text is then the sequence of its words' 64-bit hashes, each one a
digit of eight bytes, and a window counts only if another document (not just another place) holds it too.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import raw_bytes, slices, sorted_groups, stage

LENGTH = 400
GRAM = 128
#: A passage of over 50 words is covered by windows of 51; the anchor run of words.
WORDS = 51
WORD_GRAM = 16
PLACE_BITS = 19  # a chunk of bytes that is hashed at once has at most 2 ** 20 places
#: An anchor run with more different surroundings than this is finished by Spark instead of in one task.
HOT = 20_000
#: Sides up to this size (bytes in memory) are broadcast; beyond it the join shuffles.
SIDE_BYTES = 64_000_000

_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def plain_bytes(text: bytes) -> np.ndarray:
    return np.frombuffer(text, np.uint8)


def word_hashes(text: bytes) -> np.ndarray:
    """The 64-bit hashes of the words ``[^\\x20\\x09-\\x0D]+`` of a text."""
    flat = np.frombuffer(text, np.uint8)
    inside = ~_SPACE[flat]
    at = np.nonzero(inside)[0]
    if not len(at):
        return np.zeros(0, np.uint64)
    first = np.nonzero(np.concatenate([[True], at[1:] != at[:-1] + 1]))[0]  # where in ``at`` each word starts
    size = np.diff(np.append(first, len(at)))
    place = np.arange(len(at)) - np.repeat(first, size)
    with np.errstate(over="ignore"):
        power = np.cumprod(np.full(size.max(), _BASE, np.uint64))
        h = np.add.reduceat((flat[at].astype(np.uint64) + np.uint64(1)) * power[place], first)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class Units(NamedTuple):
    """What a window counts: the units of a text, bytes a unit, and whether it must recur in another document."""

    of: Callable[[bytes], np.ndarray]
    width: int
    across: bool


BYTES = Units(plain_bytes, 1, False)
ACROSS = Units(word_hashes, 8, True)


class Anchors:
    """Finds the anchors of chunks of concatenated texts."""

    def __init__(self, length: int, gram: int) -> None:
        self.length, self.gram, self.wide = length, gram, length - gram + 1
        size = 1 << PLACE_BITS
        with np.errstate(over="ignore"):
            self.power = np.cumprod(np.full(size, _BASE, np.uint64)) * np.uint64(pow(_BASE, -1, 1 << 64))
            inverse = np.uint64(pow(_BASE, -1, 1 << 64))
            self.inverse = np.cumprod(np.full(size, inverse, np.uint64)) * np.uint64(_BASE)

    def find(self, flat: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
        """Texts at ``first`` with ``size`` >= length bytes -> runs of windows: text, first window, last window, anchor, its hash."""
        n, w = len(flat), self.wide
        with np.errstate(over="ignore"):
            total = np.concatenate([[np.uint64(0)], np.cumsum((flat.astype(np.uint64) + np.uint64(1)) * self.power[:n])])
            h = (total[self.gram:] - total[:-self.gram]) * self.inverse[:n - self.gram + 1]
            h ^= h >> np.uint64(31)
            h *= np.uint64(0xBF58476D1CE4E5B9)
            h ^= h >> np.uint64(29)
        low = np.uint64((1 << PLACE_BITS) - 1)
        value = (h & ~low) | (low - np.arange(len(h), dtype=np.uint64))  # of equal hashes the last wins
        padded = np.full(-(-len(h) // w) * w + w, _MASK, np.uint64)
        padded[: len(h)] = value
        square = padded.reshape(-1, w)
        ahead = np.minimum.accumulate(square, axis=1).ravel()
        back = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
        starts = np.concatenate([np.arange(f, f + s - self.length + 1) for f, s in zip(first, size, strict=True)])
        text = np.repeat(np.arange(len(first)), size - self.length + 1)
        anchor = (low - (np.minimum(back[starts], ahead[starts + w - 1]) & low)).astype(np.int64)
        cut = np.nonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])]))[0]
        last = np.append(cut[1:], len(starts)) - 1
        return text[cut], starts[cut], starts[last], anchor[cut], h[anchor[cut]]


def _chunks(texts: list[np.ndarray], length: int) -> Iterator[list[tuple[int, int, np.ndarray]]]:
    """Lists of (text, its place, units) of at most 2 ** PLACE_BITS units; longer texts in overlapping parts that share no window."""
    most = 1 << PLACE_BITS
    held, size = [], 0
    for i, t in enumerate(texts):
        for at in range(0, max(1, len(t) - length + 1), most // 2):
            part = t if len(t) <= most // 2 else t[at:at + most // 2 + length - 1]
            if len(part) < length:
                continue
            if size + len(part) > most:
                yield held
                held, size = [], 0
            held.append((i, at if part is not t else 0, part))
            size += len(part)
            if part is t:
                break
    if held:
        yield held


def anchors(docs: DataFrame, length: int, gram: int, units: Units = BYTES) -> DataFrame:
    """(doc_id, h, row, text) -> staged (doc_id, h, row, key, around, lo, span, off): one row for each run of windows with one anchor.

    Windows lo .. lo + span of the text have their anchor at lo + off; key hashes the anchor's run,
    around all units of the windows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Anchors(length, gram)
        digest = xxhash.xxh64_intdigest
        for b in slices(batches):
            texts = [units.of(t or b"") for t in raw_bytes(b, "text")]
            doc, h, seat = b.column("doc_id"), b.column("h"), b.column("row")
            for held in _chunks(texts, length):
                owner = np.array([i for i, _, _ in held])
                size = np.array([len(p) for *_, p in held])
                first = np.cumsum(size) - size
                joined = np.concatenate([p for *_, p in held])
                text, lo, hi, anchor, key = finder.find(joined, first, size)
                view = memoryview(joined).cast("B")
                around = np.fromiter((digest(view[a:z], 1) for a, z in zip((lo * units.width).tolist(), ((hi + length) * units.width).tolist(), strict=True)), np.uint64, len(lo))
                shift = np.array([at for _, at, _ in held]) - first
                row = pa.array(owner[text])
                yield pa.RecordBatch.from_arrays(
                    [doc.take(row), h.take(row), seat.take(row), pa.array(key.view(np.int64)), pa.array(around.view(np.int64)), pa.array((lo + shift[text]).astype(np.int64)), pa.array((hi - lo).astype(np.int32)), pa.array((anchor - lo).astype(np.int32))],
                    ["doc_id", "h", "row", "key", "around", "lo", "span", "off"])

    return stage(docs.mapInArrow(run, "doc_id long, h long, row long, key long, around long, lo long, span int, off int"), "anchors")


def radix_groups(buffer: np.ndarray, start: np.ndarray, group: np.ndarray, weight: np.ndarray, length: int, owner: np.ndarray | None = None) -> np.ndarray:
    """Most-significant-digit passes over suffixes (places in ``buffer``) inside given groups -> which suffixes are repeated.

    A digit is eight bytes; a suffix leaves when its group's weight falls below two, with ``owner`` also
    when all of the group have one owner and none weighs two.  Groups in which all
    digits agree are left as they are, so a pass sorts only groups that split.
    """
    words = np.ndarray((len(buffer) - 7,), ">u8", buffer, strides=(1,))
    alive = np.arange(len(start))
    _, gid = np.unique(group, return_inverse=True)

    def lone(gid: np.ndarray, alive: np.ndarray) -> np.ndarray:
        if owner is None:
            return np.bincount(gid, weight[alive])[gid] < 2
        rep = np.zeros(gid.max(initial=-1) + 1, owner.dtype)
        rep[gid] = owner[alive]
        return np.bincount(gid, (owner[alive] != rep[gid]) | (weight[alive] > 1))[gid] == 0

    drop = lone(gid, alive)
    alive, gid = alive[~drop], gid[~drop]
    for at in range(0, length, 8):
        if not len(alive):
            break
        _, gid = np.unique(gid, return_inverse=True)
        digit = words[start[alive] + at].astype(np.uint64)
        if length - at < 8:
            digit >>= np.uint64(8 * (8 - (length - at)))
        rep = np.zeros(gid.max() + 1, np.uint64)
        rep[gid] = digit
        split = np.zeros(len(rep), bool)
        split[gid[digit != rep[gid]]] = True
        if not split.any():
            continue
        sub = np.nonzero(split[gid])[0]
        order = sub[np.lexsort((digit[sub], gid[sub]))]
        g, d = gid[order], digit[order]
        gid[order] = len(rep) + np.cumsum(np.concatenate([[0], (g[1:] != g[:-1]) | (d[1:] != d[:-1])]))
        drop = np.zeros(len(gid), bool)
        drop[sub] = lone(gid, alive)[sub]
        alive, gid = alive[~drop], gid[~drop]
    out = np.zeros(len(start), bool)
    out[alive] = True
    return out


def _windows(t: pa.Table, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows with (off, span, body) -> all bodies as bytes, and for each window its row, its place in the bytes, and its place in the row."""
    bodies = t.column("body").to_pylist()
    span = t.column("span").to_numpy().astype(np.int64)
    base = np.cumsum([0, *map(len, bodies)])[:-1]
    row = np.repeat(np.arange(len(span)), span + 1)
    inner = np.arange(len(row)) - np.repeat(np.cumsum(span + 1) - span - 1, span + 1)
    return np.frombuffer(b"".join(bodies) + bytes(8), np.uint8), row, base[row] + inner * width, inner


def _ranges(t: pa.Table, row: np.ndarray, inner: np.ndarray) -> pa.RecordBatch:
    """Repeated windows (row, place in the row; sorted) -> (doc_id, h, a, b) runs of neighbouring ones."""
    cut = np.nonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (inner[1:] != inner[:-1] + 1)]))[0] if len(row) else np.zeros(0, np.int64)
    last = np.append(cut[1:], len(row)) - 1 if len(row) else cut
    lo = t.column("lo").to_numpy()
    of = pa.array(row[cut])
    return pa.RecordBatch.from_arrays([t.column("doc_id").combine_chunks().take(of), t.column("h").combine_chunks().take(of), pa.array(lo[row[cut]] + inner[cut]), pa.array(lo[row[cut]] + inner[last])], ["doc_id", "h", "a", "b"])


def _sort_groups(length: int, units: Units):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by key -> the repeated windows of rows that stand for one occurrence."""
        for t in sorted_groups(batches, ["key"], rows=4_000):
            buffer, row, start, inner = _windows(t, units.width)
            key = np.unique(t.column("key").to_numpy(), return_inverse=True)[1]
            once = t.column("n").to_numpy() == 1
            group = key[row] * (length + 1) + (t.column("off").to_numpy()[row] - inner)  # equal windows lie at equal distances from the anchor
            owner = t.column("row").to_numpy()[row] if units.across else None
            repeated = radix_groups(buffer, start, group, np.where(once, 1, 2)[row], length * units.width, owner) & once[row]
            yield _ranges(t, row[repeated], inner[repeated])

    return run


def _digest_windows(length: int, units: Units):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t = pa.Table.from_batches([b])
            buffer, row, start, inner = _windows(t, units.width)
            view = memoryview(buffer)
            lo = t.column("lo").to_numpy()
            for at in range(0, len(row), 100_000):
                z = slice(at, at + 100_000)
                both = np.frombuffer(b"".join([xxhash.xxh3_128_digest(view[s:s + length * units.width]) for s in start[z].tolist()]), "<i8").reshape(-1, 2)
                of = pa.array(row[z])
                yield pa.RecordBatch.from_arrays([t.column("doc_id").combine_chunks().take(of), t.column("h").combine_chunks().take(of), t.column("row").combine_chunks().take(of), pa.array(lo[row[z]] + inner[z]), pa.array(np.where(t.column("n").to_numpy() == 1, 1, 2)[row[z]].astype(np.int64)),
                                                  pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())], ["doc_id", "h", "row", "a", "weight", "w1", "w2"])

    return run




def _few(df: DataFrame, arrays: list[str], each: int) -> DataFrame:
    """Broadcast a staged side of ids and arrays (``each`` bytes an element) up to SIDE_BYTES; beyond it the join shuffles."""
    size = df.agg(F.sum(F.lit(64) + sum(F.size(a) for a in arrays) * each)).first()[0] or 0
    return F.broadcast(df) if size <= SIDE_BYTES else df


def _surroundings(docs: DataFrame, wanted: DataFrame, length: int, units: Units) -> DataFrame:
    """Anchor rows -> the same rows with ``body``, the units of all of their windows, cut out of the texts."""
    fields = ["key", "around", "n", "n_around", "row", "lo", "span", "off"]
    listed = stage(wanted.groupBy("doc_id", "h").agg(F.collect_list(F.struct(*fields)).alias("cuts")), "cuts").select(F.col("doc_id").alias("d"), F.col("h").alias("g"), "cuts")
    once = docs.join(_few(listed, ["cuts"], 80), docs["doc_id"].eqNullSafe(F.col("d")) & (docs["h"] == F.col("g"))).select("doc_id", "h", "text", "cuts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            for i, raw in enumerate(raw_bytes(b, "text")):
                text = units.of(raw)
                cuts = b.column(3)[i].as_py()
                rows = pa.array([i] * len(cuts))
                types = [pa.int64()] * 6 + [pa.int32()] * 2
                yield pa.RecordBatch.from_arrays([b.column(0).take(rows), b.column(1).take(rows), *[pa.array([c[f] for c in cuts], k) for f, k in zip(fields, types, strict=True)], pa.array([text[c["lo"]:c["lo"] + c["span"] + length].tobytes() for c in cuts], pa.binary())],
                                                 ["doc_id", "h", *fields, "body"])

    made = once.mapInArrow(run, "doc_id long, h long, key long, around long, n long, n_around long, row long, lo long, span int, off int, body binary")
    return made.dropDuplicates(["doc_id", "h", "lo"] if units.across else ["key", "around"])  # repeated document rows give the same cut more than once


def repeated_ranges(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT, units: Units = BYTES) -> DataFrame:
    """(doc_id, h, row, text) -> (doc_id, h, a, b): windows a .. b of the text start a string of ``length`` units that also starts elsewhere.

    Units that count across documents want it in another ``row``; then all occurrences in all of these rows are given.
    """
    found = anchors(docs, length, gram, units)
    elsewhere = F.min("row") < F.max("row") if units.across else F.count("*") > 1
    # Staged, so that both sides of the join are plain exchanges, of which Spark can split a hot key's.
    recurring = stage(found.groupBy("key").agg(elsewhere.alias("more")).filter("more").select("key"), "recurring")
    live = stage(found.join(recurring, "key", "left_semi"), "live-anchors")
    n = F.when(elsewhere, F.lit(2)).otherwise(F.lit(1)).cast("long") if units.across else F.count("*")
    kinds = live.groupBy("key", "around").agg(n.alias("n"), F.count("*").alias("all"), F.min(F.struct("doc_id", "h", "row", "lo", "span", "off")).alias("one"))
    kinds = stage(kinds, "anchor-kinds")
    per_key = kinds.groupBy("key").agg(F.sum(F.when(F.col("n") > 1, F.lit(1)).otherwise(F.col("all"))).alias("n_around"))
    whole = live.join(kinds.filter("n > 1").select("key", "around"), ["key", "around"], "left_semi").select("doc_id", "h", F.col("lo").alias("a"), (F.col("lo") + F.col("span")).alias("b"))
    contested = kinds.join(per_key.filter("n_around > 1"), "key").select("key", "around", "n", "n_around", "all", "one.*")
    if units.across:  # a kind may stand several times in its only document: each place is judged
        again = contested.filter("n = 1 and all > 1").select("key", "around", "n", "n_around", "all")
        contested = contested.filter("n > 1 or all = 1").unionByName(live.join(again, ["key", "around"]).select(contested.columns))
    bodies = stage(_surroundings(docs, contested, length, units), "surroundings")
    usual = bodies.filter(F.col("n_around") <= hot).repartition("key").sortWithinPartitions("key")
    sorted_out = usual.mapInArrow(_sort_groups(length, units), "doc_id long, h long, a long, b long")
    digests = bodies.filter(F.col("n_around") > hot).mapInArrow(_digest_windows(length, units), "doc_id long, h long, row long, a long, weight long, w1 long, w2 long")
    digests = stage(digests, "hot-windows")
    more = (F.min("row") < F.max("row")) | (F.max("weight") > 1) if units.across else F.sum("weight") > 1
    repeated = digests.groupBy("w1", "w2").agg(more.alias("more")).filter("more")
    rest = digests.filter("weight = 1").join(repeated, ["w1", "w2"], "left_semi").select("doc_id", "h", "a", F.col("a").alias("b"))
    return whole.union(sorted_out).union(rest)


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT, words: int = WORDS, word_gram: int = WORD_GRAM) -> DataFrame:
    """Documents (doc_id, text, ...) -> doc_id, n_bytes, spans (start, end; maximal removed runs), kept (bytes) and passages; one row each.

    Every byte covered by a string of ``length`` bytes that also starts anywhere else, in the same
    document or another, is removed; strings are judged on the input.  A null text is empty.  Repeated rows
    are copies of each other.  Null ids stay; other columns are ignored.

    ``passages`` (start, end in words from 0; maximal runs) are the words in any ``words`` consecutive words
    that also stand in another row.  They are reported only: many are shorter than ``length`` bytes.
    """
    if not 8 <= gram <= length:
        raise ValueError("the anchor run must have 8 bytes at least and fit into the string")
    if not 1 <= word_gram <= words:
        raise ValueError("the anchor run of words must have one word at least and fit into the passage")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("h"), text.alias("text"))
    in_bytes = repeated_ranges(source.withColumn("row", F.lit(0).cast("long")), length, gram, hot)
    in_words = repeated_ranges(source.withColumn("row", F.monotonically_increasing_id()), words, word_gram, hot, ACROSS)
    ranges = in_bytes.withColumn("of", F.lit(0)).union(in_words.withColumn("of", F.lit(1)))
    pair = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: tuple[list, list] = ([], [])
            for ranges in b.column(2).to_pylist():
                for of, (size, into) in enumerate(zip((length, words), out, strict=True)):
                    merged: list[list[int]] = []
                    for a, z in sorted((r["a"], r["b"] + size) for r in ranges if r["of"] == of):
                        if merged and a <= merged[-1][1]:
                            merged[-1][1] = max(merged[-1][1], z)
                        else:
                            merged.append([a, z])
                    into.append([{"start": a, "end": z} for a, z in merged])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out[0], pair), pa.array(out[1], pair)], ["d", "g", "spans", "passages"])

    both = "spans array<struct<start:long,end:long>>, passages array<struct<start:long,end:long>>"
    spans = ranges.groupBy("doc_id", "h").agg(F.collect_set(F.struct("of", "a", "b")).alias("ranges")).mapInArrow(merge, f"d long, g long, {both}")
    listed = stage(spans, "spans")
    joined = source.join(_few(listed, ["spans", "passages"], 32), source["doc_id"].eqNullSafe(F.col("d")) & (source["h"] == F.col("g")), "left").select("doc_id", "text", "spans", "passages")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            kept, size, found = [], [], [s or [] for s in b.column(2).to_pylist()]
            passages = [p or [] for p in b.column(3).to_pylist()]
            for t, removed in zip(raw_bytes(b, "text"), found, strict=True):
                edges = [0, *(e for s in removed for e in (s["start"], s["end"])), len(t)]
                kept.append(b"".join(t[a:z] for a, z in zip(edges[::2], edges[1::2], strict=True)) if removed else t)
                size.append(len(t))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(size, pa.int64()), pa.array(found, pair), pa.array(kept, pa.binary()), pa.array(passages, pair)], ["doc_id", "n_bytes", "spans", "kept", "passages"])

    return joined.mapInArrow(run, "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary, passages array<struct<start:long,end:long>>")
