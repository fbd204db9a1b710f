"""Prefix trie of conversations from adaptive radix trees over fixed-width big-endian turn ids.

A turn's id is ``WIDTH`` bytes: 16 of the SHA-256 of (role, text) and its word count as a big-endian
number.  A conversation is the key made of its turns' ids.  The keys are sorted over the whole table by a
range exchange, so a hot first turn or a group of copies spreads over as many partitions as it fills.  A
task takes its sorted keys in bounded chunks, builds an adaptive radix tree of each and emits a trie node
at every turn-aligned byte depth, also inside compressed paths.

Nodes inside a chunk are complete.  Only those on the paths that a chunk shares with its neighbours (its
first and last key) are parts; they are added up by prefix over all chunks, and the sums over their
subtrees are carried up by pointer doubling, in as many joins as the depth has binary digits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import stage
from salesmart.llm.radix import Node, Tree, common

WIDTH = 20
#: Keys and key bytes of one radix tree.
CHUNK_KEYS, CHUNK_BYTES = 20_000, 16 << 20
WORD = r"[^\x20\x09-\x0D]+"
NOTHING = hashlib.sha256().hexdigest()


def turn_id(role: Column, text: Column) -> Column:
    """16 bytes of the SHA-256 of (role, text), then the word count of the text as four big-endian bytes."""
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    return F.unhex(F.concat(F.substring(digest, 1, 32), F.lpad(F.hex(F.regexp_count(text, F.lit(WORD)).cast("long")), 8, "0")))


def turn_lists(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) -> (conv_id, ids): each conversation's turn ids in order.

    Order is by turn (null first), then by role and id.  Texts do not leave the scan; a conversation is one
    value of ``WIDTH`` bytes a turn.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    narrow = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.struct(F.col("turn").alias("turn"), role.alias("role"), turn_id(role, text).alias("id")).alias("t")).filter("conv_id is not null")
    return narrow.groupBy("conv_id").agg(F.transform(F.sort_array(F.collect_list("t")), lambda t: t["id"]).alias("ids"))


class Chunk:
    """The radix tree of one run of the sorted keys, and its trie nodes.

    ``shared_first`` and ``shared_last`` say down to which turn other chunks may hold nodes of the first and
    the last key's path.
    """

    COMPLETE, PART = 0, 1

    def __init__(self, number: int, keys: list[bytes], ids: list[list[int]], shared_first: int, shared_last: int) -> None:
        self.number, self.first, self.last = number, keys[0], keys[-1]
        self.shared_first, self.shared_last = shared_first * WIDTH, shared_last * WIDTH
        self.names_first, self.names_last = (self._names(k, n) for k, n in ((self.first, shared_first), (self.last, shared_last)))
        self.tree = Tree()
        for key, values in zip(keys, ids, strict=True):
            self.tree.insert(key, values)

    @staticmethod
    def _names(key: bytes, turns: int) -> list[bytes]:
        """Names of the key's prefixes of 0 .. turns turns."""
        h, out = hashlib.sha256(), [hashlib.sha256().digest()[:16]]
        for at in range(0, turns * WIDTH, WIDTH):
            h.update(key[at:at + WIDTH])
            out.append(h.digest()[:16])
        return out

    def name(self, at: int, on_first: int, on_last: int) -> bytes | None:
        """The name of the prefix of ``at`` bytes if other chunks may hold it too; on_*: bytes the path has in common with that key."""
        if at <= on_first and at <= self.shared_first:
            return self.names_first[at // WIDTH]
        return self.names_last[at // WIDTH] if at <= on_last and at <= self.shared_last else None

    def rows(self) -> Iterator[tuple]:
        """Post-order over the tree without recursion; see ``_SCHEMA``."""
        path = [self._frame(self.tree.root, -1, None, 0, 0)]
        while path:
            frame = path[-1]
            node, above_end, above, on_first, on_last, children, _ = frame
            step = next(children, None)
            if step is not None:
                here = node.end // WIDTH * WIDTH
                path.append(self._frame(step[1], node.end, node.low if here > above_end else above, on_first, on_last))
                continue
            path.pop()
            forest = yield from self._emit(*frame)
            if path:
                held = path[-1][6]
                for k in range(3):
                    held[k] += forest[k]

    def _frame(self, node: Node, above_end: int, above: int | None, on_first: int, on_last: int) -> tuple:
        start = max(above_end, 0)
        if on_first >= start:
            on_first = common(node.key, self.first, start, node.end)
        if on_last >= start:
            on_last = common(node.key, self.last, start, node.end)
        return node, above_end, above, on_first, on_last, iter(node.table.items()), [0, 0, 0]

    def _emit(self, node: Node, above_end: int, above: int | None, on_first: int, on_last: int, _, forest: list[int]) -> Iterator[tuple]:
        """The trie nodes at this node's turn-aligned depths, deepest first; returns (tops, leaves, saved) of what hangs above them."""
        tops, leaves, saved = forest
        at = node.end // WIDTH * WIDTH
        while at > above_end:
            ends = node.values if at == node.end else []
            words = int.from_bytes(node.key[at - 4:at], "big") if at else 0
            over = at - WIDTH
            name, parent = self.name(at, on_first, on_last), self.name(over, on_first, on_last) if at else None
            if name is not None:
                yield (self.PART, node.low, at // WIDTH, None, node.count, tops, leaves, saved, words, ",".join(map(str, ends)) if ends else None, name, parent, self.number)
                tops = leaves = saved = 0
            else:
                leaves = leaves if tops else 1
                saved += (node.count - 1) * words
                known = None if parent is not None else node.low if over > above_end else above
                done = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest() if ends else NOTHING
                yield (self.COMPLETE, node.low, at // WIDTH, known, node.count, tops, leaves, saved, words, done, None, parent, self.number)
                tops = 1
            at = over
        return tops, leaves, saved


#: conv_id is the smallest member; ends holds the digest of a complete node and the ids of a part; node and
#: parent name prefixes that several chunks may share.
_SCHEMA = ("kind int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, words long, "
           "ends string, node binary, parent binary, chunk long")
_NAMES = [c.split()[0] for c in _SCHEMA.split(", ")]
_TYPES = [pa.int32(), *[pa.int64()] * 8, pa.string(), pa.binary(), pa.binary(), pa.int64()]


def _chunks(batches: Iterator[pa.RecordBatch], max_keys: int, max_bytes: int) -> Iterator[Chunk]:
    """Sorted (key, conv_id) rows -> chunks; equal keys of a chunk are held once, with all their ids."""
    number = TaskContext.get().partitionId() << 32
    keys: list[bytes] = []
    ids: list[list[int]] = []
    n = held = 0
    shared = None  # turns shared with the chunk before; unknown for the partition's first
    for b in batches:
        for key, conv in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            if keys and (n >= max_keys or held >= max_bytes):
                after = common(keys[-1], key, 0, len(key)) // WIDTH
                yield Chunk(number, keys, ids, len(keys[0]) // WIDTH if shared is None else shared, after)
                number, shared, keys, ids, n, held = number + 1, after, [], [], 0, 0
            if keys and keys[-1] == key:
                ids[-1].append(conv)
            else:
                keys.append(key)
                ids.append([conv])
                held += len(key)
            n += 1
    if keys:
        yield Chunk(number, keys, ids, len(keys[0]) // WIDTH if shared is None else shared, len(keys[-1]) // WIDTH)


def _digests(rows: DataFrame) -> DataFrame:
    """(node, ends: ascending ids) -> (node, ends): SHA-256 of a node's id lists joined by commas, by their first ids.

    Carried over the batches; a digest is sequential, so a node's id lists (not its texts or turns) pass one task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, h = None, hashlib.sha256()
        for b in batches:
            done = []
            for node, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if node != now:
                    if now is not None:
                        done.append((now, h.hexdigest()))
                    now, h = node, hashlib.sha256()
                else:
                    h.update(b",")
                h.update(ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), (pa.binary(), pa.string()), strict=True)], ["node", "ends"])
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([h.hexdigest()], pa.string())], ["node", "ends"])

    first = F.substring_index("ends", ",", 1).cast("long")
    return rows.select("node", "ends", first.alias("first")).repartition("node").sortWithinPartitions("node", "first").mapInArrow(run, "node binary, ends string")


def _subtree_sums(nodes: DataFrame) -> DataFrame:
    """(node, parent, depth, leaves, saved) -> (node, leaves, saved) with leaves and saved summed over each subtree.

    Pointer doubling: after round k a node holds the sum of its descendants less than 2^k below it and points
    to its ancestor 2^k above.
    """
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    sums = nodes.select("node", F.col("parent").alias("up"), "leaves", "saved")
    span = 1
    while span <= deepest:
        gained = sums.filter("up is not null").groupBy(F.col("up").alias("node")).agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        jump = sums.select(F.col("node").alias("up"), F.col("up").alias("next"))
        sums = sums.join(gained, "node", "left").join(jump, "up", "left").select(
            "node", F.col("next").alias("up"), (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"), (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"))
        sums = stage(sums, f"trie-sums-{span}")
        span *= 2
    return sums.select("node", "leaves", "saved")


def prefix_trie(lists: DataFrame, max_keys: int = CHUNK_KEYS, max_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(conv_id unique long, ids: array of ``WIDTH``-byte turn ids) -> one row for each trie node.

    conv_id (smallest member), depth, parent_conv_id (null for the root), n_convs, n_children, n_leaves
    (childless nodes in the subtree), saved_tokens (over the subtree, (n_convs - 1) times the words of the node's
    last turn), ends_sha256 (of the ids of conversations that end at the node, ascending, joined by commas).
    A null list counts as empty; conversations without turns belong to the root alone; no rows, no nodes.
    """
    key = F.unhex(F.array_join(F.transform(F.coalesce("ids", F.array().cast("array<binary>")), F.hex), ""))
    keys = stage(lists.select(key.alias("key"), "conv_id"), "trie-keys")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches, max_keys, max_bytes):
            rows = []
            for row in chunk.rows():
                rows.append(row)
                if len(rows) == 20_000:
                    yield _batch(rows)
                    rows = []
            if rows:
                yield _batch(rows)

    parts = stage(keys.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id").mapInArrow(run, _SCHEMA), "trie-parts")
    complete, part = parts.filter(F.col("kind") == Chunk.COMPLETE), parts.filter(F.col("kind") == Chunk.PART)

    added = part.groupBy("node").agg(F.min("parent").alias("parent"), F.min("depth").alias("depth"), F.min("words").alias("words"), F.min("conv_id").alias("conv_id"),
                                     *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")])
    below = part.filter("parent is not null").select("node", "parent").distinct().groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_below"))
    children = F.col("n_children") + F.coalesce("n_below", F.lit(0))
    nodes = stage(added.join(below, "node", "left").select(
        "node", "parent", "depth", "conv_id", "n_convs", children.alias("n_children"), (F.col("n_leaves") + F.when(children == 0, 1).otherwise(0)).alias("leaves"),
        (F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("words")).alias("saved")), "trie-shared")
    sums = _subtree_sums(nodes).select("node", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))
    ends = _digests(part.filter("ends is not null"))
    names = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    shared = nodes.drop("leaves", "saved").join(sums, "node").join(ends, "node", "left").join(names, "parent", "left")

    # A complete node below a shared one takes its parent's smallest member; by chunk, so that no parent is a hot key.
    held = part.select("chunk", F.col("node").alias("parent")).distinct().join(names, "parent").withColumnRenamed("parent_conv_id", "shared_conv_id")
    own = complete.join(held, ["chunk", "parent"], "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "shared_conv_id"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends", F.lit(NOTHING)).alias("ends_sha256")]
    return own.select(*columns).union(shared.select(*columns))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)], _NAMES)


def shared_openings(lists: DataFrame, every: int = 20, longest: int = 3) -> DataFrame:
    """(conv_id, ids) -> the same conversations, each opened by the first h turns of conversation c - c % every instead of its own.

    h is crc32(decimal c) % (longest + 1); an absent opener gives none, a shorter one all its turns.
    """
    c, h = F.col("conv_id"), (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (longest + 1)).cast("int")
    openers = lists.filter(c % every == 0).select(c.alias("opener"), F.slice("ids", 1, longest).alias("opening"))
    joined = lists.join(openers, (c - c % every) == F.col("opener"), "left")
    rest = F.slice("ids", h + 1, F.greatest(F.size("ids") - h, F.lit(0)))
    return joined.select("conv_id", F.concat(F.slice(F.coalesce("opening", F.array().cast("array<binary>")), F.lit(1), h), rest).alias("ids"))


def conversation_trie(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) as they are -> the nodes of their prefix trie.

    Null roles and texts are empty; rows without conv_id belong to no conversation; repeated rows are turns
    of their own; rows of one turn number are ordered by role and id; other columns are ignored.
    """
    return prefix_trie(turn_lists(turns))
