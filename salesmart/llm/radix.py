"""An adaptive radix tree over byte strings: node layouts that grow, path compression, values where keys end.

Keys of one fixed-width alphabet (ids of ``WIDTH`` bytes set end to end) may be prefixes of one another,
so a node can hold both values and children.  The tree lives inside one task and holds one bounded
chunk of keys.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator


class Small:
    """Up to ``limit`` children as sorted key bytes beside their nodes: the 4- and the 16-child layouts."""

    __slots__ = ("keys", "nodes", "limit")

    def __init__(self, limit: int = 4, keys: bytearray | None = None, nodes: list | None = None) -> None:
        self.limit, self.keys, self.nodes = limit, keys if keys is not None else bytearray(), nodes if nodes is not None else []

    def find(self, byte: int) -> Node | None:
        k = self.keys.find(byte)
        return self.nodes[k] if k >= 0 else None

    def put(self, byte: int, node: Node) -> Small | Indexed:
        """Add a child that is not there yet; returns the layout to use from now on."""
        if len(self.keys) == self.limit:
            grown = Small(16, self.keys, self.nodes) if self.limit == 4 else Indexed(zip(self.keys, self.nodes, strict=True))
            return grown.put(byte, node)
        at = bisect_left(self.keys, byte)
        self.keys.insert(at, byte)
        self.nodes.insert(at, node)
        return self

    def items(self) -> Iterator[tuple[int, Node]]:
        return zip(self.keys, self.nodes, strict=True)


class Indexed:
    """Up to 48 children behind an index of 256 bytes."""

    __slots__ = ("index", "nodes")

    def __init__(self, items) -> None:
        self.index, self.nodes = bytearray(256), []
        for byte, node in items:
            self.nodes.append(node)
            self.index[byte] = len(self.nodes)

    def find(self, byte: int) -> Node | None:
        k = self.index[byte]
        return self.nodes[k - 1] if k else None

    def put(self, byte: int, node: Node) -> Indexed | Full:
        if len(self.nodes) == 48:
            return Full(self.items()).put(byte, node)
        self.nodes.append(node)
        self.index[byte] = len(self.nodes)
        return self

    def items(self) -> Iterator[tuple[int, Node]]:
        return ((b, self.nodes[k - 1]) for b, k in enumerate(self.index) if k)


class Full:
    """A child pointer for every byte."""

    __slots__ = ("nodes",)

    def __init__(self, items) -> None:
        self.nodes: list = [None] * 256
        for byte, node in items:
            self.nodes[byte] = node

    def find(self, byte: int) -> Node | None:
        return self.nodes[byte]

    def put(self, byte: int, node: Node) -> Full:
        self.nodes[byte] = node
        return self

    def items(self) -> Iterator[tuple[int, Node]]:
        return ((b, n) for b, n in enumerate(self.nodes) if n is not None)


class Node:
    """The bytes up to ``end`` of ``key`` lead here; those after the parent's end are this node's compressed path."""

    __slots__ = ("key", "end", "table", "values", "count", "low")

    def __init__(self, key: bytes, end: int, values: list[int]) -> None:
        self.key, self.end, self.table, self.values = key, end, Small(), values
        self.count, self.low = len(values), min(values, default=0)

    def split(self, at: int) -> None:
        """Cut the compressed path at byte ``at``: this node ends there, its former self hangs below."""
        lower = Node(self.key, self.end, self.values)
        lower.table, lower.count, lower.low = self.table, self.count, self.low
        self.end, self.values, self.table = at, [], Small().put(self.key[at], lower)


def common(a: bytes, b: bytes, start: int, stop: int) -> int:
    """End of the common run of ``a`` and ``b`` from ``start``, at most ``stop``."""
    stop = min(stop, len(a), len(b))
    if a[start:stop] == b[start:stop]:
        return stop
    lo, hi = start, stop - 1  # a differing byte lies in lo .. hi
    while lo < hi:
        mid = (lo + hi) // 2
        if a[lo:mid + 1] == b[lo:mid + 1]:
            lo = mid + 1
        else:
            hi = mid
    return lo


class Tree:
    def __init__(self) -> None:
        self.root = Node(b"", 0, [])

    def insert(self, key: bytes, values: list[int]) -> None:
        """Add the values of a key; each key's values come in one call."""
        node, at, low = self.root, 0, min(values)
        while True:
            same = common(node.key, key, at, node.end)
            if same < node.end:
                node.split(same)
            node.low = min(node.low, low) if node.count else low
            node.count += len(values)
            at = node.end
            if at == len(key):
                node.values += values
                return
            child = node.table.find(key[at])
            if child is None:
                node.table = node.table.put(key[at], Node(key, len(key), values))
                return
            node = child
