import hashlib
import random
import re
import zlib

import pytest

from salesmart.llm import prefix_trie, queries
from salesmart.llm.radix import Full, Indexed, Small, Tree

SF = "/root/testdata/sf0.001"


def brute(conversations):
    """{conv_id: turns (role, text)} -> node rows, from all prefixes in one dictionary."""
    members: dict[tuple, list[int]] = {}
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {p: [] for p in members}
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        leaves[p] = sum(leaves[k] for k in children[p]) or 1
        saved[p] = sum(saved[k] for k in children[p]) + (len(members[p]) - 1) * words
    out = []
    for p, who in members.items():
        ends = ",".join(map(str, sorted(c for c in who if len(conversations[c]) == len(p))))
        out.append((min(who), len(p), min(members[p[:-1]]) if p else None, len(who), len(children[p]), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return ordered(out)


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0], r[1]))


def original(rows):
    """Turn rows -> {conv_id: turns}, ordered as the operator does."""
    held: dict[int, list] = {}
    for c, turn, role, text in rows:
        role, text = role or "", text or ""
        name = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16] + len(re.findall(r"[^\x20\x09-\x0D]+", text)).to_bytes(4, "big")
        if c is not None:
            held.setdefault(c, []).append(((turn is not None, turn), role.encode(), name, (role, text)))
    return {c: [t[3] for t in sorted(v, key=lambda t: t[:3])] for c, v in held.items()}


def rebuilt(rows):
    own = original(rows)
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def test_query_matches_brute_force(spark, real):
    got = queries.op11_prefix_trie(spark, SF)
    assert ordered(got.collect()) == brute(rebuilt(real("conversations", "conv_id", "turn", "role", "text")))
    assert dict(got.dtypes) == {c: "string" if c == "ends_sha256" else "bigint" for c in got.columns}


def bushy(n, seed):
    """Random conversations with shared openings, copies, prefixes of one another, and a few long ones that part late."""
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        turns = [rng.choice("abc") * (1 + rng.randrange(2)) for _ in range(rng.randrange(6))]
        if c % 3 == 0:
            turns = ["hot start", "second one", *turns[:2]]
        if c % 17 == 0:
            turns = [f"long {i}" for i in range(70)] + [str(c % 34)]
        rows += [(c, i, "user" if i % 2 else "assistant", t) for i, t in enumerate(turns)]
    return rows


@pytest.mark.parametrize("chunk", [1, 3, 50, 20_000])
def test_chunks_of_any_size_give_the_same_nodes(spark, chunk):
    rows = bushy(300, 5)
    lists = prefix_trie.turn_lists(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5))
    assert ordered(prefix_trie.prefix_trie(lists, max_keys=chunk).collect()) == brute(original(rows))
    assert ordered(prefix_trie.prefix_trie(prefix_trie.shared_openings(lists), max_keys=chunk).collect()) == brute(rebuilt(rows))


def test_awkward_rows(spark):
    rows = [(1, None, "user", "first of all"), (1, 0, None, None), (1, 1, "", ""), (2, 0, "user", "x"), (2, 0, "user", "x"), (2, 0, "assistant", "tie"),
            (None, 0, "user", "nobody"), (20, 5, "user", "é " * 30_000), (21, None, None, "\x1c word"), (-3, 0, "user", "below zero"), (-40, 7, "user", "x"), (-41, 7, "user", "x"), (2**62, 1, "user", "x"), (3, 0, "us", "erx"), (4, 0, "use", "rx")]
    schema = "conv_id long, turn long, role string, text string, id string, key string, ids string, depth string"
    df = spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], schema)
    assert ordered(prefix_trie.conversation_trie(df).collect()) == brute(original(rows))
    lists = prefix_trie.turn_lists(df)
    assert ordered(prefix_trie.prefix_trie(prefix_trie.shared_openings(lists)).collect()) == brute(rebuilt(rows))
    assert prefix_trie.conversation_trie(df.limit(0)).collect() == []


def test_layouts_grow_and_paths_compress():
    tree, seen = Tree(), set()
    for n, want in ((4, Small), (16, Small), (48, Indexed), (256, Full)):
        for b in range(n):
            if b not in seen:
                seen.add(b)
                tree.insert(bytes([7, 7, b, 9, 9]), [b])
        branch = tree.root.table.find(7)
        assert isinstance(branch.table, want) and branch.end == 2 and branch.count == n and [b for b, _ in branch.table.items()] == list(range(n))
    assert branch.table.find(200).end == 5  # the rest of a lone key is one compressed path
    tree.insert(bytes([7, 7]), [1000])
    assert branch.values == [1000] and tree.root.count == 257 and tree.root.low == 0
