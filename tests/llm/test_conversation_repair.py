import hashlib
import itertools
import random
import re
import zlib
from functools import lru_cache

import pytest

from salesmart.llm import conversation_repair as repair
from salesmart.llm import queries

SF = "/root/testdata/sf0.001"
PATTERN = re.compile(r"(s?(ua)+)?")


def faults(rows):
    """Turns (role, text) in order -> their first faults."""
    out, seen = [], set()
    for r in rows:
        body = re.sub(r"[\x20\x09-\x0D]+$", "", r[1])
        out.append("blank" if not body else "duplicate" if r in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add(r)
    return out


def exhaustive(rows):
    """Every string of edits with up to two inserts in a place: (cost, audit, repaired) of the least."""
    marks = faults(rows)
    inserts = [[], *[[("I", r, "", 2)] for r in ("user", "assistant")], *[[("I", a, "", 2), ("I", b, "", 2)] for a in ("user", "assistant") for b in ("user", "assistant")]]
    choices = [inserts]
    for (role, text), mark in zip(rows, marks, strict=True):
        one = [[("D", None, "", 3)]]
        if mark not in ("blank", "duplicate"):
            more = mark == "truncated"
            one += [[("K", role, text, more)], *[[("R", r, text, 2 + more)] for r in ("user", "assistant")]]
        choices += [one, inserts]
    best = None
    for pick in itertools.product(*choices):
        edits = [e for part in pick for e in part]
        left = [(r, t) for _, r, t, _ in edits if r is not None]
        if PATTERN.fullmatch("".join(r[:1] or "?" for r, _ in left)):
            got = (sum(c for *_, c in edits), "".join(e for e, *_ in edits), "\n".join(f"{r}:{t}" for r, t in left))
            best = got if best is None or got[:2] < best[:2] else best
    return best


def brute(rows):
    """The same by memoised recursion over suffixes, for conversations of any length."""
    marks = faults(rows)
    step = {"": "su", "s": "u", "u": "a", "a": "u"}
    name = {"u": "user", "a": "assistant"}

    @lru_cache(None)
    def best(i, state, inserted):
        options = []
        if i == len(rows) and state in ("", "a"):
            options.append((0, "", ()))
        nexts = [c for c in step[state] if c in name]
        if inserted < 2:
            for c in nexts:
                if (rest := best(i, c, inserted + 1)) is not None:
                    options.append((2 + rest[0], "I" + rest[1], ((name[c], ""), *rest[2])))
        if i < len(rows):
            role, text = rows[i]
            if (rest := best(i + 1, state, 0)) is not None:
                options.append((3 + rest[0], "D" + rest[1], rest[2]))
            if marks[i] not in ("blank", "duplicate"):
                more = marks[i] == "truncated"
                if role[:1] and role[:1] in step[state] and (rest := best(i + 1, role[:1], 0)) is not None:
                    options.append((more + rest[0], "K" + rest[1], ((role, text), *rest[2])))
                for c in nexts:
                    if (rest := best(i + 1, c, 0)) is not None:
                        options.append((2 + more + rest[0], "R" + rest[1], ((name[c], text), *rest[2])))
        return min(options, key=lambda o: o[:2], default=None)

    cost, audit, left = best(0, "", 0)
    return cost, audit, "\n".join(f"{r}:{t}" for r, t in left)


def report(conv, rows):
    """(turn, role, text) rows of one conversation -> its result row."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    turns = [r[1:] for r in rows]
    numbers = {t for t, *_ in rows if t is not None}
    marks, pairs = faults(turns), zip(turns, turns[1:], strict=False)
    cost, audit, left = brute(turns)
    return (conv, max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0, *[marks.count(m) for m in ("blank", "duplicate", "truncated")],
            sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in pairs), cost, audit, hashlib.sha256(left.encode()).hexdigest())


def planted(rows):
    """(conv, turn, role, text) -> damaged rows."""
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        out += [(conv, turn, "user" if k == 4 else role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    return out


def by_conversation(rows):
    held: dict = {}
    for conv, *r in rows:
        held.setdefault(conv, []).append(tuple((v or "") if k else v for k, v in enumerate(r)))
    return held


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is not None, r[0] or 0))


def test_query_matches_brute_force(spark, real):
    rows = real("conversations", "conv_id", "turn", "role", "text")
    held = by_conversation(planted(rows))
    got = queries.op12_conversation_repair(spark, SF)
    assert ordered(got.collect()) == ordered([report(c, held[c]) if c in held else (c, *[0] * 6, "", hashlib.sha256().hexdigest()) for c in {r[0] for r in rows}])
    assert dict(got.dtypes) == {c: "string" if c in ("audit", "repaired_sha256") else "bigint" for c in got.columns}


def test_recursion_and_machine_match_all_edits():
    rng = random.Random(3)
    kinds = [("user", "Hi."), ("assistant", "Yes."), ("system", "Be good."), ("tool", "x."), ("user", "cut"), ("assistant", " "), ("", "!")]
    cases = [list(c) for n in range(3) for c in itertools.product(kinds, repeat=n)]
    cases += [[rng.choice(kinds) for _ in range(3)] for _ in range(25)]
    for rows in cases:
        want = exhaustive(rows)
        assert brute(rows) == want, rows
        machine = repair.Conversation("1", 1000)
        seen: set = set()
        for k, r in enumerate(rows):
            machine.add(k, *r, r in seen)
            seen.add(r)
        *_, cost, audit, digest = machine.close()
        assert (cost, audit, digest) == (want[0], want[1], hashlib.sha256(want[2].encode()).hexdigest()), rows


def conversations(n, seed, longest=40):
    rng = random.Random(seed)
    roles, texts = ["user", "assistant", "user", "assistant", "system", "tool", "", None], ["Yes.", "No!", "why?", "cut off", "", " \t", None, "ends here. \n"]
    rows = []
    for c in range(n):
        for k in range(rng.randrange(1, longest)):
            rows.append((c, rng.choice([None, k, k, k, k // 2, k * 3]), rng.choice(roles), rng.choice(texts) if rng.random() < 0.4 else f"turn {rng.randrange(30)}."))
    return rows


SCHEMA = "conv_id long, turn long, role string, text string, conv string, seen string, nth string, audit string, position long"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c", "d", 9) for r in rows], SCHEMA).repartition(4)


@pytest.mark.parametrize("block", [1, 7, repair.BLOCK])
def test_awkward_conversations_and_spilled_pointers(spark, block):
    rows = conversations(60, 8) + [(None, 1, "user", "Nobody's."), (None, None, "assistant", "Indeed."), (2**60 + 1, -5, "user", "é" * 100_000 + "."), (2**60 + 1, 2**40, "assistant", "ok.")]
    df = frame(spark, rows)
    found = repair.repair_report(df, block)
    assert ordered(found.collect()) == ordered([report(c, r) for c, r in by_conversation(rows).items()])
    left: dict = {}
    for r in sorted(repair.repaired_turns(df, found).collect(), key=lambda r: r.position):
        left.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for r in found.collect():
        assert hashlib.sha256("\n".join(left.get(r.conv_id, [])).encode()).hexdigest() == r.repaired_sha256
    assert repair.repair_report(df.limit(0)).collect() == [] and repair.repaired_turns(df.limit(0), found.limit(0)).collect() == []


def test_one_long_conversation_crosses_batches_and_blocks(spark):
    rng = random.Random(5)
    rows = [(7, k, rng.choice(["user", "assistant"]), rng.choice(["ok.", f"{k}", f"{k}."])) for k in range(25_000)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1000)
    try:
        [got] = repair.repair_report(frame(spark, rows), 4096).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    machine, seen = repair.Conversation("7", 10**9), set()
    for _, turn, role, text in rows:
        machine.add(turn, role, text, (role, text) in seen)
        seen.add((role, text))
    assert tuple(got)[1:] == machine.close()[4:]


def test_damage_of_nulls(spark):
    rows = [(c, t, r, x) for c in (None, 1, 2, 3) for t in (None, *range(12)) for r, x in ((None, "A. b!"), ("assistant", None))]
    got = sorted(map(tuple, repair.damaged(frame(spark, rows)).collect()), key=repr)
    assert got == sorted(planted(rows), key=repr)


def test_one_exchange_and_no_row_dropped(spark):
    plan = repair._secondary_sorted(frame(spark, [(1, 1, "user", "x")]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning") == 1
