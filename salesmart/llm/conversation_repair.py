"""Least-cost repair of conversation structure, streamed over secondary-sorted turns.

Turns are repartitioned by conversation and sorted by turn; ``mapInPandas`` runs one forward pass over the
sorted rows and carries the state of the conversation it is in across Arrow batches.  The state is a
dynamic program over four positions in the pattern ``(s?(ua)+)?`` of role initials: the cost of the
cheapest edits that reach each position, their order by edit letters, and the digest of the turns they
leave.  Three bytes a turn remember how each position was reached.  A conversation of up to ``BLOCK`` turns
is traced back at once; of a longer one the blocks of pointers are spilled as rows of a staged table, and a
second pass reads them in descending order and carries the position back through them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.common import stage

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: Turns whose back pointers are held in a task; a longer conversation spills them in blocks of this many.
BLOCK = 65_536

#: Positions in the pattern: nothing yet, after a leading system turn, after a user turn, after an assistant turn.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
STEP = {(EMPTY, "s"): SYSTEM, (EMPTY, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: The role that an inserted or rewritten turn gets at each position, as only these continue the pattern.
NEXT_ROLE = {EMPTY: "user", SYSTEM: "user", USER: "assistant", ASSISTANT: "user"}
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
_FAR = 1 << 60
_LETTERS = [i + last for last in "DKR" for i in ("", "I", "II")]
_CODE = {letters: k for k, letters in enumerate(_LETTERS)}


def walk(position: int, letters: str, initial: str) -> tuple[int, list[str | None]] | None:
    """The position after some inserts and one edit of a turn, and the roles written (None: the turn's own); None if it breaks the pattern."""
    roles: list[str | None] = []
    for x in letters:
        if x == "D":
            continue
        role = None if x == "K" else NEXT_ROLE[position]
        after = STEP.get((position, initial if role is None else role[0]))
        if after is None:
            return None
        roles.append(role)
        position = after
    return position, roles


def _moves(initial: str, must_go: bool, truncated: bool) -> list[list[tuple[int, int, str, list[str | None]]]]:
    """For each position reached: (position before, cost, letters, roles written), the best letters for each position before."""
    best: dict[tuple[int, int], tuple] = {}
    for before in range(4):
        for letters in _LETTERS:
            last = letters[-1]
            if must_go and last != "D" or (got := walk(before, letters, initial)) is None:
                continue
            cost = INSERT * (len(letters) - 1) + (DELETE if last == "D" else (REROLE if last == "R" else KEEP) + TRUNCATED * truncated)
            move = (cost, letters, got[1])
            key = (got[0], before)
            if key not in best or move[:2] < best[key][:2]:
                best[key] = move
    return [[(before, *best[after, before]) for before in range(4) if (after, before) in best] for after in range(4)]


_TAILS = {EMPTY: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
_MOVES: dict[tuple[str, bool, bool], list] = {}


def moves(initial: str, must_go: bool, truncated: bool) -> list:
    key = (initial if initial in ("s", "u", "a") else "", must_go, truncated)
    if key not in _MOVES:
        _MOVES[key] = _moves(*key)
    return _MOVES[key]


def trace(pointers: bytes, position: int) -> tuple[int, str]:
    """Back through a block of pointers from the position after it: (position before it, its letters)."""
    out = []
    for at in range(len(pointers) - 3, -1, -3):
        code = int.from_bytes(pointers[at:at + 3], "big") >> (6 * position) & 63
        out.append(_LETTERS[code >> 2])
        position = code & 3
    return position, "".join(reversed(out))


class Conversation:
    """One conversation's running counts and dynamic program."""

    def __init__(self, name: str | None, block: int) -> None:
        self.name, self.block = name, block
        self.low = self.high = self.last = None
        self.distinct = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.before: str | None = None  # the initial of the turn before
        self.cost, self.rank = [0, _FAR, _FAR, _FAR], [0, 0, 0, 0]
        self.hashes = [hashlib.sha256() for _ in range(4)]
        self.pointers, self.spilled = bytearray(), 0

    def add(self, turn: int | None, role: str, text: str, seen: bool) -> tuple | None:
        """Take the next turn; gives a block of pointers when one is full."""
        if turn is not None:
            if self.low is None:
                self.low = turn
            self.distinct += turn != self.last
            self.high = self.last = turn
        initial = role[:1]
        self.illegal += self.before is not None and self.before + initial not in ("su", "ua", "au")
        self.before = initial
        body = text.rstrip(SPACE)
        blank, cut = not body, body[-1:] not in (".", "!", "?")
        truncated = cut and not blank and not seen
        self.blank += blank
        self.duplicate += seen and not blank
        self.truncated += truncated
        self._advance(moves(initial, blank or seen, truncated), role, text)
        if len(self.pointers) == 3 * self.block:
            full = (self.spilled, bytes(self.pointers))
            self.spilled += 1
            self.pointers = bytearray()
            return full
        return None

    def _advance(self, table: list, role: str, text: str) -> None:
        cost, rank, hashes = self.cost, self.rank, self.hashes
        chosen: list[tuple | None] = [None] * 4
        for after in range(4):
            best = None
            for before, more, letters, roles in table[after]:
                if cost[before] < _FAR:
                    key = (cost[before] + more, rank[before], letters)
                    if best is None or key < best[0]:
                        best = (key, before, roles)
            chosen[after] = best
        packed = 0
        new_cost, new_hashes = [_FAR] * 4, [hashes[0]] * 4
        body = text.encode()
        for after, best in enumerate(chosen):
            if best is None:
                continue
            (new_cost[after], _, letters), before, roles = best
            packed |= (_CODE[letters] << 2 | before) << 6 * after
            h = hashes[before]
            if roles:
                h = h.copy()
                own = letters[-1] != "D"
                for k, r in enumerate(roles):
                    h.update((("" if k == 0 and before == EMPTY else "\n") + (role if r is None else r) + ":").encode())
                    if own and k == len(roles) - 1:
                        h.update(body)
            new_hashes[after] = h
        order = sorted((best[0][1], best[0][2], after) for after, best in enumerate(chosen) if best)
        for k, (_, _, after) in enumerate(order):
            rank[after] = k
        self.cost, self.hashes = new_cost, new_hashes
        self.pointers += packed.to_bytes(3, "big")

    def close(self) -> tuple:
        """The summary row: block number, the last pointers if others were spilled, position, tail, counts, cost, audit, digest."""
        cost, _, position = min((self.cost[p] + INSERT * len(tail), self.rank[p], p) for p, tail in _TAILS.items() if self.cost[p] < _FAR)
        tail, h = _TAILS[position], self.hashes[position].copy()
        _, roles = walk(position, tail, "")
        for r in roles:  # a tail follows a written turn
            h.update(f"\n{r}:".encode())
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        counts = (gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost)
        audit = None if self.spilled else trace(bytes(self.pointers), position)[1] + tail
        return (self.spilled, bytes(self.pointers) if self.spilled else None, position, tail, *counts, audit, h.hexdigest())


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_ROWS = "conv string, block long, pointers binary, position int, tail string, " + "".join(f"{c} long, " for c in _COUNTS) + "audit string, repaired_sha256 string"
_NAMES = [c.split()[0] for c in _ROWS.split(", ")]


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    return pd.DataFrame({n: pd.Series(list(c), dtype="object") for n, c in zip(names, zip(*rows, strict=True), strict=True)})


def _secondary_sorted(turns: DataFrame) -> DataFrame:
    """Turns -> conv, turn (both as text, so that nulls and large numbers pass), role, text, seen; sorted within partitions.

    ``seen``: the conversation has the same role and text in an earlier row.  The window asks for the
    conversation's partition only, so there is one exchange.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    print_ = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = turns.select(F.col("conv_id").cast("string").alias("conv"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), print_.alias("print")).repartition("conv")
    nth = F.row_number().over(Window.partitionBy("conv", "print").orderBy("turn"))
    return rows.withColumn("nth", nth).sortWithinPartitions("conv", "turn", "role", "text", "nth")


def _text(v) -> str | None:
    return v if isinstance(v, str) else None


def _forward(sorted_turns: DataFrame, block: int) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now: Conversation | None = None
        for f in frames:
            out: list[tuple] = []
            for conv, turn, role, text, seen in zip(f["conv"], f["turn"], f["role"], f["text"], f["seen"], strict=True):
                conv = _text(conv)
                if now is None or now.name != conv:
                    if now is not None:
                        out.append((now.name, *now.close()))
                    now = Conversation(conv, block)
                if full := now.add(int(turn) if _text(turn) else None, role, text, bool(seen)):
                    out.append((now.name, *full, *[None] * (len(_NAMES) - 3)))
            if out:
                yield _frame(out, _NAMES)
        if now is not None:
            yield _frame([(now.name, *now.close())], _NAMES)

    seen = (F.col("nth") > 1).alias("seen")
    return sorted_turns.select("conv", F.col("turn").cast("string").alias("turn"), "role", "text", seen).mapInPandas(run, _ROWS)


def _backward(rows: DataFrame) -> DataFrame:
    """Spilled blocks and the summary rows of their conversations -> (conv, audit)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        position = EMPTY
        for f in frames:
            out = []
            for conv, block, pointers, last, tail in zip(f["conv"], f["block"], f["pointers"], f["position"], f["tail"], strict=True):
                if _text(tail) is not None:  # a conversation's summary row comes before its blocks
                    position = int(last)
                position, letters = trace(pointers, position)
                out.append((_text(conv), int(block), letters + (_text(tail) or "")))
            if out:
                yield _frame(out, ["conv", "block", "letters"])

    spilled = rows.filter("pointers is not null").select("conv", "block", "pointers", "position", "tail")
    letters = spilled.repartition("conv").sortWithinPartitions("conv", F.desc("block")).mapInPandas(run, "conv string, block long, letters string")
    parts = F.sort_array(F.collect_list(F.struct("block", "letters")))
    return letters.groupBy("conv").agg(F.array_join(F.transform(parts, lambda p: p["letters"]), "").alias("long_audit"))


def repair_report(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """Turns (conv_id, turn, role, text, ...) -> one row for each conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Turns are taken by turn (nulls first), then by role and text.  A turn's first fault counts: blank (no
    character but white space), duplicate (role and text seen earlier), truncated (last such character not one
    of ``.!?``).  Edits: K keeps (0), R rewrites the role to user or assistant (2), D deletes (3; blank
    and duplicate turns must go), I inserts an empty user or assistant turn (2); each truncated turn that
    stays adds 1.  audit names the cheapest edits that leave role initials ``(s?(ua)+)?``, the least string of
    those of equal cost; repaired_sha256 is the digest of the turns they leave, as ``role:text`` lines.

    Null and empty roles have no initial, null texts are empty, null conv_ids are one conversation,
    repeated rows are duplicates, other columns are ignored, an empty table gives an empty result.
    A conversation passes one task as a stream: memory holds one batch, four digests and one block of
    pointers; an audit is one value of a letter an edit.
    """
    rows = stage(_forward(_secondary_sorted(turns), block), "repair-forward")
    summary = rows.filter("tail is not null")
    long_ones = _backward(rows)
    found = summary.join(long_ones.withColumnRenamed("conv", "__conv"), F.col("conv").eqNullSafe(F.col("__conv")), "left")
    conv_id = F.col("conv").cast(turns.schema["conv_id"].dataType).alias("conv_id")
    return found.select(conv_id, *_COUNTS, F.coalesce("audit", "long_audit").alias("audit"), "repaired_sha256")


def repaired_turns(turns: DataFrame, report: DataFrame) -> DataFrame:
    """Turns and their report -> the turns that the edits leave: conv_id, position (from 0), edit (K, R or I), role, text.

    Each conversation's audit comes first in its sorted stream; the turns follow it and are rewritten one by one.
    """
    plan = report.select(F.col("conv_id").cast("string").alias("conv"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("text"), F.lit(0).cast("int").alias("nth"), "audit")
    rows = _secondary_sorted(turns).drop("print").withColumn("audit", F.lit(None).cast("string")).unionByName(plan)
    lined = rows.repartition("conv").sortWithinPartitions("conv", F.expr("audit is null"), "turn", "role", "text", "nth").select("conv", "role", "text", "audit")
    names = ["conv", "position", "edit", "role", "text"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        conv, audit, at, position, written = None, "", 0, EMPTY, 0
        for f in frames:
            out: list[tuple] = []
            for c, role, text, plan_ in zip(f["conv"], f["role"], f["text"], f["audit"], strict=True):
                if _text(plan_) is not None:
                    conv, audit, at, position, written = _text(c), plan_, 0, EMPTY, 0
                    own = None
                else:
                    own = (role, text)
                # After a turn come the inserts before the next; with the plan itself, those before the first.
                while at < len(audit) and (own is not None or audit[at] == "I"):
                    edit, at = audit[at], at + 1
                    new = None if edit == "D" else (own[0] if edit == "K" else NEXT_ROLE[position], "" if edit == "I" else own[1])
                    if new is not None:
                        out.append((conv, written, edit, *new))
                        written += 1
                        position = STEP[position, new[0][:1]]
                    if edit != "I":
                        own = None
            if out:
                yield _frame(out, names)

    conv_id = F.col("conv").cast(turns.schema["conv_id"].dataType).alias("conv_id")
    return lined.mapInPandas(run, "conv string, position long, edit string, role string, text string").select(conv_id, *names[1:])


def damaged(turns: DataFrame) -> DataFrame:
    """Plant faults by crc32(``conv_id:turn``) % 20: 0 drops the row, 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4 sets role user.  Nulls become one space."""
    as_text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault: Column = F.crc32(F.concat(as_text("conv_id"), F.lit(":"), as_text("turn")).cast("binary")) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.translate(as_text("text"), ".!?", "")).otherwise(as_text("text"))
    role = F.when(fault == 4, "user").otherwise(as_text("role"))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(1), F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1))).alias("copy"))
    return rows.drop("copy")
