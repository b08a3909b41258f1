"""Repair of the turn structure of conversations by alignment with target strings.

A repaired conversation's role initials are ``(s?(ua)+)?``. Its rows are kept (cost 0),
reroled to user or assistant (1), deleted (2; blank and repeated rows must be), and empty
rows of user or assistant are inserted (5); a truncated row that stays costs 5 more. ``align``
takes every feasible length of the target string in turn, the likeliest first, and fills
the Wagner-Fischer table of rows against targets only within the band that the cheapest
cost found so far leaves open (Ukkonen); lengths whose difference alone costs more are
skipped. The tables are traced back to audits, and of the cheapest the first in ASCII order
wins.

A conversation may be of any length, so it is aligned in blocks of bounded size, from every
state of the grammar to every other: what a prefix may end with (nothing, s, u or a) is all
that the next block depends on. No cheapest audit of a block begins another one between the
same states, so the cheapest of the whole, and the first among equals, is put together from
those of its blocks. Blocks are built in parallel over ranges of the sorted rows; then a
task goes through the blocks of a conversation, holding for every state its cost, audit and
running digest, and no texts but those of one block. Equal rows of a turn are counted before
any of this, and what was said in an earlier turn is found by an aggregate and a join.

Rows are ordered by turn, nulls first, then by role and text; a null conv_id is a
conversation of its own. Null roles and texts are one space: such a text is blank, such a
role is none of the three. Rows that are repeated whole are duplicates of each other. A
conversation without rows has zeros and empty results. An empty table gives an empty
result; other columns are ignored. A text longer than a block's bound is a block of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from townpulse.llm.common import WHITE, map_batches

#: Rows and characters of a block.
BLOCK_ROWS = 32
BLOCK_CHARS = 1 << 16

REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: What the repaired rows so far end with: nothing, or a role's initial.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
STATES = "-sua"
NAMES = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")
FAR = 1 << 40




def targets(entry: int, length: int) -> list[str]:
    """The strings of that length that the grammar lets follow ``entry``."""
    begins = {NOTHING: "us", SYSTEM: "u", USER: "a", ASSISTANT: "u"}[entry]
    return [(first + ("au" if first == "u" else "ua") * length)[:length] for first in begins]


def _trace(rows: str, target: str, most: int) -> tuple[int, str] | None:
    """Cost and audit of the cheapest alignment, of equals the first in ASCII order; None if it costs more than ``most``."""
    n, m = len(rows), len(target)

    def apart(i: int, j: int) -> int:  # what i rows against j targets cost at least
        return DELETE * (i - j) if i > j else INSERT * (j - i)

    rest: list[dict[int, int]] = [{} for _ in range(n + 1)]  # cost from row i and target j on
    for i in range(n, -1, -1):
        row = rows[i] if i < n else "x"
        plain, here, after = row.lower(), rest[i], rest[i + 1] if i < n else {}
        stays = TRUNCATED if row != plain else 0
        for j in range(m, -1, -1):
            if apart(i, j) + apart(n - i, m - j) > most:
                continue
            best = 0 if i == n and j == m else DELETE + after.get(j, FAR)
            if j < m:
                want = target[j]
                if want != "s":
                    best = min(best, INSERT + here.get(j + 1, FAR))
                if plain == want:
                    best = min(best, stays + after.get(j + 1, FAR))
                elif row != "x" and want != "s":
                    best = min(best, REROLE + stays + after.get(j + 1, FAR))
            if best < FAR:
                here[j] = best
    cost = rest[0].get(0, FAR)
    if cost > most:
        return None
    audit, i, j = [], 0, 0
    while i < n or j < m:  # of D, I, K and R the first that leads on at this cost
        left = rest[i][j]
        if i < n and left == DELETE + rest[i + 1].get(j, FAR):
            audit.append("D")
            i += 1
        elif j < m and target[j] != "s" and left == INSERT + rest[i].get(j + 1, FAR):
            audit.append("I")
            j += 1
        else:
            audit.append("K" if rows[i].lower() == target[j] else "R")
            i, j = i + 1, j + 1
    return cost, "".join(audit)


@lru_cache(20_000)
def align(rows: str, entry: int) -> tuple[tuple[int, str] | None, ...]:
    """The cheapest (cost, audit) from ``entry`` to each state, None where there is none.

    ``rows`` has a letter per row: the initial s, u or a, or o for any other, upper case if
    the row is truncated; x for one that must go. Every state that can be reached at all can
    be for deleting the rows and inserting two, which bounds the first lengths.
    """
    n = len(rows)
    bound = DELETE * n + 2 * INSERT
    found: list[tuple[int, str] | None] = [None] * len(STATES)
    found[entry] = DELETE * n, "D" * n
    for m in sorted(range(1, n + bound // INSERT + 1), key=lambda m: (abs(m - n), m)):
        least = INSERT * (m - n) if m > n else DELETE * (n - m)
        for target in targets(entry, m):
            end = STATES.index(target[-1])
            known = found[end]
            if least <= (most := known[0] if known else bound) and (got := _trace(rows, target, most)) and (known is None or got < known):
                found[end] = got
    return tuple(found)


def apply(rows: str, roles: list[str], texts: list[str], ops: str, entry: int) -> Iterator[tuple[str, str, str]]:
    """(op, role, text) of the rows that ``ops`` leave; ``roles`` and ``texts`` are those of rows other than x."""
    last, at, own = STATES[entry], 0, 0
    for op in ops:
        after = "a" if last == "u" else "u"
        if op == "I":
            yield op, NAMES[after], ""
            last = after
            continue
        if op != "D":
            last = rows[at].lower() if op == "K" else after
            yield op, roles[own] if op == "K" else NAMES[after], texts[own]
        own += rows[at] != "x"
        at += 1


@dataclass
class Block:
    """Neighbouring rows of a conversation; ``gone`` others stand before them and must go."""

    conv_id: int | None
    gone: int = 0
    rows: str = ""
    roles: list[str] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)
    chars: int = 0
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    first: str | None = None
    last: str | None = None
    first_turn: int | None = None
    last_turn: int | None = None
    n_turns: int = 0

    def full(self, n: int) -> bool:
        """Whether ``n`` more equal rows belong into another block."""
        return len(self.rows) + n > BLOCK_ROWS and self.rows != "" or self.chars > BLOCK_CHARS

    def add(self, turn: int | None, role: str, text: str, fault: str, n: int) -> None:
        """Add ``n`` equal rows of the same fault; only rows that must go come in numbers."""
        initial = role[:1]
        self.illegal += n - 1 + (self.last is not None and self.last + initial not in LEGAL)
        self.first, self.last = initial if self.first is None else self.first, initial
        if turn is not None and turn != self.last_turn:
            self.first_turn, self.last_turn, self.n_turns = turn if self.first_turn is None else self.first_turn, turn, self.n_turns + 1
        if fault in ("blank", "duplicate"):
            self.blank += n * (fault == "blank")
            self.duplicate += n * (fault == "duplicate")
            if self.rows:
                self.rows += "x" * n
            else:
                self.gone += n
            return
        letter = initial if initial in NAMES or initial == "s" else "o"
        self.truncated += fault == "truncated"
        self.rows += letter.upper() if fault == "truncated" else letter
        self.roles.append(role)
        self.texts.append(text)
        self.chars += len(text)


#: ``costs`` and ``audits``: of the cheapest way from each state (rows) to each (columns), null where there is none.
BLOCKS = """conv_id long, part int, seq long, gone long, rows string, roles array<string>, texts array<string>,
    blank long, duplicate long, truncated long, illegal long, first string, last string, first_turn long, last_turn long, n_turns long,
    costs array<long>, audits array<string>"""
_BLOCKS = pa.schema(
    [("conv_id", pa.int64()), ("part", pa.int32()), ("seq", pa.int64()), ("gone", pa.int64()), ("rows", pa.string()), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))]
    + [(c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal")] + [("first", pa.string()), ("last", pa.string())]
    + [(c, pa.int64()) for c in ("first_turn", "last_turn", "n_turns")] + [("costs", pa.list_(pa.int64())), ("audits", pa.list_(pa.string()))]
)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows to aligned blocks."""
    part, seq, out, size, block = TaskContext.get().partitionId(), 0, [], 0, None

    def closed(block: Block) -> dict:
        ways = [way for entry in range(len(STATES)) for way in align(block.rows, entry)]
        return {**vars(block), "part": part, "seq": seq, "costs": [w and w[0] for w in ways], "audits": [w and w[1] for w in ways]}

    for batch in batches:
        for row in batch.to_pylist():
            runs = [(row["fault"], min(row["times"], 1)), ("blank" if row["fault"] == "blank" else "duplicate", row["times"] - 1)]
            for fault, n in runs:
                if block is None or block.conv_id != row["conv_id"] or n > 0 and block.full(n):
                    if block is not None:
                        out.append(closed(block))
                        seq, size = seq + 1, size + block.chars
                    block = Block(row["conv_id"])
                    if len(out) >= 500 or size > 1 << 22:
                        yield pa.RecordBatch.from_pylist(out, schema=_BLOCKS)
                        out, size = [], 0
                if n > 0:
                    block.add(row["turn"], row["role"], row["text"], fault, n)
    if block is not None:
        out.append(closed(block))
        yield pa.RecordBatch.from_pylist(out, schema=_BLOCKS)


def blocks(turns: DataFrame) -> DataFrame:
    """``BLOCKS`` of conversations (conv_id, turn, role, text).

    With a column ``copies`` a row stands for so many equal ones; for none, it only says
    that there is such a conversation.
    """
    spoken = lambda c: F.when(F.col("copies") > 0, F.coalesce(F.col(c).cast("string"), F.lit(" "))).alias(c)
    copies = F.col("copies") if "copies" in turns.columns else F.lit(1)
    rows = turns.select("conv_id", "turn", "role", "text", copies.cast("long").alias("copies"))
    rows = rows.select("conv_id", F.when(F.col("copies") > 0, F.col("turn")).alias("turn"), spoken("role"), spoken("text"), "copies")
    same = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("times"))
    same = same.withColumns({"digest": F.sha2("text", 256), "at": F.struct(F.col("turn").isNotNull().alias("known"), "turn")})
    firsts = same.where("times > 0").groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d")).agg(F.min("at").alias("said"), F.count("*").alias("n"))
    firsts = firsts.where("n > 1").drop("n")
    shown = F.rtrim(F.col("text"), F.lit(WHITE))
    fault = F.when(shown == "", "blank").when(F.col("said").isNotNull() & ~F.col("said").eqNullSafe(F.col("at")), "duplicate")
    fault = fault.when(~F.substring(shown, -1, 1).isin(".", "!", "?"), "truncated").otherwise("none")
    known = same.join(firsts, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d")), "left")
    dealt = known.select("conv_id", "turn", "role", "text", "times", fault.alias("fault"))
    dealt = dealt.repartitionByRange("conv_id", "turn", "role", F.left("text", F.lit(64))).sortWithinPartitions("conv_id", "turn", "role", "text")
    return map_batches(dealt, _cut, BLOCKS)


@dataclass
class _Way:
    """The best way to a state so far; ``path`` holds the ops of each block, the last first."""

    cost: int
    audit: str
    digest: object
    written: int = 0
    path: tuple | None = None


class Conversation:
    """Goes through the blocks of a conversation in order."""

    def __init__(self, conv_id: int | None) -> None:
        self.conv_id = conv_id
        self.ways: list[_Way | None] = [_Way(0, "", hashlib.sha256()), None, None, None]
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.last, self.first_turn, self.last_turn, self.n_turns = None, None, None, 0

    def _step(self, tables: list, gone: int, block: dict, at: tuple[int, int]) -> list[_Way | None]:
        after: list[_Way | None] = [None] * len(STATES)
        for end in range(len(STATES)):
            ways = [
                (way.cost + DELETE * gone + t[end][0], way.audit + "D" * gone + t[end][1], entry)
                for entry, (way, t) in enumerate(zip(self.ways, tables)) if way and t[end]
            ]
            if not ways:
                continue
            cost, audit, entry = min(ways)
            before, ops = self.ways[entry], tables[entry][end][1]
            digest, written = before.digest.copy(), before.written
            for _, role, text in apply(block["rows"], block["roles"], block["texts"], ops, entry):
                digest.update(("\n" * (written > 0) + f"{role}:{text}").encode())
                written += 1
            after[end] = _Way(cost, audit, digest, written, (before.path, (*at, entry, ops, before.written)))
        return after

    def add(self, block: dict) -> None:
        for c in self.counts:
            self.counts[c] += block[c]
        if block["first"] is not None:
            self.counts["illegal"] += self.last is not None and self.last + block["first"] not in LEGAL
            self.last = block["last"]
        if block["n_turns"]:
            self.n_turns += block["n_turns"] - (block["first_turn"] == self.last_turn)
            self.first_turn, self.last_turn = block["first_turn"] if self.first_turn is None else self.first_turn, block["last_turn"]
        k = len(STATES)
        ways = [None if cost is None else (cost, audit) for cost, audit in zip(block["costs"], block["audits"])]
        self.ways = self._step([ways[i:i + k] for i in range(0, k * k, k)], block["gone"], block, (block["part"], block["seq"]))

    def result(self) -> dict:
        """The row of the conversation once all its blocks are in."""
        none = {"rows": "", "roles": [], "texts": []}
        ends = self._step([align("", entry) for entry in range(len(STATES))], 0, none, (-1, 0))
        best = min((w for w in (ends[NOTHING], ends[ASSISTANT]) if w), key=lambda w: (w.cost, w.audit))
        path, step = [], best.path
        while step:
            step, piece = step
            path.append(dict(zip(("part", "seq", "entry", "ops", "written"), piece)))
        gaps = self.last_turn - self.first_turn + 1 - self.n_turns if self.n_turns else 0
        return {"conv_id": self.conv_id, "gaps": gaps, **self.counts, "cost": best.cost, "audit": best.audit, "repaired_sha256": best.digest.hexdigest(), "path": path[::-1]}


REPAIRED = """conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string,
    path array<struct<part: int, seq: long, entry: int, ops: string, written: long>>"""
_PIECE = pa.struct([("part", pa.int32()), ("seq", pa.int64()), ("entry", pa.int32()), ("ops", pa.string()), ("written", pa.int64())])
_REPAIRED = pa.schema([(c, pa.int64()) for c in ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")] + [("audit", pa.string()), ("repaired_sha256", pa.string()), ("path", pa.list_(_PIECE))])


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks in the order of conversations to a row per conversation."""
    out, now = [], None
    for batch in batches:
        for block in batch.to_pylist():
            if now is None or now.conv_id != block["conv_id"]:
                if now is not None:
                    out.append(now.result())
                now = Conversation(block["conv_id"])
            now.add(block)
        if len(out) >= 500:
            yield pa.RecordBatch.from_pylist(out, schema=_REPAIRED)
            out = []
    if now is not None:
        out.append(now.result())
        yield pa.RecordBatch.from_pylist(out, schema=_REPAIRED)


def judge(blocked: DataFrame) -> DataFrame:
    """``REPAIRED``: faults, cost, audit and digest per conversation, and the way through its ``blocks``."""
    return map_batches(blocked.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq"), _fold, REPAIRED)


def repair(turns: DataFrame) -> DataFrame:
    """Faults, cost, audit and digest of the repaired rows, per conversation."""
    return judge(blocks(turns)).drop("path")


def _apply_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("conv_id", pa.int64()), ("position", pa.int64()), ("op", pa.string()), ("role", pa.string()), ("text", pa.string())])
    for batch in batches:
        for b in batch.to_pylist():
            left = apply(b["rows"] or "", b["roles"] or [], b["texts"] or [], b["ops"], b["entry"])
            yield pa.RecordBatch.from_pylist([{"conv_id": b["conv_id"], "position": b["written"] + i, "op": op, "role": role, "text": text} for i, (op, role, text) in enumerate(left)], schema=schema)


def repaired_turns(turns: DataFrame) -> DataFrame:
    """The rows of the repaired conversations: conv_id, position, op (K, R or I), role, text."""
    blocked = blocks(turns)
    ways = judge(blocked).select("conv_id", F.explode("path").alias("p")).select("conv_id", "p.*")
    own = blocked.select("part", "seq", "rows", "roles", "texts")
    return map_batches(ways.join(own, ["part", "seq"], "left"), _apply_all, "conv_id long, position long, op string, role string, text string")


def damage(turns: DataFrame) -> DataFrame:
    """Conversations with faults to try a repair on, drawn by a checksum of ``conv_id:turn``, with ``copies``.

    Of twenty: 0 drops the row, 1 empties its text, 2 takes its sentence ends away, 3 repeats
    it and 4 makes it the user's. Nulls are one space.
    """
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn"))) % 20
    text = F.when(fate == 1, "").when(fate == 2, F.translate(said("text"), ".!?", "")).otherwise(said("text"))
    copies = F.when(fate == 0, 0).when(fate == 3, 2).otherwise(1)
    return turns.select("conv_id", "turn", F.when(fate == 4, "user").otherwise(said("role")).alias("role"), text.alias("text"), copies.alias("copies"))
