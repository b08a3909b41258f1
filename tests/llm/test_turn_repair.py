"""Turn repair against a search over all edits and against a plain walk of the grammar."""

import hashlib
import random
import zlib
from itertools import product

import pytest

from townpulse.llm import turn_repair as r

SCHEMA = "conv_id long, turn long, role string, text string, op string, cost string"
NEXT = {"-": "us", "s": "u", "u": "a", "a": "u"}
BLANK = " \t\n\x0b\x0c\r"


def walk(rows):
    """The least (cost, audit) of whole conversations, given as letters like those of ``align``."""
    best = {"-": (0, "")}

    def with_inserts(ways):
        for _ in range(2):
            for state, (cost, audit) in list(ways.items()):
                end = "a" if state == "u" else "u"
                ways[end] = min(ways.get(end, (1 << 30, "")), (cost + 5, audit + "I"))
        return ways

    for row in rows:
        after = {}
        for state, (cost, audit) in with_inserts(best).items():
            ends = [(state, 2, "D")]
            if row != "x":
                more = 5 * (row != row.lower())
                ends += [(row.lower(), more, "K")] if row.lower() in NEXT[state] else []
                ends += [("a" if state == "u" else "u", 1 + more, "R")]
            for end, price, op in ends:
                after[end] = min(after.get(end, (1 << 30, "")), (cost + price, audit + op))
        best = after
    return min(w for state, w in with_inserts(best).items() if state in "-a")


def search(rows):
    """The same by trying all edits; up to two inserts in one place are enough."""
    found = []
    for ops in product("DKR", repeat=len(rows)):
        for inserts in product(range(3), repeat=len(rows) + 1):
            state, cost, audit, legal = "-", 0, "", True
            for op, row, n in zip([*ops, ""], [*rows, ""], inserts):
                for _ in range(n):
                    state, cost, audit = "a" if state == "u" else "u", cost + 5, audit + "I"
                if op == "D":
                    cost, audit = cost + 2, audit + "D"
                elif op:
                    end = row.lower() if op == "K" else "a" if state == "u" else "u"
                    legal &= row != "x" and end in NEXT[state]
                    state, cost, audit = end, cost + (op == "R") + 5 * (row != row.lower()), audit + op
                    if not legal:
                        break
            if legal and state in "-a":
                found.append((cost, audit))
    return min(found)


def whole(rows):
    """What the aligned blocks of a conversation come to."""
    return min(w for w in (r.align(rows, r.NOTHING)[r.NOTHING], r.align(rows, r.NOTHING)[r.ASSISTANT]) if w)


def test_short_conversations_have_the_least_of_all_edits():
    for n in range(4):
        for rows in product("suaoSUx", repeat=n):
            assert whole("".join(rows)) == search("".join(rows)) == walk("".join(rows)), rows


def test_long_conversations():
    draw = random.Random(2)
    for _ in range(150):
        rows = "".join(draw.choice(("ua" * 4 + "sUAoOxxx") if draw.random() < 0.5 else "ua") for _ in range(draw.randint(5, 60)))
        assert whole(rows) == walk(rows)


@pytest.mark.parametrize("size", [1, 3, 32])
def test_blocks_of_any_size_come_to_the_same(monkeypatch, size):
    monkeypatch.setattr(r, "BLOCK_ROWS", size)
    draw = random.Random(size)
    for _ in range(60):
        letters = [draw.choice("uauauauasSUAox") for _ in range(draw.randint(0, 40))]
        talk = r.Conversation(1)
        for i in range(0, len(letters), size):
            block = r.Block(1)
            for x in letters[i:i + size]:
                fault = "duplicate" if x == "x" else "truncated" if x.isupper() else "none"
                block.add(i, x.lower(), "t", fault, 1)
            ways = [w for entry in range(4) for w in r.align(block.rows, entry)]
            talk.add({**vars(block), "part": 0, "seq": i, "costs": [w and w[0] for w in ways], "audits": [w and w[1] for w in ways]})
        got = talk.result()
        assert (got["cost"], got["audit"]) == walk("".join(letters))


def plain(rows):
    """The contract's row of each conversation, one row after the other."""
    out = {}
    space = lambda x: " " if x is None else x
    for conv_id in {c for c, *_ in rows}:
        kept = []
        for _, turn, role, text in [x[:4] for x in rows if x[0] == conv_id]:
            role, text, fate = space(role), space(text), zlib.crc32(f"{space(conv_id)}:{space(turn)}".encode()) % 20
            text = "" if fate == 1 else "".join(c for c in text if c not in ".!?") if fate == 2 else text
            role = "user" if fate == 4 else role
            kept += [(turn, role, text)] * {0: 0, 3: 2}.get(fate, 1)
        kept.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
        seen, letters, counts = set(), "", dict(blank=0, duplicate=0, truncated=0)
        for _, role, text in kept:
            shown = text.rstrip(BLANK)
            fault = "blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            letter = role[:1] if role[:1] in ("s", "u", "a") else "o"
            letters += "x" if fault in ("blank", "duplicate") else letter.upper() if fault else letter
        cost, audit = walk(letters)
        left, state, at = [], "-", 0
        for op in audit:
            end = "a" if state == "u" else "u"
            if op in "IR":
                left.append((op, {"u": "user", "a": "assistant"}[end], "" if op == "I" else kept[at][2]))
                state = end
            elif op == "K":
                left.append((op, *kept[at][1:]))
                state = kept[at][1][:1]
            at += op != "I"
        turns = [t for t, *_ in kept if t is not None]
        out[conv_id] = (
            conv_id, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *counts.values(),
            sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(kept, kept[1:])),
            cost, audit, hashlib.sha256("\n".join(f"{role}:{text}" for _, role, text in left).encode()).hexdigest(),
        ), left
    return out


def rows_of(draw, n):
    rows = []
    for conv_id in [None, *range(n)]:
        turn = draw.choice([0, -5, 3])
        for _ in range(draw.randint(1, 14)):
            turn = None if draw.random() < 0.05 else (turn or 0) + draw.choice([0, 1, 1, 1, 1, 4])
            role = draw.choice(["user", "assistant", "user", "assistant", "system", "tool", "User", "", None])
            text = draw.choice(["Yes.", "No!", "and so", "Why? ", "", " \n", None, "x" * 9, "ends.\t\n", "é…", f"say {turn}."])
            rows += [(conv_id, turn, role, text, "clash", None)] * draw.choice([1, 1, 1, 2])
    return rows


def test_all_columns(spark):
    rows = rows_of(random.Random(5), 150)
    rows += [(1000, i // 2, "user" if i % 3 else "assistant", f"{i % 50}.", None, None) for i in range(700)]  # one long conversation
    rows += [(1001, None, "user", "same", None, None)] * 300 + [(1002, 7, None, None, None, None)]
    rows += [(1003, 1, "user", "long " * 200_000, None, None), (1003, 2, "assistant", "word. " * 200_000, None, None)]
    want = plain(rows)
    turns = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = r.repair(r.damage(turns)).collect()
    assert len(got) == len(want)
    assert {g.conv_id: tuple(g) for g in got} == {c: w for c, (w, _) in want.items()}
    left = {}
    for row in sorted(r.repaired_turns(r.damage(turns)).collect(), key=lambda x: x.position):
        left.setdefault(row.conv_id, []).append((row.op, row.role, row.text))
    assert left == {c: rows for c, (_, rows) in want.items() if rows}


def test_partitioning_does_not_matter(spark, partitions):
    turns = spark.createDataFrame(rows_of(random.Random(6), 40), SCHEMA)
    one, *others = partitions(lambda: r.repair(r.damage(turns)).where("conv_id is not null"))
    assert all(o == one for o in others)


def test_rows_without_damage(spark):
    rows = [(1, 1, "user", "Hi.", "", ""), (1, 2, "user", "There?", "", ""), (2, 1, "system", "Be kind.", "", "")]
    got = {x.conv_id: (x.cost, x.audit) for x in r.repair(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {1: (1, "KR"), 2: (2, "D")}


def test_empty_table(spark):
    turns = spark.createDataFrame([], SCHEMA)
    assert r.repair(r.damage(turns)).collect() == []
    assert r.repaired_turns(turns).collect() == []
