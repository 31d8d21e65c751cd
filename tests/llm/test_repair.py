"""Conversation repair against all edit sequences of small conversations, and long conversations in pieces against one search."""

import hashlib
import random
import zlib

import pytest

from fieldpulse.llm import conversation_repair as repair

SCHEMA = "conv_id long, turn long, role string, text string, first string, audit string"
EDITS = {"D": 2, "I": 5, "K": 0, "R": 1}


def plain(initials, faults, state=repair.START):
    """The least (cost, edits) by trying all edits, at most two inserted rows between any others."""
    best = {(0, state, 0): (0, "")}
    done = []
    while best:
        (i, now, held), (cost, edits) = min(best.items(), key=lambda entry: (entry[0][0], entry[0][2]))
        del best[i, now, held]
        if i == len(initials) and now in (repair.START, repair.ASSISTANT):
            done.append((cost, edits))

        def reach(place, after, inserted, price, edit):
            there = best.get((place, after, inserted))
            best[place, after, inserted] = min(filter(None, (there, (cost + price, edits + edit))))
        if held < 2:
            reach(i, repair.AFTER[now], held + 1, 5, "I")
        if i == len(initials):
            continue
        reach(i + 1, now, 0, 2, "D")
        if faults[i] in "t-":
            more = 5 if faults[i] == "t" else 0
            reach(i + 1, repair.AFTER[now], 0, 1 + more, "R")
            if (now, initials[i]) in repair.KEPT:
                reach(i + 1, repair.KEPT[now, initials[i]], 0, more, "K")
    return min(done)


def test_search_finds_the_least_of_the_cheapest():
    draw = random.Random(3)
    for _ in range(400):
        size = draw.randrange(0, 9)
        initials, faults = ("".join(draw.choice(letters) for _ in range(size)) for letters in ("suax", "---btd"))
        assert repair.solve(initials, faults) == plain(initials, faults), (initials, faults)


def test_pieces_join_to_the_same_edits():
    draw = random.Random(4)
    for _ in range(60):
        size = draw.randrange(1, 40)
        initials, faults = ("".join(draw.choice(letters) for _ in range(size)) for letters in ("suuaa ", "----btd"))
        for rows in (1, 3, 7):
            assert repair.solve(initials, faults, pieces=repair.Pieces(rows=rows)) == plain(initials, faults)


def test_unreachable_goals_end():
    assert repair.cheapest("ua", "--", repair.USER, repair.START) == repair.NO_PATH
    assert repair.cheapest("bs", "bd", repair.START, repair.SYSTEM) == repair.NO_PATH
    assert repair.cheapest("s", "-", repair.START, repair.SYSTEM) == (0, "K")


def expected(rows):
    """Report and hash per conversation, by the plain search."""
    out = {}
    for conv_id in {row[0] for row in rows}:
        held = sorted(((t is not None, t or 0, r if r is not None else " ", x if x is not None else " ") for c, t, r, x in rows if c == conv_id))
        seen, faults = set(), ""
        for _, _, role, text in held:
            body = text.strip(" \t\n\v\f\r")
            faults += "b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else "-"
            seen.add((role, text))
        roles = [row[2] for row in held]
        cost, edits = plain([role[:1] or " " for role in roles], faults)
        lines, at, state = [], 0, repair.START
        for edit in edits:
            if edit == "I":
                lines.append(f"{repair.SPEAKER[state]}:")
            elif edit == "R":
                lines.append(f"{repair.SPEAKER[state]}:{held[at][3]}")
            elif edit == "K":
                lines.append(f"{roles[at]}:{held[at][3]}")
            state = state if edit == "D" else repair.KEPT[state, roles[at][0]] if edit == "K" else repair.AFTER[state]
            at += edit != "I"
        turns = [row[1] for row in held if row[0]]
        out[conv_id] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("b"), faults.count("d"), faults.count("t"),
                        sum(a[:1] + b[:1] not in ("su", "ua", "au") for a, b in zip(roles, roles[1:])), cost, edits,
                        hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


@pytest.mark.parametrize("block_bits", [12, 2, 0])
def test_repair_matches_plain_search(spark, block_bits):
    """Nulls in every column, empty roles, repeated rows, tied turns, a null conversation, and runs of a few rows only."""
    draw = random.Random(block_bits)
    rows = [(None, 1, "user", "Null conversation."), (None, None, "assistant", "Yes."), (5, None, None, None), (6, 1, "", "No role."), (6, 1, "user", "Tied."), (6, 2, "user", "Tied.")]
    for conv_id in range(10, 30):
        for turn in range(draw.randrange(1, 25)):
            rows.append((conv_id, draw.choice([turn, turn, turn + 1, None]), draw.choice(["user", "assistant", "system", "user", "assistant", "tool"]),
                         draw.choice(["Said.", "open", " \n", None, f"Turn {turn}!", f"x{turn}? "])))
    frame = spark.createDataFrame([(*row, "clash", "clash") for row in rows], SCHEMA)
    report, repaired = repair.repair(frame, repair.Pieces(rows=4, block_bits=block_bits))
    hashes = {row.conv_id: row.repaired_sha256 for row in repair.line_digests(repaired).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    got = {row.conv_id: (row.gaps, row.blank, row.duplicate, row.truncated, row.illegal, row.cost, row.audit, hashes.get(row.conv_id, empty)) for row in report.collect()}
    assert got == expected(rows)


def test_long_conversation_in_many_runs(spark):
    rows = [(1, turn, "user" if turn % 3 else "assistant", f"t{turn}." if turn % 7 else "cut") for turn in range(1500)]
    report, repaired = repair.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), repair.Pieces(rows=16, block_bits=6))
    row = report.first()
    assert (row.conv_id, row.cost, row.audit) == (1, *plain([r[2][0] for r in rows], "".join("-" if r[1] % 7 else "t" if r[1] in (0, 7) else "d" if (r[2], "cut") in {(x[2], x[3]) for x in rows[:r[1]]} else "t" for r in rows)))
    roles = [r.role[0] for r in repaired.orderBy("part", "place").collect()]
    assert "".join(roles) == "ua" * (len(roles) // 2)


def test_empty_table(spark):
    report, repaired = repair.repair(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))
    assert report.count() == repaired.count() == 0


def test_damage(spark):

    rows = [(conv, turn, "assistant", "A. b!") for conv in range(40) for turn in range(4)] + [(None, 3, None, None), (3, None, None, "x.")]
    got = sorted(map(tuple, repair.damage(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()), key=str)
    want = []
    for conv, turn, role, text in rows:
        role, text = role or " ", text or " "
        harm = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        row = (conv, turn, "user" if harm == 4 else role, {1: "", 2: text.translate({ord(c): None for c in ".!?"})}.get(harm, text))
        want += [row] * {0: 0, 3: 2}.get(harm, 1)
    assert got == sorted(want, key=str)
    assert {"", "A b"} <= {row[3] for row in got}
