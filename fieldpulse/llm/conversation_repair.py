"""Cheapest repair of conversations by iterative-deepening A*.

A conversation's roles must read ``(s?(ua)+)?`` by their initials. Edits go from row to row: Delete costs 2, Insert an empty user or assistant
row 5, Keep 0, Rerole to user or assistant 1; blank and duplicate rows must go, and a truncated row that stays adds 5. What stands so far is one of
four states, and in each state only one of user and assistant can follow, so the initials of the edits (D, I, K, R) say all.

The search is depth first in the order of the initials under a growing bound. A table holds for every row and state that failed the
cost it needs at least, which prunes later visits and gives the next bound. The first path to be accepted is the cheapest, and of the
cheapest the least in ASCII.

Conversations of any length are cut: rows are sorted over all tasks and dealt in runs of ``Pieces.block`` neighbours. A conversation within a
run is solved there. One that may go on in the next run is solved for every state at its start and end, in pieces of ``Pieces.rows``, and
the pieces and runs are then joined by cost from the end and by initials from the start. Only 36 numbers per run meet in
one task; texts never do.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldpulse.llm.tables import ship, stored, whole_groups

START, SYSTEM, USER, ASSISTANT = STATES = range(4)
NEVER = 1 << 40
DELETE, INSERT, REROLE, CUT_OFF = 2, 5, 1, 5
BLANK, DUPLICATE, TRUNCATED, SOUND = "b", "d", "t", "-"
#: What an inserted or reroled row is in each state, the state after it, and the states that a kept row leads to.
SPEAKER = {START: "user", SYSTEM: "user", USER: "assistant", ASSISTANT: "user"}
AFTER = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}


@dataclass(frozen=True)
class Pieces:
    """Rows that one search sees, and, as a power of two, neighbouring rows that one task solves together."""
    rows: int = 64
    block_bits: int = 12


Path = tuple[int, str]  # cost and edits
NO_PATH: Path = (NEVER, "")


@lru_cache(1 << 14)
def cheapest(initials: str, faults: str, entry: int, goal: int | None) -> Path:
    """The cheapest edits that lead from ``entry`` over all rows to the state ``goal``; None accepts an end of the conversation, and only then may
    rows be inserted behind the last one."""
    size, last = len(initials), goal is None

    def hopeless(i: int, state: int) -> bool:
        if goal == START:
            return state != START
        if goal == SYSTEM:
            return state != SYSTEM and (state != START or not any(a == "s" and f not in (BLANK, DUPLICATE) for a, f in zip(initials[i:], faults[i:])))
        return False
    least = [0] * (size + 1)
    for i in range(size - 1, -1, -1):
        least[i] = least[i + 1] + (0 if faults[i] == SOUND else DELETE)  # a faulty row costs no less than its deletion
    need = [[NEVER if hopeless(i, state) else least[i] for state in STATES] for i in range(size + 1)]
    for state in STATES:
        if not (state in (START, ASSISTANT) if last else state == goal):
            need[size][state] = max(need[size][state], INSERT if last else NEVER)
    path: list[str] = []

    def moves(i: int, state: int) -> Iterator[tuple[str, int, int, int]]:
        if i < size:
            yield "D", DELETE, i + 1, state
        if i < size or last:
            yield "I", INSERT, i, AFTER[state]
        if i < size and faults[i] not in (BLANK, DUPLICATE):
            extra = CUT_OFF if faults[i] == TRUNCATED else 0
            if (state, initials[i]) in KEPT:
                yield "K", extra, i + 1, KEPT[state, initials[i]]
            yield "R", REROLE + extra, i + 1, AFTER[state]

    def visit(i: int, state: int, budget: int) -> bool:
        if need[i][state] > budget:
            return False
        if i == size and need[i][state] == 0:
            return True
        low = NEVER
        for edit, cost, row, after in moves(i, state):
            path.append(edit)
            if visit(row, after, budget - cost):
                return True
            path.pop()
            low = min(low, cost + need[row][after])
        need[i][state] = min(low, NEVER)
        return False

    while need[0][entry] < NEVER:
        bound = need[0][entry]
        if visit(0, entry, bound):
            return bound, "".join(path)
    return NO_PATH


def chosen(tables: list[list[list[Path]]], ends: list[Path], entry: int) -> tuple[Path, list[int]]:
    """Joins parts, each a table of paths by entry and exit state: the cheapest way from ``entry`` through all to an end, and the state before each
    part and after the last. Of equal costs the least initials win: they are compared at the first part where they differ."""
    costs = [[end[0] for end in ends]]
    for table in reversed(tables):
        costs.append([min(table[a][b][0] + costs[-1][b] for b in STATES) for a in STATES])
    costs.reverse()
    if costs[0][entry] >= NEVER:
        return NO_PATH, []
    states, edits = [entry], []
    for table, after in zip(tables, costs[1:]):
        now = states[-1]
        best = min(table[now][b][0] + after[b] for b in STATES)
        step = min((table[now][b][1], b) for b in STATES if table[now][b][0] + after[b] == best)
        edits.append(step[0])
        states.append(step[1])
    return (costs[0][entry], "".join(edits) + ends[states[-1]][1]), states


def _cut(initials: str, faults: str, rows: int) -> list[tuple[str, str]]:
    return [(initials[i:i + rows], faults[i:i + rows]) for i in range(0, len(initials), rows)]


def _table(initials: str, faults: str) -> list[list[Path]]:
    return [[cheapest(initials, faults, a, b) for b in STATES] for a in STATES]


def solve(initials: str, faults: str, entry: int = START, pieces: Pieces = Pieces()) -> Path:
    """The cheapest edits of a whole conversation, or of its end from a state on."""
    parts = _cut(initials, faults, pieces.rows)
    if len(parts) <= 1:
        return cheapest(initials, faults, entry, None)
    ends = [cheapest(*parts[-1], state, None) for state in STATES]
    return chosen([_table(*part) for part in parts[:-1]], ends, entry)[0]


def solve_between(initials: str, faults: str, pieces: Pieces = Pieces()) -> list[list[Path]]:
    """The cheapest edits of a run of rows within a conversation, by the states before and after it."""
    tables = [_table(*part) for part in _cut(initials, faults, pieces.rows)]
    if len(tables) == 1:
        return tables[0]
    goals = [[(0 if state == goal else NEVER, "") for state in STATES] for goal in STATES]
    return [[chosen(tables, goals[goal], entry)[0] for goal in STATES] for entry in STATES]


BLANKS = r"\x20\x09-\x0D"


def numbered(rows: DataFrame, pieces: Pieces) -> DataFrame:
    """Rows with ``order``, by conversation, turn (nulls first), role and text over all tasks, and the ``block`` of neighbours that holds each."""
    plain = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    by = ("conv_id", "turn", "role", "text")
    placed = plain.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("order", F.monotonically_increasing_id())
    return stored(placed.withColumn("block", F.shiftright("order", pieces.block_bits)), "conversation-rows")


def with_faults(placed: DataFrame) -> DataFrame:
    """order, block, conv_id, turn, the role's initial and the first fault of each row. A join on the row's own number, which no hot key skews, says
    which rows are the first of their role and text."""
    blank = ~F.regexp_like("text", F.lit(f"[^{BLANKS}]"))
    narrow = placed.select("order", "block", "conv_id", "turn", "role", blank.alias("blank"), F.sha2("text", 256).alias("digest"),
                           F.regexp_like("text", F.lit(rf"[.!?][{BLANKS}]*\z")).alias("closed"))
    first = narrow.where("not blank").groupBy("conv_id", "role", "digest").agg(F.min("order").alias("order")).select("order", F.lit(True).alias("first"))
    fault = F.when(F.col("blank"), BLANK).when(F.col("first").isNull(), DUPLICATE).when(~F.col("closed"), TRUNCATED).otherwise(SOUND)
    return narrow.join(first, "order", "left").select("order", "block", "conv_id", "turn", F.substring("role", 1, 1).alias("initial"), fault.alias("fault"))


FOLLOWS = ("su", "ua", "au")
SEGMENT = ("first long, conv_id long, whole boolean, blank long, duplicate long, truncated long, illegal long, turns long, least_turn long, most_turn long, "
           "first_initial string, last_initial string, costs array<long>, audits array<string>")


def _segments(judged: DataFrame, pieces: Pieces) -> DataFrame:
    """One row per conversation and block: what its rows count, and its edits. ``whole`` ones have one path; others, at the edge of their
    block, 16 by entry and exit and 4 by entry to the conversation's end."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None
        for table in whole_groups(batches, "block"):
            rows = list(zip(*(table.column(name).to_pylist() for name in ("block", "conv_id", "order", "turn", "initial", "fault"))))
            out = []
            for _, held in groupby(rows, lambda row: row[0]):
                groups = [list(group) for _, group in groupby(held, lambda row: row[1])]
                for place, group in enumerate(groups):
                    conv_id, initials, faults = group[0][1], [row[4] for row in group], "".join(row[5] for row in group)
                    # An empty role has no initial that may be kept.
                    letters = "".join(initial or " " for initial in initials)
                    turns = [row[3] for row in group if row[3] is not None]
                    whole = 0 < place < len(groups) - 1
                    if whole:
                        paths = [solve(letters, faults, START, pieces)]
                    else:
                        paths = [path for row in solve_between(letters, faults, pieces) for path in row]
                        paths += [solve(letters, faults, state, pieces) for state in STATES]
                    out.append({"first": group[0][2], "conv_id": conv_id, "whole": whole, "blank": faults.count(BLANK), "duplicate": faults.count(DUPLICATE),
                                "truncated": faults.count(TRUNCATED), "illegal": sum(a + b not in FOLLOWS for a, b in zip(initials, initials[1:])),
                                "turns": len(set(turns)), "least_turn": min(turns, default=None), "most_turn": max(turns, default=None),
                                "first_initial": initials[0], "last_initial": initials[-1],
                                "costs": [path[0] for path in paths], "audits": [path[1] for path in paths]})
            schema = schema or pa.schema([(name, {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64()),
                                                  "array<string>": pa.list_(pa.string())}[kind]) for name, kind in (part.split(" ") for part in SEGMENT.split(", "))])
            yield pa.RecordBatch.from_pylist(out, schema)
    return judged.repartition("block").sortWithinPartitions("block", "order").mapInArrow(run, SEGMENT)


LINK = "first long, entry int, path int, illegal_before long, turn_before long"


def _linked(edges: DataFrame) -> DataFrame:
    """For the segments of conversations at block edges: the state before each, which of its paths to take, and what the border to the segment
    before it adds to the counts. Takes 20 costs and 16 ranks per segment."""
    ranks = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda a: F.transform(F.sequence(F.lit(0), F.lit(3)), lambda b: F.array_position(
        F.array_sort(F.slice("audits", a * 4 + 1, F.lit(4))), F.element_at("audits", a * 4 + b + 1))))
    narrow = edges.select("conv_id", "first", "first_initial", "last_initial", "least_turn", "most_turn", "costs", F.flatten(ranks).alias("ranks"))

    def link(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda row: row["first"])
        # Ranks stand for the initials; one digit each, so that they compare like them.
        tables = [[[(row["costs"][a * 4 + b], chr(row["ranks"][a * 4 + b])) for b in STATES] for a in STATES] for row in rows]
        states = chosen(tables[:-1], [(cost, "") for cost in rows[-1]["costs"][16:]], START)[1]
        out = []
        for place, row in enumerate(rows):
            before = rows[place - 1] if place else None
            out.append({"first": row["first"], "entry": states[place],
                        "path": states[place] * 4 + states[place + 1] if place < len(rows) - 1 else 16 + states[place],
                        "illegal_before": int(bool(before) and before["last_initial"] + row["first_initial"] not in FOLLOWS),
                        "turn_before": int(bool(before) and before["most_turn"] is not None and before["most_turn"] == row["least_turn"])})
        return pa.Table.from_pylist(out, pa.schema([("first", pa.int64()), ("entry", pa.int32()), ("path", pa.int32()),
                                                    ("illegal_before", pa.int64()), ("turn_before", pa.int64())]))
    return narrow.groupBy("conv_id").applyInArrow(link, LINK)


def plan_repair(placed: DataFrame, pieces: Pieces) -> DataFrame:
    """Per segment of a conversation its counts, cost and edits, and the state before it."""
    segments = stored(_segments(with_faults(placed), pieces), "segments")
    whole, edges = segments.where("whole"), segments.where("not whole")
    alone = whole.select("*", F.lit(START).alias("entry"), F.lit(0).alias("path"), F.lit(0).cast("long").alias("illegal_before"), F.lit(0).cast("long").alias("turn_before"))
    both = alone.unionByName(edges.join(stored(_linked(edges), "links"), "first"))
    return stored(both.select("first", "conv_id", "entry", "blank", "duplicate", "truncated", (F.col("illegal") + F.col("illegal_before")).alias("illegal"),
                              (F.col("turns") - F.col("turn_before")).alias("turns"), "least_turn", "most_turn",
                              F.element_at("costs", F.col("path") + 1).alias("cost"), F.element_at("audits", F.col("path") + 1).alias("audit")), "repair-plan")


def report(plan: DataFrame) -> DataFrame:
    """Per conversation: gaps, blank, duplicate, truncated, illegal, cost and audit."""
    gaps = F.coalesce(F.max("most_turn") - F.min("least_turn") + 1 - F.sum("turns"), F.lit(0))
    return plan.groupBy("conv_id").agg(
        gaps.alias("gaps"), *(F.sum(name).alias(name) for name in ("blank", "duplicate", "truncated", "illegal", "cost")),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("first", "audit"))), lambda s: s["audit"]), "").alias("audit"))


ROW = "conv_id long, part long, place long, role string, text string, edit string"


def repaired_rows(placed: DataFrame, plan: DataFrame, pieces: Pieces) -> DataFrame:
    """The rows after repair: conv_id, part and place (their order), role, text, edit. Every segment's edits are sorted before its rows and
    followed row by row, so a task holds one batch and one list of edits."""
    edits = plan.select(F.shiftright("first", pieces.block_bits).alias("block"), F.col("first").alias("order"), "conv_id", "audit", "entry")
    both = placed.select("block", "order", "conv_id", "role", "text").unionByName(edits, allowMissingColumns=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv_id, part, audit, at, state, place = None, 0, "", 0, START, 0
        out: list[tuple] = []

        def add(role: str, text: str, edit: str) -> None:
            nonlocal place
            out.append((conv_id, part, place, role, text, edit))
            place += 1

        def insert() -> None:
            nonlocal at, state
            while at < len(audit) and audit[at] == "I":
                add(SPEAKER[state], "", "I")
                at, state = at + 1, AFTER[state]

        def packed() -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string())
            columns = list(zip(*out)) or [()] * 6
            out.clear()
            return pa.record_batch([pa.array(column, kind) for column, kind in zip(columns, kinds)], ["conv_id", "part", "place", "role", "text", "edit"])
        for batch in batches:
            for order, conv, role, text, edits_, entry in zip(*(batch.column(name).to_pylist() for name in ("order", "conv_id", "role", "text", "audit", "entry"))):
                if edits_ is not None:
                    insert()
                    conv_id, part, audit, at, state, place = conv, order, edits_, 0, entry, 0
                    continue
                insert()
                edit, at = audit[at], at + 1
                if edit == "K":
                    add(role, text, "K")
                    state = KEPT[state, role[:1]]
                elif edit == "R":
                    add(SPEAKER[state], text, "R")
                    state = AFTER[state]
            yield packed()
        insert()
        yield packed()
    return both.repartition("block").sortWithinPartitions("block", "order", F.col("audit").isNull()).mapInArrow(run, ROW)


def repair(rows: DataFrame, pieces: Pieces = Pieces()) -> tuple[DataFrame, DataFrame]:
    """The report and the repaired rows of ``rows(conv_id, turn, role, text)``.

    A null role or text counts as one space. Rows are taken by turn, nulls first, then role, then text; rows with a null conv_id are one
    conversation. An empty role has no initial: it can't be kept, and its neighbours count as illegal. A row's fault is the first of blank (nothing but
    space), duplicate (role and text seen earlier) and truncated (no ``.``, ``!`` or ``?`` at the end). Rows that repeat are duplicates. A conversation
    whose rows are all deleted has no repaired rows; an empty table gives two empty ones. Other columns are not used.
    """
    ship(rows.sparkSession)
    placed = numbered(rows, pieces)
    plan = plan_repair(placed, pieces)
    return report(plan), repaired_rows(placed, plan, pieces)


def damage(rows: DataFrame) -> DataFrame:
    """``rows`` damaged by the remainder of crc32(``conv_id:turn``) by 20: 0 drops a row, 1 empties its text, 2 removes ``.``, ``!`` and ``?``, 3
    repeats it, 4 makes it the user's. A null of any column counts as one space."""
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    name = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    marked = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.pmod(F.crc32(name.cast("binary")), F.lit(20)).alias("_harm"))
    harm = F.col("_harm")
    changed = marked.select(
        "conv_id", "turn", F.when(harm == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(harm == 1, "").when(harm == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(1), F.when(harm == 0, 0).when(harm == 3, 2).otherwise(1))).alias("_copy"))
    return changed.drop("_copy")


def line_digests(repaired: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of the ``role:text`` lines of each conversation, joined by newlines. Lines are hashed as they come, one batch at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, now, done = None, None, []
        for batch in batches:
            for conv_id, line in zip(batch.column("conv_id").to_pylist(), batch.column("line").to_pylist()):
                if state is None or conv_id != now:
                    if state is not None:
                        done.append((now, state.hexdigest()))
                    state, now = hashlib.sha256(line.encode()), conv_id
                else:
                    state.update(b"\n" + line.encode())
            yield pa.record_batch([pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.string())], ["conv_id", "repaired_sha256"])
            done = []
        if state is not None:
            yield pa.record_batch([pa.array([now], pa.int64()), pa.array([state.hexdigest()])], ["conv_id", "repaired_sha256"])
    lines = repaired.select("conv_id", "part", "place", F.concat("role", F.lit(":"), "text").alias("line"))
    return lines.repartition("conv_id").sortWithinPartitions("conv_id", "part", "place").mapInArrow(run, "conv_id long, repaired_sha256 string")
