"""Conversations brought into order by the lightest derivation.

A good conversation has the roles ``(s?(ua)+)?``: perhaps a system turn, then user and
assistant in turn. Turns may be kept, given another role, deleted or inserted, each at a
cost. A repair item says that the first turns of a conversation can be edited so that the
grammar is in some state; a deduction adds an edit to it. Costs and edits together, as the
pair (cost, audit), never fall along a deduction, so the agenda of Knuth's generalisation of
the shortest path finalises items in rising order, the goal with the cheapest edits and of
those the least by their letters.

Turns are sorted by range over (conversation, turn, role, text), so a task holds whole
conversations but for the first and the last, and solves them as they pass. Those two, and
any longer than ``LONGEST`` turns or characters, stay open. Open conversations are cut into
blocks of turns: the agenda gives each block its lightest derivation from any state to any
other. The blocks of a conversation are then deduced from left to right, four states at a
time, and its repaired text is digested in order, a turn at a time. That needs one task for
a conversation, with memory for its audit alone, as the result holds both in one value.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from ..sources.staging import stage
from .common import rows_of

#: The letters and costs of the edits, and the cost of keeping a cut turn.
KEEP, REROLE, DELETE, INSERT, CUT = 0, 1, 2, 5, 5
SPACE = " \t\n\x0b\x0c\r"
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {
    (START, "s"): SYSTEM,
    (START, "u"): USER,
    (SYSTEM, "u"): USER,
    (ASSISTANT, "u"): USER,
    (USER, "a"): ASSISTANT,
}
GOOD = (START, ASSISTANT)
LEGAL = ("su", "ua", "au")
ROLES = {"u": "user", "a": "assistant"}
LONGEST = (2048, 1 << 22)
BLOCK = 256
BLANK, DUPLICATE, TRUNCATED = "blank", "duplicate", "truncated"


class Turn(NamedTuple):
    """What the deductions need to know of a turn."""

    initial: str
    fault: str | None


def fault_of(text: str, duplicate: bool) -> str | None:
    """The first fault that a turn has."""
    said = text.strip(SPACE)
    if not said:
        return BLANK
    if duplicate:
        return DUPLICATE
    return None if said[-1] in ".!?" else TRUNCATED


def edits(turn: Turn, state: int) -> Iterator[tuple[str, int, int]]:
    """The letters, costs and next states of the edits that consume a turn."""
    yield "D", DELETE, state
    if turn.fault in (BLANK, DUPLICATE):
        return
    more = CUT if turn.fault == TRUNCATED else 0
    if (state, turn.initial) in NEXT:
        yield "K", KEEP + more, NEXT[state, turn.initial]
    for initial in "au":
        if (state, initial) in NEXT:
            yield "R", REROLE + more, NEXT[state, initial]


def lightest(turns: list[Turn], state: int = START, whole: bool = True) -> dict[int, tuple[int, str]]:
    """From ``state`` on, the lightest (cost, audit) of the goal, which has key -1.

    If the turns are not the ``whole`` rest: of each state after the last turn. Then no
    insertion comes last, it belongs to the turns that follow."""
    n = len(turns)
    agenda = [(0, "", 0, state)]
    done: set[tuple[int, int]] = set()
    found: dict[int, tuple[int, str]] = {}
    while agenda:
        cost, audit, at, state = heapq.heappop(agenda)
        if (at, state) in done:
            continue
        done.add((at, state))
        if at == n:
            if not whole:
                found[state] = cost, audit
                continue
            if state in GOOD:  # the goal, the lightest item that is left
                return {-1: (cost, audit)}
        for initial in "ua":
            if (state, initial) in NEXT:
                heapq.heappush(agenda, (cost + INSERT, audit + "I", at, NEXT[state, initial]))
        if at < n:
            for letter, more, after in edits(turns[at], state):
                heapq.heappush(agenda, (cost + more, audit + letter, at + 1, after))
    return found


def after_insertions(turns: list[Turn], state: int) -> dict[int, tuple[int, str]]:
    """``lightest`` of a block: its last edit consumes a turn."""
    *first, last = turns
    found: dict[int, tuple[int, str]] = {}
    reached = lightest_anywhere(first, state)
    for between, (cost, audit) in reached.items():
        for letter, more, after in edits(last, between):
            found[after] = min(found.get(after, (cost + more, audit + letter)), (cost + more, audit + letter))
    return found


def lightest_anywhere(turns: list[Turn], state: int) -> dict[int, tuple[int, str]]:
    """The lightest (cost, audit) of each state after all turns and any insertions."""
    return lightest(turns, state, whole=False) if turns else inserted(state)


def inserted(state: int) -> dict[int, tuple[int, str]]:
    found, cost, audit = {}, 0, ""
    while state not in found:
        found[state] = cost, audit
        state = NEXT.get((state, "u"), NEXT.get((state, "a"), state))
        cost, audit = cost + INSERT, audit + "I"
    return found


def walk(audit: str, roles: Iterator[str], state: int = START) -> Iterator[tuple[str, str, int]]:
    """Letter, new role and next state of each edit. A deleted turn has its old role."""
    for letter in audit:
        role = "" if letter == "I" else next(roles)
        if letter in "RI":
            initial = "u" if (state, "u") in NEXT else "a"
            role = ROLES[initial]
        if letter != "D":
            state = NEXT[state, role[:1]]
        yield letter, role, state


class Digest:
    """The hash of repaired turns, joined by line ends."""

    def __init__(self) -> None:
        self.hash, self.between = hashlib.sha256(), b""

    def add(self, role: str, text: str) -> None:
        self.hash.update(self.between + f"{role}:{text}".encode())
        self.between = b"\n"


def illegal(initials: list[str]) -> int:
    return sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
SUMMARY = "conv string, " + ", ".join(f"{c} long" for c in COUNTS) + ", audit string, repaired_sha256 string"
SOLVED = SUMMARY + ", chunk long, at long, turn long, role string, text string, closed boolean"
TYPES = [pa.string()] + [pa.int64()] * len(COUNTS) + [pa.string()] * 2
SOLVED_TYPES = TYPES + [pa.int64()] * 3 + [pa.string()] * 2 + [pa.bool_()]


def names_of(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def batches_of(rows: Iterator[tuple], types: list[pa.DataType], schema: str) -> Iterator[pa.RecordBatch]:
    """Result rows in batches of few rows and characters."""
    names, held, weight = names_of(schema), [], 0

    def batch() -> pa.RecordBatch:
        columns = zip(*held) if held else ([] for _ in types)
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=names)

    for row in rows:
        held.append(row)
        weight += sum(len(v) for v in row if isinstance(v, str))
        if len(held) >= 1024 or weight >= 1 << 22:
            yield batch()
            held, weight = [], 0
    yield batch()


def solved(conv: str | None, rows: list[tuple]) -> tuple:
    """The summary of a conversation of (turn, role, text), in order."""
    seen: set[tuple[str, str]] = set()
    turns = []
    for _, role, text in rows:
        turns.append(Turn(role[:1], fault_of(text, (role, text) in seen)))
        seen.add((role, text))
    (cost, audit) = lightest(turns)[-1]
    digest, texts = Digest(), iter(rows)
    for letter, role, _ in walk(audit, iter([r for _, r, _ in rows])):
        text = "" if letter == "I" else next(texts)[2]
        if letter != "D":
            digest.add(role, text)
    numbers = {t for t, _, _ in rows if t is not None}
    gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
    faults = [sum(t.fault == f for t in turns) for f in (BLANK, DUPLICATE, TRUNCATED)]
    pairs = illegal([t.initial for t in turns])
    return (conv, gaps, *faults, pairs, cost, audit, digest.hash.hexdigest())


def solve(longest: tuple[int, int]):
    def rows_solved(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        chunk = TaskContext.get().partitionId()
        most_rows, most_chars = longest
        now, held, weight, still_open, at, first = None, [], 0, False, 0, True

        def opened() -> Iterator[tuple]:
            nonlocal at
            for turn, role, text in held:
                yield (now, *(None,) * (len(TYPES) - 1), chunk, at, turn, role, text, False)
                at += 1

        for conv, turn, role, text in rows_of(batches):
            if at == 0 and not held and first is True:
                now, first = conv, conv
                still_open = True  # it may have begun in the task before
            elif conv != now:
                if still_open:
                    yield from opened()
                else:
                    yield (*solved(now, held), *(None,) * 5, True)
                now, held, weight, still_open = conv, [], 0, False
            held.append((turn, role, text))
            weight += len(text)
            if still_open or len(held) > most_rows or weight > most_chars:
                still_open = True
                yield from opened()
                held, weight = [], 0
        yield from opened()  # it may go on in the next task

    return lambda batches: batches_of(rows_solved(batches), SOLVED_TYPES, SOLVED)


BLOCKS = (
    "conv string, chunk long, block long, blank long, duplicate long, truncated long, pairs long, "
    "first string, last string, ways array<struct<from:int,to:int,cost:long,audit:string>>"
)
WAY = pa.struct([("from", pa.int32()), ("to", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
BLOCK_TYPES = [pa.string()] + [pa.int64()] * 6 + [pa.string()] * 2 + [pa.list_(WAY)]


def solve_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ways through each block: the lightest edits from any state to any other."""

    def block(key: tuple, turns: list[Turn]) -> tuple:
        ways = []
        for state in range(4):
            for after, (cost, audit) in after_insertions(turns, state).items():
                ways.append({"from": state, "to": after, "cost": cost, "audit": audit})
        faults = [sum(t.fault == f for t in turns) for f in (BLANK, DUPLICATE, TRUNCATED)]
        initials = [t.initial for t in turns]
        return (*key, *faults, illegal(initials), initials[0], initials[-1], ways)

    def found() -> Iterator[tuple]:
        key, turns = None, []
        for conv, chunk, number, _, initial, fault in rows_of(batches):
            if key != (conv, chunk, number) and turns:
                yield block(key, turns)
                turns = []
            key = conv, chunk, number
            turns.append(Turn(initial, fault))
        if turns:
            yield block(key, turns)

    return batches_of(found(), BLOCK_TYPES, BLOCKS)


CHOSEN = (
    "conv string, chunk long, block long, audit string, state int, "
    "blank long, duplicate long, truncated long, illegal long, cost long"
)
CHOSEN_TYPES = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int32()] + [pa.int64()] * 5


def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each block the edits that are taken and the state before them; the last row of a
    conversation, without a block, has the insertions at its end, and its counts.

    Audits up to a block's end have a letter for each turn and end with one, so none is the
    beginning of another; their order is kept as the rank of a state."""

    def conversation(conv: str | None, blocks: Iterator[tuple]) -> Iterator[tuple]:
        reached: dict[int, tuple[int, int, tuple | None]] = {START: (0, 0, None)}
        counts, last = [0] * 4, None
        for chunk, number, *faults, first, final, ways in blocks:
            for k, v in enumerate(faults):
                counts[k] += v
            counts[3] += last is not None and last + first not in LEGAL
            last = final
            best: dict[int, tuple] = {}
            for way in ways:
                if way["from"] in reached:
                    cost, rank, path = reached[way["from"]]
                    option = (cost + way["cost"], rank, way["audit"], way["from"], path)
                    known = best.get(way["to"])
                    if known is None or option[:3] < known[:3]:
                        best[way["to"]] = option
            order = sorted(best, key=lambda state: best[state][1:3])
            reached = {}
            for rank, state in enumerate(order):
                cost, _, audit, before, path = best[state]
                reached[state] = cost, rank, (path, chunk, number, audit, before)
        ends = []
        for state, (cost, rank, path) in reached.items():
            for good, (more, audit) in inserted(state).items():
                if good in GOOD:
                    ends.append((cost + more, rank, audit, state, path))
        cost, _, audit, state, path = min(ends, key=lambda e: e[:3])
        steps = []
        while path:
            path, *step = path
            steps.append(step)
        for chunk, number, letters, before in reversed(steps):
            yield (conv, chunk, number, letters, before, *(None,) * 5)
        yield (conv, None, None, audit, state, *counts, cost)

    def found() -> Iterator[tuple]:
        rows = rows_of(batches, 16)
        row = next(rows, None)
        while row is not None:
            conv = row[0]

            def blocks() -> Iterator[tuple]:
                nonlocal row
                while row is not None and row[0] == conv:
                    yield row[1:]
                    row = next(rows, None)

            yield from conversation(conv, blocks())

    return batches_of(found(), CHOSEN_TYPES, CHOSEN)


DIGESTS = "conv string, repaired_sha256 string"


def digest_in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of each open conversation, of (conv, chunk, block, at, role, text, audit,
    state) in order; the row without a block has what is inserted at the end."""

    def found() -> Iterator[tuple]:
        now, digest, key, steps = None, None, None, iter(())
        roles: list[str] = []
        for conv, chunk, number, _, role, text, audit, state in rows_of(batches):
            if digest is None or conv != now:
                if digest:
                    yield now, digest.hash.hexdigest()
                now, digest, key = conv, Digest(), None
            if key != (chunk, number):
                key, roles = (chunk, number), []
                steps = walk(audit, iter(roles.pop, None), state)
            if role is None:
                for _, new, _ in steps:
                    digest.add(new, "")
                continue
            roles.append(role)
            for letter, new, _ in steps:
                if letter != "D":
                    digest.add(new, "" if letter == "I" else text)
                if letter != "I":
                    break
        if digest:
            yield now, digest.hash.hexdigest()

    return batches_of(found(), [pa.string(), pa.string()], DIGESTS)


def sha256(*columns: Column) -> Column:
    return F.sha2(F.concat_ws("\n", *columns), 256)


def open_conversations(rows: DataFrame, block: int) -> DataFrame:
    """The summaries of conversations that several tasks hold, or that are long."""
    rows = rows.select("conv", "chunk", "at", "turn", "role", "text")
    rows = rows.withColumn("said", sha256(F.length("role").cast("string"), "role", "text"))
    first = rows.groupBy("conv", "said").agg(F.min(F.struct("chunk", "at")).alias("first"))
    first = first.toDF("of", "same", "first")
    met = rows["conv"].eqNullSafe(first["of"]) & (rows["said"] == first["same"])
    said = F.regexp_replace("text", r"[\x20\x09-\x0D]+\z", "")
    fault = (
        F.when(said == "", BLANK)
        .when(F.struct("chunk", "at") != F.col("first"), DUPLICATE)
        .when(~F.substring(said, -1, 1).isin(".", "!", "?"), TRUNCATED)
    )
    number = F.floor(F.col("at") / block).alias("block")
    turns = rows.join(first, met).select(
        "conv", "chunk", number, "at", F.substring("role", 1, 1).alias("initial"), fault.alias("fault")
    )
    place = ["conv", "chunk", "block"]
    turns = turns.repartition(*place).sortWithinPartitions(*place, "at")
    blocks = turns.mapInArrow(solve_blocks, BLOCKS)
    blocks = blocks.repartition("conv").sortWithinPartitions(*place)
    chosen = stage(blocks.mapInArrow(choose, CHOSEN), "chosen-edits")

    texts = rows.select("conv", "chunk", number, "at", "role", "text")
    steps = chosen.select(F.col("conv").alias("c"), F.col("chunk").alias("k"), F.col("block").alias("b"), "audit", "state")
    same = texts["conv"].eqNullSafe(steps["c"]) & (texts["chunk"] == steps["k"]) & (texts["block"] == steps["b"])
    texts = texts.join(steps, same).drop("c", "k", "b")
    ends = chosen.where("chunk is null").select("conv", "chunk", "block", "audit", "state")
    texts = texts.unionByName(ends, allowMissingColumns=True)
    ordered = texts.select("conv", "chunk", "block", "at", "role", "text", "audit", "state")
    ordered = ordered.repartition("conv").sortWithinPartitions(
        "conv", F.asc_nulls_last("chunk"), "block", "at"
    )
    digests = ordered.mapInArrow(digest_in_order, DIGESTS).toDF("c", "repaired_sha256")

    numbers = rows.groupBy(F.col("conv").alias("g")).agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1, F.lit(0)).alias("span"),
        F.count_distinct("turn").alias("turns"),
    )
    letters = chosen.groupBy(F.col("conv").alias("l")).agg(
        F.array_join(
            F.transform(
                F.array_sort(
                    F.collect_list(F.struct(F.col("chunk").isNull().alias("end"), "chunk", "block", "audit"))
                ),
                lambda s: s["audit"],
            ),
            "",
        ).alias("letters")
    )
    ends = chosen.where("chunk is null").drop("audit")
    ends = ends.join(numbers, ends["conv"].eqNullSafe(numbers["g"]))
    ends = ends.join(letters, ends["conv"].eqNullSafe(letters["l"]))
    ends = ends.join(digests, ends["conv"].eqNullSafe(digests["c"]))
    ends = ends.withColumn("gaps", F.col("span") - F.col("turns"))
    return ends.withColumn("audit", F.col("letters")).select(names_of(SUMMARY))


def repair(
    turns: DataFrame,
    *,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    longest: tuple[int, int] = LONGEST,
    block: int = BLOCK,
) -> DataFrame:
    """``conv_col``, ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost``,
    ``audit`` and ``repaired_sha256`` of every conversation.

    Turns are taken by turn, null first; of equal turns by role, then by text. Null roles
    and texts count as one space, null conversations are one conversation. Rows that are
    equal in all of these are duplicates but for the first. A conversation of which nothing
    is kept has the hash of an empty string. An empty table gives an empty result; other
    columns are not read. ``longest`` (turns, characters) and ``block`` change the work,
    not the result; ``walk`` gives the roles of the turns that an audit keeps."""
    kind = turns.schema[conv_col].dataType
    given = turns.select(
        turns[conv_col].cast("string").alias("conv"),
        turns[turn_col].cast("long").alias("turn"),
        F.coalesce(turns[role_col], F.lit(" ")).alias("role"),
        F.coalesce(turns[text_col], F.lit(" ")).alias("text"),
    )
    # Bounds of ranges hold the beginning of texts only; equal beginnings stay together.
    ranges = given.repartitionByRange("conv", "turn", "role", F.substring("text", 1, 32))
    ordered = ranges.sortWithinPartitions("conv", "turn", "role", "text")
    found = stage(ordered.mapInArrow(solve(longest), SOLVED), "repaired")
    closed = found.where("closed").select(names_of(SUMMARY))
    result = closed.unionByName(open_conversations(found.where("not closed"), block))
    return result.withColumn("conv", F.col("conv").cast(kind)).withColumnRenamed("conv", conv_col)
