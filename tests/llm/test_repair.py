"""Repair of conversations, against every sequence of edits."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from reportmart.llm import repair
from reportmart.llm.queries import damaged

GOOD = re.compile("(s?(ua)+)?")
SPACE = " \t\n\x0b\x0c\r"


def options(rows, faults):
    """Every (cost, audit, repaired) with at most one insertion of one or two turns a gap."""
    pads = [[], ["user"], ["assistant"], ["user", "assistant"], ["assistant", "user"]]
    each = []
    for (_, role, text), fault in zip(rows, faults):
        choices = [("D", 2, None)]
        if fault not in ("blank", "duplicate"):
            more = 5 if fault == "truncated" else 0
            choices += [("K", more, role), ("R", 1 + more, "user"), ("R", 1 + more, "assistant")]
        each.append([(pad, c, text) for pad in pads for c in choices])
    for picked in itertools.product(*each, pads):
        audit, cost, said = "", 0, []
        for pad, (letter, price, role), text in picked[:-1]:
            audit += "I" * len(pad) + letter
            cost += 5 * len(pad) + price
            said += [(p, "") for p in pad] + ([] if role is None else [(role, text)])
        audit += "I" * len(picked[-1])
        cost += 5 * len(picked[-1])
        said += [(p, "") for p in picked[-1]]
        if GOOD.fullmatch("".join(r[:1] or "-" for r, _ in said)):
            yield cost, audit, "\n".join(f"{r}:{t}" for r, t in said)


def brute_faults(rows):
    seen, found = [], []
    for _, role, text in rows:
        kept = text.strip(SPACE)
        fault = "blank" if not kept else "duplicate" if (role, text) in seen else None
        found.append(fault or (None if kept[-1] in ".!?" else "truncated"))
        seen.append((role, text))
    return found


def brute(conv, rows):
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    faults = brute_faults(rows)
    cost, audit, said = min(options(rows, faults))
    numbers = {t for t, _, _ in rows} - {None}
    gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    pairs = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (conv, gaps, *counts, pairs, cost, audit, hashlib.sha256(said.encode()).hexdigest())


def random_conversations(seed, n, longest):
    rng = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None]
    texts = ["Yes.", "No!", "cut off", "", " \t", None, "Why?  ", "é.", "."]
    found = []
    for conv in [None, *range(n)]:
        for _ in range(rng.randint(1, longest)):
            turn = rng.choice([None, *range(9)])
            found.append((conv, turn, rng.choice(roles), rng.choice(texts)))
    rng.shuffle(found)
    return found


def by_conversation(rows):
    found = {}
    for conv, *row in rows:
        found.setdefault(conv, []).append(tuple(row))
    return found


def in_order(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is not None, r[0] or 0))


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("longest, block", [((2048, 1 << 22), 256), ((0, 0), 1), ((2, 8), 2), ((0, 0), 3)])
def test_against_all_edits(spark, longest, block):
    rows = random_conversations(block, 60, 3)
    df = spark.createDataFrame(rows, SCHEMA)
    found = repair.repair(df, longest=longest, block=block).collect()
    assert in_order(found) == in_order(brute(c, r) for c, r in by_conversation(rows).items())


def test_blocks_give_what_whole_conversations_give(spark):
    rows = random_conversations(5, 6, 120)
    df = spark.createDataFrame(rows, SCHEMA)
    whole = in_order(repair.repair(df).collect())
    for block in (1, 7, 64):
        assert in_order(repair.repair(df, longest=(0, 0), block=block).collect()) == whole


def test_one_conversation_over_several_tasks(spark):
    rng = random.Random(8)
    rows = [(1, t, rng.choice(["user", "assistant"]), f"{rng.randint(0, 900)}{rng.choice('.!?x')}") for t in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = repair.repair(df).collect()
    turns = [(t, r, x) for _, t, r, x in rows]
    assert [tuple(r)[1:] for r in found] == [repair.solved("1", turns)[1:]]


def test_long_texts_repeated_rows_and_other_columns(spark):
    long = "word " * 400_000 + "."
    rows = [(1, 0, "user", long), (1, 1, "assistant", long), (2, 0, "user", "a."), (2, 0, "user", "a.")]
    rows += [(3, None, "assistant", "x.")]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("conv", "at", "chunk", "block", "audit", "cost", "closed", "said"):
        df = df.withColumn(name, df["role"])
    found = repair.repair(df).collect()
    assert in_order(found) == in_order(brute(c, r) for c, r in by_conversation(rows).items())


def test_empty_table(spark):
    assert repair.repair(spark.createDataFrame([], SCHEMA)).collect() == []


def test_ties_take_the_least_letters():
    turns = [repair.Turn("u", None), repair.Turn("u", None), repair.Turn("a", None)]
    assert repair.lightest(turns) == {-1: (2, "DKK")}
    assert repair.lightest([]) == {-1: (0, "")}
    assert list(repair.walk("KRI", iter(["system", "tool"]))) == [
        ("K", "system", 1), ("R", "user", 2), ("I", "assistant", 3)
    ]


def test_damage(spark):
    rows = [(c, t, "assistant", "One. Two!") for c in range(40) for t in range(5)] + [(None, None, None, None)]
    want = []
    for c, t, role, text in rows:
        fault = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = (" " if role is None else role), (" " if text is None else text)
        text = {1: "", 2: text.replace(".", "").replace("!", "")}.get(fault, text)
        row = (c, t, "user" if fault == 4 else role, text)
        want += [row] * {0: 0, 3: 2}.get(fault, 1)
    found = damaged(spark.createDataFrame(rows, SCHEMA)).collect()
    order = lambda r: tuple((v is not None, v or 0 if not isinstance(v, str) else v) for v in r)
    assert sorted(map(tuple, found), key=order) == sorted(want, key=order)
