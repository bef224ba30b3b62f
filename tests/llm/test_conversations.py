"""Repairs against a plain search over all edits."""

import functools
import hashlib
import random
import zlib
from collections import defaultdict

from roadpulse.llm import conversations as c

SCHEMA = "conv_id long, turn long, role string, text string, key string, audit string, present int"
BLANKS = " \t\n\x0b\x0c\r"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(x for x in text if x not in ".!?")
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def repaired(rows):
    """(cost, audit, lines) of (role, text, fault) by trying every edit, turns added up to two at a time."""

    @functools.cache
    def best(i, state, added):
        ways = []
        if i == len(rows) and state in "-a":
            ways.append((0, "", ()))
        if added < 2:
            role = "assistant" if state == "u" else "user"
            ways.append(then(2, "I", (role + ":",), best(i, role[0], added + 1)))
        if i < len(rows):
            role, text, fault = rows[i]
            ways.append(then(3, "D", (), best(i + 1, state, 0)))
            if fault not in ("blank", "duplicate"):
                late = fault == "truncated"
                if role[:1] and role[0] + state in ("s-", "u-", "us", "ua", "au"):
                    ways.append(then(late, "K", (f"{role}:{text}",), best(i + 1, role[0], 0)))
                new = "assistant" if state == "u" else "user"
                ways.append(then(2 + late, "R", (f"{new}:{text}",), best(i + 1, new[0], 0)))
        return min(ways, default=(10**9, "", ()))

    def then(cost, letter, lines, rest):
        return (cost + rest[0], letter + rest[1], lines + rest[2])

    return best(0, "-", 0)


def plain(rows):
    """The report of rows that are damaged already, without their conversations."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).hexdigest()))
    seen, faults = set(), []
    for _, _, role, text in rows:
        full = text.rstrip(BLANKS)
        faults.append("blank" if not full else "duplicate" if (role, text) in seen else "truncated" if full[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = {r[1] for r in rows} - {None}
    pairs = [a[2][:1] + b[2][:1] for a, b in zip(rows, rows[1:])]
    cost, audit, lines = repaired(tuple((r[2], r[3], f) for r, f in zip(rows, faults)))
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"),
        sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    ), [tuple(x.split(":", 1)) for x in lines]


def some_rows():
    draw = random.Random(11)
    texts = ["Yes.", "no", "Why?", "", " \n", "Stop! ", "a.b", "é.", "one\ntwo."]
    rows = []
    for conv in range(150):
        for turn in range(draw.randrange(1, 9)):
            role = draw.choice(["system", "user", "user", "assistant", "assistant", "tool", "", None])
            rows.append((conv, draw.choice([turn, turn, turn, None]), role, draw.choice([*texts, f"t{turn}.", None])))
    rows += [(None, t, r, x) for t, r, x in ((0, "user", "a."), (1, "assistant", "b"), (None, None, None))]
    rows += [(1000, 5 * t, "user", "again.") for t in range(6)] + [(1001, None, "assistant", "x.")]
    return rows + [(2000 + i, 0, "user", "x.") for i in range(60)]


def expected(rows, ready=lambda rows: rows):
    groups = {r[0]: [] for r in rows}
    for r in ready(rows):
        groups[r[0]].append(r)
    return {conv: plain(group) for conv, group in groups.items()}


def test_report_equals_plain_search(spark):
    rows = some_rows()
    df = spark.createDataFrame([(*r, "k", "a", 0) for r in rows], SCHEMA)
    want = expected(rows, damaged)
    got = c.report(c.damage(df)).collect()
    assert len(got) == len(want) and any(w[0][6] == "" for w in want.values())
    for r in got:
        assert tuple(r)[1:] == want[r.conv_id][0], r
    assert c.report(c.damage(df.limit(0))).collect() == []


def test_repaired_rows_and_blocks_of_three(spark):
    rows = [(a, b, "" if x is None else x, "" if y is None else y) for a, b, x, y in some_rows()]
    df = spark.createDataFrame([(*r, "k", "a", 0) for r in rows], SCHEMA)
    want = expected(rows)
    found = c.audits(c.pointers(df, block_rows=3))
    got = defaultdict(list)
    for r in c.repair(df, found).orderBy("place").collect():
        got[r.conv_id].append((r.role, r.text))
        assert r.place == len(got[r.conv_id]) - 1
    assert {k: v for k, (_, v) in want.items() if v} == dict(got)
    assert {tuple(r)[1:] for r in c.report(df, found).collect()} == {w[0] for w in want.values()}


def test_a_long_conversation_with_a_long_text(spark):
    rows = [(1, t, "user" if t % 2 else "assistant", f"t{t}.") for t in range(20_000)] + [(1, 20_000, "user", "long " * 2_000_000)]
    df = spark.createDataFrame(rows, "conv_id string, turn long, role string, text string")
    (r,) = c.report(df, c.audits(c.pointers(df, block_rows=1000))).collect()
    # The first and the last row are out of place, the last one is truncated.
    assert (r.conv_id, r.gaps, r.truncated, r.illegal, r.cost) == ("1", 0, 1, 1, 5)
    assert len(r.audit) == 20_001 + r.audit.count("I")


def test_one_shuffle_before_the_window(spark):
    df = spark.createDataFrame(some_rows()[:20], "conv_id long, turn long, role string, text string")
    plan = c.pointers(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_relative_costs_stay_few():
    steps, draw, at = c.Steps(), random.Random(3), c.Steps.START
    for _ in range(200_000):
        at, _, _ = steps.step(at, draw.randrange(4), draw.choice([0, 0, 0, 1, 2, 3]))
    assert len(steps.seen) < 2000
