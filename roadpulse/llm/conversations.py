"""Conversation structure repair by secondary-sorted streams.

A conversation must read ``(system? (user assistant)+)?`` by the initials of its roles.  The cheapest
edits that make it so are found by dynamic programming over four states (nothing yet, after system,
after user, after assistant), in three passes, each repartitioned by conversation and sorted inside it:

1. ``pointers``: rows without their texts, by turn.  ``mapInPandas`` carries costs and order of the four
   states from one Arrow batch to the next and emits two bytes of backpointers a row, in blocks of
   ``BLOCK_ROWS``.  So a giant conversation spills its pointers to Spark's own shuffle files instead of keeping them.
2. ``audits``: blocks of pointers, last one first, walked back to the edits' initials.
3. ``repaired``: rows with their texts by turn, the audit ahead of them, edited one by one.

A worker holds one batch of rows, one block of pointers and one audit at a time, however long a conversation is; the audit
is a single value of the result.  Repeats of a row are found by a window inside the first pass's partitions,
which sorts and spills by itself.  One task streams each conversation, as its order asks for;
what is large, the texts, passes through it once.

Defined results: rows are taken by turn, nulls first, equal turns by role, then by the MD5 of the text, so rows equal in all
three are repeats of each other and their order does not show.  A null role or text is one space: blank, or a
role that has to change.  Rows with a null ``conv_id`` are a conversation of their own.  Repeated rows are duplicates.
An empty text is blank.  Long texts travel as one value.  Of equally cheap edits the least audit in ASCII order is taken.
An empty table gives no rows.  Other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.sources.storage import stage

#: Rows whose backpointers travel as one block.
BLOCK_ROWS = 1 << 18

# Costs of edits; an undeleted truncated row adds one.
RETYPE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: Characters that are no content.
BLANKS = " \t\n\x0b\x0c\r"

# States: 0 nothing yet, 1 after system, 2 after user, 3 after assistant.
_AFTER_INSERT = (2, 2, 3, 2)
_BEFORE = {1: (0,), 2: (0, 1, 3), 3: (2,)}
_ROLE = {2: "user", 3: "assistant"}
_NEVER = 1 << 20
# No suffix costs over 5 more from the cheapest state than from any other, so a state further behind is on no cheapest path.
_BEHIND = 6
#: Column of damaged rows that is false for a row that was dropped: its conversation still has a result.
PRESENT = "__present"


# -- rows -------------------------------------------------------------------------
def plain_rows(df: DataFrame) -> DataFrame:
    """conv_id, turn, role and text with nulls of the last two as one space."""
    space = F.lit(" ")
    return df.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"))


def damage(df: DataFrame) -> DataFrame:
    """Faults planted by crc32(``conv_id:turn``) % 20; a dropped row stays with ``PRESENT`` false and no text."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn")).cast("binary")) % 20
    rows = plain_rows(df).withColumn("kind", kind)
    text = F.when(F.col("kind") <= 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"), (F.col("kind") != 0).alias(PRESENT), F.explode(copies).alias("copy"),
    ).drop("copy")


def _ready(df: DataFrame) -> DataFrame:
    """Rows with the string key of their conversation and what orders rows inside it."""
    rows = df if PRESENT in df.columns else plain_rows(df).withColumn(PRESENT, F.lit(True))
    return rows.select(F.col("conv_id").cast("string").alias("key"), "turn", "role", "text", PRESENT, F.md5(F.col("text").cast("binary")).alias("digest"))


def _initial(role: Column) -> Column:
    """1 system, 2 user, 3 assistant by the first letter, else 0."""
    first = F.substring(role, 1, 1)
    return F.when(first == "s", 1).when(first == "u", 2).when(first == "a", 3).otherwise(0)


def _faults(rows: DataFrame) -> DataFrame:
    """Narrow rows by conversation and turn: initial and first fault (0 none, 1 blank, 2 duplicate, 3 truncated).

    The window's keys contain the conversation, so it reads the partitions as they are, without another shuffle.
    """
    filled = F.rtrim(F.col("text"), F.lit(BLANKS))
    facts = rows.select(
        "key", "turn", "role", "digest", PRESENT, _initial(F.col("role")).alias("initial"), (filled == "").alias("blank"),
        (~F.substring(filled, -1, 1).isin(".", "!", "?")).alias("cut"),
    ).repartition("key")
    same = Window.partitionBy("key", "role", "digest", PRESENT).orderBy(F.asc_nulls_first("turn"))
    fault = F.when(F.col("blank"), 1).when(F.row_number().over(same) > 1, 2).when(F.col("cut"), 3).otherwise(0)
    return facts.select("key", "turn", "role", "digest", PRESENT, "initial", fault.alias("fault")).sortWithinPartitions(
        "key", F.asc_nulls_first("turn"), "role", "digest", F.col("fault") == 2
    )


# -- the four states ----------------------------------------------------------------
def _inserts(start: int, goal: int) -> int:
    """Turns to add to get from one state to another; -1 if none leads there."""
    for n in range(4):
        if start == goal:
            return n
        start = _AFTER_INSERT[start]
    return -1


def _options() -> dict[int, list[tuple[int, int, str, str]]]:
    """By next state: (state before, turns added, initials of the edits, edit of the row)."""
    found: dict[int, list[tuple[int, int, str, str]]] = {}
    for goal in range(4):
        for start in range(4):
            for edit in "DKR":
                for before in (goal,) if edit == "D" else _BEFORE.get(goal, ()):
                    n = _inserts(start, before)
                    if n >= 0 and not (edit == "R" and goal == 1):
                        found.setdefault(goal, []).append((start, n, "I" * n + edit, edit))
    return found


_OPTIONS = _options()
_EDITS = "DKR"
#: By (next state, state before, edit): the initials added, the fewest turns that lead there.
_BLOCKS = {
    (goal, start, edit): min((block for s, _, block, e in some if s == start and e == edit), key=len)
    for goal, some in _OPTIONS.items() for start, _, _, edit in some
}


class Steps:
    """Costs and audit order of the four states; steps are looked up by what they were seen to do before.

    Audits of the states differ and none is the beginning of another up to the same row, so keeping the
    order of the states' audits is as good as keeping the audits.  Costs are kept relative to the least.
    """

    START = ((0, _NEVER, _NEVER, _NEVER), (0, 1, 2, 3))

    def __init__(self) -> None:
        self.seen: dict[tuple, tuple] = {}

    def step(self, at: tuple, initial: int, fault: int) -> tuple[tuple, int, int]:
        """(state after one row, cost added to all, four pointers of four bits)."""
        key = (at, initial, fault)
        if key not in self.seen:
            self.seen[key] = self._make(*key)
        return self.seen[key]

    @staticmethod
    def _make(at: tuple, initial: int, fault: int) -> tuple[tuple, int, int]:
        costs, ranks = at
        late = TRUNCATED if fault == 3 else 0
        best = []
        for goal in range(4):
            choices = []
            for start, inserts, block, edit in _OPTIONS[goal]:
                if edit == "D":
                    price = DELETE
                elif fault in (1, 2) or (edit == "K" and initial != goal):
                    continue
                else:
                    price = late + (RETYPE if edit == "R" else 0)
                if costs[start] < _NEVER:
                    choices.append((costs[start] + inserts * INSERT + price, ranks[start], block, start, edit))
            best.append(min(choices, default=(_NEVER, 0, "", 0, "D")))
        least = min(b[0] for b in best)
        order = sorted(range(4), key=lambda s: (best[s][1], best[s][2]))
        pointers = sum((b[3] << 2 | _EDITS.index(b[4])) << 4 * s for s, b in enumerate(best))
        after = tuple(b[0] - least if b[0] - least <= _BEHIND else _NEVER for b in best)
        return (after, tuple(order.index(s) for s in range(4))), least, pointers

    @staticmethod
    def finish(at: tuple) -> tuple[int, int, int]:
        """(cost still to add, last state, turns added at the end)."""
        costs, ranks = at
        ends = [(costs[s] + n * INSERT, ranks[s], s, n) for s, n in ((0, 0), (1, 2), (2, 1), (3, 0)) if costs[s] < _NEVER]
        cost, _, state, n = min(ends)
        return cost, state, n


# -- first pass -----------------------------------------------------------------------
_POINTERS = (
    "key string, part long, pointers binary, last boolean, gaps long, blank long, duplicate long, truncated long, "
    "illegal long, cost long, state int, tail int"
)
_LEGAL = {(1, 2), (2, 3), (3, 2)}


class _Conversation:
    """What the first pass carries of one conversation."""

    def __init__(self, key: str | None):
        self.key, self.at, self.cost, self.part = key, Steps.START, 0, 0
        self.pointers: list[int] = []
        self.faults = [0, 0, 0, 0]
        self.illegal, self.before = 0, None
        self.first = self.latest = None
        self.turns = 0

    def block(self, last: bool) -> tuple:
        packed = np.array(self.pointers, "<u2").tobytes()
        self.pointers, part = [], self.part
        self.part += 1
        if not last:
            return (self.key, part, packed, False, *[0] * 8)
        cost, state, tail = Steps.finish(self.at)
        gaps = self.latest - self.first + 1 - self.turns if self.turns else 0
        return (self.key, part, packed, True, gaps, *self.faults[1:], self.illegal, self.cost + cost, state, tail)


def _point(frames: Iterator[pd.DataFrame], block_rows: int) -> Iterator[pd.DataFrame]:
    names = [c.split()[0] for c in _POINTERS.split(", ")]
    steps, now = Steps(), None
    for frame in frames:
        out = []
        for key, turn, present, initial, fault in zip(*[frame[c].tolist() for c in ("key", "turn", PRESENT, "initial", "fault")]):
            key = key if isinstance(key, str) else None
            if now is None or now.key != key:
                if now is not None:
                    out.append(now.block(True))
                now = _Conversation(key)
            if not present:
                continue
            if isinstance(turn, str):
                turn = int(turn)
                if turn != now.latest:
                    now.turns += 1
                    now.first = turn if now.first is None else now.first
                    now.latest = turn
            now.faults[fault] += 1
            if now.before is not None and (now.before, initial) not in _LEGAL:
                now.illegal += 1
            now.before = initial
            now.at, more, pointers = steps.step(now.at, initial, fault)
            now.cost += more
            now.pointers.append(pointers)
            if len(now.pointers) == block_rows:
                out.append(now.block(False))
        if out:
            yield pd.DataFrame(out, columns=names)
    if now is not None:
        yield pd.DataFrame([now.block(True)], columns=names)


def pointers(df: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Blocks of backpointers of each conversation; the last one has its counts and its cost."""
    rows = _faults(_ready(df)).select("key", F.col("turn").cast("string").alias("turn"), PRESENT, "initial", "fault")
    return rows.mapInPandas(lambda frames: _point(frames, block_rows), _POINTERS)


# -- second pass ------------------------------------------------------------------------
_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    step = [
        [(code >> 2, _BLOCKS.get((state, code >> 2, _EDITS[code & 3]), "")) if code & 3 < 3 else (0, "") for code in range(16)]
        for state in range(4)
    ]
    state, edits, counts = 0, [], ()
    for frame in frames:
        out = []
        for row in frame.itertuples(index=False):
            if row.last:
                state, edits, counts = row.state, ["I" * row.tail], tuple(getattr(row, c) for c in _COUNTS)
            for codes in np.frombuffer(row.pointers, "<u2")[::-1].tolist():
                state, block = step[state][codes >> 4 * state & 15]
                edits.append(block)
            if row.part == 0:
                out.append((row.key if isinstance(row.key, str) else None, *counts, "".join(reversed(edits))))
        yield pd.DataFrame(out, columns=["key", *_COUNTS, "audit"])


def audits(blocks: DataFrame) -> DataFrame:
    """One row for each conversation: its counts, its cost and the initials of its edits."""
    schema = "key string, " + ", ".join(f"{c} long" for c in _COUNTS) + ", audit string"
    return blocks.repartition("key").sortWithinPartitions("key", F.desc("part")).mapInPandas(_walk, schema)


# -- third pass ------------------------------------------------------------------------------
def _edited(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[str | None, int, str | None, str | None]]:
    """(key, place, role, text) of repaired rows; every conversation ends with (key, -1, None, None)."""
    key, audit, place, at, state, begun = None, "", 0, 0, 0, False

    def added() -> Iterator[tuple[str | None, int, str | None, str | None]]:
        nonlocal place, at, state
        while at < len(audit) and audit[at] == "I":
            state = _AFTER_INSERT[state]
            yield key, place, _ROLE[state], ""
            place, at = place + 1, at + 1

    for frame in frames:
        for new, is_audit, role, text, present in zip(*[frame[c].tolist() for c in ("key", "is_audit", "role", "text", PRESENT)]):
            if is_audit:
                if begun:
                    yield from added()
                    yield key, -1, None, None
                key, audit, place, at, state, begun = new if isinstance(new, str) else None, text, 0, 0, 0, True
                continue
            if not present:
                continue
            yield from added()
            edit = audit[at]
            at += 1
            if edit == "D":
                continue
            if edit == "R":
                state = _AFTER_INSERT[state]
                role = _ROLE[state]
            else:
                state = {"s": 1, "u": 2, "a": 3}[role[0]]
            yield key, place, role, text
            place += 1
    if begun:
        yield from added()
        yield key, -1, None, None


def _stream(df: DataFrame, found: DataFrame) -> DataFrame:
    """Each conversation's audit, then its rows by turn."""
    rows = _ready(df).select("key", F.lit(False).alias("is_audit"), "turn", "role", "digest", "text", PRESENT)
    heads = found.select(
        "key", F.lit(True).alias("is_audit"), F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"),
        F.lit(None).cast("string").alias("digest"), F.col("audit").alias("text"), F.lit(True).alias(PRESENT),
    )
    order = ["key", F.desc("is_audit"), F.asc_nulls_first("turn"), "role", "digest"]
    return heads.unionAll(rows).repartition("key").sortWithinPartitions(*order).select("key", "is_audit", "role", "text", PRESENT)


def _as_rows(frames: Iterator[pd.DataFrame], rows: int = 1000) -> Iterator[pd.DataFrame]:
    names, out = ["key", "place", "role", "text"], []
    for item in _edited(frames):
        if item[1] >= 0:
            out.append(item)
        if len(out) >= rows:
            yield pd.DataFrame(out, columns=names)
            out = []
    if out:
        yield pd.DataFrame(out, columns=names)


def _as_digests(frames: Iterator[pd.DataFrame], rows: int = 1000) -> Iterator[pd.DataFrame]:
    names, out, digest = ["key", "repaired_sha256"], [], hashlib.sha256()
    for key, place, role, text in _edited(frames):
        if place >= 0:
            digest.update(f"{chr(10) if place else ''}{role}:{text}".encode())
            continue
        out.append((key, digest.hexdigest()))
        digest = hashlib.sha256()
        if len(out) >= rows:
            yield pd.DataFrame(out, columns=names)
            out = []
    if out:
        yield pd.DataFrame(out, columns=names)


def _typed(df: DataFrame, like: DataFrame) -> DataFrame:
    """The string key as ``conv_id`` of the type it had."""
    return df.select(F.col("key").cast(like.schema["conv_id"].dataType).alias("conv_id"), *[c for c in df.columns if c != "key"])


def repair(df: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """conv_id, place, role and text of the repaired conversations; ``df`` may come from ``damage``."""
    found = audits(pointers(df)) if found is None else found
    return _typed(_stream(df, found).mapInPandas(_as_rows, "key string, place long, role string, text string"), df)


def report(df: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """Counts, cost, audit and digest of the repaired rows of every conversation in ``df``."""
    # Written: the audits head the streams below and are joined to what comes out of them.
    found = stage(audits(pointers(df)), "audits") if found is None else found
    digests = _stream(df, found).mapInPandas(_as_digests, "key string, repaired_sha256 string")
    both = found.join(digests.withColumnRenamed("key", "other"), F.col("key").eqNullSafe(F.col("other"))).drop("other")
    return _typed(both, df)


def sql() -> str:
    """The report on damaged conversations in DuckDB: a recursion over places that keeps (cost, audit, repaired rows) of each state."""

    def candidates(goal: int) -> str:
        parts = []
        for start, n, block, edit in _OPTIONS[goal]:
            state, added = start, []
            for _ in range(n):
                state = _AFTER_INSERT[state]
                added.append(f"{_ROLE[state]}:")
            price = n * INSERT + (DELETE if edit == "D" else RETYPE if edit == "R" else 0)
            cost = f"s{start}.cost + {price}" + ("" if edit == "D" else f" + CASE fault WHEN 3 THEN {TRUNCATED} ELSE 0 END")
            lines = "".join(f" || chr(10) || '{line}'" for line in added)
            if edit != "D":
                lines += " || chr(10) || " + ("role" if edit == "K" else f"'{_ROLE[goal]}'") + " || ':' || text"
            allowed = "TRUE" if edit == "D" else "fault NOT IN (1, 2)" + (f" AND initial = '{' sua'[goal]}'" if edit == "K" else "")
            parts.append(
                f"CASE WHEN {allowed} AND s{start}.cost < {_NEVER} THEN {{'cost': {cost}, 'audit': s{start}.audit || '{block}', 'done': s{start}.done{lines}}} END"
            )
        never = f"{{'cost': CAST({_NEVER} AS BIGINT), 'audit': '', 'done': ''}}"
        return f"list_min(list_filter([{', '.join([*parts, never])}], lambda c: c IS NOT NULL))"

    never = f"{{'cost': CAST({_NEVER} AS BIGINT), 'audit': '', 'done': ''}}"
    ends = ", ".join(
        f"CASE WHEN s{s}.cost < {_NEVER} THEN {{'cost': s{s}.cost + {n * INSERT}, 'audit': s{s}.audit || '{'I' * n}', "
        f"'done': s{s}.done{''.join(f' || chr(10) || {chr(39)}{r}:{chr(39)}' for r in added)}}} END"
        for s, n, added in ((0, 0, ()), (1, 2, ("user", "assistant")), (2, 1, ("assistant",)), (3, 0, ()))
    )
    # CRC-32 by bytes, from its polynomial.
    return f"""
WITH RECURSIVE crc_bits AS (
  SELECT b, b AS v, 0 AS n FROM range(256) r(b)
  UNION ALL SELECT b, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, n + 1 FROM crc_bits WHERE n < 8
), crc_table AS (SELECT list(v ORDER BY b) AS t FROM crc_bits WHERE n = 8
), keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    encode(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')) AS name FROM conversations
), hashed AS (
  SELECT conv_id, turn, role, text, xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(range(1, octet_length(name) + 1),
      lambda i: CAST('0x' || substr(hex(name), CAST(2 * i - 1 AS INT), 2) AS BIGINT))), lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295) % 20 AS kind
  FROM keyed, crc_table
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM hashed, range(2) r(copy) WHERE kind <> 0 AND (copy = 0 OR kind = 3)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS place, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS filled
  FROM damaged
), rows_ AS (
  SELECT conv_id, turn, place, role, text, substr(role, 1, 1) AS initial,
    CASE WHEN filled = '' THEN 1 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 THEN 2 WHEN right(filled, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
    lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY place) || substr(role, 1, 1) AS pair
  FROM placed
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
    count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, max(place) AS n
  FROM rows_ GROUP BY conv_id
), walk AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS place, {{'cost': CAST(0 AS BIGINT), 'audit': '', 'done': ''}} AS s0, {never} AS s1, {never} AS s2, {never} AS s3 FROM counts
  UNION ALL
  SELECT w.conv_id, r.place, {', '.join(f'{candidates(goal)} AS s{goal}' for goal in range(4))}
  FROM walk w JOIN rows_ r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.place = w.place + 1
), ended AS (
  SELECT w.conv_id, list_min(list_filter([{ends}], lambda c: c IS NOT NULL)) AS best
  FROM walk w JOIN counts c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.n = w.place
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(best.cost, 0) AS cost, coalesce(best.audit, '') AS audit, sha256(coalesce(substr(best.done, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id"""
