"""Repair of a conversation's structure by divide and conquer (Hirschberg).

Rows are kept, given another role or deleted, and empty turns inserted, so that the
roles become legal: a system turn or none, then user and assistant in turn. Four
states (nothing yet, after system, after user, after assistant) tell what may
follow. What a row can do is a matrix of least costs between states, and so is what
a stretch of rows can do; each entry also knows how its cheapest audit (the edits'
initials) ranks among the others of its line, so that ties go to the least audit.

A stretch is repaired by meeting in its middle: a vector of four costs comes forward
from its first state, one comes backward from its last, the cheapest crossing
(of equal ones that of the least audit before it) is fixed, and both halves are
repaired by themselves. No table of all rows and states is kept.

Long conversations are stretches of stretches: blocks of rows are summed up to one
matrix, blocks of blocks likewise, until one is left; then crossings are handed down,
level by level, in the same way. Blocks are cut by a row's rank in its conversation,
so no task holds more than a block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.chat import ranked
from tidemark.llm.common import map_arrow, quoted, shared_table

START, SYSTEM, USER, ASSISTANT = STATES = range(4)
INITIALS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
FULL = {USER: "user", ASSISTANT: "assistant"}
#: The state that an inserted turn or a changed role leads to, as only one is legal.
FOLLOWS = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
NEVER = 1 << 60
#: Costs of the edits, and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: Rows of a block, and blocks of a larger block.
BLOCK_ROWS, BLOCK_FAN = 128, 512
BLANK, DUPLICATE, CUT_OFF = "blank", "duplicate", "truncated"
_SPACE = " \t\n\x0b\x0c\r"


class Matrix:
    """Least cost from state to state, the rank of its audit among those from the same
    state, and (of a row) the audit."""

    __slots__ = ("cost", "rank", "audit")

    def __init__(self, cost, rank, audit=None):
        self.cost, self.rank, self.audit = cost, rank, audit


def ranks(keys: list) -> tuple[int, ...]:
    """The place of each key among the sorted ones; None has none."""
    order = sorted(k for k in keys if k is not None)
    return tuple(NEVER if k is None else order.index(k) for k in keys)


def row_matrix(own: int | None, fault: str | None) -> Matrix:
    """What a row whose role leads to state ``own`` (None: to none) can do."""
    best: list[list[tuple[int, str] | None]] = [[None] * 4 for _ in STATES]

    def offer(a: int, b: int, cost: int, audit: str) -> None:
        if best[a][b] is None or (cost, audit) < best[a][b]:
            best[a][b] = (cost, audit)

    for a in STATES:
        offer(a, a, DELETE, "D")
        if fault in (BLANK, DUPLICATE):
            continue
        state, spent, audit = a, TRUNCATED * (fault == CUT_OFF), ""
        for _ in range(3):  # a third inserted turn would lead back
            if own == FOLLOWS[state] or (own == SYSTEM and state == START):
                offer(a, own, spent, audit + "K")
            offer(a, FOLLOWS[state], spent + REROLE, audit + "R")
            state, spent, audit = FOLLOWS[state], spent + INSERT, audit + "I"
    cost = tuple(tuple(NEVER if x is None else x[0] for x in line) for line in best)
    return Matrix(cost, tuple(ranks([x and x[1] for x in line]) for line in best), tuple(tuple(x[1] if x else None for x in line) for line in best))


ROWS = {(own, fault): row_matrix(own, fault) for own in (None, SYSTEM, USER, ASSISTANT) for fault in (None, BLANK, DUPLICATE, CUT_OFF)}


def row_of(role: str, fault: str | None) -> Matrix:
    return ROWS[INITIALS.get(role[:1]), fault]


def joined(x: Matrix, y: Matrix) -> Matrix:
    """The matrix of a stretch and the one after it."""
    costs, all_ranks = [], []
    for a in STATES:
        cost, keys = [], []
        for b in STATES:
            m = min(STATES, key=lambda m: (x.cost[a][m] + y.cost[m][b], x.rank[a][m]))
            total = x.cost[a][m] + y.cost[m][b]
            cost.append(min(total, NEVER))
            keys.append((x.rank[a][m], y.rank[m][b]) if total < NEVER else None)
        costs.append(tuple(cost))
        all_ranks.append(ranks(keys))
    return Matrix(tuple(costs), tuple(all_ranks))


@lru_cache(maxsize=1 << 14)
def _longer(cost: tuple, rank: tuple, m: Matrix) -> tuple[int, tuple, tuple]:
    """``joined`` with ``m``, for a stretch given by costs and ranks; its least cost, taken off, comes first."""
    new = joined(Matrix(cost, rank), m)
    low = min(map(min, new.cost))
    return low, tuple(tuple(c - low if c < NEVER else NEVER for c in line) for line in new.cost), new.rank


@lru_cache(maxsize=1 << 14)
def _ahead(cost: tuple, rank: tuple, m: Matrix) -> tuple[int, tuple, tuple]:
    """A forward vector (its least cost taken off) after ``m``, and how much it went up."""
    new, keys = [], []
    for b in STATES:
        a = min(STATES, key=lambda a: (cost[a] + m.cost[a][b], rank[a]))
        total = cost[a] + m.cost[a][b]
        new.append(total)
        keys.append((rank[a], m.rank[a][b]) if total < NEVER else None)
    low = min(new)
    return low, tuple(min(c - low, NEVER) if c < NEVER else NEVER for c in new), ranks(keys)


@lru_cache(maxsize=1 << 14)
def _behind(cost: tuple, m: Matrix) -> tuple:
    """A backward vector (its least cost taken off) before ``m``."""
    new = [min(m.cost[a][b] + cost[b] for b in STATES) for a in STATES]
    low = min(new)
    return tuple(c - low if c < NEVER else NEVER for c in new)


def _at(state: int) -> tuple[int, ...]:
    return tuple(0 if s == state else NEVER for s in STATES)


def crossings(steps: list[Matrix], entry: int, exit_: int) -> list[int]:
    """The states between ``steps`` on the cheapest way from ``entry`` to ``exit_`` (of
    the least audit among equal ones)."""
    if len(steps) < 2:
        return []
    middle = len(steps) // 2
    cost, rank = _at(entry), tuple(0 if s == entry else NEVER for s in STATES)
    for m in steps[:middle]:
        _, cost, rank = _ahead(cost, rank, m)
    back = _at(exit_)
    for m in reversed(steps[middle:]):
        back = _behind(back, m)
    state = min(STATES, key=lambda s: (cost[s] + back[s], rank[s]))
    return [*crossings(steps[:middle], entry, state), state, *crossings(steps[middle:], state, exit_)]


def closing(state: int) -> str:
    """Inserted turns after the last row, so that an assistant closes or nothing is left."""
    return {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}[state]


def last_state(m: Matrix) -> int:
    """The state after a whole conversation's rows."""
    return min(STATES, key=lambda s: (m.cost[START][s] + INSERT * len(closing(s)), m.rank[START][s]))


def turns(state: int, audit: str, role: str, text: str) -> Iterator[tuple[str, str]]:
    """The (role, text) that a row's edits put out after ``state``."""
    for edit in audit:
        if edit == "K":
            state = INITIALS[role[0]]
            yield role, text
        elif edit != "D":
            state = FOLLOWS[state]
            yield FULL[state], text if edit == "R" else ""


def damaged(rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows as a faulty export would leave them, by the CRC-32 of ``conversation:turn`` mod
    20: 0 is dropped, 1 loses its text, 2 its full stops, question and exclamation marks,
    3 comes twice, 4 is the user's. A null role or text is a space, and so is a null in
    the CRC's string. Other columns are left out."""
    c, t, r, x = (F.col(quoted(n)) for n in (conversation, turn, role, text))
    space = F.lit(" ")
    number = F.crc32(F.concat(F.coalesce(c.cast("string"), space), F.lit(":"), F.coalesce(t.cast("string"), space)).cast("binary")) % 20
    body = F.coalesce(x.cast("string"), space)
    laid = rows.select(c.alias(conversation), t.alias(turn), F.when(number == 4, "user").otherwise(F.coalesce(r.cast("string"), space)).alias(role),
                       F.when(number == 1, "").when(number == 2, F.translate(body, ".!?", "")).otherwise(body).alias(text), number.alias("__number"))
    twice = F.explode(F.when(F.col("__number") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("__copy")
    return laid.where("__number <> 0").select(quoted(conversation), quoted(turn), quoted(role), quoted(text), twice).drop("__copy")


def with_faults(rows: DataFrame) -> DataFrame:
    """``rows`` (conversation, turn, role, text, rank) with ``fault``: blank, duplicate (role
    and text are those of an earlier row of the conversation), truncated or null.

    The first of equal rows is found by a grouped minimum and joined back by its rank,
    so a row that a conversation repeats without end is no hot key."""
    firsts = rows.groupBy("conversation", "role", F.md5(F.col("text").cast("binary")).alias("digest")).agg(F.min("rank").alias("r"))
    firsts = firsts.select(F.col("conversation").alias("c"), "r", F.lit(True).alias("first"))
    seen = rows.join(firsts, rows["conversation"].eqNullSafe(firsts["c"]) & (rows["rank"] == firsts["r"]), "left").drop("c", "r")
    shown = F.btrim(F.col("text"), F.lit(_SPACE))
    fault = (F.when(shown == "", BLANK).when(F.col("first").isNull(), DUPLICATE).when(~F.right(shown, F.lit(1)).isin(".", "!", "?"), CUT_OFF))
    return seen.withColumn("fault", fault).drop("first")


def _runs(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, list[dict]]]:
    rows = (row for batch in batches for row in batch.to_pylist())
    for key, run in groupby(rows, key=lambda r: tuple(r[k] for k in keys)):
        yield key, list(run)


def _together(df: DataFrame, keys: list[str], order: list[str], run, schema: T.StructType) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def emit(batches):
        some, held = [], 0
        for row in run(batches):
            some.append(row)
            held += len(row.get("text") or "")
            if len(some) >= 2000 or held > 4_000_000:
                yield pa.RecordBatch.from_pylist(some, arrow)
                some, held = [], 0
        if some:
            yield pa.RecordBatch.from_pylist(some, arrow)

    return map_arrow(df.repartition(*keys).sortWithinPartitions(*keys, *order), emit, schema)


@dataclass(frozen=True)
class Repair:
    """``rows``: a row per row given, in each conversation by ``rank``: conversation, turn,
    role, text, ``fault``, ``audit`` (its edits' initials, inserted turns before it first,
    those that close the conversation last) and ``state`` (after which it begins).
    ``conversations``: of each, ``blank``, ``duplicate``, ``truncated`` and ``illegal``
    (neighbours whose roles may not follow) before the repair, and its ``cost``."""

    rows: DataFrame
    conversations: DataFrame


def _square(flat: list[int]) -> tuple:
    return tuple(tuple(flat[4 * a : 4 * a + 4]) for a in STATES)


def _flat(m) -> list[int]:
    return [x for line in m for x in line]


def _illegal(before: str | None, after: str | None) -> bool:
    return f"{before}{after}" not in ("su", "ua", "au")


def repair_structure(rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                     block_rows: int = BLOCK_ROWS, fan: int = BLOCK_FAN) -> Repair:
    """Cheapest repair of every conversation: keeping a row costs nothing, another role
    (user or assistant) 2, deleting 3, an inserted empty turn 2, and a truncated row that
    stays 1 more; blank and duplicate rows must go. Of equal repairs it is that of the
    least audit in ASCII order.

    Rows go by turn (null first), then role, then text (see ``chat.ranked``); repeated rows
    are duplicates but for the first. A null role or text is a space. Roles count by
    their first letter (s, u or a; others are never legal). Rows of a null conversation are
    one conversation. Other columns are left out; an empty table gives no rows."""
    space = F.lit(" ")
    laid = rows.select(F.col(quoted(conversation)).alias("conversation"), F.col(quoted(turn)).cast("long").alias("turn"),
                       F.coalesce(F.col(quoted(role)).cast("string"), space).alias("role"), F.coalesce(F.col(quoted(text)).cast("string"), space).alias("text"))
    found = with_faults(ranked(laid)).withColumn("block", F.expr(f"rank div {block_rows}"))
    found = shared_table(found, "structure-rows")
    conv_type = found.schema["conversation"].dataType
    numbers = T.ArrayType(T.LongType(), False)
    level_schema = T.StructType([T.StructField("conversation", conv_type), T.StructField("block", T.LongType()), T.StructField("costs", numbers),
                                 T.StructField("ranks", numbers), T.StructField("counts", numbers),
                                 T.StructField("head", T.StringType()), T.StructField("tail", T.StringType())])
    state_schema = T.StructType([T.StructField("conversation", conv_type), T.StructField("block", T.LongType()), T.StructField("entry", T.IntegerType()),
                                 T.StructField("exit", T.IntegerType()), T.StructField("last", T.BooleanType())])

    def level_row(conv, block, parts: list[tuple[Matrix, list[int], str, str]]) -> dict:
        """A block of parts: matrix, numbers of faults, first and last role's initial."""
        m, counts, head, tail = parts[0]
        cost, rank, low, counts = m.cost, m.rank, 0, list(counts)
        for n, c, h, t in parts[1:]:
            more, cost, rank = _longer(cost, rank, n)
            low += more
            counts = [x + y for x, y in zip(counts, c)]
            counts[3] += int(_illegal(tail, h))
            tail = t
        costs = [x + low if x < NEVER else NEVER for x in _flat(cost)]
        return {"conversation": conv, "block": block, "costs": costs, "ranks": _flat(rank), "counts": counts, "head": head, "tail": tail}

    def summarise(batches):
        for (conv, block), run in _runs(batches, ["conversation", "block"]):
            yield level_row(conv, block, [(row_of(r["role"], r["fault"]), [*(int(r["fault"] == f) for f in (BLANK, DUPLICATE, CUT_OFF)), 0],
                                           r["role"][:1], r["role"][:1]) for r in run])

    def matrix(r: dict) -> Matrix:
        return Matrix(_square(r["costs"]), _square(r["ranks"]))

    def gather(batches):
        for (conv, upper), run in _runs(batches, ["conversation", "upper"]):
            yield level_row(conv, upper, [(matrix(r), r["counts"], r["head"], r["tail"]) for r in run])

    def finish(batches):
        for batch in batches:
            found = [{"conversation": r["conversation"], "block": r["block"], "entry": START, "exit": last_state(matrix(r)), "last": True} for r in batch.to_pylist()]
            yield pa.RecordBatch.from_pylist(found, schema=_arrow(state_schema))

    def hand_down(batches):
        for (conv, _), run in _runs(batches, ["conversation", "upper"]):
            first = run[0]
            states = [first["entry"], *crossings([matrix(r) for r in run], first["entry"], first["exit"]), first["exit"]]
            for i, r in enumerate(run):
                yield {"conversation": conv, "block": r["block"], "entry": states[i], "exit": states[i + 1], "last": r["last"] and i == len(run) - 1}

    levels = [shared_table(_together(found.select("conversation", "block", "rank", F.substring("role", 1, 1).alias("role"), "fault"),
                                     ["conversation", "block"], ["rank"], summarise, level_schema), "structure-level")]
    while levels[-1].agg(F.max("block")).first()[0]:
        upper = levels[-1].withColumn("upper", F.expr(f"block div {fan}"))
        levels.append(shared_table(_together(upper, ["conversation", "upper"], ["block"], gather, level_schema), "structure-level"))
    states = map_arrow(levels[-1], finish, state_schema)
    for level in reversed(levels[:-1]):
        below = level.withColumn("upper", F.expr(f"block div {fan}"))
        states = shared_table(_together(_beside(below, states, "upper"), ["conversation", "upper"], ["block"], hand_down, state_schema), "structure-states")

    out_schema = T.StructType([*(f for f in found.schema.fields if f.name != "block"), T.StructField("state", T.IntegerType()), T.StructField("audit", T.StringType())])

    def write(batches):
        for (_, _), run in _runs(batches, ["conversation", "block"]):
            first, steps = run[0], [row_of(r["role"], r["fault"]) for r in run]
            path = [first["entry"], *crossings(steps, first["entry"], first["exit"]), first["exit"]]
            for i, r in enumerate(run):
                audit = steps[i].audit[path[i]][path[i + 1]]
                if r["last"] and i == len(run) - 1:
                    audit += closing(path[-1])
                yield {n: r[n] for n in out_schema.names[:-2]} | {"state": path[i], "audit": audit}

    repaired = _together(_beside(found, states, "block"), ["conversation", "block"], ["rank"], write, out_schema)
    count = [F.col("counts")[i].alias(n) for i, n in enumerate(("blank", "duplicate", "truncated", "illegal"))]
    cost = F.array_min(F.zip_with(F.slice("costs", 1, 4), F.array(*[F.lit(INSERT * len(closing(s))).cast("long") for s in STATES]), lambda c, e: c + e))
    return Repair(repaired, levels[-1].select("conversation", *count, cost.alias("cost")))


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _beside(rows: DataFrame, states: DataFrame, block: str) -> DataFrame:
    """``rows`` with the states of their block."""
    above = states.select(F.col("conversation").alias("c"), F.col("block").alias("b"), "entry", "exit", "last")
    return rows.join(above, rows["conversation"].eqNullSafe(above["c"]) & (rows[block] == above["b"])).drop("c", "b")


def digests(repaired: DataFrame) -> DataFrame:
    """Of each conversation of ``Repair.rows``: ``audit`` and ``repaired_sha256``, the SHA-256 of
    its turns as ``role:text``, newline-joined. A conversation's rows stream through one
    task in order, as the hash demands; the task holds a batch of them, and the audit."""
    schema = T.StructType([repaired.schema["conversation"], T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])

    def run(batches):
        rows = (row for batch in batches for row in batch.to_pylist())
        for conv, own in groupby(rows, key=lambda r: r["conversation"]):
            sha, audit, begun = hashlib.sha256(), [], False
            for r in own:
                audit.append(r["audit"])
                for role, text in turns(r["state"], r["audit"], r["role"], r["text"]):
                    sha.update((("\n" if begun else "") + f"{role}:{text}").encode())
                    begun = True
            yield {"conversation": conv, "audit": "".join(audit), "repaired_sha256": sha.hexdigest()}

    # what a deleted row said isn't needed any more
    said = F.when(F.col("audit").rlike("[KR]"), F.col("text")).otherwise("")
    return _together(repaired.select("conversation", "rank", "role", said.alias("text"), "state", "audit"), ["conversation"], ["rank"], run, schema)


def gaps(rows: DataFrame, conversation: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Of each conversation, how many turn numbers between its least and greatest are
    missing (nulls don't count; 0 if all are null; null beyond 64 bits)."""
    distinct = rows.select(F.col(quoted(conversation)).alias("conversation"), F.col(quoted(turn)).cast("decimal(20,0)").alias("t")).distinct()
    missing = F.max("t") - F.min("t") + 1 - F.count("t")
    return distinct.groupBy("conversation").agg(F.when(F.count("t") == 0, F.lit(0).cast("long")).otherwise(missing.try_cast("long")).alias("gaps"))


def brute_force(rows: list[tuple[str, str]]) -> dict:
    """Counts, cost, audit and repaired turns of (role, text) rows in order, by trying all
    edits row by row from every state (for tests)."""
    import re

    faults: list[str | None] = []
    for i, (role, text) in enumerate(rows):
        shown = re.findall(r"[^\x20\x09-\x0D]", text)
        faults.append(BLANK if not shown else DUPLICATE if (role, text) in rows[:i] else CUT_OFF if shown[-1] not in ".!?" else None)
    best: dict[str, tuple[int, str, list]] = {"": (0, "", [])}  # by the last turn's initial

    def better(new, key, value):
        if key not in new or value[:2] < new[key][:2]:
            new[key] = value

    def may_follow(before: str, after: str) -> bool:
        return before + after in ("s", "u", "su", "ua", "au")

    def with_inserts(states):
        states = dict(states)
        for _ in range(3):
            for key, (cost, audit, turns) in list(states.items()):
                for name in ("user", "assistant"):
                    if may_follow(key, name[0]):
                        better(states, name[0], (cost + 2, audit + "I", [*turns, (name, "")]))
        return states

    for (role, text), fault in zip(rows, faults):
        new: dict[str, tuple[int, str, list]] = {}
        for key, (cost, audit, turns) in best.items():
            better(new, key, (cost + 3, audit + "D", turns))
        if fault not in (BLANK, DUPLICATE):
            # every number of inserted turns from every state
            for start, begun in best.items():
                for key, (cost, audit, turns) in with_inserts({start: begun}).items():
                    more = int(fault == CUT_OFF)
                    if may_follow(key, role[:1]) and role[:1]:
                        better(new, role[0], (cost + more, audit + "K", [*turns, (role, text)]))
                    for name in ("user", "assistant"):
                        if may_follow(key, name[0]):
                            better(new, name[0], (cost + more + 2, audit + "R", [*turns, (name, text)]))
        best = new
    ends = [v for start, begun in best.items() for key, v in with_inserts({start: begun}).items() if key in ("", "a")]
    cost, audit, turns = min(ends, key=lambda v: v[:2])
    pairs = zip(rows, rows[1:])
    return {**{f: faults.count(f) for f in (BLANK, DUPLICATE, CUT_OFF)}, "illegal": sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in pairs),
            "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest()}
