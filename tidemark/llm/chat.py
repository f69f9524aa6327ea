"""Minimum-cost role repair of conversations, and chat formatting.

Legal turns are: a system turn or none, then user and assistant in turn, closed
by an assistant. Dynamic programming over this automaton's states (the role put
out last) chooses for each turn to keep its role or to relabel it, to merge it
into the turn before, and which empty turns to insert, at least cost.

A stretch of turns acts on the states as a matrix of least costs, and matrices of
consecutive stretches combine. So long conversations are cut into blocks, blocks
into blocks of blocks, until one is left; its best states are handed down again,
and each block finds its own path between the states it was given. Blocks are cut
by a row's rank in its conversation, whatever its turn's number, so no task holds
more than a block, however long a conversation is.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import map_arrow, quoted, shared_table

ROLES = ("start", "system", "user", "assistant")
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
NEVER = float("inf")
#: Turns of a block, and blocks of a larger block.
BLOCK_TURNS, BLOCK_FAN = 512, 512
#: Characters of a text that order rows of one turn and role.
TEXT_ORDER = 256


@dataclass(frozen=True)
class Costs:
    relabel: float = 2.0
    relabel_unknown: float = 1.0
    merge: float = 1.0
    insert: float = 3.0


@cache
def inserted(state: int, role: int) -> tuple[int, ...] | None:
    """The fewest empty turns that lead from ``state`` to a legal ``role``; None if nothing does."""
    paths: list[tuple[int, ...]] = [()]
    for _ in ROLES:
        for path in paths:
            if role in NEXT[path[-1] if path else state]:
                return path
        paths = [(*p, n) for p in paths for n in NEXT[p[-1] if p else state]]
    return None


def step_cost(state: int, own: int | None, role: int, costs: Costs) -> tuple[float, bool]:
    """Cost of putting out a turn of role ``own`` as ``role`` after ``state``, and whether
    it is merged into the turn before."""
    relabel = 0.0 if own == role else costs.relabel_unknown if own is None else costs.relabel
    path = inserted(state, role)
    insert = NEVER if path is None else costs.insert * len(path)
    if state == role and costs.merge <= insert:
        return relabel + costs.merge, True
    return relabel + insert, False


def closing(state: int) -> tuple[int, ...]:
    """Empty turns after the last one, so that an assistant closes."""
    return () if state == ASSISTANT else (*inserted(state, ASSISTANT), ASSISTANT)


@cache
def turn_matrix(own: int | None, costs: Costs) -> tuple[tuple[float, ...], ...]:
    return tuple(tuple(NEVER if role == START else step_cost(state, own, role, costs)[0] for role in range(4)) for state in range(4))


IDENTITY = tuple(tuple(0.0 if a == b else NEVER for b in range(4)) for a in range(4))


def combined(x, y):
    return tuple(tuple(min(x[a][k] + y[k][b] for k in range(4)) for b in range(4)) for a in range(4))


def best_path(matrices: list, entry: int, exit_: int) -> list[int]:
    """The states after each of ``matrices`` on the cheapest way from ``entry`` to ``exit_``;
    of equal ways, the one of lower states last."""
    cost = [0.0 if s == entry else NEVER for s in range(4)]
    back: list[list[int]] = []
    for m in matrices:
        came = [min(range(4), key=lambda a, b=b: (cost[a] + m[a][b], a)) for b in range(4)]
        cost = [cost[came[b]] + m[came[b]][b] for b in range(4)]
        back.append(came)
    path = [exit_]
    for came in reversed(back[1:]):
        path.append(came[path[-1]])
    return path[::-1] if matrices else []


def _code(role: str | None) -> int | None:
    return ROLES.index(role) if role in ROLES[1:] else None


def _grouped(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, list[dict]]]:
    """Runs of rows that agree in ``keys``; a run may span batches."""
    rows = (row for batch in batches for row in batch.to_pylist())
    for key, run in groupby(rows, key=lambda r: tuple(r[k] for k in keys)):
        yield key, list(run)


def _together(df: DataFrame, keys: list[str], order: list[str], run: Callable, schema: T.StructType | str) -> DataFrame:
    return map_arrow(df.repartition(*keys).sortWithinPartitions(*keys, *order), run, schema)


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema)


def _emit(rows: Iterable[dict], schema: T.StructType) -> Iterator[pa.RecordBatch]:
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow, some = to_arrow_schema(schema), []
    for row in rows:
        some.append(row)
        if len(some) >= 2000:
            yield _batch(some, arrow)
            some = []
    if some:
        yield _batch(some, arrow)


def ranked(rows: DataFrame) -> DataFrame:
    """``rows`` (the conversation first) with ``rank``, from 0 in each conversation,
    by turn, role and text (its first ``TEXT_ORDER`` characters, then a hash).
    Sorted ranges of rows are numbered one by one. Only the first conversation of a
    range can go on from the ranges before; by how many rows, the driver adds up
    from two rows per range."""
    order = ["conversation", "turn", "role", "__head", "__hash", "__row"]
    laid = (rows.withColumn("__head", F.substring("text", 1, TEXT_ORDER)).withColumn("__hash", F.xxhash64("text"))
            .withColumn("__row", F.monotonically_increasing_id()))  # rows that are alike may lie in several ranges
    added = [T.StructField("part", T.IntegerType()), T.StructField("run", T.LongType()), T.StructField("place", T.LongType())]
    schema = T.StructType([*rows.schema.fields, *added])

    def number(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, current, run, place = TaskContext.get().partitionId(), None, -1, 0
        for batch in batches:
            runs, places = [], []
            for key in map(repr, batch.column(0).to_pylist()):
                if key != current:
                    current, run, place = key, run + 1, 0
                runs.append(run)
                places.append(place)
                place += 1
            columns = [pa.array([part] * batch.num_rows, pa.int32()), pa.array(runs, pa.int64()), pa.array(places, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=schema.names)

    placed = shared_table(map_arrow(laid.repartitionByRange(*order).sortWithinPartitions(*order).select(*rows.columns), number, schema), "chat-placed")
    ends = placed.groupBy("part").agg(F.max_by("conversation", F.struct("run", "place")).alias("last"), F.max("run").alias("runs"),
                                      F.max(F.struct("run", "place"))["place"].alias("place"), F.min_by("conversation", "run").alias("head"))
    before, going_on, open_rows = {}, None, 0
    for r in ends.orderBy("part").collect():
        before[r["part"]] = open_rows if repr(r["head"]) == going_on else 0
        open_rows = r["place"] + 1 + (before[r["part"]] if r["runs"] == 0 else 0)
        going_on = repr(r["last"])
    begun = placed.sparkSession.createDataFrame([(p, n) for p, n in before.items() if n], "part int, begun long")
    rank = F.col("place") + F.when(F.col("run") == 0, F.coalesce("begun", F.lit(0))).otherwise(F.lit(0))
    return placed.join(F.broadcast(begun), "part", "left").select(*rows.columns, rank.alias("rank"))


def repair(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           costs: Costs = Costs(), block_turns: int = BLOCK_TURNS, fan: int = BLOCK_FAN) -> DataFrame:
    """A row per turn: the conversation, turn and role as given, ``position`` (block and
    place in it), ``new_role``, ``action``, ``inserted_before``, ``inserted_after`` (roles,
    comma-joined) and ``rendered``. The rendered pieces of a conversation, joined by
    position, are its chat text.

    Turns go by number (null first), then role, then text (its first ``TEXT_ORDER``
    characters, then a hash); repeated turns all count, in blocks of ``block_turns`` rows.
    A null role or one that is none of system, user and assistant is unknown; a
    null text is empty. Rows of a null conversation are one conversation. Other
    columns are left out."""
    number = F.col(quoted(turn)).cast("long")
    rows = ranked(turns.select(F.col(quoted(conversation)).alias("conversation"), number.alias("turn"), F.col(quoted(role)).cast("string").alias("role"),
                               F.coalesce(F.col(quoted(text)).cast("string"), F.lit("")).alias("text"))).withColumn("block", F.expr(f"rank div {block_turns}"))
    conv_type = rows.schema["conversation"].dataType
    matrix = T.ArrayType(T.DoubleType(), False)
    level_schema = T.StructType([T.StructField("conversation", conv_type), T.StructField("block", T.LongType()), T.StructField("costs", matrix)])
    state_schema = T.StructType([T.StructField("conversation", conv_type), T.StructField("block", T.LongType()), T.StructField("entry", T.IntegerType()),
                                 T.StructField("exit", T.IntegerType()), T.StructField("last", T.BooleanType())])

    def flat_matrix(m) -> list[float]:
        return [x for line in m for x in line]

    def square(x: list[float]):
        return tuple(tuple(x[4 * a : 4 * a + 4]) for a in range(4))

    def summarise(batches):
        def found():
            for (conv, block), run in _grouped(batches, ["conversation", "block"]):
                m = IDENTITY
                for r in run:
                    m = combined(m, turn_matrix(_code(r["role"]), costs))
                yield {"conversation": conv, "block": block, "costs": flat_matrix(m)}
        return _emit(found(), level_schema)

    def gather(batches):
        def found():
            for (conv, upper), run in _grouped(batches, ["conversation", "upper"]):
                m = IDENTITY
                for r in run:
                    m = combined(m, square(r["costs"]))
                yield {"conversation": conv, "block": upper, "costs": flat_matrix(m)}
        return _emit(found(), level_schema)

    def finish(batches):
        def found():
            for batch in batches:
                for r in batch.to_pylist():
                    first = r["costs"][:4]
                    last = min(range(1, 4), key=lambda s: (first[s] + costs.insert * len(closing(s)), s))
                    yield {"conversation": r["conversation"], "block": r["block"], "entry": START, "exit": last, "last": True}
        return _emit(found(), state_schema)

    def hand_down(batches):
        def found():
            for (conv, _), run in _grouped(batches, ["conversation", "upper"]):
                path = best_path([square(r["costs"]) for r in run], run[0]["entry"], run[0]["exit"])
                for i, r in enumerate(run):
                    yield {"conversation": conv, "block": r["block"], "entry": path[i - 1] if i else r["entry"], "exit": path[i],
                           "last": r["last"] and i == len(run) - 1}
        return _emit(found(), state_schema)

    levels = [shared_table(_together(rows.select("conversation", "block", "rank", "role"), ["conversation", "block"], ["rank"], summarise, level_schema), "chat-level")]
    while True:
        shared = levels[-1].groupBy("conversation").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        if not shared.take(1):
            break
        upper = levels[-1].withColumn("upper", F.expr(f"block div {fan}"))
        levels.append(shared_table(_together(upper, ["conversation", "upper"], ["block"], gather, level_schema), "chat-level"))
    states = shared_table(map_arrow(levels[-1], finish, state_schema), "chat-states")
    for level in reversed(levels[:-1]):
        below = level.withColumn("upper", F.expr(f"block div {fan}"))
        above = states.select(F.col("conversation").alias("c"), F.col("block").alias("b"), "entry", "exit", "last")
        joined = below.join(above, below["conversation"].eqNullSafe(above["c"]) & (below["upper"] == above["b"])).drop("c", "b")
        states = shared_table(_together(joined, ["conversation", "upper"], ["block"], hand_down, state_schema), "chat-states")

    out_schema = T.StructType([T.StructField(conversation, conv_type), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
                               T.StructField("block", T.LongType()), T.StructField("position", T.LongType()), T.StructField("new_role", T.StringType()),
                               T.StructField("action", T.StringType()), T.StructField("inserted_before", T.StringType()),
                               T.StructField("inserted_after", T.StringType()), T.StructField("rendered", T.StringType())])

    def write(batches):
        def found():
            for (conv, block), run in _grouped(batches, ["conversation", "block"]):
                first = run[0]
                path = best_path([turn_matrix(_code(r["role"]), costs) for r in run], first["entry"], first["exit"])
                state = first["entry"]
                for i, r in enumerate(run):
                    ends = first["last"] and i == len(run) - 1
                    made = _turn(state, _code(r["role"]), path[i], r["text"], ends, costs)
                    yield {conversation: conv, "turn": r["turn"], "role": r["role"], "block": block, "position": i, **made}
                    state = path[i]
        return _emit(found(), out_schema)

    above = states.select(F.col("conversation").alias("c"), F.col("block").alias("b"), "entry", "exit", "last")
    placed = rows.join(above, rows["conversation"].eqNullSafe(above["c"]) & (rows["block"] == above["b"])).drop("c", "b")
    return _together(placed, ["conversation", "block"], ["rank"], write, out_schema)


def _turn(state: int, own: int | None, role: int, text: str, ends: bool, costs: Costs) -> dict:
    _, merged = step_cost(state, own, role, costs)
    before = () if merged else inserted(state, role)
    after = closing(role) if ends else ()
    text = text.replace("<|", "< |")  # a text can't open or close a turn
    rendered = "\n" + text if merged else ("" if state == START else "<|end|>\n") + "".join(map(_empty, before)) + f"<|{ROLES[role]}|>\n{text}"
    if ends:
        rendered += "<|end|>\n" + "".join(map(_empty, after))
    action = ("keep" if own == role else "relabel") + ("+merge" if merged else "")
    return {"new_role": ROLES[role], "action": action, "inserted_before": ",".join(ROLES[r] for r in before),
            "inserted_after": ",".join(ROLES[r] for r in after), "rendered": rendered}


def _empty(role: int) -> str:
    return f"<|{ROLES[role]}|>\n<|end|>\n"
