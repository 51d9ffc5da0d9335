"""Chat formatting by minimum-cost role repair.

A legal conversation is at most one system turn, then user and assistant turns in alternation,
user first, assistant last. Repairs are chosen by dynamic programming over that automaton, whose
states are the role last written: an input turn may be relabelled, merged into the turn before it
when their roles are equal, or have empty turns inserted before it; the end may get one, too. The
cheapest repair wins; of equal ones that whose states, seen from the end of the conversation and
then of each chunk, come first in the order SYSTEM, USER, ASSISTANT.

The recursion is a product of min-plus matrices, one per turn, so a long conversation needs no
single task: turns are dealt out in chunks of ``CHUNK`` places, each chunk gives its 4 x 4 matrix, the
matrices of a conversation are chained to find the best state at every chunk's ends, and each
chunk then traces its own best path between its ends and renders it.

Order is by ``turn``, then role, then text, so ties have a defined order; repeated rows are turns
each. Defined results: a null turn comes first; a null or unknown role may become any role at the
relabelling cost; roles are compared without case and outer blanks; a null text is empty; rows
with a null conv_id are one conversation of their own; an empty table gives an empty table; other
columns, whatever their names, are not looked at. A conversation of one chunk is one row.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROLES = ["start", "system", "user", "assistant"]
START, SYSTEM, USER, ASSISTANT = range(4)
CHUNK = 512
OPEN, CLOSE = "<|{role}|>\n", "\n<|end|>\n"


class Costs(NamedTuple):
    relabel: float = 3.0
    merge: float = 1.0
    insert: float = 1.0


def _steps(costs: Costs) -> tuple[np.ndarray, dict[tuple[int, int], list[int]]]:
    """Cost of writing role t after state s, and the empty turns that it takes. The same role again
    is a merge; a system turn is legal at the start alone."""
    cost, insert = np.full((4, 4), np.inf), {}
    for s in range(4):
        for t in (SYSTEM, USER, ASSISTANT):
            if s == t:
                cost[s, t] = costs.merge
            elif t == SYSTEM:
                if s == START:
                    cost[s, t] = 0.0
            elif t == USER or s == USER:
                cost[s, t] = 0.0
            else:  # an assistant turn before any user turn
                cost[s, t], insert[s, t] = costs.insert, [USER]
    return cost, insert


#: What it takes to end in each state: the last turn must be the assistant's.
_END = {START: [USER, ASSISTANT], SYSTEM: [USER, ASSISTANT], USER: [ASSISTANT], ASSISTANT: []}


def _turn(role: int, step: np.ndarray, costs: Costs) -> np.ndarray:
    """Min-plus matrix of one input turn; ``role`` 0 is unknown."""
    return step + np.array([np.inf] + [0.0 if t == role else costs.relabel for t in (SYSTEM, USER, ASSISTANT)])


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a[:, :, None] + b[None, :, :]).min(axis=1)


def best_path(roles: list[int], first: int, last: int | None, costs: Costs) -> list[int]:
    """The cheapest roles for the turns from state ``first``, to end in ``last`` (or anywhere legal, the
    end's cost counted)."""
    step, _ = _steps(costs)
    value = np.full(4, np.inf)
    value[first] = 0.0
    back = []
    for r in roles:
        total = value[:, None] + _turn(r, step, costs)
        back.append(total.argmin(axis=0))
        value = total.min(axis=0)
    if last is None:
        last = int(np.argmin(value + _end_cost(costs)))
    path = [last]
    for b in reversed(back[1:]):
        path.append(int(b[path[-1]]))
    return path[::-1] if roles else []


def _end_cost(costs: Costs) -> np.ndarray:
    return np.array([costs.insert * len(_END[s]) for s in range(4)])


class Repaired(NamedTuple):
    text: str
    merged: int
    relabelled: int
    inserted: int
    turns: int


def render(roles: list[int], texts: list[str], path: list[int], first: int, closes: bool, costs: Costs) -> Repaired:
    """The repaired turns as text. A chunk that goes on with the turn before it begins with its text."""
    _, insert = _steps(costs)
    out: list[str] = []
    state, merged, relabelled, inserted, turns = first, 0, 0, 0, 0
    begun = first != START  # a turn is open from the chunk before

    def open_turn(role: int) -> None:
        nonlocal begun, turns
        if begun:
            out.append(CLOSE)
        out.append(OPEN.format(role=ROLES[role]))
        begun, turns = True, turns + 1

    for r, text, t in zip(roles, texts, path, strict=True):
        relabelled += r != t
        if t == state:
            merged += 1
            out.append("\n" + text)
        else:
            for x in insert.get((state, t), []):
                open_turn(x)
                inserted += 1
            open_turn(t)
            out.append(text)
        state = t
    if closes:
        for x in _END[state]:
            open_turn(x)
            inserted += 1
        out.append(CLOSE)
    return Repaired("".join(out), merged, relabelled, inserted, turns)


def _numbered(conversations: DataFrame, chunk: int) -> DataFrame:
    role = F.lower(F.trim(F.coalesce(F.col("role").cast("string"), F.lit(""))))
    code: Column = F.lit(0)
    for k in (SYSTEM, USER, ASSISTANT):
        code = F.when(role == ROLES[k], F.lit(k)).otherwise(code)
    turn = F.col("turn").cast("long")
    return conversations.select(F.col("conv_id"), turn.alias("turn"), F.coalesce(F.floor(turn / chunk), F.lit(-(1 << 62))).cast("long").alias("chunk"),
                                code.cast("int").alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


_ORDER = [("turn", "ascending"), ("role", "ascending"), ("text", "ascending")]


def repair(conversations: DataFrame, costs: Costs = Costs(), chunk: int = CHUNK) -> DataFrame:
    """One row per conversation and chunk: conv_id, chunk (its number by place), n_turns, n_written (turns
    that begin here), n_merged, n_relabelled, n_inserted, cost, rendered. A conversation's text is its
    rows' ``rendered`` in the order of ``chunk``, and its cost their sum."""
    rows = _numbered(conversations, chunk)
    id_type = conversations.schema["conv_id"].dataType
    field = lambda n, t: T.StructField(n, t)
    numbers = [field(c, T.LongType()) for c in ("n_turns", "n_written", "n_merged", "n_relabelled", "n_inserted")]

    def matrix(table: pa.Table) -> pa.Table:
        step, _ = _steps(costs)
        total = np.where(np.eye(4, dtype=bool), 0.0, np.inf)
        for r in table.sort_by(_ORDER)["role"].to_pylist():
            total = product(total, _turn(r, step, costs))
        return pa.table({"conv_id": table["conv_id"][:1], "chunk": table["chunk"][:1], "matrix": pa.array([total.ravel().tolist()], pa.list_(pa.float64()))})

    def chain(table: pa.Table) -> pa.Table:
        table = table.sort_by([("chunk", "ascending")])
        value, back = np.array([0.0, np.inf, np.inf, np.inf]), []
        for m in table["matrix"].to_pylist():
            total = value[:, None] + np.array(m).reshape(4, 4)
            back.append(total.argmin(axis=0))
            value = total.min(axis=0)
        last = [int(np.argmin(value + _end_cost(costs)))]
        for b in reversed(back):
            last.append(int(b[last[-1]]))
        last = last[::-1]
        n = table.num_rows
        return pa.table({"conv_id": table["conv_id"], "chunk": table["chunk"], "first": pa.array(last[:-1], pa.int32()),
                         "last": pa.array(last[1:], pa.int32()), "closes": pa.array([k == n - 1 for k in range(n)])})

    schema = T.StructType([field("conv_id", id_type), field("chunk", T.LongType()), *numbers, field("cost", T.DoubleType()), field("rendered", T.StringType())])

    def trace(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by(_ORDER)
        roles, texts = left["role"].to_pylist(), left["text"].to_pylist()
        first, last, closes = (right[c][0].as_py() for c in ("first", "last", "closes"))
        r = render(roles, texts, best_path(roles, first, last, costs), first, closes, costs)
        cost = costs.merge * r.merged + costs.relabel * r.relabelled + costs.insert * r.inserted
        one = {"conv_id": left["conv_id"][:1], "chunk": left["chunk"][:1], "n_turns": [len(roles)], "n_written": [r.turns], "n_merged": [r.merged],
               "n_relabelled": [r.relabelled], "n_inserted": [r.inserted], "cost": [cost], "rendered": [r.text]}
        return pa.table(one)

    edge = T.StructType([field("conv_id", id_type), field("chunk", T.LongType())])
    matrices = rows.groupBy("conv_id", "chunk").applyInArrow(matrix, T.StructType([*edge, field("matrix", T.ArrayType(T.DoubleType()))]))
    ends = matrices.groupBy("conv_id").applyInArrow(chain, T.StructType([*edge, field("first", T.IntegerType()), field("last", T.IntegerType()), field("closes", T.BooleanType())]))
    return rows.groupBy("conv_id", "chunk").cogroup(ends.groupBy("conv_id", "chunk")).applyInArrow(trace, schema)
