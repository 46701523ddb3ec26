"""Chat formatting: minimum-cost role repair by dynamic programming, then rendering.

A legal conversation is an optional system turn and then user and assistant
turns in alternation, first the user's and last the assistant's. Each turn of
the input is kept, relabelled, merged into the turn before it, or preceded by
inserted empty turns, and the cheapest legal outcome is chosen by dynamic
programming over the automaton of legal turns (states: nothing yet, after a
system, user or assistant turn). Of several cheapest outcomes the one with the
smallest choice number at the latest possible turn counts, so it is unique.

Costs: RELABEL for another role, MERGE for joining the turn before, INSERT for
an empty turn. A turn without a known role must be relabelled.

A conversation may hold any share of the rows, so none is gathered: rows are
range-partitioned by (conversation, turn) into blocks of bounded size. What a
block has of a conversation acts on the automaton as a matrix of cheapest
costs between states; matrices of the blocks that a conversation spans are
chained (one small row a block), which fixes the state at each block's borders,
and every block then repairs its own part. The result has one row per piece of
the rendered conversations, in order, and never a whole conversation in a cell.

Edge cases: null roles and roles that are not known count as without role;
null texts are empty; rows with a null conversation id are one conversation;
null turns come first; rows of one turn are ordered by role and text, and rows
that occur twice are two turns; an empty table gives an empty result; other
columns are ignored whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize, pick, prepare

RELABEL, MERGE, INSERT = 2, 1, 4
ROLES = ("system", "user", "assistant")
#: Other names of roles.
ALIASES = {"human": "user", "prompter": "user", "bot": "assistant", "gpt": "assistant", "model": "assistant", "ai": "assistant"}
BLOCK_ROWS = 20_000
FAR = 1 << 40

#: Legal next roles of each state; states are 0 and 1 + the last role's place.
_NEXT = {0: (0, 1), 1: (1,), 2: (2,), 3: (1,)}


def role_place(role: str | None) -> int:
    """0-2 for a known role, else -1."""
    name = (role or "").strip().lower()
    name = ALIASES.get(name, name)
    return ROLES.index(name) if name in ROLES else -1


def _steps(role: int) -> list[list[tuple[int, int, int, int]]]:
    """For each state before a turn: (cost, choice, state after, inserted role or -1) of every legal choice."""
    out = []
    for state in range(4):
        found = []
        for target in range(3):
            base = 0 if target == role else RELABEL
            if target in _NEXT[state]:
                found.append((base, target, target + 1, -1))
            if state == target + 1:
                found.append((base + MERGE, 3 + target, target + 1, -1))
            for empty in _NEXT[state]:
                if target not in _NEXT[state] and target in _NEXT[empty + 1]:
                    found.append((base + INSERT, 6 + 3 * empty + target, target + 1, empty))
        out.append(found)
    return out


STEPS = {role: _steps(role) for role in (-1, 0, 1, 2)}
#: Cost of closing a conversation in each state, and the empty turns that do it.
CLOSING = {0: (0, ()), 1: (2 * INSERT, (1, 2)), 2: (INSERT, (2,)), 3: (0, ())}


def forward(roles: list[int], first: list[int]) -> tuple[list[int], list[list[tuple]]]:
    """Cheapest cost to each state after all turns, and each turn's best (cost, choice, before, inserted)."""
    costs, backs = first, []
    for role in roles:
        steps = STEPS[role]
        best: list[tuple] = [(FAR, 99, 0, -1)] * 4
        for state in range(4):
            if costs[state] < FAR:
                for cost, choice, after, empty in steps[state]:
                    entry = (costs[state] + cost, choice, state, empty)
                    if entry < best[after]:
                        best[after] = entry
        backs.append(best)
        costs = [b[0] for b in best]
    return costs, backs


def matrix(roles: list[int]) -> list[list[int]]:
    """Cheapest cost from each state before the turns to each state after them."""
    return [forward(roles, [0 if s == state else FAR for s in range(4)])[0] for state in range(4)]


def trace(backs: list[list[tuple]], last: int) -> list[tuple[int, int, int]]:
    """(state before, choice, inserted role) of every turn, ending in state ``last``."""
    out = []
    for best in reversed(backs):
        _, choice, state, empty = best[last]
        out.append((state, choice, empty))
        last = state
    return out[::-1]


def chain(matrices: list[list[list[int]]]) -> list[tuple[int, int]]:
    """States before and after each of a conversation's parts, of the cheapest way through."""
    costs, backs = [0, FAR, FAR, FAR], []
    for m in matrices:
        best = [min((costs[s] + m[s][t], s) for s in range(4)) for t in range(4)]
        backs.append([b[1] for b in best])
        costs = [min(b[0], FAR) for b in best]
    state = min(range(4), key=lambda s: (costs[s] + CLOSING[s][0], s))
    out = []
    for back in reversed(backs):
        out.append((back[state], state))
        state = back[state]
    return out[::-1]


def repaired(rows: list[tuple[int, str]], before: int, after: int, closes: bool) -> list[tuple[str, str, str, int]]:
    """(role, action, text, cost) of the pieces of one part, from state ``before`` to ``after``."""
    roles = [r for r, _ in rows]
    _, backs = forward(roles, [0 if s == before else FAR for s in range(4)])
    out = []
    for (_, choice, empty), (role, text) in zip(trace(backs, after), rows, strict=True):
        target = choice % 3
        if empty >= 0:
            out.append((ROLES[empty], "insert", "", INSERT))
        changed = RELABEL if target != role else 0
        if 3 <= choice < 6:
            out.append((ROLES[target], "merge", text, MERGE + changed))
        else:
            out.append((ROLES[target], "relabel" if changed else "keep", text, changed))
    if closes:
        out += [(ROLES[r], "insert", "", INSERT) for r in CLOSING[after][1]]
    return out


def render(role: str, action: str, text: str) -> str:
    """A piece of the rendered conversation; pieces in order make it whole."""
    return f"\n{text}" if action == "merge" else f"<|{role}|>\n{text}"


def blocks(spark: SparkSession, turns: DataFrame, conv: str, turn: str, role: str, text: str, block_rows: int) -> DataFrame:
    """The turns in order, with the number of their block and their place in it."""
    import pyarrow as pa

    rows = pick(turns, conv=conv, turn=turn, role=role, text=text)
    count = rows.count() // block_rows + 1
    order = ["conv", "turn", "role", "text"]
    # equal rows may be any number; a row number parts them
    dealt = rows.withColumn("_n", F.monotonically_increasing_id()).repartitionByRange(int(count), *order, "_n").sortWithinPartitions(*order, "_n").drop("_n")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block, at = TaskContext.get().partitionId(), 0
        for b in batches:
            n = b.num_rows
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, block, np.int32)), pa.array(np.arange(at, at + n, dtype=np.int32)), *(b.column(i) for i in range(4))], names=["block", "place", *order])
            at += n

    kinds = {c: rows.schema[c].dataType.simpleString() for c in order}
    return materialize(dealt.mapInArrow(number, f"block int, place int, {', '.join(f'{c} {k}' for c, k in kinds.items())}"), "turns")


def _parts(rows) -> Iterator[tuple[object, list[tuple[int, str]], bool, bool]]:
    """(conversation, [(role, text)], is first of block, is last of block) of a sorted block."""
    import pandas as pd

    names = [None if pd.isna(c) else c for c in rows["conv"].tolist()]
    data = list(zip(map(role_place, (None if pd.isna(r) else r for r in rows["role"])), ("" if pd.isna(t) else t for t in rows["text"]), strict=True))
    start = 0
    for i in range(1, len(names) + 1):
        if i == len(names) or names[i] != names[start]:
            yield names[start], data[start:i], start == 0, i == len(names)
            start = i


def repair(spark: SparkSession, turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(conv, part, piece, role, action, cost, fragment): the rendered conversations, piece by piece.

    Pieces are ordered by (part, piece) within a conversation.
    """
    import pandas as pd

    prepare(spark)
    rows = blocks(spark, turns, conv, turn, role, text, block_rows)
    kind = rows.schema["conv"].dataType.simpleString()
    nullable = {"bigint": "Int64", "int": "Int32"}.get(kind, "object")

    def borders(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("place")
        out = [(name, int(block["block"].iloc[0]), [c for line in matrix([r for r, _ in data]) for c in line]) for name, data, first, last in _parts(block) if first or last]
        found = pd.DataFrame(out, columns=["conv", "block", "costs"])
        return found.astype({"conv": nullable})

    def chained(parts: pd.DataFrame) -> pd.DataFrame:
        parts = parts.sort_values("block")
        ways = chain([np.array(c).reshape(4, 4).tolist() for c in parts["costs"]])
        return pd.DataFrame({"conv": parts["conv"].astype(nullable), "block": parts["block"], "before": [a for a, _ in ways], "after": [b for _, b in ways], "closes": [i == len(parts) - 1 for i in range(len(parts))]})

    spans = rows.groupBy("block").applyInPandas(borders, f"conv {kind}, block int, costs array<long>")
    states = spans.groupBy("conv").applyInPandas(chained, f"conv {kind}, block int, before int, after int, closes boolean").select(F.col("conv").alias("at_conv"), F.col("block").alias("at"), "before", "after", "closes")

    def whole(block: pd.DataFrame, ways: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("place")
        known = {None if pd.isna(c) else c: (b, a, z) for c, b, a, z in zip(ways["at_conv"], ways["before"], ways["after"], ways["closes"], strict=True)}
        out = []
        number = int(block["block"].iloc[0]) if len(block) else 0
        for name, data, first, last in _parts(block):
            if first or last:
                before, after, closes = known[name]
            else:
                (before, after), closes = chain([matrix([r for r, _ in data])])[0], True
            for i, (who, action, content, cost) in enumerate(repaired(data, int(before), int(after), bool(closes))):
                out.append((name, number, i, who, action, cost, render(who, action, content)))
        return pd.DataFrame(out, columns=["conv", "part", "piece", "role", "action", "cost", "fragment"]).astype({"conv": nullable})

    return rows.groupBy("block").cogroup(states.groupBy("at")).applyInPandas(whole, f"conv {kind}, part int, piece int, role string, action string, cost int, fragment string")


def formatted(spark: SparkSession, turns: DataFrame) -> DataFrame:
    """(conv_id, piece, role, action, cost, fragment) of every conversation, pieces numbered from 0."""
    found = materialize(repair(spark, turns), "pieces")
    # numbers go on from part to part: counts of parts, not pieces, meet per conversation
    sizes = found.groupBy("conv", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    later = sizes.withColumn("before", F.sum("n").over(earlier)).where("before > 0").select(F.col("conv").alias("c"), F.col("part").alias("p"), "before")
    both = found.join(later, found.conv.eqNullSafe(later.c) & (found.part == later.p), "left")
    piece = (F.coalesce("before", F.lit(0)) + F.col("piece")).cast("long").alias("piece")
    return both.select(F.col("conv").alias("conv_id"), piece, "role", "action", "cost", "fragment")
