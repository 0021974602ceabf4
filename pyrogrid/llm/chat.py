"""Chat formatting with minimum-cost role repair.

A conversation is legal if it is an optional system turn followed by pairs of a user and an assistant
turn.  Turns that break this are repaired by the cheapest sequence of edits: keep a turn, relabel
its role, merge it into the turn before, or insert an empty turn before it (or at the end).  The choice
is a shortest path over the automaton of legal turns: state = role of the last turn written.

Turns are dealt to tasks by ranges of their order, so a conversation of any length, and one of any number of null or repeated turns,
is spread over as many tasks as it needs.  A conversation within one range is solved there.  One that goes on in the next range
hands on the table of its costs from state to state (16 numbers, whatever the number of turns), of which there are two a range at most;
these are combined in order, and each range then replays the path between the states it was given.
Results are rows per turn, so no conversation is gathered in one row.

Defined results: null and unknown roles cost as a relabelling does, whichever role they get; null texts
render as empty; very long texts are rendered whole; turns are ordered by turn (nulls first), then role, then text; repeated rows are turns of their own;
a null conv_id is one conversation; an empty table gives an empty result; columns beside the four are not read and may have any name.
In a text ``<|``, which begins the marks of turns, gets a backslash after its first character (one more where it has some),
so that no text can pass for a mark.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, small_batches

ROLES = ("system", "user", "assistant")
#: State 0 is the start; state r + 1 is "the last turn written has role r".
STATES = 4
KEEP, MERGE, RELABEL, INSERT = 0.0, 1.0, 2.0, 3.0
NEXT = {0: (1, 2), 1: (2,), 2: (3,), 3: (2,)}
FINAL = 3
#: Characters of a text that take part in dealing turns to ranges; rows alike up to there share one.
KEY_CHARS = 32
MARK = re.compile(r"<(\\*\|)")


def inserts() -> list[list[tuple[float, tuple[int, ...]]]]:
    """Cheapest empty turns that lead from state to state: cost and the states passed."""
    best: list[list[tuple[float, tuple[int, ...]]]] = [[(np.inf, ())] * STATES for _ in range(STATES)]
    for s in range(STATES):
        best[s][s] = (0.0, ())
        edge = [s]
        while edge:
            edge_next = []
            for a in edge:
                cost, path = best[s][a]
                for b in NEXT[a]:
                    if cost + INSERT < best[s][b][0]:
                        best[s][b] = (cost + INSERT, (*path, b))
                        edge_next.append(b)
            edge = edge_next
    return best


FILL = inserts()


def moves(role: int | None) -> list[list[tuple[float, str, tuple[int, ...]]]]:
    """For a turn of a role: from state to state, the cheapest cost, the action, and the empty turns before it."""
    table: list[list[tuple[float, str, tuple[int, ...]]]] = [[(np.inf, "", ())] * STATES for _ in range(STATES)]
    for s in range(STATES):
        for to in range(1, STATES):
            change = KEEP if role == to - 1 else RELABEL
            options = [(change + FILL[s][a][0], "keep" if not change else "relabel", FILL[s][a][1]) for a in range(STATES) if to in NEXT[a]]
            if s == to:
                options.append((MERGE + change, "merge", ()))
            # ties: fewer empty turns, then the name of the action
            table[s][to] = min(options, key=lambda o: (o[0], len(o[2]), o[1]))
    return table


MOVES = {r: moves(r) for r in (None, 0, 1, 2)}
COSTS = {r: np.array([[x[0] for x in row] for row in m]) for r, m in MOVES.items()}


def role_of(name: str | None) -> int | None:
    name = (name or "").strip().lower()
    return ROLES.index(name) if name in ROLES else None


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Costs of a then b."""
    return (a[:, :, None] + b[None, :, :]).min(axis=1)


def block_costs(roles: list[int | None]) -> np.ndarray:
    total = np.where(np.eye(STATES, dtype=bool), 0.0, np.inf)
    for r in roles:
        total = combine(total, COSTS[r])
    return total


def replay(roles: list[int | None], start: int, end: int) -> list[tuple[int, float, str, tuple[int, ...]]]:
    """Per turn: the state after it, cost, action and empty turns, along a cheapest path from start to end."""
    cost = np.full(STATES, np.inf)
    cost[start] = 0.0
    came = []
    for r in roles:
        through = cost[:, None] + COSTS[r]
        came.append(through.argmin(axis=0))
        cost = through.min(axis=0)
    at, path = end, []
    for i in reversed(range(len(roles))):
        before = int(came[i][at])
        c, action, fill = MOVES[roles[i]][before][at]
        path.append((at, c, action, fill))
        at = before
    return path[::-1]


def precedence(roles: list[int | None], costs: np.ndarray) -> list[int]:
    """For each start and end state the start's place among all starts, if they cost alike: by their paths, compared from the end.

    A path replayed over the whole conversation takes the least state before each one; so do its pieces, by this order.
    """
    place = np.zeros((STATES, STATES), int)
    for end in range(STATES):
        known = [s for s in range(STATES) if costs[s, end] < np.inf]
        paths = {s: [at for at, *_ in replay(roles, s, end)][::-1] for s in known}
        for i, s in enumerate(sorted(known, key=lambda s: (paths[s], s))):  # noqa: B023
            place[s, end] = i
    return place.ravel().tolist()


def end_state(costs: np.ndarray) -> int:
    """The state to end the turns in, empty turns at the end counted."""
    closing = np.array([FILL[s][FINAL][0] for s in range(STATES)])
    return int((costs + closing).argmin())


def escaped(text: str | None) -> str:
    return MARK.sub(r"<\\\1", text or "")


def in_ranges(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Columns conv_id, turn, role, text in ranges of their order, sorted, and materialised so that the ranges stay as they are."""
    rows = turns.select(F.col(conv).alias("conv_id"), F.col(turn).cast("long").alias("turn"), F.col(role).cast("string").alias("role"), F.col(text).cast("string").alias("text"))
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    body = F.coalesce("text", F.lit(""))
    keys = ["conv_id", "turn", F.coalesce("role", F.lit("")), F.substring(body, 1, KEY_CHARS)]
    return cut(rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys, body))


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """A range's rows by conversation; each has to be there as a whole for its path."""
    held: list[tuple] = []
    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if held and row[0] != held[-1][0]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def joined_pieces(tables: list[tuple]) -> dict[tuple[int, object], tuple[int, int, int, bool]]:
    """Of rows (range, conv_id, n, m, places) in order, of the first and last conversation of each range: what each piece of one that spans
    ranges needs, by (range, conv_id): start state, end state, turns before it, and whether it is the last one."""
    chains: list[list[tuple]] = []
    for row in tables:
        if chains and chains[-1][-1][1] == row[1] and chains[-1][-1][0] != row[0]:
            chains[-1].append(row)
        else:
            chains.append([row])
    out = {}
    for chain in (c for c in chains if len(c) > 1):
        each = [np.array(m).reshape(STATES, STATES) for *_, m, _ in chain]
        places = [np.array(p).reshape(STATES, STATES) for *_, p in chain]
        reach = [np.where(np.arange(STATES) == 0, 0.0, 1e18)]
        for m in each:
            reach.append((reach[-1][:, None] + m).min(axis=0))
        ends = [end_state(reach[-1])]
        for i in reversed(range(len(each))):
            through = reach[i] + each[i][:, ends[-1]]
            best = np.flatnonzero(through == through.min())
            ends.append(int(best[places[i][best, ends[-1]].argmin()]))
        ends.reverse()
        done = np.cumsum([0] + [n for _, _, n, *_ in chain])
        for i, (part, name, *_) in enumerate(chain):
            out[part, name] = (ends[i], ends[i + 1], int(done[i]), i == len(chain) - 1)
    return out


def repair(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Per turn: conv_id, turn, seq (its place), role_in, role_out, action, cost, empty_before, empty_after, rendered.

    The rendered pieces of a conversation, joined in the order of seq, are its chat text.
    """
    rows = small_batches(in_ranges(turns, conv, turn, role, text))
    kind = dict(rows.dtypes)["conv_id"]

    def ends_of_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The cost tables of a range's first and last conversation."""
        part, kept = TaskContext.get().partitionId(), []
        conv_kind = None

        def watched() -> Iterator[pa.RecordBatch]:
            nonlocal conv_kind
            for b in batches:
                conv_kind = b.schema.field("conv_id").type
                yield b.select(["conv_id", "role"])

        for group in _groups(watched()):
            kept = [*kept[:1], (group[0][0], len(group), [role_of(r[1]) for r in group])]
        if kept:
            costs = [block_costs(roles) for *_, roles in kept]
            m = [np.where(np.isinf(c), 1e18, c).ravel().tolist() for c in costs]
            places = [precedence(roles, c) for (*_, roles), c in zip(kept, costs, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * len(kept), pa.int32()), pa.array([k[0] for k in kept], conv_kind), pa.array([k[1] for k in kept], pa.int64()), pa.array(m, pa.list_(pa.float64())), pa.array(places, pa.list_(pa.int32()))],
                names=["part", "conv_id", "n", "m", "places"],
            )

    tables = rows.mapInArrow(ends_of_range, f"part int, conv_id {kind}, n long, m array<double>, places array<int>").collect()  # two rows a range at most
    # a stable sort: a range's first conversation stays before its last
    spans = turns.sparkSession.sparkContext.broadcast(joined_pieces([tuple(r) for r in sorted(tables, key=lambda r: r["part"])]))

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out, conv_kind = TaskContext.get().partitionId(), [], None

        def watched() -> Iterator[pa.RecordBatch]:
            nonlocal conv_kind
            for b in batches:
                conv_kind = b.schema.field("conv_id").type
                yield b

        def batch() -> pa.RecordBatch:
            types = [conv_kind, pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.int32(), pa.int32(), pa.string()]
            names = ["conv_id", "turn", "seq", "role_in", "role_out", "action", "cost", "empty_before", "empty_after", "rendered"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), types, strict=True)], names=names)

        for group in _groups(watched()):
            roles = [role_of(r[2]) for r in group]
            start, end, offset, last = spans.value.get((part, group[0][0])) or (0, end_state(block_costs(roles)[0]), 0, True)
            for i, ((name, at_turn, role_in, body), (at, cost, action, fill)) in enumerate(zip(group, replay(roles, start, end), strict=True)):
                closes = last and i == len(group) - 1
                closing = FILL[at][FINAL][1] if closes else ()
                cost += INSERT * len(closing)
                if action == "merge":
                    piece = "\n" + escaped(body)
                else:
                    opened = i > 0 or offset > 0
                    piece = ("\n<|end|>\n" if opened else "") + "".join(f"<|{ROLES[s - 1]}|>\n\n<|end|>\n" for s in fill) + f"<|{ROLES[at - 1]}|>\n" + escaped(body)
                if closes:
                    piece += "\n<|end|>\n" + "".join(f"<|{ROLES[s - 1]}|>\n\n<|end|>\n" for s in closing)
                out.append((name, at_turn, offset + i, role_in, ROLES[at - 1], action, cost, len(fill), len(closing), piece))
                if len(out) >= 1000:
                    yield batch()
                    out = []
        if out:
            yield batch()

    schema = f"conv_id {kind}, turn long, seq long, role_in string, role_out string, action string, cost double, empty_before int, empty_after int, rendered string"
    return rows.mapInArrow(written, schema)
