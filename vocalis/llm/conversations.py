"""Repair of the structure of conversations by a Viterbi search over edits.

A conversation is legal if its roles are an optional system turn and then user and assistant in turn, ending with the
assistant. Rows may be kept, given another role, deleted or have empty turns inserted before them; the cheapest edits
win, and among equally cheap ones those whose initials come first in ASCII.

``Survivors`` runs the search over one row after another. For each state (nothing yet, system, user, assistant) the best
way to it survives. Ways are kept as a tree of edits pointing back to the row before, and a node goes when nothing
refers to it. As soon as all survivors share an ancestor, the edits up to it are final and are
emitted, so only the undecided end of a conversation is held. Equally cheap ways are compared by all of their undecided
edits: survivors are kept in that order, and as both ways go on from survivors, the order of the
survivors and then of the newest edits is the order of the whole ends. Ways that cost so much more than another that
no rest can make up for it are dropped, which lets the others meet.

Conversations may be of any length, so they are not gathered. Rows are sorted by range into blocks of even size; a
conversation that crosses blocks is searched in each block from all four states, the small tables of costs and orders
are put in a row, and each block then makes its own edits between two known states. The checksum of a repaired text
has to see it from its first byte to its last: for a conversation that crosses blocks one task streams the repaired
lines, without holding them; for all others it is made where the edits are.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from hashlib import sha256
from itertools import groupby
from operator import itemgetter

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from vocalis.llm import common

SPACES = " \t\n\x0b\x0c\r"
#: States: nothing yet, after a system turn, after a user's, after an assistant's. The first and the last may end.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
NAMES = ("", "system", "user", "assistant")
#: What edits cost, and what it costs not to delete a row that is cut off.
RENAME, DELETE, INSERT, CUT_OFF = 1, 2, 5, 5
#: Faults of a row; the first one counts.
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
AFTER_INSERT = (USER, USER, ASSISTANT, USER)
#: Turns to insert until a state may end.
MISSING = (0, 2, 1, 0)
#: A way to the first state is hopeless if it costs this much more than one to the second: what the second can
#: do at that price, the first cannot undercut.
HOPELESS = [
    (NOTHING, ASSISTANT, DELETE), (NOTHING, USER, INSERT + DELETE), (SYSTEM, ASSISTANT, 0), (SYSTEM, NOTHING, 0), (SYSTEM, USER, INSERT),
    (USER, ASSISTANT, INSERT), (USER, NOTHING, INSERT), (USER, SYSTEM, INSERT), (ASSISTANT, USER, INSERT), (ASSISTANT, NOTHING, 0),
]
CHUNK_BYTES = 1 << 20


def moves(initial: str, fault: int) -> list[list[tuple[int, int, str]]]:
    """For every state the states that a row can lead to: (state, cost, initials of the edits), the best way each."""
    found: list[list[tuple[int, int, str]]] = []
    for start in STATES:
        best: dict[int, tuple[int, str]] = {}
        state, cost, text = start, 0, ""
        for _ in range(3):  # a third insertion would only return to a state
            ways = [(state, DELETE, "D")]
            if fault in (SOUND, TRUNCATED):
                stay = CUT_OFF if fault == TRUNCATED else 0
                ways.append((AFTER_INSERT[state], RENAME + stay, "R"))
                if initial == NAMES[AFTER_INSERT[state]][0] or (initial == "s" and state == NOTHING):
                    ways.append((SYSTEM if initial == "s" else AFTER_INSERT[state], stay, "K"))
            for to, extra, edit in ways:
                best[to] = min(best.get(to, (1 << 60, "")), (cost + extra, text + edit))
            state, cost, text = AFTER_INSERT[state], cost + INSERT, text + "I"
        found.append([(to, *way) for to, way in sorted(best.items())])
    return found


MOVES = {(i, f): moves(i, f) for i in ("s", "u", "a", "") for f in range(4)}


def kind(initial: str, fault: int) -> tuple[str, int]:
    return (initial if initial in ("s", "u", "a") else "", fault)


class Survivors:
    """The best ways to each state, from one state on. Nodes are [node before, edits, nodes after]: a node is held as long as nodes after it are."""

    def __init__(self, entry: int = NOTHING):
        self.root: list = [None, "", []]
        self.live: list[tuple[int, int, list]] = [(entry, 0, self.root)]  # (state, cost, node) in the order of the edits

    def step(self, row: tuple[str, int]) -> list[str]:
        """Takes the next row; the edits that are final now, one string per row from the oldest on."""
        table = MOVES[row]
        best: dict[int, tuple[int, int, str]] = {}
        for order, (state, cost, _) in enumerate(self.live):
            for to, extra, edits in table[state]:
                way = (cost + extra, order, edits)
                if to not in best or way < best[to]:
                    best[to] = way
        costs = {state: way[0] for state, way in best.items()}
        for state, other, more in HOPELESS:
            if state in best and other in costs and costs[state] > costs[other] + more:
                del best[state]
        before, self.live = self.live, []
        for state, (cost, order, edits) in sorted(best.items(), key=lambda item: item[1][1:]):
            node = [before[order][2], edits, []]
            node[0][2].append(node)
            self.live.append((state, cost, node))
        for _, _, node in before:
            while not node[2] and node[0] is not None:
                siblings = node[0][2]
                siblings[:] = [n for n in siblings if n is not node]
                node = node[0]
        final = []
        while len(self.root[2]) == 1:
            self.root = self.root[2][0]
            self.root[0] = None
            final.append(self.root[1])
        return final

    def finish(self, exit: int | None = None) -> tuple[int, list[str]]:
        """Cost and remaining edits of the way that ends in ``exit``, or of the best one that ends legally, its last insertions included."""
        if exit is None:
            cost, order = min((cost + INSERT * MISSING[state], order) for order, (state, cost, _) in enumerate(self.live))
            state, _, node = self.live[order]
            last = ["I" * MISSING[state]]
        else:
            state, cost, node = next(s for s in self.live if s[0] == exit)
            last = []
        edits = []
        while node is not self.root:
            edits.append(node[1])
            node = node[0]
        return cost, edits[::-1] + last


def table_of(rows: list[tuple[str, int]]) -> tuple[list[int], list[int]]:
    """Costs and orders, 4 x 4 by state before and after a block; cost -1 where no way is worth taking."""
    costs, orders = [-1] * 16, [0] * 16
    for entry in STATES:
        search = Survivors(entry)
        for row in rows:
            search.step(row)
        for order, (state, cost, _) in enumerate(search.live):
            costs[4 * entry + state], orders[4 * entry + state] = cost, order
    return costs, orders


def between(tables: list[tuple[list[int], list[int]]]) -> list[tuple[int, int]]:
    """The states before and after each block on the best way through all of them."""
    live, steps = [(NOTHING, 0)], []  # (state, cost) in the order of the edits
    for costs, orders in tables:
        best: dict[int, tuple[int, int, int]] = {}
        for order, (entry, cost) in enumerate(live):
            for state in STATES:
                if costs[4 * entry + state] >= 0:
                    way = (cost + costs[4 * entry + state], order, orders[4 * entry + state])
                    best[state] = min(best.get(state, way), way)
        steps.append({state: live[way[1]][0] for state, way in best.items()})
        live = [(state, way[0]) for state, way in sorted(best.items(), key=lambda item: item[1][1:])]
    _, order = min((cost + INSERT * MISSING[state], order) for order, (state, cost) in enumerate(live))
    state, found = live[order][0], []
    for entries in reversed(steps):
        found.append((entries[state], state))
        state = entries[state]
    return found[::-1]


def repaired(state: int, edits: str, role: str, text: str) -> tuple[int, list[tuple[str, str]]]:
    """The turns that one row's edits leave, and the state after them."""
    turns = []
    for edit in edits:
        if edit == "D":
            continue
        state = SYSTEM if edit == "K" and state == NOTHING and role[:1] == "s" else AFTER_INSERT[state]
        turns.append((role, text) if edit == "K" else (NAMES[state], text if edit == "R" else ""))
    return state, turns


SUMMARY = "cost long, audit string, sha string, blank long, duplicate long, truncated long, illegal long, first_role string, last_role string, first_turn long, last_turn long, turns long"


def _edited(rows: Iterator[tuple], entry: int | None, exit: int | None) -> Iterator[tuple]:
    """The turns and the summary of one block: ("turns", bytes) for conversations that cross blocks, then ("all", summary)."""
    crosses, counts, waiting, audit = entry is not None, [0] * 4, deque(), []
    search, state = Survivors(entry or NOTHING), entry or NOTHING
    digest, held, held_bytes, first = sha256(), [], 0, True
    illegal, roles, turns, distinct = 0, [None, None], [None, None], 0

    def take(edits: str, role: str, text: str) -> None:
        nonlocal state, first, held_bytes
        audit.append(edits)
        state, kept = repaired(state, edits, role, text)
        for new_role, new_text in kept:
            line = f"{new_role}:{new_text}".encode()
            if crosses:
                held.append(b"\n" + line)
                held_bytes += 1 + len(line)
            else:
                digest.update(line if first else b"\n" + line)
            first = False

    for turn, role, text, fault in rows:
        counts[fault] += 1
        initial = role[:1]
        if roles[0] is None:
            roles[0] = initial
        elif roles[1] + initial not in ("su", "ua", "au"):
            illegal += 1
        roles[1] = initial
        if turn is not None:
            distinct += turn != turns[1]
            turns = [turn if turns[0] is None else turns[0], turn]
        waiting.append((role, text))
        for edits in search.step(kind(initial, fault)):
            take(edits, *waiting.popleft())
        if held_bytes >= CHUNK_BYTES:
            yield "turns", b"".join(held)
            held.clear()
            held_bytes = 0
    cost, rest = search.finish(exit if crosses and exit >= 0 else None)
    for edits in rest:
        take(edits, *(waiting.popleft() if waiting else ("", "")))
    if held:
        yield "turns", b"".join(held)
    yield "all", (cost, "".join(audit), None if crosses else digest.hexdigest(), *counts[1:], illegal, *roles, *turns, distinct)


def damaged(rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows (conv, turn, role, text) with one damage in four of twenty cases each, told by a checksum of conversation and turn."""
    blank = F.lit(" ")
    sum_ = F.crc32(F.concat(F.coalesce(F.col(conversation).cast("string"), blank), F.lit(":"), F.coalesce(F.col(turn).cast("string"), blank)).cast("binary")) % 20
    rows = rows.select(
        F.col(conversation).alias("conv"), F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role), blank).alias("role"),
        F.coalesce(F.col(text), blank).alias("text"), sum_.alias("damage"),
    )
    changed = F.when(F.col("damage") == 1, "").when(F.col("damage") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    renamed = F.when(F.col("damage") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("damage") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.where("damage <> 0").select("conv", "turn", renamed.alias("role"), changed.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def _same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def placed(rows: DataFrame) -> DataFrame:
    """Rows (conv, turn, role, text) with ``at``, which ascends over the whole table by conversation and turn, ``part``, its block,
    and ``fault``. Nulls come first; rows of one turn are ordered by a digest of role and text, so equal ones are neighbours."""
    digest = F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"))
    order = ["conv", "turn", "digest", "id"]
    rows = rows.select("conv", "turn", "role", "text", digest.alias("digest"), F.monotonically_increasing_id().alias("id"))
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("id").withColumn("at", F.monotonically_increasing_id())
    rows = common.written(rows).withColumn("part", F.shiftright("at", 33))
    trimmed = F.rtrim(F.col("text"), F.lit(SPACES))
    blank = trimmed == ""
    firsts = rows.where(~blank).groupBy(F.col("conv").alias("conv_"), F.col("digest").alias("digest_")).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    firsts = common.written(firsts.where("n > 1").drop("n"))
    rows = rows.join(firsts, _same(F.col("conv"), F.col("conv_")) & (F.col("digest") == F.col("digest_")), "left")
    cut = ~F.substring(trimmed, -1, 1).isin(".", "!", "?")
    fault = F.when(blank, BLANK).when(F.col("at") > F.col("first"), DUPLICATE).when(cut, TRUNCATED).otherwise(SOUND)
    return rows.select("conv", "turn", "role", "text", "at", "part", fault.alias("fault"))


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Neighbouring rows with the same first ``keys`` columns, streamed."""
    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
    return groupby(rows, key=itemgetter(*range(keys)))


def _batches(rows: Iterator[tuple], schema: T.StructType) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of bounded size."""
    arrow, held, size = to_arrow_schema(schema), [], 0
    for row in rows:
        held.append(row)
        size += 100 + sum(len(v) for v in row if isinstance(v, bytes | str))
        if size >= CHUNK_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), arrow)], schema=arrow)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), arrow)], schema=arrow)


def _plan(rows: DataFrame, conv_type: str) -> DataFrame:
    """(conv_, part_, entry, exit) of the blocks of conversations that cross blocks; the last one's exit is -1.

    At most two conversations of a block cross its ends, so there are at most two rows per block.
    """
    crossing = rows.groupBy(F.col("conv").alias("conv_")).agg(F.min("part").alias("least"), F.max("part").alias("most"))
    crossing = common.written(crossing.where("least < most").select("conv_"))
    inside = rows.join(F.broadcast(crossing), _same(F.col("conv"), F.col("conv_")))
    inside = inside.select("conv", "part", F.substring("role", 1, 1).alias("initial"), "fault", "at")
    schema = T.StructType.fromDDL(f"conv {conv_type}, part long, costs array<long>, orders array<long>")

    def tables(batches):
        blocks = ((*keys, [kind(r[2], r[3]) for r in run]) for keys, run in _runs(batches, 2))
        return _batches(((conv, part, *table_of(kinds)) for conv, part, kinds in blocks), schema)

    found = common.map_arrow(inside.repartition("part").sortWithinPartitions("part", "at"), tables, schema)

    def chosen(blocks: pd.DataFrame) -> pd.DataFrame:
        blocks = blocks.sort_values("part")
        ways = between(list(zip(blocks.costs, blocks.orders)))
        exits = [w[1] for w in ways[:-1]] + [-1]
        return pd.DataFrame({"conv_": blocks.conv, "part_": blocks.part, "entry": [w[0] for w in ways], "exit": exits})

    return common.written(found.groupBy("conv").applyInPandas(chosen, f"conv_ {conv_type}, part_ long, entry int, exit int"))


def _hashes(turns: DataFrame, conv_type: str) -> DataFrame:
    """(conv_, whole_sha): the checksum of the turns of every conversation that crosses blocks, streamed in order."""
    schema = T.StructType.fromDDL(f"conv_ {conv_type}, whole_sha string")

    def hashed(chunks: Iterator[tuple]) -> str:
        digest, first = sha256(), True
        for *_, data in chunks:
            digest.update(data[1:] if first else data)
            first = False
        return digest.hexdigest()

    def run(batches):
        return _batches(((conv, hashed(chunks)) for conv, chunks in _runs(batches, 1)), schema)

    ordered = turns.repartition("conv").sortWithinPartitions("conv", "part", "seq").select("conv", "part", "seq", "data")
    return common.map_arrow(ordered, run, schema)


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows`` (conv, turn, role, text): conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    conv_type = rows.schema["conv"].dataType.simpleString()
    rows = placed(rows)
    plan = _plan(rows, conv_type)
    rows = rows.join(F.broadcast(plan), _same(F.col("conv"), F.col("conv_")) & (F.col("part") == F.col("part_")), "left")
    rows = rows.select("conv", "part", "entry", "exit", "turn", "role", "text", "fault", "at")
    schema = T.StructType.fromDDL(f"conv {conv_type}, part long, seq long, data binary, {SUMMARY}")
    names = [f.name for f in schema.fields]

    def edited(batches):
        for (conv, part, entry, exit), run in _runs(batches, 4):
            for seq, (what, made) in enumerate(_edited((r[4:8] for r in run), entry, exit)):
                yield (conv, part, seq, *((made, *[None] * 12) if what == "turns" else (None, *made)))

    def edit(batches):
        return _batches(edited(batches), schema)

    made = common.map_arrow(rows.repartition("part").sortWithinPartitions("part", "at"), edit, schema)
    made = common.written(made)
    blocks = made.where(F.col("data").isNull()).drop("data", "seq").groupBy("conv")
    blocks = blocks.agg(F.sort_array(F.collect_list(F.struct(*[F.col(c) for c in names if c not in ("conv", "seq", "data")]))).alias("b"))
    joins = "size(filter(sequence(0, size(b) - 1), i -> i > 0 and {}))"
    same_turn = joins.format("b[i - 1].last_turn = b[i].first_turn")
    illegal = joins.format("concat(b[i - 1].last_role, b[i].first_role) not in ('su', 'ua', 'au')")
    total = "aggregate(b, 0L, (s, x) -> s + x.{})"
    hashes = _hashes(made.where(F.col("data").isNotNull()), conv_type)
    blocks = blocks.join(hashes, _same(F.col("conv"), F.col("conv_")), "left")
    return blocks.select(
        "conv",
        F.expr(f"coalesce(array_max(b.last_turn) - array_min(b.first_turn) + 1 - ({total.format('turns')} - {same_turn}), 0L)").alias("gaps"),
        *[F.expr(total.format(c)).alias(c) for c in ("blank", "duplicate", "truncated")],
        F.expr(f"{total.format('illegal')} + {illegal}").cast("long").alias("illegal"),
        F.expr(total.format("cost")).alias("cost"),
        F.array_join("b.audit", "").alias("audit"),
        F.coalesce("whole_sha", F.expr("b[0].sha"), F.lit(sha256().hexdigest())).alias("repaired_sha256"),
    )


def repair_damaged(rows: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """Damages a table of turns and repairs it: one row per conversation of the table, a null one included.

    Null turns come first; null roles and texts are one space, so such texts are blank. A conversation that loses all of its
    rows has zeros, no edits and the checksum of nothing. Rows of one turn are ordered by a digest of role and
    text. Repeated rows are duplicates of each other. An empty table gives no rows; other columns are not read.
    """
    found = repair(damaged(rows, conversation)).withColumnRenamed("conv", "conv_")
    every = rows.select(F.col(conversation).alias(conversation)).distinct()
    joined = every.join(found, _same(every[conversation], F.col("conv_")), "left")
    zeros = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return joined.select(
        every[conversation], *zeros, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(sha256().hexdigest())).alias("repaired_sha256")
    )
