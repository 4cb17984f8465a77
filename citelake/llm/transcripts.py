"""Chat formatting: roles recovered from transcripts by a hidden Markov model (operator 9).

Input rows are stretches of a transcript in order (conversation, turn, text); a stretch is of one
speaker unless a speaker marker within it says otherwise. Every line is observed through its marker,
its length, whether it asks, and the size of its stretch. States are roles, each as the first line of
a turn or a later one. The model's tables are counted from stretches whose role is known, and the
Viterbi path over a conversation gives every line its role. Turns are then rendered in canonical form,
markers removed.

A conversation may hold any share of all rows, with or without turn numbers, so it is not taken whole.
All rows are range-partitioned by conversation, turn and text and numbered in that order; a block is
``BLOCK_TURNS`` consecutive numbers of one conversation, however often turns repeat. Transitions are
counted in the same order as the tasks' sorted rows stream by. Blocks of lines become
matrices of best scores between states, these are multiplied (max-plus) in rounds of ``FAN`` until one
is left for each conversation, and the states at the ends of blocks are handed down again the same
way. The result is a best path of the whole conversation.

Defined results: a null text is one empty line; a null conversation is one of its own; a null turn counts
as -1; rows that share a turn are ordered by text, equal ones by role; rows without a known role are read but not learned from; an empty table
gives no rows; without any known role all roles are equally likely.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from citelake.llm.scratch import written

ROLES = ("system", "user", "assistant")
STATES = 2 * len(ROLES)  # role r: first line 2r, later lines 2r + 1
START = STATES
BLOCK_TURNS = 64
FAN = 64
SIZES = 16
MARKED = 0.05  # share of turns taken to begin with their speaker's marker, besides those counted
# Words that name a speaker at the head of a line.
SPEAKERS = {
    "system": ("system", "instructions"),
    "user": ("user", "human", "question", "q", "customer", "prompt", "me"),
    "assistant": ("assistant", "ai", "bot", "answer", "a", "agent", "model", "response"),
}
ROLE_OF = {word: i for i, role in enumerate(ROLES) for word in SPEAKERS[role]}
MARKER = re.compile(r"^\s*[\[(*<#]*\s*(" + "|".join(ROLE_OF) + r")\s*[\])*>]*\s*:\s*", re.IGNORECASE)
FEATURES = (4, 8, 2, SIZES)  # values of marker, line length, question, size of the stretch


def observe(text: str | None) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Lines without their markers; each line's features; and which lines may begin a turn:
    1 must, 0 must not, 2 may."""
    text = text or ""
    lines, seen, begins = [], [], []
    size = min(SIZES - 1, len(text).bit_length())
    for i, line in enumerate(text.split("\n")):
        found = MARKER.match(line)
        marker = 1 + ROLE_OF[found[1].lower()] if found else 0
        lines.append(line[found.end() :] if found else line)
        seen.append((marker, min(7, len(line).bit_length() // 2), line.rstrip().endswith("?"), size))
        begins.append(1 if i == 0 else 2 if found else 0)
    return lines, np.array(seen, dtype=np.int64), np.array(begins)


class Tables:
    """Logarithms of the model's probabilities."""

    def __init__(self, steps: np.ndarray, seen: list[np.ndarray]) -> None:
        """``steps``: counts from state or start to state; ``seen``: counts by feature, state, value."""
        steps = steps + 0.5
        seen = [x.copy() for x in seen]
        for role in range(len(ROLES)):  # what a marker says is known beforehand
            seen[0][2 * role, 1 + role] += max(20.0, MARKED * seen[0][2 * role].sum())
            seen[0][2 * role + 1, 0] += 20.0
        later = np.arange(STATES) % 2 == 1
        for before in range(STATES + 1):  # a later line follows a line of its own role
            own = later & (np.arange(STATES) // 2 == before // 2) & (before != START)
            steps[before, later & ~own] = 0
        with np.errstate(divide="ignore"):
            self.step = np.log(steps / steps.sum(axis=1, keepdims=True))
            self.seen = []
            for x in seen:  # states that were hardly seen lean on what is seen in all
                common = (x.sum(axis=0) + 0.5) / (x.sum(axis=0) + 0.5).sum()
                x = x + 2 * common
                self.seen.append(np.log(x / x.sum(axis=1, keepdims=True)))

    def scores(self, features: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Of line by state."""
        total = sum(table[:, features[:, i]].T for i, table in enumerate(self.seen))
        first = np.arange(STATES) % 2 == 0
        total[np.ix_(begins == 1, ~first)] = -np.inf
        total[np.ix_(begins == 0, first)] = -np.inf
        return total


def block_matrix(tables: Tables, scores: np.ndarray) -> np.ndarray:
    """Best score from each state before the lines to each state of the last line."""
    best = tables.step + scores[0]
    for row in scores[1:]:
        best = (best[:, :, None] + tables.step[None, :STATES, :]).max(axis=1) + row
    return np.column_stack([best, np.full(STATES + 1, -np.inf)])


def product(matrices: list[np.ndarray]) -> np.ndarray:
    total = matrices[0]
    for m in matrices[1:]:
        total = (total[:, :, None] + m[None, :, :]).max(axis=1)
    return total


def between(matrices: list[np.ndarray], enter: int, leave: int) -> list[int]:
    """States at the joints of consecutive blocks on a best path from ``enter`` to ``leave``."""
    value, back = matrices[0][enter], []
    for m in matrices[1:]:
        scores = value[:, None] + m
        back.append(scores.argmax(axis=0))
        value = scores.max(axis=0)
    path = [leave]
    for choice in reversed(back):
        path.append(int(choice[path[-1]]))
    return [enter, *path[::-1]]


def line_states(tables: Tables, scores: np.ndarray, enter: int, leave: int) -> list[int]:
    value, back = tables.step[enter] + scores[0], []
    for row in scores[1:]:
        ways = value[:, None] + tables.step[:STATES]
        back.append(ways.argmax(axis=0))
        value = ways.max(axis=0) + row
    path = [leave]
    for choice in reversed(back):
        path.append(int(choice[path[-1]]))
    return path[::-1]


def in_order(rows: DataFrame) -> DataFrame:
    """Rows dealt to tasks in ranges of (conv, turn, text, role) and sorted. Equal rows are told apart by
    ``tie``, so that any number of them can be cut into ranges."""
    keys = ["conv", "turn", "text", "role", "tie"]
    tied = written(rows.withColumn("tie", F.monotonically_increasing_id()))
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return tied.repartitionByRange(n, *keys).sortWithinPartitions(*keys).drop("tie")


def numbered(rows: DataFrame) -> DataFrame:
    """With ``place``: rows of a conversation follow each other by it, without gaps inside a task."""
    # A task's rows get consecutive numbers, above them the task's number.
    placed = written(in_order(rows).withColumn("at", F.monotonically_increasing_id()))
    last = F.lit((1 << 33) - 1)
    most = placed.agg(F.max(F.col("at").bitwiseAND(last))).first()[0]
    width = -(-((most or 0) + 1) // BLOCK_TURNS) * BLOCK_TURNS
    place = F.shiftright("at", 33) * width + F.col("at").bitwiseAND(last)
    return placed.withColumn("place", place).drop("at")


def transitions(rows: DataFrame, conv_type: T.DataType) -> np.ndarray:
    """How often the first line of a stretch of each role follows each state, or the start. Neither a
    stretch without a known role nor what comes right after it counts."""
    width = STATES + 1

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = np.zeros((width, len(ROLES)), dtype=np.int64)
        edges, before = [], None
        for batch in batches:
            for row in zip(*[column.to_pylist() for column in batch.columns], strict=True):
                if before is None:
                    edges.append((False, *row))
                else:
                    step = follow(before, row)
                    if step:
                        steps[step] += 1
                before = row
        if before is not None:
            edges.append((True, *before))
        used = np.flatnonzero(steps)
        none = [None] * len(used)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([*used.tolist(), *[None] * len(edges)], pa.int32()),
                pa.array([*steps.reshape(-1)[used].tolist(), *[None] * len(edges)], pa.int64()),
                pa.array([*none, *[e[4] for e in edges]], pa.int32()),
                pa.array([*none, *[e[0] for e in edges]], pa.bool_()),
                pa.array([*none, *[e[1] for e in edges]], batch_type),
                pa.array([*none, *[e[2] for e in edges]], pa.string()),
                pa.array([*none, *[e[3] for e in edges]], pa.bool_()),
            ],
            names=["step", "n", "task", "last", "conv", "role", "long"],
        )

    def follow(before: tuple | None, row: tuple) -> tuple[int, int] | None:
        role = row[1]
        if role not in ROLES:
            return None
        if before is None or before[0] != row[0]:
            return START, ROLES.index(role)
        if before[1] not in ROLES:
            return None
        return 2 * ROLES.index(before[1]) + bool(before[2]), ROLES.index(role)

    batch_type = to_arrow_type(conv_type)
    schema = T.StructType(
        [
            T.StructField("step", T.IntegerType()),
            T.StructField("n", T.LongType()),
            T.StructField("task", T.IntegerType()),
            T.StructField("last", T.BooleanType()),
            T.StructField("conv", conv_type),
            T.StructField("role", T.StringType()),
            T.StructField("long", T.BooleanType()),
        ]
    )
    ordered = in_order(rows).select("conv", "role", (F.instr("text", "\n") > 0).alias("long"), F.spark_partition_id())
    counted = written(ordered.mapInArrow(count, schema))
    steps = np.zeros((width, len(ROLES)))
    for step, n in counted.filter("step IS NOT NULL").groupBy("step").agg(F.sum("n")).collect():
        steps[divmod(step, len(ROLES))] = n
    before = None  # two rows a task: the stretches at either side of a cut between ranges
    for row in counted.filter("task IS NOT NULL").orderBy("task", "last").collect():
        if not row["last"]:
            step = follow(before, (row["conv"], row["role"], row["long"]))
            if step:
                steps[step] += 1
        before = (row["conv"], row["role"], row["long"])
    return steps


def learn(rows: DataFrame) -> Tables:
    """Count the model's tables from rows (conv, turn, role, text) whose role is known."""
    known = rows.filter(F.col("role").isin(*ROLES))

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps, seen = np.zeros(STATES), [np.zeros((STATES, n)) for n in FEATURES]
        for batch in batches:
            for role, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                _, features, _ = observe(text)
                first = 2 * ROLES.index(role)
                state = np.full(len(features), first + 1)
                state[0] = first
                steps[first] += len(features) > 1
                steps[first + 1] += max(0, len(features) - 2)
                for i, table in enumerate(seen):
                    np.add.at(table, (state, features[:, i]), 1)
        flat = np.concatenate([steps, *[x.reshape(-1) for x in seen]])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)], names=["place", "n"]
        )

    width = STATES + STATES * sum(FEATURES)
    flat = np.zeros(width)
    counted = known.select("role", "text").mapInArrow(count, "place int, n double")
    for row in counted.groupBy("place").agg(F.sum("n")).collect():
        flat[row[0]] = row[1]
    steps = np.zeros((STATES + 1, STATES))
    for role in range(len(ROLES)):
        steps[2 * role, 2 * role + 1] = flat[2 * role]
        steps[2 * role + 1, 2 * role + 1] = flat[2 * role + 1]
    steps[:, ::2] += transitions(rows, rows.schema["conv"].dataType)
    seen, at = [], STATES
    for n in FEATURES:
        seen.append(flat[at : at + STATES * n].reshape(STATES, n))
        at += STATES * n
    return Tables(steps, seen)


def _ordered(group: pa.Table) -> pa.Table:
    return group.sort_by("place")


def recover_roles(
    conversations: DataFrame,
    known: DataFrame | None = None,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """``conv``, ``turn``, ``part``, ``given``, ``role``, ``rendered``: a row for each recovered turn.

    ``known`` holds the rows to learn from, by default all whose role is one of ``ROLES``. ``part``
    counts the turns within an input row.
    """
    spark = conversations.sparkSession

    def shaped(rows: DataFrame) -> DataFrame:
        return rows.select(
            F.col(conv).alias("conv"),
            F.coalesce(F.col(turn).cast("bigint"), F.lit(-1)).alias("turn"),
            F.col(role).alias("role"),
            F.coalesce(F.col(text), F.lit("")).alias("text"),
        )

    tables = spark.sparkContext.broadcast(learn(shaped(conversations if known is None else known)))
    rows = numbered(shaped(conversations)).withColumn("block", F.floor(F.col("place") / BLOCK_TURNS))
    conv_type = conversations.schema[conv].dataType
    level_type = T.StructType(
        [
            T.StructField("conv", conv_type),
            T.StructField("block", T.LongType()),
            T.StructField("matrix", T.ArrayType(T.DoubleType())),
        ]
    )
    ends_type = T.StructType(
        [
            T.StructField("conv", conv_type),
            T.StructField("block", T.LongType()),
            T.StructField("enter", T.IntegerType()),
            T.StructField("leave", T.IntegerType()),
        ]
    )

    def scored(group: pa.Table):
        group = _ordered(group)
        found = [observe(x) for x in group.column("text").to_pylist()]
        scores = [tables.value.scores(features, begins) for _, features, begins in found]
        return group, [lines for lines, _, _ in found], scores

    def level_row(group: pa.Table, name: str, matrix: np.ndarray) -> pa.Table:
        return pa.table(
            {
                "conv": group.column("conv")[:1],
                "block": group.column(name)[:1],
                "matrix": pa.array([matrix.reshape(-1).tolist()], pa.list_(pa.float64())),
            }
        )

    def first_level(group: pa.Table) -> pa.Table:
        group, _, scores = scored(group)
        return level_row(group, "block", block_matrix(tables.value, np.concatenate(scores)))

    def matrices_of(group: pa.Table) -> list[np.ndarray]:
        return [np.array(m).reshape(STATES + 1, STATES + 1) for m in group.column("matrix").to_pylist()]

    def raise_level(group: pa.Table) -> pa.Table:
        group = group.sort_by("block")
        return level_row(group, "above", product(matrices_of(group)))

    levels = [written(rows.groupBy("conv", "block").applyInArrow(first_level, level_type))]
    while levels[-1].groupBy("conv").count().agg(F.max("count")).first()[0] not in (None, 1):
        crowd = levels[-1].groupBy("conv").count().agg(F.max("count")).first()[0]
        above = F.lit(0).cast("bigint") if crowd <= FAN else F.floor(F.col("block") / FAN)
        raised = levels[-1].withColumn("above", above)
        levels[-1] = raised
        levels.append(written(raised.groupBy("conv", "above").applyInArrow(raise_level, level_type)))

    def finish(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best = [int(m[START].argmax()) for m in matrices_of(pa.Table.from_batches([batch]))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("conv"),
                    batch.column("block"),
                    pa.array([START] * len(best), pa.int32()),
                    pa.array(best, pa.int32()),
                ],
                names=["conv", "block", "enter", "leave"],
            )

    def hand_down(blocks: pa.Table, above: pa.Table) -> pa.Table:
        blocks = blocks.sort_by("block")
        if not blocks.num_rows:
            return blocks.select(["conv", "block"]).append_column("enter", pa.array([], pa.int32())).append_column("leave", pa.array([], pa.int32()))
        path = between(matrices_of(blocks), above.column("enter")[0].as_py(), above.column("leave")[0].as_py())
        return pa.table(
            {
                "conv": blocks.column("conv"),
                "block": blocks.column("block"),
                "enter": pa.array(path[:-1], pa.int32()),
                "leave": pa.array(path[1:], pa.int32()),
            }
        )

    ends = written(levels[-1].mapInArrow(finish, ends_type))
    for level in reversed(levels[:-1]):
        upper = ends.withColumnRenamed("block", "above")
        ends = written(
            level.groupBy("conv", "above").cogroup(upper.groupBy("conv", "above")).applyInArrow(hand_down, ends_type)
        )

    result = T.StructType(
        [
            T.StructField(conv, conv_type),
            T.StructField(turn, T.LongType()),
            T.StructField("part", T.LongType()),
            T.StructField("given", T.StringType()),
            T.StructField("role", T.StringType()),
            T.StructField("rendered", T.StringType()),
        ]
    )

    def render(group: pa.Table, block: pa.Table) -> pa.Table:
        group, texts, scores = scored(group)
        out = {name: [] for name in ("row", "part", "role", "rendered")}
        if group.num_rows:
            states = line_states(
                tables.value,
                np.concatenate(scores),
                block.column("enter")[0].as_py(),
                block.column("leave")[0].as_py(),
            )
            at = 0
            for row, lines in enumerate(texts):
                own = states[at : at + len(lines)]
                at += len(lines)
                cuts = [i for i, s in enumerate(own) if s % 2 == 0 or i == 0] + [len(lines)]
                for part, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    name = ROLES[own[a] // 2]
                    out["row"].append(row)
                    out["part"].append(part)
                    out["role"].append(name)
                    out["rendered"].append(canonical(name, lines[a:b]))
        take = pa.array(out["row"], pa.int64())
        return pa.table(
            {
                conv: group.column("conv").take(take),
                turn: group.column("turn").take(take),
                "part": pa.array(out["part"], pa.int64()),
                "given": group.column("role").take(take),
                "role": pa.array(out["role"], pa.string()),
                "rendered": pa.array(out["rendered"], pa.string()),
            }
        )

    return rows.groupBy("conv", "block").cogroup(ends.groupBy("conv", "block")).applyInArrow(render, result)


def canonical(role: str, lines: list[str]) -> str:
    return f"<|{role}|>\n" + "\n".join(lines).strip() + "\n<|end|>"
