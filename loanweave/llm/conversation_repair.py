"""Repair of conversation structure at least cost, with square-root checkpoints.

A repaired conversation's roles are nothing, or an optional system message and then turns of
user and assistant.  Rows are kept, given another role, deleted, or preceded by an inserted
message.  The cheapest edits come from a dynamic programme over four states: its backward
cost vectors are kept only at the ends of blocks, whose length is about the square root of the
longest conversation, and a block is computed again while it is walked forward.  Blocks are
independent rows of a table: only their 4 x 4 cost matrices and end states run along a
conversation, so a conversation that holds a third of all rows is no single task's work.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from loanweave.llm.common import annotate, bounded_batches, stored, table

#: Costs of the edits; a truncated row that stays adds ``TRUNCATED``.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Least rows of a block; conversations beyond its square get longer blocks.
LEAST_BLOCK = 256

#: States: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
#: State after a kept row of a role, and after the only message that may come next by edit.
_KEPT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
_GIVEN = (USER, USER, ASSISTANT, USER)
_ROLES = {USER: "user", ASSISTANT: "assistant"}
_FAR = 1 << 60

_WHITE = r"\x20\x09-\x0D"
#: Order of entries at one place: inserted before it, the decision, the row, inserted after it.
_DECISION, _ROW, _AFTER = 2, 3, 4


def with_inserts(costs: list[int]) -> tuple[int, ...]:
    """Costs to go when up to two messages may be inserted first."""
    once = [INSERT + costs[_GIVEN[s]] for s in STATES]
    return tuple(min(costs[s], once[s], INSERT + once[_GIVEN[s]], _FAR) for s in STATES)


#: Cost to go at the end of a conversation.
END = with_inserts([0, _FAR, _FAR, 0])


def edits(kind: str, state: int) -> Iterator[tuple[str, int, int]]:
    """(letter, cost, next state) of the edits that use up a row.

    ``kind`` is the role's initial (``o`` for others), in upper case for truncated rows, or
    ``x`` for rows that have to go.
    """
    yield "D", DELETE, state
    if kind != "x":
        extra = TRUNCATED if kind.isupper() else 0
        kept = _KEPT.get(kind.lower(), {}).get(state)
        if kept is not None:
            yield "K", extra, kept
        yield "R", REROLE + extra, _GIVEN[state]


def backward(kind: str, after: tuple[int, ...]) -> tuple[int, ...]:
    """Costs to go before a row from those after it."""
    return with_inserts([min(cost + after[to] for _, cost, to in edits(kind, s)) for s in STATES])


@lru_cache(1 << 16)
def _matrix(kinds: str) -> tuple[int, ...]:
    columns = []
    for target in STATES:
        costs = tuple(0 if s == target else _FAR for s in STATES)
        for kind in reversed(kinds):
            costs = backward(kind, costs)
        columns.append(costs)
    return tuple(columns[t][s] for s in STATES for t in STATES)


def matrix(kinds: str) -> tuple[int, ...]:
    """Least cost from each state before a block to each state after it, row by row."""
    return _matrix(kinds) if len(kinds) <= 64 else _matrix.__wrapped__(kinds)


def through(costs: list[int], after: tuple[int, ...]) -> tuple[int, ...]:
    """Costs to go before a block from its matrix and the costs after it."""
    return tuple(min(_FAR, *(costs[4 * s + t] + after[t] for t in STATES)) for s in STATES)


@lru_cache(1 << 16)
def _walk(kinds: str, after: tuple[int, ...], last: bool, state: int) -> tuple[str, int]:
    vectors = [after]
    for kind in reversed(kinds):
        vectors.append(backward(kind, vectors[-1]))
    vectors.reverse()
    letters, k = [], 0
    while True:
        left = vectors[k][state]
        taken = [(x, to) for x, cost, to in edits(kinds[k], state) if cost + vectors[k + 1][to] == left] if k < len(kinds) else []
        if k == len(kinds) and (not last or left == 0):
            return "".join(letters), state
        # tight edits in ASCII order: D, I, K, R
        if taken and taken[0][0] == "D":
            letter, state = taken[0]
        elif INSERT + vectors[k][_GIVEN[state]] == left:
            letters.append("I")
            state = _GIVEN[state]
            continue
        else:
            letter, state = taken[0]
        letters.append(letter)
        k += 1


def walk(kinds: str, after: tuple[int, ...], last: bool, state: int) -> tuple[str, int]:
    """Letters of the ASCII-least cheapest edits of a block entered in ``state``, and its end state.

    Messages inserted between two blocks belong to the second; the last block ends with
    those that complete the conversation.
    """
    if after[state] >= _FAR and min(after) >= _FAR:
        raise ValueError("no way to the end")
    return _walk(kinds, after, last, state) if len(kinds) <= 64 else _walk.__wrapped__(kinds, after, last, state)


def messages_of(kinds: str, letters: str, state: int, places: list[int]) -> list[tuple[int, int, str | None, str]]:
    """(place, order, role or None, letter) of every message that a block's letters leave."""
    out, k, order = [], 0, 0
    for letter in letters:
        if letter == "I":
            state = _GIVEN[state]
            at = (places[k], order) if k < len(places) else (places[-1], _AFTER + order)
            out.append((*at, _ROLES[state], letter))
            order += 1
            continue
        if letter == "K":
            state = _KEPT[kinds[k].lower()][state]
            out.append((places[k], _DECISION, None, letter))
        elif letter == "R":
            state = _GIVEN[state]
            out.append((places[k], _DECISION, _ROLES[state], letter))
        k, order = k + 1, 0
    return out


def damage(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The rows with planted faults, by crc32 of ``conv_id:turn`` modulo 20.

    0 drops a row, 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4 makes it a user's.
    A null id, turn, role or text counts as one space.  Other columns are left out.
    """
    space = F.lit(" ")
    fault = F.crc32(F.concat(F.coalesce(F.col(conv).cast("string"), space), F.lit(":"), F.coalesce(F.col(turn).cast("string"), space))) % 20
    rows = conversations.select(
        F.col(conv), F.col(turn), F.coalesce(F.col(role), space).alias("_role"),
        F.coalesce(F.col(text), space).alias("_text"), fault.alias("_fault"),
    ).where("_fault != 0")
    return rows.select(
        F.col(conv),
        F.col(turn),
        F.when(F.col("_fault") == 4, "user").otherwise(F.col("_role")).alias(role),
        F.when(F.col("_fault") == 1, "").when(F.col("_fault") == 2, F.regexp_replace("_text", "[.!?]", "")).otherwise(F.col("_text")).alias(text),
        F.explode(F.when(F.col("_fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("_copy"),
    ).drop("_copy")


@dataclass
class Repair:
    """What a repair found and made.

    ``summary``: per conversation ``conv_id``, ``gaps``, ``blank``, ``duplicate``, ``truncated``,
    ``illegal``, ``cost`` and ``audit``.  ``rows`` are the rows in order with their ``place``,
    ``decisions`` the messages that stay or come in.
    """

    summary: DataFrame
    rows: DataFrame
    decisions: DataFrame

    def messages(self, by: str = "block") -> DataFrame:
        """``conv_id``, ``place``, ``entry``, ``role``, ``text`` and ``edit`` of the repaired conversations.

        They are ordered by ``place`` and ``entry`` within each ``by`` (``block``, or ``conv``).
        """
        rows = self.rows.select("conv", "block", "place", F.lit(_ROW).alias("entry"), "role", "text", F.lit(None).cast("string").alias("edit"))
        entries = self.decisions.select("conv", "block", "place", "entry", "role", F.lit("").alias("text"), "edit").unionByName(rows)
        ordered = entries.repartition(by).sortWithinPartitions(by, "place", "entry")

        def start():
            before: list = [None, None, None]

            def work(places, entries, roles, edit):
                keep, role_out, edit_out = [], [], []
                for place, entry, role, letter in zip(places.to_pylist(), entries.to_pylist(), roles.to_pylist(), edit.to_pylist()):
                    keep.append(letter == "I" or (entry == _ROW and before[0] == place))
                    role_out.append(before[1] or role if entry == _ROW else role)
                    edit_out.append(before[2] if entry == _ROW else letter)
                    before[:] = [place, role, letter] if entry == _DECISION else [None, None, None]
                return [keep, role_out, edit_out]

            return work

        merged = annotate(ordered.select("conv", "place", "entry", F.col("role").alias("_role"), "text", F.col("edit").alias("_edit")),
                          ["place", "entry", "_role", "_edit"], "keep boolean, role string, edit string", start)
        return merged.where("keep").select(F.col("conv").alias("conv_id"), "place", "entry", "role", "text", "edit")


def _numbered(rows: DataFrame, length: int) -> DataFrame:
    """Rows sorted over all partitions with ``place`` and ``block``, at most ``length`` rows of one conversation each.

    Rows that are alike in everything are told apart by the input partition they come from,
    so that a great many of them still fall into several ranges.
    """
    order = ["conv", F.asc_nulls_first("turn"), "role", "text", "source"]
    ordered = rows.withColumn("source", F.spark_partition_id()).repartitionByRange(*order).sortWithinPartitions(*order)

    def start():
        first = TaskContext.get().partitionId() << 40
        state = {"conv": None, "place": first - 1, "block": first - 1, "rows": length}
        fresh = [True]

        def work(column):
            places, blocks = [], []
            for conv in column.to_pylist():
                state["place"] += 1
                if fresh[0] or conv != state["conv"] or state["rows"] == length:
                    state.update(conv=conv, block=state["block"] + 1, rows=0)
                    fresh[0] = False
                state["rows"] += 1
                places.append(state["place"])
                blocks.append(state["block"])
            return [places, blocks]

        return work

    return annotate(ordered.drop("source"), ["conv"], "place bigint, block bigint", start)


def _chain(blocks: DataFrame, inputs: list[str], fields: str, step, descending: bool) -> DataFrame:
    """Append columns by going along each conversation's blocks; ``step(first, state, *values)`` gives state and columns."""
    order = F.desc("block") if descending else F.asc("block")
    ordered = blocks.repartition("conv").sortWithinPartitions("conv", order)

    def start():
        held: dict = {"conv": None, "state": None, "fresh": True}

        def work(convs, *columns):
            out = []
            for conv, *values in zip(convs.to_pylist(), *(c.to_pylist() for c in columns)):
                first = held["fresh"] or conv != held["conv"]
                held["state"], row = step(first, held["state"], *values)
                held.update(conv=conv, fresh=False)
                out.append(row)
            return [list(c) for c in zip(*out)]

        return work

    return annotate(ordered, ["conv", *inputs], fields, start)


def _step_back(first, after, costs):
    after = END if first else after
    before = through(costs, after)
    return before, (list(after), first, before[START])


def _step_on(first, held, ends, before, head, tail, low, high):
    state, role, turn = (START, None, None) if first else held
    broken = int(role is not None and role + head not in ("su", "ua", "au"))
    again = int(turn is not None and turn == low)
    return (ends[state], tail, turn if high is None else high), (state, broken, again, before if first else 0)


def repair(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> Repair:
    """The cheapest edits that give every conversation the right order of roles.

    Rows are taken by turn, nulls first; rows of one turn by role and text.  A row's first fault
    counts: blank, duplicate (role and text were there before), truncated (does not end in
    ``.!?``).  Null roles and texts count as one space, null turns come first and are no part of
    gaps, null ids are one conversation, repeated rows are duplicates, extra columns are left
    out whatever their names, no rows give empty tables, and a text is read whole.  Of equally
    cheap edits those with the ASCII-least letters are taken.
    """
    space = F.lit(" ")
    rows = conversations.select(
        F.col(conv).alias("conv"), F.col(turn).cast("bigint").alias("turn"),
        F.coalesce(F.col(role), space).alias("role"), F.coalesce(F.col(text), space).alias("text"),
    )
    longest = rows.groupBy("conv").count().agg(F.max("count")).first()[0] or 0
    length = max(LEAST_BLOCK, math.isqrt(longest) + 1)
    rows = stored(_numbered(rows, length))

    initial = F.substring("role", 1, 1)
    facts = rows.select(
        "conv", "turn", "place", "block",
        F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("initial"),
        (~F.col("text").rlike(f"[^{_WHITE}]")).alias("blank"),
        (~F.col("text").rlike(rf"[.!?][{_WHITE}]*\z")).alias("cut"),
        F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))).alias("said"),
    )
    opening = facts.where("not blank").groupBy("conv", "said").agg(F.min("place").alias("place")).select("place", F.lit(True).alias("opening"))
    again = F.col("opening").isNull()
    kind = F.when(F.col("blank") | again, "x").when(F.col("cut"), F.upper("initial")).otherwise(F.col("initial"))
    flagged = facts.drop("said").join(opening, "place", "left").select(
        "conv", "turn", "place", "block", "initial", kind.alias("kind"), "blank",
        (~F.col("blank") & again).alias("duplicate"), (~F.col("blank") & ~again & F.col("cut")).alias("truncated"),
    )
    listed: Column = F.array_sort(F.collect_list(F.struct("place", "kind", "initial")))
    blocks = flagged.groupBy("conv", "block").agg(
        listed.alias("rows"),
        F.count_if("blank").alias("blank"), F.count_if("duplicate").alias("duplicate"), F.count_if("truncated").alias("truncated"),
        F.min("turn").alias("low"), F.max("turn").alias("high"), F.size(F.collect_set("turn")).cast("bigint").alias("turns"),
    ).select(
        "conv", "block", "blank", "duplicate", "truncated", "low", "high", "turns",
        F.col("rows.place").alias("places"),
        F.array_join("rows.kind", "").alias("kinds"), F.array_join("rows.initial", "").alias("roles"),
    )

    def matrices():
        def work(kinds, roles):
            said = roles.to_pylist()
            return [
                [list(matrix(k)) for k in kinds.to_pylist()],
                [sum(r[i : i + 2] not in ("su", "ua", "au") for i in range(len(r) - 1)) for r in said],
                [r[0] for r in said], [r[-1] for r in said],
            ]

        return work

    blocks = stored(annotate(blocks, ["kinds", "roles"], "costs array<bigint>, inner bigint, head string, tail string", matrices))
    back = _chain(blocks.select("conv", "block", "costs"), ["costs"], "after array<bigint>, last boolean, before bigint", _step_back, True)

    def ends():
        def work(kinds, after, last):
            return [[[_end(k, tuple(a), z, s) for s in STATES] for k, a, z in zip(kinds.to_pylist(), after.to_pylist(), last.to_pylist())]]

        return work

    known = stored(annotate(blocks.drop("costs", "conv").join(back.drop("costs"), "block"), ["kinds", "after", "last"], "ends array<int>", ends))
    forward = _chain(
        known.select("conv", "block", "ends", "before", "head", "tail", "low", "high"),
        ["ends", "before", "head", "tail", "low", "high"], "state int, broken bigint, again bigint, cost bigint", _step_on, False,
    ).select("block", "state", "broken", "again", "cost")

    def letters():
        def work(kinds, after, last, state, places):
            audits, made = [], []
            for k, a, z, s, p in zip(kinds.to_pylist(), after.to_pylist(), last.to_pylist(), state.to_pylist(), places.to_pylist()):
                found, _ = walk(k, tuple(a), z, s)
                audits.append(found)
                made.append([{"place": m[0], "entry": m[1], "role": m[2], "edit": m[3]} for m in messages_of(k, found, s, p)])
            return [audits, made]

        return work

    done = stored(annotate(
        known.join(forward, "block"), ["kinds", "after", "last", "state", "places"],
        "audit string, made array<struct<place:bigint,entry:int,role:string,edit:string>>", letters,
    ))
    turns = F.sum(F.col("turns") - F.col("again"))
    summary = done.groupBy("conv").agg(
        F.coalesce(F.max("high") - F.min("low") + 1 - turns, F.lit(0)).cast("bigint").alias("gaps"),
        F.sum("blank").alias("blank"), F.sum("duplicate").alias("duplicate"), F.sum("truncated").alias("truncated"),
        F.sum(F.col("inner") + F.col("broken")).alias("illegal"), F.sum("cost").alias("cost"),
        F.array_join(F.array_sort(F.collect_list(F.struct("block", "audit")))["audit"], "").alias("audit"),
    ).withColumnRenamed("conv", "conv_id")
    decisions = done.select("conv", "block", F.explode("made").alias("m")).select("conv", "block", "m.*")
    return Repair(summary, rows, decisions)


def _end(kinds: str, after: tuple[int, ...], last: bool, state: int) -> int:
    return walk(kinds, after, last, state)[1]


def text_digests(messages: DataFrame) -> DataFrame:
    """``conv_id`` and the SHA-256 of ``role:text`` lines of messages ordered by conversation.

    The hash is fed message by message, so a conversation of any length takes constant memory.
    """
    bounded_batches(messages.sparkSession)
    kind = messages.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, digest, typed = None, None, None
        for batch in batches:
            typed = batch.schema.field(0).type
            done: list[tuple] = []
            for value, role, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if digest is None or value != conv:
                    if digest is not None:
                        done.append((conv, digest.hexdigest()))
                    conv, digest = value, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], typed), pa.array([d[1] for d in done])], ["conv_id", "sha256"])
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([conv], typed), pa.array([digest.hexdigest()])], ["conv_id", "sha256"])

    return messages.select("conv_id", "role", "text").mapInArrow(run, f"conv_id {kind}, sha256 string")


def digests(spark: SparkSession, directory: str) -> DataFrame:
    """Faults, cheapest edits and repaired text of every damaged conversation of a directory."""
    conversations = table(spark, directory, "conversations")
    found = repair(damage(conversations))
    hashes = text_digests(found.messages("conv")).withColumnRenamed("conv_id", "hashed")
    summary = found.summary.withColumnRenamed("conv_id", "repaired")
    zero = F.lit(0).cast("bigint")
    out = (
        conversations.select("conv_id").distinct()
        .join(summary, F.col("conv_id").eqNullSafe(F.col("repaired")), "left")
        .join(hashes, F.col("conv_id").eqNullSafe(F.col("hashed")), "left")
    )
    return out.select(
        "conv_id",
        *(F.coalesce(c, zero).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
