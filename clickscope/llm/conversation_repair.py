"""Conversation structure repair as secondary-sorted streaming.

A repaired conversation is empty, or has the role initials ``s?(ua)+``. Edits,
by their initials: Keep a row (costs 0), Rerole it to user or assistant (2),
Delete it (3; the only choice for a blank or duplicate row), Insert a user or
assistant row with empty text anywhere (2). A truncated row that stays adds 1.
The cheapest edits win; of equally cheap ones those whose initials in order
are the least ASCII text.

Rows are dealt by conversation once. Everything after that is sorting inside
the partitions, which Spark spills, and streaming over the sorted rows, which
carries a few numbers across Arrow batches, so a conversation's length costs
no memory:

1. From the last turn to the first, a dynamic programme carries the cost of
   finishing from each of the four grammar states and leaves one byte with
   every row: the best edit, two bits, for each state it may be met in. These
   backpointers travel with the rows, and Spark's sort spills them with the
   rows where a conversation is too long for memory.
2. From the first turn to the last, the best edits are read off those bytes,
   starting in the empty state.
3. In the same order, counts, costs and an incremental hash are taken.

Nulls, in any column, read as one space. Rows of a conversation come by turn
(nulls first), then role, then text; rows equal in all of these are
interchangeable. A null conversation id is a conversation of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickscope.llm.common import ASCII_SPACE, importable_by_workers, pick

BLANK = " "  # what a null reads as
KEEP_COST, REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 0, 2, 3, 2, 1
EDITS = "DIKR"  # in ASCII order; two bits of a backpointer are the place in here
DELETE, INSERT, KEEP, REROLE = range(4)
LEGAL_PAIRS = ("su", "ua", "au")
ROLES = {"u": "user", "a": "assistant"}

# States: nothing yet, behind the system row, behind a user row, behind an assistant row.
STATES, START = 4, 0
_NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
_WANTED = "uuau"  # the role that a rerole or an insertion gives
_OVER = (0, 2 * INSERT_COST, INSERT_COST, 0)  # cost of finishing where no rows are left
_FAR = 1 << 60


def damaged(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows of ``turns`` with faults, chosen by crc32 of ``conv:turn`` modulo 20.

    0 drops the row, 1 empties its text, 2 takes out ``.``, ``!`` and ``?``, 3
    repeats it, 4 makes its role user; all others stay. Nulls read as one space.
    """
    rows = pick(turns, conv, turn, role, text).toDF("conv", "turn", "role", "text")
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(BLANK))
    rows = (rows.withColumn("fate", F.crc32(F.concat(shown("conv"), F.lit(":"), shown("turn"))) % 20)
            .withColumns({"role": shown("role"), "text": shown("text")}).where("fate != 0"))
    told = (F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")))
    spoken = F.when(F.col("fate") == 4, "user").otherwise(F.col("role"))
    times = F.explode(F.when(F.col("fate") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return rows.select("conv", "turn", spoken.alias("role"), told.alias("text"), times.alias("time")).drop("time")


def with_faults(turns: DataFrame, conv: str = "conv", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, text, place, fault, illegal), dealt by conversation.

    ``fault`` is the first that fits: blank (nothing but ASCII space),
    duplicate (role and text seen earlier in the conversation), truncated (the
    last other character is none of ``.!?``), else null. ``illegal``: the
    initials of the row before and this one are none of su, ua, au. All
    windows are over the one exchange by conversation.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(BLANK))
    rows = pick(turns, conv, turn, role, text).toDF("conv", "turn", "role", "text")
    rows = rows.withColumns({"role": blank("role"), "text": blank("text")}).repartition("conv")
    in_turn = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    alike = Window.partitionBy("conv", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    initial = F.substring("role", 1, 1)
    bare = F.rtrim(F.col("text"), F.lit(ASCII_SPACE))
    rows = (rows.withColumn("again", F.row_number().over(alike) > 1)
            .withColumns({"place": F.row_number().over(in_turn), "before": F.lag(initial).over(in_turn)}))
    fault = (F.when(F.length(bare) == 0, "blank").when(F.col("again"), "duplicate")
             .when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), "truncated"))
    illegal = F.col("before").isNotNull() & ~F.concat("before", initial).isin(*LEGAL_PAIRS)
    return rows.select("conv", "turn", "role", "text", "place", fault.alias("fault"), illegal.alias("illegal"))


def best_edits(after: tuple[int, ...], initial: str, fault: str | None) -> tuple[tuple[int, ...], int]:
    """Costs of finishing from each state before a row, and the row's byte of best edits.

    ``after``: the costs behind the row. Of equal costs the least initial is
    taken at every step, which makes the whole text of initials the least,
    since from a state each edit leads to one other state only.
    """
    stays = fault not in ("blank", "duplicate")
    extra = TRUNCATED_COST if fault == "truncated" else 0
    cost, edit = [], []
    for state in range(STATES):
        options = [(DELETE_COST + after[state], DELETE)]
        if stays:
            kept = _NEXT[state].get(initial)
            if kept is not None:
                options.append((KEEP_COST + extra + after[kept], KEEP))
            options.append((REROLE_COST + extra + after[_NEXT[state][_WANTED[state]]], REROLE))
        least = min(options)
        cost.append(least[0])
        edit.append(least[1])
    # insertions lead from state to state before the row; at most one round of u and a pays
    for _ in range(3):
        for state in range(STATES):
            through = (INSERT_COST + cost[_NEXT[state][_WANTED[state]]], INSERT)
            if through < (cost[state], edit[state]):
                cost[state], edit[state] = through
    return tuple(cost), sum(e << 2 * s for s, e in enumerate(edit))


_ROWS = "conv string, turn string, role string, text string, place int, fault string, illegal boolean"


def _point_back(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Last turn first: leave every row its byte of best edits."""
    conv, after = object(), _OVER
    for frame in frames:
        found = []
        for key, role, fault in zip(frame["conv"], frame["role"], frame["fault"]):
            if key != conv:
                conv, after = key, _OVER
            after, byte = best_edits(after, role[:1], fault)
            found.append(byte)
        frame["edits"] = pd.Series(found, dtype="int16", index=frame.index)
        yield frame


def _follow(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """First turn first: read the edits off the bytes, from the empty state on."""
    conv, state, step = object(), START, 0
    columns = ["conv", "step", "edit", "turn", "role", "text", "fault", "illegal"]

    def inserted(rows: list) -> None:
        nonlocal state, step
        step += 1
        wanted = _WANTED[state]
        rows.append((conv, step, "I", None, ROLES[wanted], "", None, False))
        state = _NEXT[state][wanted]

    def finished(rows: list) -> None:
        while state in (1, 2):  # nothing but insertions is left
            inserted(rows)

    for frame in frames:
        rows: list = []
        for key, turn, role, text, fault, illegal, edits in zip(
                *[frame[c] for c in ("conv", "turn", "role", "text", "fault", "illegal", "edits")]):
            if key != conv:
                finished(rows)
                conv, state, step = key, START, 0
            while (edit := edits >> 2 * state & 3) == INSERT:
                inserted(rows)
            if edit == KEEP:
                state = _NEXT[state][role[:1]]
            elif edit == REROLE:
                role, state = ROLES[_WANTED[state]], _NEXT[state][_WANTED[state]]
            step += 1
            rows.append((conv, step, EDITS[edit], turn, role, text, fault, illegal))
        yield pd.DataFrame(rows, columns=columns)
    rows = []
    finished(rows)
    if rows:
        yield pd.DataFrame(rows, columns=columns)


def _total(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per conversation of rows that come conversation by conversation, in order of their steps."""
    conv, started, state = object(), False, {}
    columns = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]

    def told() -> tuple:
        gaps = state["last"] - state["first"] + 1 - state["turns"] if state["turns"] else 0
        return (conv, gaps, state["blank"], state["duplicate"], state["truncated"], state["illegal"], state["cost"],
                "".join(state["audit"]), state["hash"].hexdigest())

    for frame in frames:
        rows = []
        for key, edit, turn, role, text, fault, illegal in zip(
                *[frame[c] for c in ("conv", "edit", "turn", "role", "text", "fault", "illegal")]):
            if key != conv or not started:
                if started:
                    rows.append(told())
                conv, started = key, True
                state = {"first": 0, "last": None, "turns": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0,
                         "cost": 0, "audit": [], "hash": hashlib.sha256(), "any": False}
            if turn is not None:
                at = int(turn)
                if not state["turns"]:
                    state["first"] = at
                state["turns"] += state["last"] is None or at != state["last"]
                state["last"] = at
            if fault is not None:
                state[fault] += 1
            state["illegal"] += bool(illegal)
            state["cost"] += (DELETE_COST if edit == "D" else (INSERT_COST if edit == "I" else REROLE_COST if edit == "R" else KEEP_COST)
                              + (TRUNCATED_COST if fault == "truncated" else 0))
            state["audit"].append(edit)
            if edit != "D":
                state["hash"].update(("\n" if state["any"] else "").encode() + f"{role}:{text}".encode("utf-8", "surrogatepass"))
                state["any"] = True
        yield pd.DataFrame(rows, columns=columns)
    if started:
        yield pd.DataFrame([told()], columns=columns)


def _edited(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    importable_by_workers(turns.sparkSession)
    rows = with_faults(turns, conv, turn, role, text)
    # ids and turns travel as text: pandas would turn whole numbers beside nulls into doubles
    rows = rows.withColumns({"conv": F.col("conv").cast("string"), "turn": F.col("turn").cast("string")})
    pointed = (rows.sortWithinPartitions("conv", F.desc("place"))
               .mapInPandas(_point_back, f"{_ROWS}, edits smallint"))
    return pointed.sortWithinPartitions("conv", "place").mapInPandas(
        _follow, "conv string, step int, edit string, turn string, role string, text string, fault string, illegal boolean")


def _typed(name: str, kind: str) -> Column:
    return F.col(name).cast(kind).alias(name)


def repair(turns: DataFrame, conv: str = "conv", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, step, edit, turn, role, text, fault, illegal): every edit of every conversation, in order of ``step``.

    The rows whose edit is not D are the repaired conversation, with their new
    roles. Extra columns are not read; an empty table gives an empty result.
    """
    types = {c: turns.schema[s].dataType.simpleString() for c, s in (("conv", conv), ("turn", turn))}
    edited = _edited(turns, conv, turn, role, text)
    return edited.select(*[_typed(c, types[c]) if c in types else F.col(c) for c in edited.columns])


def repair_report(turns: DataFrame, conv: str = "conv", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) per conversation.

    ``gaps``: whole numbers between the least and the largest turn that no row
    has; ``audit``: the edits' initials in order; the hash is that of the
    repaired ``role:text``, joined by newlines. Turns are whole numbers.
    """
    kind = turns.schema[conv].dataType.simpleString()
    # the rows are still dealt by conversation and in order of their steps
    whole = _edited(turns, conv, turn, role, text).mapInPandas(
        _total, "conv string, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
                "audit string, repaired_sha256 string")
    return whole.select(_typed("conv", kind), *whole.columns[1:])
