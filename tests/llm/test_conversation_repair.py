"""Conversation repair against an exhaustive search over edits."""

import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from clickscope.llm import conversation_repair as cr
from tests.llm.edge import CLASHES, plain_rows

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
EMPTY = hashlib.sha256(b"").hexdigest()


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if h == 0:
            continue
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        out += [(conv, turn, "user" if h == 4 else role, text)] * (2 if h == 3 else 1)
    return out


def cheapest(rows):
    """(cost, audit, roles) by uniform-cost search over (rows used, initials so far)."""
    heap, done = [(0, "", 0, "")], set()
    while heap:
        cost, audit, i, said = heapq.heappop(heap)
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", said):
            return cost, audit, said
        state = (i, said)
        if state in done or len(said) > len(rows) + 2:
            continue
        done.add(state)
        ok = lambda s: re.fullmatch("(s?(ua)*u?)?", s)
        for c in "ua":
            if ok(said + c):
                heapq.heappush(heap, (cost + 2, audit + "I", i, said + c))
        if i < len(rows):
            role, fault = rows[i]
            extra = fault == "truncated"
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, said))
            if fault not in ("blank", "duplicate"):
                if role[:1] in ("s", "u", "a") and ok(said + role[:1]):
                    heapq.heappush(heap, (cost + extra, audit + "K", i + 1, said + role[:1]))
                for c in "ua":
                    if ok(said + c):
                        heapq.heappush(heap, (cost + 2 + extra, audit + "R", i + 1, said + c))
    raise AssertionError


def brute(rows, damage=True):
    out = []
    kept = brute_damage(rows) if damage else [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    for conv in {r[0] for r in rows}:
        mine = sorted([r for r in kept if r[0] == conv], key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        seen, faults = set(), []
        for _, _, role, text in mine:
            bare = text.rstrip(" \t\n\x0b\f\r")
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else None if bare[-1] in ".!?" else "truncated")
            seen.add((role, text))
        turns = [t for _, t, _, _ in mine if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        cost, audit, said = cheapest([(r[2], f) for r, f in zip(mine, faults)])
        texts, left, names = [], iter(mine), iter(said)
        for e in audit:
            row = next(left) if e != "I" else None
            if e != "D":
                initial = next(names)
                role = row[2] if e == "K" else {"u": "user", "a": "assistant"}[initial]
                texts.append(f"{role}:{row[3] if row else ''}")
        out.append((conv, gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit,
                    hashlib.sha256("\n".join(texts).encode()).hexdigest()))
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def conversations(seed, n=60, longest=9):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "cut off", "", " \n\t", "Why?  ", "Grüße 🎉.", "a\x0bb", None]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None]
    return [(conv, rng.choice([t, t, t, t + 3, None]), rng.choice(roles), rng.choice(texts))
            for conv in [*range(n), None] for t in range(rng.randrange(1, longest))]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_reports_match_a_search_over_all_edits(spark, seed):
    rows = conversations(seed)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert plain_rows(cr.repair_report(df, "conv_id")) == brute(rows, damage=False)


def test_damage_and_report(spark):
    from clickscope.llm.queries import repaired_conversations

    rows = conversations(4, n=200)
    found = plain_rows(repaired_conversations(spark.createDataFrame(rows, SCHEMA)))
    assert found == brute(rows)
    assert any(r[7] == "" and r[8] == EMPTY for r in found)  # some conversation lost all its rows


def test_state_is_carried_across_batches(spark):
    rows = conversations(5, n=12, longest=40)
    long = [(99, t, ["user", "assistant"][(t * t) % 3 % 2], "text." if t % 7 else "text") for t in range(500)]
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        small = plain_rows(cr.repair_report(spark.createDataFrame(rows + long, SCHEMA), "conv_id"))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert small == plain_rows(cr.repair_report(spark.createDataFrame(rows + long, SCHEMA), "conv_id"))
    assert small[:0] + [r for r in small if r[0] != 99] == brute(rows, damage=False)


def test_repaired_rows(spark):
    rows = [(1, 0, "assistant", "Hello."), (1, 1, "user", "cut"), (1, 1, "user", ""), (1 << 60, None, "user", "Hi."), (None, 5, "user", "Hi.")]
    found = plain_rows(cr.repair(spark.createDataFrame(rows, SCHEMA), "conv_id").select("conv", "step", "edit", "turn", "role", "text", "fault"))
    assert [r for r in found if r[0] == 1 << 60] == [(1 << 60, 1, "K", None, "user", "Hi.", None), (1 << 60, 2, "I", None, "assistant", "", None)]
    assert [r[2] for r in found if r[0] is None] == ["K", "I"]
    first = sorted(r for r in found if r[0] == 1)
    kept = [r for r in first if r[2] != "D"]
    assert re.fullmatch("(s?(ua)+)?", "".join(r[4][0] for r in kept))
    assert [r[1] for r in first] == list(range(1, len(first) + 1))


def test_one_exchange(spark):
    df = cr.repair_report(spark.createDataFrame(conversations(6), SCHEMA), "conv_id")
    assert df._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_clashing_columns_and_empty_tables(spark):
    rows = conversations(7, n=10)
    df = spark.createDataFrame(rows, SCHEMA)
    more = df.select("*", *[F.lit(f"x{i}").alias(c) for i, c in enumerate([*CLASHES, "place", "fault", "edits", "step", "fate"]) if c != "turn"])
    assert plain_rows(cr.repair_report(more, "conv_id")) == brute(rows, damage=False)
    assert cr.repair_report(df.limit(0), "conv_id").collect() == [] and cr.repair(df.limit(0), "conv_id").collect() == []
