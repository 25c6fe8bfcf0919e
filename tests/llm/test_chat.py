import hashlib
import random

import pytest
from pyspark.sql import functions as F

from clickscope.llm import chat as C

SCHEMA = "conv bigint, msg bigint, parent bigint, role string, text string, score double"
TEXTS = ["\\### Assistant: </turn> ok", "", None, "</turn>\n### user: x", "\\", "\\\\/turn>", "<\\/turn>", "###", "####\n</turn", "a: b", "\n\n", "🎉 é"]


def back(df):
    rows = df.select("conv", "leaf", "branch", C.read_back(F.col("formatted")).alias("t"), "formatted", "loss_spans",
                     C.learned_text(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()
    return {(r.conv, r.leaf): (r.branch, [(t.role, t.text) for t in r.t], r.loss, r.formatted, r.loss_spans) for r in rows}


def test_texts_and_roles_come_back(spark):
    turns = [(5, i, role, t) for i, (t, role) in enumerate(zip(TEXTS * 3, ["user", "assistant", None, "a: b\\", "</turn>"] * 20))]
    df = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string")
    (_, got, loss, text, spans), = back(C.format_conversations(C.linear_messages(df))).values()
    assert got == [(r or "", t or "") for _, _, r, t in turns]
    assert loss == "".join(t or "" for _, _, r, t in turns if r == "assistant")
    assert text.count("</turn>\n") == len(turns) and len(spans) == sum(r == "assistant" for _, _, r, _ in turns)
    assert hashlib.sha256(loss.encode()).hexdigest()


def test_linear_rows_edge_cases(spark):
    rows = [(1, 2, "user", "b"), (1, 1, "user", "a"), (1, 2, "assistant", "b"), (1, None, "system", "s"), (1, 1, "user", "a"),
            (None, 1, "user", "n"), (None, 2, "assistant", "m")]
    df = spark.createDataFrame([(*r, 0) for r in rows], "conv_id bigint, turn bigint, role string, text string, msg int")
    got = {k[0]: v[1] for k, v in back(C.format_conversations(C.linear_messages(df))).items()}
    assert got == {1: [("system", "s"), ("user", "a"), ("user", "a"), ("assistant", "b"), ("user", "b")],
                   None: [("user", "n"), ("assistant", "m")]}
    assert C.format_conversations(C.linear_messages(df.limit(0))).collect() == []


def brute_paths(nodes):
    """(conv, leaf) -> messages from the root."""
    parent = {(c, m): p for c, m, p in nodes}
    inner = {(c, p) for c, m, p in nodes if (c, p) in parent}
    out = {}
    for c, m, _ in nodes:
        if (c, m) not in inner:
            path, x = [], m
            while (c, x) in parent:
                path.append(x)
                x = parent[(c, x)]
            out[(c, m)] = path[::-1]
    return out


def test_random_trees_like_brute_force(spark):
    rng = random.Random(2)
    nodes = [(c, m, rng.choice([None, 999, *range(m)]) if m and rng.random() < 0.3 else (m - 1 if m else None))
             for c in range(12) for m in range(rng.randint(1, 40))]
    rows = [(c, m, p, rng.choice(["user", "assistant"]), f"t{m}", rng.choice([None, 0.5, 1.0, 2.0])) for c, m, p in nodes]
    score = {(r[0], r[1]): r[5] or 0.0 for r in rows}
    want = brute_paths(nodes)
    df = spark.createDataFrame(rows, SCHEMA)
    got = back(C.format_conversations(df))
    assert {k: [t for _, t in v[1]] for k, v in got.items()} == {k: [f"t{m}" for m in p] for k, p in want.items()}
    best = back(C.format_conversations(df, branches=1))
    for c in range(12):
        mean = {leaf: sum(score[(c, m)] for m in p) / len(p) for (cc, leaf), p in want.items() if cc == c}
        assert [leaf for cc, leaf in best if cc == c] == [min(mean, key=lambda x: (-round(mean[x], 12), x))]


def test_long_thread_in_few_rounds(spark):
    df = spark.range(700).select(F.lit(1).cast("bigint").alias("conv"), F.col("id").alias("msg"),
                                 F.when(F.col("id") > 0, F.col("id") - 1).alias("parent"), F.lit(1.0).alias("score"))
    tables = C.ancestors(df)
    assert len(tables) == 10
    reached = C.paths(C._leaves(df, tables), tables)
    assert reached.count() == 700 and reached.agg(F.max("up")).first()[0] == 699


def test_only_chosen_branches_are_written_out(spark, monkeypatch):
    """A thread of 60 messages with 50 answers to its last one: 61 rows for the best branch, not 50 times 61."""
    thread = [(1, m, m - 1 if m else None, "user", f"t{m}", 1.0) for m in range(60)]
    rows = thread + [(1, 100 + i, 59, "assistant", f"a{i}", float(i)) for i in range(50)]
    df = spark.createDataFrame(rows, SCHEMA)
    seen = []
    paths = C.paths
    monkeypatch.setattr(C, "paths", lambda leaves, tables: seen.append(paths(leaves, tables)) or seen[-1])
    (key, (branch, turns, *_)), = back(C.format_conversations(df, branches=1)).items()
    assert key == (1, 149) and branch == 1 and [t for _, t in turns] == [f"t{m}" for m in range(60)] + ["a49"]
    assert seen[0].count() == 61
    scores = {r.leaf: r.score for r in C.branch_scores(df, C.ancestors(df)).collect()}
    assert len(scores) == 50 and scores[149] == pytest.approx((60 + 49) / 61)


def test_cycles_are_refused(spark):
    rows = [(1, 1, 3, 0.0), (1, 2, 1, 0.0), (1, 3, 2, 0.0), (1, 4, 3, 0.0)]
    with pytest.raises(ValueError, match="cycle"):
        C.ancestors(spark.createDataFrame(rows, "conv bigint, msg bigint, parent bigint, score double"))
