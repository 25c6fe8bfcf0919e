import math
import random

import pytest
from pyspark.sql import functions as F

from clickscope.llm import mixing as M
from tests.llm.edge import edge_docs, empty_docs


def brute_targets(sizes, cap=3):
    """Share by weight, stop at the cap, share the excess again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        above = [s for s in free if share[s] > cap * sizes[s]]
        if not above:
            return {**fixed, **share}
        fixed.update({s: cap * sizes[s] for s in above})


def corpus(spark, seed=1, n=3000):
    rng = random.Random(seed)
    rows = [(i, " ".join("w" * rng.randint(1, 3) for _ in range(rng.choice([1, 5, 30, 300]))),
             rng.choice(["hot"] * 8 + ["a", "b", "é", None, "tiny"]) if i > 3 else "tiny") for i in range(n)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string")


def test_targets_by_water_filling(spark):
    rng = random.Random(3)
    for _ in range(4):
        sizes = {f"s{i}": rng.choice([0, 1, 10, 500, 10_000]) for i in range(7)} | {None: rng.choice([3, 900])}
        df = M.targets(M.cycle_weights(spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")))
        want = brute_targets(sizes)
        for r in df.collect():
            assert r.target == pytest.approx(want[r.source], rel=1e-9, abs=1e-9)


def test_sample_meets_targets_and_reruns_agree(spark):
    docs = corpus(spark)
    rows = M.sample(docs).collect()
    again = M.sample(docs.repartition(3)).collect()
    assert len(rows) == docs.count() and {r.id: r.copies for r in rows} == {r.id: r.copies for r in again}
    by_source = {}
    for r in rows:
        by_source.setdefault(r.source, []).append(r)
        assert 0 <= r.copies <= 3
    for name, own in by_source.items():
        taken = sum(r.copies * r.size for r in own)
        assert abs(taken - own[0].target) <= max(2, 0.02 * own[0].target), name
        whole = math.floor(own[0].target / own[0].source_size)
        assert {r.copies for r in own if r.size} <= {whole, whole + 1}


def test_keys_are_sorted_prefix_sums(spark):
    docs = corpus(spark, 5, 600)
    rows = {}
    for r in M.sample(docs, cell_rows=16).collect():
        rows.setdefault(r.source, []).append(r)
    other = {r.id: r.copies for r in M.sample(docs, cell_rows=10_000).collect()}
    for own in rows.values():  # the cells only cut the work, never the answer
        assert all(other[r.id] == r.copies for r in own)


def test_better_documents_are_drawn_first(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("a b c d").alias("text"),
                                    F.when(F.col("id") < 2000, "x").otherwise("y").alias("source"), (F.col("id") % 2).alias("good"))
    drawn = M.sample(docs, quality=F.when(F.col("good") == 1, 1.0).otherwise(0.1)).where("source = 'x'").collect()
    good = sum(r.copies for r in drawn if r.id % 2)
    assert good > 1.5 * (sum(r.copies for r in drawn) - good)


def test_edge_rows_and_the_mixed_corpus(spark):
    docs = edge_docs(spark, clashing=True)
    rows = M.sample(docs).collect()
    assert len(rows) == docs.count()
    mixed = M.mix(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in rows)
    want, got = {}, {}
    for r in rows:
        want[r.id] = want.get(r.id, 0) + r.copies
    for r in mixed.select("doc_id").collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    assert got == {i: n for i, n in want.items() if n}
    assert M.sample(empty_docs(spark)).collect() == [] and M.mix(empty_docs(spark)).collect() == []
    nothing = spark.createDataFrame([(1, None, "a"), (2, "", "b")], "doc_id bigint, text string, source string")
    assert {(r.target, r.copies) for r in M.sample(nothing).collect()} == {(0.0, 0)}


def test_a_very_long_document_does_not_shut_out_small_ones(spark):
    sizes = {"a": [60_000] + [100] * 999, "b": [100] * 320, "c": [100] * 481}  # a has weight 1 of 6: target 40,000
    rows = [(1000 * k + i, n, s) for k, s in enumerate(sizes) for i, n in enumerate(sizes[s])]
    docs = spark.createDataFrame(rows, "doc_id bigint, n bigint, source string").withColumn("text", F.lit("w"))
    for seed in (0, 4):
        own = M.sample(docs, size=F.col("n"), quality=F.lit(1.0), seed=seed).where("source = 'a'").collect()
        assert own[0].target == 40_000
        assert abs(sum(r.copies * r.size for r in own) - 40_000) <= 40, seed


def test_few_rounds_fill_a_budget_whatever_the_sizes(spark, monkeypatch):
    """Sizes that would cost a round each in key order: a row that just misses the gap behind every small one."""
    rows = [(i, "a", n) for i, n in enumerate([1, 990, 1, 989, 1, 988] * 60 + list(range(900, 990)))]
    rows += [(5000 + i, "b", 700) for i in range(40)] + [(6000 + i, "c", 3) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, n bigint").withColumn("text", F.lit("w"))
    rounds = []
    summed = M._summed
    monkeypatch.setattr(M, "_summed", lambda df: (rounds.append(1), summed(df))[1])
    for seed in range(3):
        del rounds[:]
        own = M.sample(docs, size=F.col("n"), quality=F.lit(1.0), seed=seed).collect()
        assert len(rounds) <= 2 + math.log2(1 / M.NEAR) + 1
        for name in "abc":
            mine = [r for r in own if r.source == name]
            assert abs(sum(r.copies * r.size for r in mine) - mine[0].target) <= max(0.01 * mine[0].target, 350), (name, seed)
