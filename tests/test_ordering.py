"""The bucketed ordering must equal a plain per-session sort, including when
one session spans many time buckets."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from clickscope.operators import pages, sessions
from clickscope.operators.actions import base_actions
from clickscope.operators.ordering import DAY, HOUR, MINUTE, jump_and_view_counts, measured_buckets, with_order
from tests.helpers import action, tables


def make_rows(seed=7):
    rnd = random.Random(seed)
    rows, aid = [], 0
    # one hot session with most of the rows, plus many small ones
    for s, n in [("hot", 600)] + [(f"s{i:03d}", rnd.randint(1, 6)) for i in range(120)]:
        for _ in range(n):
            sec = rnd.randint(0, 3000)
            rows.append(action(s, f"2018-11-26 {sec // 3600:02d}:{sec // 60 % 60:02d}:{sec % 60:02d}",
                               page_id=rnd.randint(1, 4), action_id=aid,
                               keyword=rnd.choice([None, "k1", "k2"])))
            aid += 1
    return rows


def counts_of(rows_df):
    return {(r["x"], r["y"]): r["n"] for r in rows_df.where("kind = 'p'").collect()}


def brute_counts(rows):
    return dict(Counter((a, b) for _, a, b in brute_pairs(rows)))


def brute_pairs(rows):
    by_session = {}
    for r in sorted(rows, key=lambda r: (r["session_id"], r["action_time"], r["action_id"])):
        by_session.setdefault(r["session_id"], []).append(r)
    out = []
    for s, acts in by_session.items():
        out += [(s, a["page_id"], b["page_id"]) for a, b in zip(acts, acts[1:])]
    return sorted(out)


def every_pair(a, b):
    return a.isNotNull() & b.isNotNull()


@pytest.mark.parametrize("chars", [DAY, HOUR, MINUTE, 19])
def test_bucket_width_does_not_change_the_answer(spark, chars):
    rows = make_rows()
    acts = base_actions(tables(spark, rows), enrich=())
    assert counts_of(jump_and_view_counts(acts, "page_id", every_pair, F.lit(True), chars)) == brute_counts(rows)
    lists = {r["sessionId"]: r["searchKeywords"] for r in sessions.session_rollup(acts, "t", chars).collect()}
    hot = [r["search_keyword"] for r in sorted(rows, key=lambda r: (r["action_time"], r["action_id"]))
           if r["session_id"] == "hot" and r["search_keyword"]]
    assert lists["hot"] == ",".join(hot)


def test_a_hot_session_is_cut_into_many_buckets(spark):
    acts = with_order(base_actions(tables(spark, make_rows()), enrich=()), MINUTE)
    sizes = [r["count"] for r in acts.where("session_id = 'hot'").groupBy("session_id", "_bucket").count().collect()]
    assert len(sizes) > 40 and max(sizes) < 40


def test_views_come_from_the_same_pass(spark):
    rows = make_rows(seed=3)
    acts = base_actions(tables(spark, rows), enrich=())
    got = jump_and_view_counts(acts, "page_id", every_pair, F.col("x").isin([1, 2]), HOUR)
    views = {r["x"]: r["n"] for r in got.where("kind = 'v'").collect()}
    assert views == {p: sum(r["page_id"] == p for r in rows) for p in (1, 2)}


def test_jumps_use_all_actions_before_page_filter(spark):
    # 1 -> 9 -> 2 : there is no 1->2 jump; filtering pages first would invent one
    rows = [action("s", "2018-11-26 10:00:00", page_id=1), action("s", "2018-11-26 10:00:01", page_id=9),
            action("s", "2018-11-26 10:00:02", page_id=2), action("s", "2018-11-27 10:00:03", page_id=3)]
    acts = base_actions(tables(spark, rows), enrich=())
    got = {r["pageJump"]: r["jump_count"] for r in pages.page_jumps(acts, [1, 2, 3]).collect()}
    assert got == {"2_3": 1}  # across midnight, so across buckets


def test_without_action_id_the_row_hash_orders_ties(spark):
    rows = make_rows(seed=11)
    # unique times per session so the expected order is defined; drop the id column
    seen, unique_rows = set(), []
    for r in rows:
        if (r["session_id"], r["action_time"]) not in seen:
            seen.add((r["session_id"], r["action_time"]))
            unique_rows.append(r)
    acts = base_actions(tables(spark, unique_rows), enrich=()).drop("action_id")
    assert counts_of(jump_and_view_counts(acts, "page_id", every_pair, F.lit(False), HOUR)) == brute_counts(unique_rows)


def one_tie_column_less(df):
    return df.drop("action_id")


@pytest.mark.parametrize("with_ids", [True, False])
def test_measured_buckets_do_not_change_the_answer(spark, with_ids):
    rows = make_rows()
    # one second holds many actions, and the hot session goes on after midnight
    rows += [action("hot", "2018-11-26 00:10:00", page_id=1 + i % 4, action_id=10_000 + i, keyword=f"s{i}") for i in range(300)]
    rows += [action("hot", f"2018-11-27 00:00:{i:02d}", page_id=1 + i % 3, action_id=20_000 + i) for i in range(30)]
    acts = base_actions(tables(spark, rows), enrich=())
    if not with_ids:
        acts = one_tie_column_less(acts)
    buckets = measured_buckets(acts, min_rows=100)
    assert {r["session_id"]: sorted(r["hours"]) for r in buckets.collect()} == {"hot": ["2018-11-26 00"]}
    ordered = with_order(acts, buckets)
    sizes = [r["count"] for r in ordered.where("session_id = 'hot'").groupBy("_bucket").count().collect()]
    assert len(sizes) > 100 and max(sizes) <= 31
    # buckets are ranges of the time order
    spans = (ordered.groupBy("session_id", "_bucket").agg(F.min(F.struct("action_time", "_tie")).alias("a"),
                                                          F.max(F.struct("action_time", "_tie")).alias("b"))
             .orderBy("session_id", "_bucket").collect())
    assert all(x["b"] < y["a"] for x, y in zip(spans, spans[1:]) if x["session_id"] == y["session_id"])
    plain = counts_of(jump_and_view_counts(acts, "page_id", every_pair, F.lit(True)))
    assert counts_of(jump_and_view_counts(acts, "page_id", every_pair, F.lit(True), buckets)) == plain
    if with_ids:
        assert plain == brute_counts(rows)
    by_day = {tuple(r) for r in sessions.session_rollup(acts, "t").collect()}
    assert {tuple(r) for r in sessions.session_rollup(acts, "t", buckets).collect()} == by_day


def test_a_session_of_a_million_rows_in_one_hour_is_spread(spark):
    """10^6 rows of one session in one hour among 10^5 small sessions."""
    ids = spark.range(1_100_000).withColumnRenamed("id", "action_id")
    hot = F.col("action_id") < 1_000_000
    second = F.when(hot, F.pmod(F.xxhash64("action_id"), F.lit(3600))).otherwise(F.lit(7))
    acts = ids.select(
        F.when(hot, "hot").otherwise(F.concat(F.lit("s"), F.col("action_id").cast("string"))).alias("session_id"),
        F.concat(F.lit("2018-11-26 10:"), F.lpad(F.floor(second / 60).cast("string"), 2, "0"), F.lit(":"),
                 F.lpad((second % 60).cast("string"), 2, "0")).alias("action_time"),
        (F.col("action_id") % 5 + 1).alias("page_id"), "action_id").repartition(4)
    buckets = measured_buckets(acts, min_rows=10_000).checkpoint()

    def tasks(how):
        dealt = with_order(acts, how).repartition(8, "session_id", "_bucket")
        return sorted(r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect())

    by_day, measured = tasks(DAY), tasks(buckets)
    assert by_day[-1] > 1_000_000 and measured[-1] < 3 * measured[4]
    pair = lambda a, b: a.isNotNull() & b.isNotNull()
    assert (counts_of(jump_and_view_counts(acts, "page_id", pair, F.lit(False), buckets))
            == counts_of(jump_and_view_counts(acts, "page_id", pair, F.lit(False))))
