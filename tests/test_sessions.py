from collections import Counter

import pytest
from pyspark.sql import functions as F

from clickscope.conditions import Condition
from clickscope.operators import sessions
from clickscope.operators.actions import base_actions
from clickscope.sources import load_fixture_tables
from tests.helpers import action, tables


@pytest.fixture(scope="module")
def acts(spark):
    rows = [
        # s1: 3 steps over 12 s; equal-second pair ordered by action_id
        action("s1", "2018-11-26 10:00:00", keyword="b", action_id=11),
        action("s1", "2018-11-26 10:00:00", keyword="a", action_id=10),
        action("s1", "2018-11-26 10:00:12", click_category=4, click_product=9, order_categories="1,2",
               action_id=12),
        # s2: one action
        action("s2", "2018-11-26 11:30:00", user_id=2, pay_categories="7", pay_products="8,9", action_id=20),
        # s3: 6 steps, 10 s
        *[action("s3", f"2018-11-26 11:45:{s:02d}", user_id=3, click_category=2, click_product=2,
                 action_id=30 + s) for s in (0, 2, 4, 6, 8, 10)],
    ]
    return base_actions(tables(spark, rows))


def test_rollup_lists_ordered_with_duplicates(acts):
    got = {r["sessionId"]: r.asDict() for r in sessions.session_rollup(acts, "t").collect()}
    s1 = got["s1"]
    assert s1["searchKeywords"] == "a,b"          # tie on second broken by action id
    assert s1["clickCategoryIds"] == "4" and s1["clickProductIds"] == "9"
    assert s1["orderCategoryIds"] == "1,2" and s1["payProductIds"] == ""
    assert (s1["stepLength"], s1["visitLength"], s1["startTime"]) == (3, 12, "2018-11-26 10:00:00")
    assert s1["professional"] == "学生"
    s2 = got["s2"]
    assert (s2["stepLength"], s2["visitLength"], s2["payProductIds"], s2["searchKeywords"]) == (1, 0, "8,9", "")
    assert got["s3"]["clickProductIds"] == "2,2,2,2,2,2"


def test_bucket_stats(acts):
    r = sessions.session_bucket_stats(acts, "t", Condition(city=1)).collect()[0]
    assert r["session_count"] == 3
    assert r["contiditions"] == '{"city": 1}'
    # visit lengths 12, 0, 10 -> <=10: 2 of 3; steps 3, 1, 6 -> <=5: 2 of 3
    assert r["session_visitLength_le_10s_ratio"] == 66.67
    assert r["session_visitLength_gt_10s_ratio"] == 33.33
    assert r["session_stepLength_le_5_ratio"] == 66.67
    assert r["session_stepLength_gt_5_ratio"] == 33.33


def test_bucket_stats_of_nothing_is_null(acts):
    r = sessions.session_bucket_stats(acts.filter("false"), "t").collect()[0]
    assert r["session_count"] == 0 and r["session_visitLength_le_10s_ratio"] is None


def test_hourly_counts(acts):
    got = {r["hour"]: r["session_count"] for r in sessions.hourly_session_counts(acts).collect()}
    assert got == {"2018-11-26 10": 1, "2018-11-26 11": 2}


def test_sample_takes_everything_when_small(acts):
    # fewer sessions than requested: quota is capped at the hour's size (no endless draw)
    ids = sessions.sample_session_ids(acts, need=1000)
    assert sorted(r["sessionId"] for r in ids.collect()) == ["s1", "s2", "s3"]


def test_sample_is_proportional_and_distinct(spark):
    rows = []
    for h, n in [(0, 50), (1, 30), (2, 20)]:
        for i in range(n):
            rows.append(action(f"h{h}-{i}", f"2018-11-26 0{h}:{i % 60:02d}:00", user_id=1 + i % 4))
    acts = base_actions(tables(spark, rows))
    ids = sessions.sample_session_ids(acts, need=10).collect()
    per_hour = Counter(r["hour"] for r in ids)
    assert per_hour == {"2018-11-26 00": 5, "2018-11-26 01": 3, "2018-11-26 02": 2}
    assert len({r["sessionId"] for r in ids}) == 10
    full = sessions.session_sample(acts, "t", need=10)
    assert full.count() == 10
    again = sorted(r["sessionId"] for r in sessions.sample_session_ids(acts, need=10).collect())
    assert again == sorted(r["sessionId"] for r in ids)  # reproducible


def test_times_ignore_the_session_time_zone(spark):
    # 2018-03-11 02:00-03:00 does not exist in Los Angeles (spring forward)
    rows = [action("dst", "2018-03-11 01:59:50", action_id=1), action("dst", "2018-03-11 02:30:00", action_id=2),
            action("dst", "2018-03-11 03:00:10", action_id=3)]
    acts = base_actions(tables(spark, rows))
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        r = sessions.session_stats(acts).collect()[0]
        full = sessions.session_rollup(acts, "t").collect()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert (r["startTime"], r["endTime"], r["visitLength"]) == ("2018-03-11 01:59:50", "2018-03-11 03:00:10", 3620)
    assert (full["startTime"], full["visitLength"]) == ("2018-03-11 01:59:50", 3620)


def test_sample_is_complete_over_many_hours(spark):
    # 2,000 hours with one session each: every floor is zero, the remainders decide
    rows = [action(f"s{i:04d}", f"20{18 + i // 1000:02d}-{1 + i // 100 % 10:02d}-{1 + i // 24 % 28:02d} {i % 24:02d}:{i // 672:02d}:00")
            for i in range(2000)]
    ids = sessions.sample_session_ids(base_actions(tables(spark, rows)), need=1000).collect()
    assert len({r["sessionId"] for r in ids}) == len(ids) == 1000


@pytest.mark.parametrize("need", [1, 7, 100, 1000, 100_000])
def test_a_large_sample_draws_the_same_sessions(spark, need):
    acts = base_actions(load_fixture_tables(spark, "/root/testdata/sf0.001"), enrich=())
    one_hour = acts.withColumn("action_time", F.concat(F.lit("2024-01-01 10"), F.substring("action_time", 14, 6)))
    for log in (acts, one_hour):
        by_hour = sessions.sample_session_ids(log, need)
        by_cell = sessions.sample_session_ids(log, need, small=0)
        kept = sessions.sample_session_ids(log, need, stats=sessions.session_stats(log))
        want = sorted(map(tuple, by_hour.collect()))
        assert sorted(map(tuple, by_cell.collect())) == want and sorted(map(tuple, kept.collect())) == want
        assert by_cell.schema == by_hour.schema


def test_a_large_sample_is_not_broadcast(spark):
    acts = base_actions(load_fixture_tables(spark, "/root/testdata/sf0.001"), enrich=())
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = [sessions.session_sample(acts, "r", need, small=1000)._jdf.queryExecution().executedPlan().toString() for need in (1000, 1001)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "BroadcastHashJoin" in plans[0] and "BroadcastHashJoin" not in plans[1]
