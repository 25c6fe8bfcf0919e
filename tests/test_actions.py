import pytest
from pyspark.sql import functions as F

from clickscope.conditions import Condition
from clickscope.operators.actions import base_actions, hot_users, join_users
from tests.helpers import action, rows, tables


@pytest.fixture(scope="module")
def t(spark):
    return tables(spark, [
        action("s1", "2018-11-01 10:00:00", user_id=1, click_category=3, click_product=7, city_id=1),
        action("s1", "2018-11-01 10:00:05", user_id=1, keyword="苹果", city_id=1),
        action("s2", "2018-11-02 09:00:00", user_id=2, click_category=5, click_product=99, city_id=2),
        action("s3", "2018-11-03 09:00:00", user_id=3, pay_categories="1,2", pay_products="3", city_id=7),
        action("s4", "2018-11-04 09:00:00", user_id=4, keyword="i7", city_id=2),
        action("s9", "2018-11-04 09:00:00", user_id=42, click_category=3, click_product=7),  # unknown user
    ])


def test_enrichment_and_unknown_user_dropped(t):
    df = base_actions(t)
    got = rows(df, "session_id", "user_name", "professional", "product_name")
    assert got == [("s1", "user_1", "学生", "product_7"), ("s1", "user_1", "学生", None),
                   ("s2", "user_2", "程序员", None), ("s3", "user_3", "经理", None),
                   ("s4", "user_4", "老师", None)]
    # the placeholders of the fact table are replaced, not duplicated (ambiguity quirk)
    assert df.columns.count("professional") == 1


def test_minimal_enrichment_keeps_unknown_user_drop(t):
    df = base_actions(t, enrich=())
    assert "professional" not in df.columns and "product_name" not in df.columns
    assert sorted(r["session_id"] for r in df.collect()) == ["s1", "s1", "s2", "s3", "s4"]


@pytest.mark.parametrize("cond,expected", [
    (Condition(start_date="2018-11-02", end_date="2018-11-03"), ["s2", "s3"]),
    (Condition(start_age=30, end_age=45), ["s2", "s3"]),
    (Condition(professionals=("学生", "老师")), ["s1", "s1", "s4"]),
    (Condition(city=2), ["s2", "s4"]),
    (Condition(gender="女"), ["s2", "s4"]),
    (Condition(keywords=("苹果",)), ["s1"]),
    (Condition(category_ids=(3, 5)), ["s1", "s2"]),
    (Condition(start_date="2018-11-01", gender="男", professionals=("学生", "经理")), ["s1", "s1", "s3"]),
    (Condition(), ["s1", "s1", "s2", "s3", "s4"]),
])
def test_condition_fields(t, cond, expected):
    assert sorted(r["session_id"] for r in base_actions(t, cond).collect()) == expected


def test_condition_json_is_stable():
    cond = Condition(end_date="2018-12-28", start_date="2018-11-01", category_ids=(3,))
    assert cond.to_json() == '{"category_ids": [3], "end_date": "2018-12-28", "start_date": "2018-11-01"}'
    assert Condition().to_json() == "{}"


def test_non_click_rows_do_not_meet_a_product_with_id_minus_one(spark):
    t = tables(spark, [action("s1", "2018-11-01 10:00:00", user_id=1)],
               products=[(-1, "ghost", "x"), (1, "p1", "x")])
    assert rows(base_actions(t), "product_name") == [(None,)]


def test_hot_users_are_joined_apart_with_the_same_rows(spark):
    rows = [action(f"s{i % 7}", "2018-11-26 10:00:00", user_id=1 if i % 2 else 2 + i % 5, click_product=i % 4, action_id=i)
            for i in range(60)]
    t = tables(spark, rows)
    for condition in (None, Condition(professionals=("程序员",)), Condition(gender="男")):
        for enrich in ((), ("professional", "user_name", "product_name")):
            plain = base_actions(t, condition, enrich=enrich)
            for most in (1, 3):
                split = base_actions(t, condition, enrich=enrich, hot=hot_users(t.actions, min_rows=2, most=most))
                assert split.columns == plain.columns
                assert sorted(map(str, split.collect())) == sorted(map(str, plain.collect()))


def test_half_of_all_rows_on_one_user_are_spread(spark):
    ids = spark.range(200_000).withColumnRenamed("id", "action_id")
    acts = ids.select(F.when(F.col("action_id") % 2 == 0, 1).otherwise(F.col("action_id") % 5000).cast("bigint").alias("user_id"),
                      "action_id").repartition(4)
    users = spark.range(6000).select(F.col("id").alias("user_id"), F.concat(F.lit("p"), F.col("id").cast("string")).alias("professional"))
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    old = {k: spark.conf.get(k) for k in keys}
    spark.conf.set(keys[0], "-1")
    spark.conf.set(keys[1], "false")

    def tasks(hot):
        joined = join_users(acts, users, {"professional": "professional"}, hot)
        return (sorted(r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()),
                joined.agg(F.sum(F.xxhash64("user_id", "action_id", "professional").cast("decimal(38,0)")), F.count("professional")).first())

    try:
        plain, rows = tasks(None)
        spread, same = tasks(hot_users(acts, min_rows=1000))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert same == rows and rows[1] == 200_000
    assert plain[-1] > 3 * plain[4] and spread[-1] < 1.5 * spread[4]
