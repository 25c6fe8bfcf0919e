"""Profession mix of sessions (or users) that clicked one product twice or more."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickscope.functions import non_empty, percent_half_up, task_id
from clickscope.operators.ordering import with_order

# Profession labels of the shop's user table, per output column.
DEFAULT_PROFESSIONS = {
    "teacher_ratio": "老师",
    "programmer_ratio": "程序员",
    "PM_ratio": "经理",
    "stu_ratio": "学生",
}


def last_profession(profession: Column) -> Column:
    """Aggregate: the last non-empty profession of a group, by time, tie (see
    ``ordering.with_order``), then user id; NULL if all are empty."""
    return F.max_by(profession, F.when(non_empty(profession), F.struct("action_time", "_tie", "user_id")))


def repeat_click_groups(actions: DataFrame, users: DataFrame, by: str = "session",
                        min_clicks: int = 2) -> DataFrame:
    """Sessions (``by='session'``) or users (``by='user'``) with >= ``min_clicks``
    clicks on one product, with the group's last non-empty profession.

    Only clicks are counted and shuffled (two hash aggregations with map-side
    combine). The profession is then looked up for the few groups that
    qualify: a user's in the user dimension, a session's from its own actions.
    """
    key = {"session": "session_id", "user": "user_id"}[by]
    groups = (actions.filter(F.col("click_product_id") > 0)
              .groupBy(key, "click_product_id").agg(F.count(F.lit(1)).alias("n"))
              .filter(F.col("n") >= F.lit(min_clicks)).select(key).distinct())
    named = users.select("user_id", "professional")
    if by == "user":
        found = groups.join(named, "user_id", "left")
        return found.select(F.col("user_id").alias("group_id"), F.coalesce("professional", F.lit("")).alias("professional"))
    own = with_order(actions.drop("professional")).select("session_id", "user_id", "action_time", "_tie")
    last = (own.join(groups, "session_id", "left_semi").join(named, "user_id", "left")
            .groupBy("session_id").agg(last_profession(F.col("professional")).alias("professional")))
    return last.select(F.col("session_id").alias("group_id"), F.coalesce("professional", F.lit("")).alias("professional"))


def professional_share(actions: DataFrame, users: DataFrame, run_id: str, by: str = "session",
                       professions: dict[str, str] | None = None) -> DataFrame:
    """One row: userCount (groups counted) and the share of each profession in percent."""
    mapping = professions or DEFAULT_PROFESSIONS
    groups = repeat_click_groups(actions, users, by)
    counts = groups.agg(
        F.count(F.lit(1)).alias("userCount"),
        *[F.count_if(F.col("professional") == F.lit(label)).alias(f"_{name}") for name, label in mapping.items()],
    )
    return counts.select(
        task_id(run_id), "userCount",
        *[percent_half_up(f"_{name}", "userCount").alias(name) for name in mapping],
    )
