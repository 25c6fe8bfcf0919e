"""Hot categories (click / order / pay counts) and their most active sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickscope.functions import task_id


def _id_list(c: str):
    """Comma list column -> array of items ('' for NULL; empty items are kept and filtered later)."""
    return F.split(F.coalesce(F.col(c), F.lit("")), ",")


def category_event_counts(actions: DataFrame) -> DataFrame:
    """Per category id (string): click_count, order_count, pay_count; missing kinds are 0.

    Each action becomes one array [clicked id or '', order ids..., pay ids...]
    exploded with its position, so the kind follows from the position: a
    click counts its category once, an order/pay every listed id. Plain
    split/concat/posexplode keep the stage in generated code (no per-row
    lambdas), and the counts combine map-side before the shuffle.
    """
    click = F.when(F.col("click_category_id") > 0, F.col("click_category_id").cast("string")).otherwise(F.lit(""))
    parts = actions.select(F.array(click).alias("c"), _id_list("order_category_ids").alias("o"),
                           _id_list("pay_category_ids").alias("p"))
    items = (parts.select(F.size("o").alias("n_order"), F.posexplode(F.concat("c", "o", "p")).alias("pos", "category_id"))
             .filter(F.col("category_id") != ""))
    pos, n_order = F.col("pos"), F.col("n_order")
    return items.groupBy("category_id").agg(
        F.count_if(pos == 0).alias("click_count"),
        F.count_if((pos >= 1) & (pos <= n_order)).alias("order_count"),
        F.count_if(pos > n_order).alias("pay_count"),
    )


def category_top10(actions: DataFrame, run_id: str, k: int = 10) -> DataFrame:
    """Top ``k`` categories by clicks, then orders, then pays (ties: category id)."""
    counts = category_event_counts(actions)
    top = counts.orderBy(F.desc("click_count"), F.desc("order_count"), F.desc("pay_count"),
                         F.asc("category_id")).limit(k)
    return top.select(task_id(run_id), "category_id", "click_count", "order_count", "pay_count")


def top_sessions_per_top_category(actions: DataFrame, run_id: str, k_categories: int = 10,
                                  k_sessions: int = 10, top: DataFrame | None = None) -> DataFrame:
    """For each top category, its ``k_sessions`` sessions with most clicks in it.

    The top categories (at most ``k_categories`` rows) are broadcast for a
    semi-join; (category, session) clicks are counted with partial
    aggregation; the per-category ranking keeps ``k_sessions`` rows per map
    task before its shuffle, so few, huge categories stay cheap. ``top`` is
    the ``category_top10`` of the same actions where the caller has it already.
    """
    top = category_top10(actions, run_id, k_categories) if top is None else top.limit(k_categories)
    top = top.select(F.col("category_id").alias("categoryId"))
    clicks = (actions.filter(F.col("click_category_id") > 0)
              .select("session_id", F.col("click_category_id").cast("string").alias("categoryId")))
    counts = (clicks.join(F.broadcast(top), "categoryId", "left_semi")
              .groupBy("categoryId", "session_id").agg(F.count(F.lit(1)).alias("clickCount")))
    w = Window.partitionBy("categoryId").orderBy(F.desc("clickCount"), F.asc("session_id"))
    ranked = counts.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= F.lit(k_sessions))
    return ranked.select(task_id(run_id), "categoryId", F.col("session_id").alias("sessionId"), "clickCount")
