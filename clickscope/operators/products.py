"""Hot products (by clicks), their top buyers, and those buyers' visits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickscope.functions import classify_operation, split_ids, task_id
from clickscope.operators.actions import tie_columns
from clickscope.sources.tables import ModelTables


def product_click_top10(actions: DataFrame, run_id: str, k: int = 10) -> DataFrame:
    """Top ``k`` clicked products (ties: product id)."""
    counts = (actions.filter(F.col("click_product_id") > 0)
              .groupBy(F.col("click_product_id").alias("product_id"))
              .agg(F.count(F.lit(1)).alias("click_count")))
    return (counts.orderBy(F.desc("click_count"), F.asc("product_id")).limit(k)
            .select(task_id(run_id), "product_id", "click_count"))


def _hot_ids(actions: DataFrame, k: int) -> Column:
    """Scalar subquery: array of the ``k`` hot product ids (bounded by k)."""
    return product_click_top10(actions, "", k).agg(F.collect_list("product_id")).scalar()


def _paid_products() -> Column:
    """Distinct product ids of one pay action as text (a repeated id counts once, '' items go)."""
    return F.array_distinct(split_ids("pay_product_ids"))


def _as_id(text: Column) -> Column:
    """The id as a number; text that is none fails the query instead of vanishing."""
    return F.when(text.rlike("^-?[0-9]+$"), text.cast("long")).otherwise(
        F.raise_error(F.concat(F.lit("not a product id: "), text)).cast("long"))


def paid_hot_actions(actions: DataFrame, k: int = 10) -> DataFrame:
    """Actions whose payment includes at least one hot product.

    The hot list (k ids) is a scalar subquery evaluated once and shipped with
    the task, so this is a map-only filter: no join, no dedup shuffle.
    """
    return actions.filter(F.arrays_overlap(_paid_products(), _hot_ids(actions, k).cast("array<string>")))


def user_product_purchases(actions: DataFrame, hot_only_k: int | None = None) -> DataFrame:
    """(user_id, product_id, purchase_count): pay actions per user and product.

    With ``hot_only_k`` only the hot products are counted. Purchases are dealt
    by (user, product) of their own accord: an aggregation on top of a join by
    user would otherwise reuse that partitioning and keep all rows of a hot
    user in one task.
    """
    paid = (actions.filter(F.col("pay_product_ids").isNotNull())
            .select("user_id", F.explode(_paid_products()).alias("product_id")))
    if hot_only_k is not None:
        paid = paid.filter(F.array_contains(_hot_ids(actions, hot_only_k).cast("array<string>"), F.col("product_id")))
    counts = (paid.repartition("user_id", "product_id")
              .groupBy("user_id", "product_id").agg(F.count(F.lit(1)).alias("purchase_count")))
    return counts.select("user_id", _as_id(F.col("product_id")).alias("product_id"), "purchase_count")


def top2_buyers_per_hot_product(actions: DataFrame, run_id: str, k_products: int = 10,
                                k_buyers: int = 2) -> DataFrame:
    """For each hot product, the ``k_buyers`` users who paid for it most often (ties: user id)."""
    counts = user_product_purchases(actions, hot_only_k=k_products)
    w = Window.partitionBy("product_id").orderBy(F.desc("purchase_count"), F.asc("user_id"))
    ranked = counts.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= F.lit(k_buyers))
    return ranked.select(task_id(run_id), "product_id", "user_id", "purchase_count")


def hot_product_user_visits(tables: ModelTables, actions: DataFrame, run_id: str, date: str | None = None,
                            k_products: int = 10, k_buyers: int = 2) -> DataFrame:
    """Every action (on ``date``, or all days) of each hot product's top buyers, time-ordered.

    One output row per (hot product, action of one of its top buyers). The
    buyer table has at most k_products * k_buyers rows, so it is broadcast
    (with the hot product's name attached) against the action scan. A product
    id that the product dimension repeats is named once (its smallest name).
    """
    buyers = top2_buyers_per_hot_product(actions, run_id, k_products, k_buyers).select("product_id", "user_id")
    names = tables.products.groupBy("product_id").agg(F.min("product_name").alias("product_name"))
    named = buyers.join(names, "product_id", "left")
    visits = actions.drop("product_name")  # the name shown is the hot product's, not the clicked one (if present)
    if date is not None:
        visits = visits.filter(F.col("date") == F.lit(date))
    ties = tie_columns(visits)
    op_type, op_obj = classify_operation()
    rows = visits.join(F.broadcast(named), "user_id", "inner").select(
        task_id(run_id), "product_id", "product_name",
        F.col("user_id").cast("string").alias("user_id"), "user_name", "action_time",
        op_type, op_obj, *ties,
    )
    return rows.orderBy("action_time", *ties, "product_id").drop(*ties)
