"""Page single-jump conversion rate along a target page flow."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickscope.functions import percent_half_up, task_id
from clickscope.operators.ordering import DAY, jump_and_view_counts


def flow_pairs(flow: list[int] | tuple[int, ...]) -> list[tuple[int, int]]:
    """Adjacent pairs of the target flow, any length, duplicates removed."""
    seen, pairs = set(), []
    for a, b in zip(flow, flow[1:]):
        if (a, b) not in seen:
            seen.add((a, b))
            pairs.append((int(a), int(b)))
    return pairs


def targeted_page_views(actions: DataFrame, flow: list[int] | tuple[int, ...]) -> DataFrame:
    """View count of every page that appears in the flow (last page of a session included)."""
    pages = sorted({int(p) for p in flow})
    return (actions.filter(F.col("page_id").isin(pages))
            .groupBy("page_id").agg(F.count(F.lit(1)).alias("view_count")))


def _wanted(flow) -> tuple:
    """Predicates: is (a, b) a pair of the flow; is a page one that a pair starts from."""
    pairs = flow_pairs(flow)

    def pair(a, b):
        if not pairs:
            return F.lit(False)
        listed = F.struct(a, b).isin([F.struct(F.lit(x).cast("long"), F.lit(y).cast("long")) for x, y in pairs])
        return F.coalesce(listed, F.lit(False))

    return pair, F.coalesce(F.col("x").isin(sorted({a for a, _ in pairs})), F.lit(False))


def _jump_text() -> Column:
    return F.concat_ws("_", F.col("x").cast("string"), F.col("y").cast("string")).alias("pageJump")


def page_jumps(actions: DataFrame, flow: list[int] | tuple[int, ...], buckets: int | DataFrame = DAY) -> DataFrame:
    """Count of consecutive page pairs (by time inside a session) that are flow pairs.

    Adjacency is computed on all actions first, then the pairs are filtered:
    filtering pages first would invent jumps over removed actions.
    """
    pair, _ = _wanted(flow)
    counts = jump_and_view_counts(actions, "page_id", pair, F.lit(False), buckets)
    return counts.filter(F.col("kind") == "p").select(
        _jump_text(), F.col("x").alias("from_page"), F.col("y").alias("to_page"), F.col("n").alias("jump_count"))


def page_conversion_rate(actions: DataFrame, run_id: str, flow: list[int] | tuple[int, ...],
                         buckets: int | DataFrame = DAY) -> DataFrame:
    """rate(a_b) = jumps(a->b) / views(a) in percent (HALF_UP, 2 decimals).

    Pairs that never occur produce no row. Views are counted in the pass that
    counts the jumps and meet them in a window over the few counts.
    """
    pair, view = _wanted(flow)
    counts = jump_and_view_counts(actions, "page_id", pair, view, buckets)
    views = F.max(F.when(F.col("kind") == "v", F.col("n"))).over(Window.partitionBy("x"))
    return (counts.withColumn("views", views).filter(F.col("kind") == "p")
            .select(task_id(run_id), _jump_text(), percent_half_up("n", "views").alias("rate")))
