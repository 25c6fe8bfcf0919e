"""Session rollups and the session-level reports (length/step mix, sample).

Two rollups exist on purpose:

* ``session_stats`` is the light one (start, end, step count, visit
  length): fixed-width aggregates with map-side partial aggregation, so a
  session of any size is combined before the shuffle. All counting reports
  use it.
* ``session_rollup`` adds the ordered comma lists of the full session record.
  Lists grow with the session, so they are built per time bucket and then
  put end to end (see ``ordering``); only queries that must show lists use it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickscope.conditions import Condition
from clickscope.functions import (
    action_ts,
    format_ts,
    hour_key,
    non_empty,
    percent_half_up,
    seconds_between,
    task_id,
    ts_seconds_between,
)
from clickscope.operators.ordering import DAY, with_order
from clickscope.operators.professions import last_profession

LIST_FIELDS = [
    # (output name, value column, keep predicate)
    ("searchKeywords", "search_keyword", lambda: non_empty("search_keyword")),
    ("clickCategoryIds", "click_category_id", lambda: F.col("click_category_id") > 0),
    ("clickProductIds", "click_product_id", lambda: F.col("click_product_id") > 0),
    ("orderCategoryIds", "order_category_ids", lambda: non_empty("order_category_ids")),
    ("orderProductIds", "order_product_ids", lambda: non_empty("order_product_ids")),
    ("payCategoryIds", "pay_category_ids", lambda: non_empty("pay_category_ids")),
    ("payProductIds", "pay_product_ids", lambda: non_empty("pay_product_ids")),
]


def session_stats(actions: DataFrame) -> DataFrame:
    """One row per session: sessionId, startTime, endTime (text), stepLength, visitLength.

    Times are aggregated as zone-free timestamps (fixed-width values), which
    keeps the aggregation hash-based; min/max over the text column would
    force a sort-based aggregation of the whole action log.
    """
    t = action_ts(F.col("action_time"))
    stats = actions.groupBy("session_id").agg(
        F.min(t).alias("t0"), F.max(t).alias("t1"), F.count(F.lit(1)).alias("stepLength"))
    return stats.select(
        F.col("session_id").alias("sessionId"),
        format_ts(F.col("t0")).alias("startTime"),
        format_ts(F.col("t1")).alias("endTime"),
        "stepLength",
        ts_seconds_between("t0", "t1").alias("visitLength"),
    )


def session_rollup(actions: DataFrame, run_id: str, buckets: int | DataFrame = DAY) -> DataFrame:
    """Full session record (SessionInfo) including ordered comma lists.

    Lists follow (action_time, tie) order, keep duplicates, and are '' when
    empty. Built in two aggregation levels: ordered lists per (session, time
    bucket), then the buckets' texts end to end. The first level bounds what a
    task sorts to one bucket of a session (see ``ordering``); the finished
    record holds all its lists and, as one row, stays below Spark's 2 GB.
    """
    if "professional" not in actions.columns:
        actions = actions.withColumn("professional", F.lit(None).cast("string"))
    actions = with_order(actions, buckets)
    prof = F.col("professional")
    names = [name for name, _, _ in LIST_FIELDS]
    # One struct per action: its place in time and every list value (NULL
    # where that action contributes nothing), so each level collects and
    # sorts a single array; array_join skips the NULLs.
    values = [F.when(keep(), F.col(col).cast("string")).alias(name) for name, col, keep in LIST_FIELDS]
    contributes = reduce(lambda a, b: a | b, [keep() for _, _, keep in LIST_FIELDS])
    item = F.when(contributes, F.struct("action_time", "_tie", *values))
    per_bucket = (actions.groupBy("session_id", "_bucket").agg(
        F.min("action_time").alias("t0"),
        F.max("action_time").alias("t1"),
        F.count(F.lit(1)).alias("n"),
        last_profession(prof).alias("prof"),
        F.sort_array(F.collect_list(item)).alias("items"),
    ).select("session_id", "_bucket", "t0", "t1", "n", "prof",
             *[F.nullif(F.array_join(F.col("items").getField(name), ","), F.lit("")).alias(name) for name in names]))
    piece = F.struct("_bucket", *[F.col(name) for name in names])
    per_session = (per_bucket.groupBy("session_id").agg(
        F.min("t0").alias("startTime"),
        F.max("t1").alias("endTime"),
        F.sum("n").alias("stepLength"),
        F.max_by("prof", F.when(F.col("prof").isNotNull(), F.coalesce("_bucket", F.lit("")))).alias("professional"),
        F.sort_array(F.collect_list(piece)).alias("pieces"),
    ).select("session_id", "startTime", "endTime", "stepLength", "professional",
             *[F.array_join(F.col("pieces").getField(name), ",").alias(name) for name in names]))
    return per_session.select(
        task_id(run_id),
        F.col("session_id").alias("sessionId"),
        "startTime",
        "searchKeywords",
        "clickCategoryIds",
        F.col("stepLength").cast("long").alias("stepLength"),
        seconds_between("startTime", "endTime").alias("visitLength"),
        "clickProductIds", "orderCategoryIds", "orderProductIds", "payCategoryIds", "payProductIds",
        F.coalesce("professional", F.lit("")).alias("professional"),
    )


def session_bucket_stats(actions: DataFrame, run_id: str, condition: Condition | None = None,
                         stats: DataFrame | None = None) -> DataFrame:
    """Share of sessions with visit length <= 10 s / > 10 s and steps <= 5 / > 5 (one row).

    ``stats``, here and below, is the ``session_stats`` of the same actions
    where the caller has it already; the log is not read again then.
    """
    stats = session_stats(actions) if stats is None else stats
    counts = stats.agg(
        F.count(F.lit(1)).alias("session_count"),
        F.count_if(F.col("visitLength") <= 10).alias("vl_le"),
        F.count_if(F.col("visitLength") > 10).alias("vl_gt"),
        F.count_if(F.col("stepLength") <= 5).alias("sl_le"),
        F.count_if(F.col("stepLength") > 5).alias("sl_gt"),
    )
    total = F.col("session_count")
    return counts.select(
        task_id(run_id),
        F.lit((condition or Condition()).to_json()).alias("contiditions"),
        total.alias("session_count"),
        percent_half_up("vl_le", total).alias("session_visitLength_le_10s_ratio"),
        percent_half_up("vl_gt", total).alias("session_visitLength_gt_10s_ratio"),
        percent_half_up("sl_le", total).alias("session_stepLength_le_5_ratio"),
        percent_half_up("sl_gt", total).alias("session_stepLength_gt_5_ratio"),
    )


def hourly_session_counts(actions: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """Sessions per start hour ('yyyy-MM-dd HH')."""
    return ((session_stats(actions) if stats is None else stats)
            .groupBy(hour_key("startTime").alias("hour"))
            .agg(F.count(F.lit(1)).alias("session_count")))


SMALL_SAMPLE = 100_000  # most ids of a sample that are broadcast, or ranked hour by hour
CELL_DIGITS = 3         # hex digits of the draw that part an hour into cells


def sample_session_ids(actions: DataFrame, need: int = 1000, seed: str = "clickscope",
                       stats: DataFrame | None = None, small: int = SMALL_SAMPLE) -> DataFrame:
    """Proportional per-hour sample of session ids, without replacement.

    The ``need`` sessions (or all, if there are fewer) are shared out over the
    hours by largest remainder: floor(hourCount * need / total) each, then one
    more to the hours with the largest remainder (ties: the earlier hour).
    Inside an hour, sessions are drawn in md5(seed || sessionId) order: a
    uniform, reproducible permutation; ``rn`` is the place in it. The quotas
    are a window over one row per hour. For the ranks see ``_ranked_by_hour``
    (a need of at most ``small``) and ``_ranked_by_cell``; both give the same
    rows.
    """
    if stats is None:
        starts = (actions.groupBy("session_id").agg(F.min(action_ts(F.col("action_time"))).alias("t0"))
                  .select(F.col("session_id").alias("sessionId"), hour_key(format_ts("t0")).alias("hour")))
    else:
        starts = stats.select("sessionId", hour_key("startTime").alias("hour"))
    hours = starts.groupBy("hour").agg(F.count(F.lit(1)).alias("hour_count"))
    every = Window.partitionBy()
    total = F.sum("hour_count").over(every)
    shares = (hours.withColumn("total", total).withColumn("drawn", F.least(F.lit(need), F.col("total")))
              .withColumn("base", F.call_function("div", F.col("hour_count") * F.col("drawn"), F.col("total")))
              .withColumn("rest", F.col("hour_count") * F.col("drawn") - F.col("base") * F.col("total"))
              .withColumn("left", F.col("drawn") - F.sum("base").over(every))
              .withColumn("place", F.row_number().over(Window.orderBy(F.desc("rest"), F.asc("hour")))))
    hours = shares.select("hour", (F.col("base") + (F.col("place") <= F.col("left")).cast("long")).alias("quota"))
    drawn = starts.withColumn("draw", F.md5(F.concat(F.lit(seed), F.col("sessionId"))))
    ranked = _ranked_by_hour(drawn, hours, need) if need <= small else _ranked_by_cell(drawn, hours)
    return ranked.filter(F.col("rn") <= F.col("quota")).select("sessionId", "hour", "rn")


def _ranked_by_hour(drawn: DataFrame, hours: DataFrame, need: int) -> DataFrame:
    """The literal ``rn <= need`` lets Spark keep only ``need`` rows per hour
    in each map task before the shuffle (WindowGroupLimit), so a hot hour
    never reaches one reducer in full."""
    w = Window.partitionBy("hour").orderBy("draw", "sessionId")
    ranked = drawn.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= F.lit(need))
    return ranked.join(hours, "hour")


def _ranked_by_cell(drawn: DataFrame, hours: DataFrame) -> DataFrame:
    """For quotas that no task should hold: two levels. An hour's draws fall
    into 4096 cells of about equal size. Cells are counted with map-side
    combine and added up in order; only cells that begin within the quota go
    on, and places are worked out inside each cell."""
    placed = drawn.withColumn("cell", F.left("draw", F.lit(CELL_DIGITS)))
    earlier = Window.partitionBy("hour").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = (placed.groupBy("hour", "cell").agg(F.count(F.lit(1)).alias("n")).join(hours, "hour")
             .withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
             .filter(F.col("before") < F.col("quota")).select("hour", "cell", "before", "quota"))
    inside = Window.partitionBy("hour", "cell").orderBy("draw", "sessionId")
    return (placed.join(cells, ["hour", "cell"])
            .withColumn("rn", (F.col("before") + F.row_number().over(inside)).cast("int")))


def session_sample(actions: DataFrame, run_id: str, need: int = 1000, seed: str = "clickscope",
                   stats: DataFrame | None = None, buckets: int | DataFrame = DAY, small: int = SMALL_SAMPLE) -> DataFrame:
    """Session records (with lists) of the proportional hourly sample.

    A sample of at most ``small`` ids, a bound that the quotas keep, is
    broadcast to select the sampled sessions' actions; a larger one is a plain
    join. Only the selected actions reach the rollup.
    """
    ids = sample_session_ids(actions, need, seed, stats, small).select(F.col("sessionId").alias("session_id"))
    return session_rollup(actions.join(F.broadcast(ids) if need <= small else ids, "session_id", "left_semi"), run_id, buckets)
