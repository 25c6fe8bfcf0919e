"""Time order inside sessions, in time buckets.

Questions about neighbours and order inside a session are answered per
(session, bucket): one hash exchange of the log on these two, one window or
ordered list per bucket, and then one small record per bucket to stitch
sessions that span several. A bucket is a range of the time order, and its
text sorts as its range does. The buckets decide only how much of one session
a task can hold, never the answer.

A day of a session is one bucket by default, which nearly every session is
happy with. A session that is hot (a crawler, a shared id) is measured, not
guessed: ``measured_buckets`` counts rows per (session, hour) with map-side
combine, takes the heaviest hours and cuts each into 256 ranges of about equal
rows, within single seconds where need be.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickscope.operators.actions import tie_columns

DAY, HOUR, MINUTE = 10, 13, 16  # characters of 'yyyy-MM-dd HH:mm:ss'
MIN_ROWS = 1_000_000  # rows of a session in one hour that are worth splitting
HOT_HOURS = 1_000     # most (session, hour) pairs that are split
FINE, COARSE = 256, 16  # ranges of a split hour, and every how many the first look goes


def _tie(actions: DataFrame) -> Column:
    """The unique action id where there is one, else a hash of the whole row."""
    ties = tie_columns(actions)
    return F.col(ties[0]) if ties else F.xxhash64(*actions.columns)


def _hour() -> Column:
    return F.substring("action_time", 1, HOUR)


def _in_hour(tie: Column, low: Column, high: Column) -> Column:
    """Place of a row in its hour as a double that never falls along (action_time, tie)."""
    second = F.substring("action_time", 15, 2).try_cast("int") * 60 + F.substring("action_time", 18, 2).try_cast("int")
    low, high = low.cast("double"), high.cast("double")
    return second + (tie.cast("double") - low) / (high - low + 1)


def measured_buckets(actions: DataFrame, min_rows: int = MIN_ROWS, hours: int = HOT_HOURS) -> DataFrame:
    """(session_id, hours): the hot hours of hot sessions with the cuts between their ranges.

    A lazy plan to hand to ``with_order``, or to keep (``checkpoint``) and use
    for several reports. It has at most ``hours`` (session, hour) pairs of
    ``FINE`` numbers, 2 MB, so it is broadcast. A pair that is not among them
    has less than 1 / ``hours`` of the log's rows.
    """
    placed = actions.select("session_id", "action_time", _hour().alias("hour"), _tie(actions).alias("tie"))
    heavy = (placed.where("hour is not null and session_id is not null").groupBy("session_id", "hour")
             .agg(F.count(F.lit(1)).alias("n"), F.min("tie").alias("low"), F.max("tie").alias("high"))
             .where(F.col("n") > min_rows).orderBy(F.desc("n"), "session_id", "hour").limit(hours))
    cuts = F.percentile_approx("at", [i / FINE for i in range(1, FINE)], 10_000)
    ranges = (placed.join(F.broadcast(heavy), ["session_id", "hour"])
              .select("session_id", "hour", "low", "high", _in_hour(F.col("tie"), F.col("low"), F.col("high")).alias("at"))
              .groupBy("session_id", "hour", "low", "high").agg(cuts.alias("cuts")))
    first_look = F.filter("cuts", lambda x, i: (i + 1) % COARSE == 0)
    entry = F.struct("hour", F.struct("low", "high", "cuts", first_look.alias("coarse")))
    return ranges.groupBy("session_id").agg(F.map_from_entries(F.collect_list(entry)).alias("hours"))


def _range_number(tie: Column, hot: Column) -> Column:
    """How many cuts lie at or before the row: first every sixteenth, then those between."""
    at = _in_hour(tie, hot["low"], hot["high"])
    below = lambda xs: F.size(F.filter(xs, lambda x: x <= at))
    first = below(hot["coarse"])
    return first * COARSE + below(F.slice(hot["cuts"], first * COARSE + 1, F.lit(COARSE - 1)))


def with_order(actions: DataFrame, buckets: int | DataFrame = DAY) -> DataFrame:
    """Add ``_bucket`` and ``_tie``, the last part of a total order in time.

    ``_tie`` is the unique action id where there is one, else a hash of the
    whole row; rows equal in every column are interchangeable. ``buckets``: so
    many characters of the time, or a result of ``measured_buckets`` (then all
    other sessions go by day, and a hot session's other hours by hour).
    """
    ordered = actions.withColumn("_tie", _tie(actions))
    if isinstance(buckets, int):
        return ordered.withColumn("_bucket", F.substring("action_time", 1, buckets))
    known = buckets.select(F.col("session_id").alias("_hot_session"), F.col("hours").alias("_hours"))
    joined = ordered.join(F.broadcast(known), F.col("session_id") == F.col("_hot_session"), "left")
    number = F.coalesce(_range_number(F.col("_tie"), F.try_element_at("_hours", _hour())), F.lit(0))
    split = F.concat(_hour(), F.lit("#"), F.lpad(number.cast("string"), 4, "0"))
    return (joined.withColumn("_bucket", F.when(F.col("_hours").isNull(), F.substring("action_time", 1, DAY)).otherwise(split))
            .drop("_hot_session", "_hours"))


def jump_and_view_counts(actions: DataFrame, value: str, wanted_pair, wanted_view: Column,
                         buckets: int | DataFrame = DAY) -> DataFrame:
    """(kind, x, y, n): how often ``y`` directly follows ``x`` inside a session
    (kind 'p', wanted pairs only) and how often ``x`` occurs (kind 'v').

    One straight plan without a second branch, so nothing is computed twice:
    window per bucket, partial counts, then a window over one border record
    per bucket (its first and last value) that pairs neighbouring buckets.
    """
    ordered = with_order(actions, buckets)
    w = Window.partitionBy("session_id", "_bucket").orderBy("action_time", "_tie")
    marked = ordered.select(
        F.col("session_id").alias("s"), F.col("_bucket").alias("b"), F.col(value).alias("x"),
        F.lead(value).over(w).alias("y"), F.lead(F.lit(1)).over(w).isNull().alias("last"), F.first(value).over(w).alias("first"))
    kind = marked.schema["x"].dataType
    none, no_text = F.lit(None).cast(kind), F.lit(None).cast("string")

    def record(name, s, b, x, y):
        return F.struct(F.lit(name).alias("kind"), s.alias("s"), b.alias("b"), x.alias("x"), y.alias("y"))

    records = marked.select(F.explode(F.array_compact(F.array(
        F.when(wanted_view, record("v", no_text, no_text, F.col("x"), none)),
        F.when(~F.col("last") & wanted_pair(F.col("x"), F.col("y")), record("p", no_text, no_text, F.col("x"), F.col("y"))),
        F.when(F.col("last"), record("b", F.col("s"), F.col("b"), F.col("first"), F.col("x"))),
    ))).alias("r")).select("r.*")
    counted = records.groupBy("kind", "s", "b", "x", "y").agg(F.count(F.lit(1)).alias("n"))
    # border records of one session meet here; the counts, a few rows, share the null session
    before = F.lag("y").over(Window.partitionBy("s").orderBy("b"))
    border = F.col("kind") == "b"
    stitched = counted.withColumn("prev", F.when(border, before)).select(
        F.when(border, "p").otherwise(F.col("kind")).alias("kind"),
        F.when(border, F.col("prev")).otherwise(F.col("x")).alias("x"),
        F.when(border, F.col("x")).otherwise(F.col("y")).alias("y"),
        "n", border.alias("border"))
    kept = stitched.filter(~F.col("border") | wanted_pair(F.col("x"), F.col("y")))
    return kept.groupBy("kind", "x", "y").agg(F.sum("n").cast("long").alias("n"))
