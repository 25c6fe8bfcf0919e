"""Column functions shared by the queries (all JVM-side built-ins)."""

from clickscope.functions.core import (
    TASK_ID_COLUMN,
    action_ts,
    city_remark,
    classify_operation,
    format_ts,
    hour_key,
    non_empty,
    percent_half_up,
    percent_text,
    seconds_between,
    split_ids,
    task_id,
    ts_seconds_between,
)

__all__ = [
    "TASK_ID_COLUMN", "action_ts", "format_ts", "city_remark", "classify_operation", "hour_key",
    "non_empty", "percent_half_up", "percent_text", "seconds_between", "split_ids", "task_id", "ts_seconds_between",
]
