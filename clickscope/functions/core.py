"""Scalar and aggregate-building column expressions.

All of them compose ``pyspark.sql.functions`` built-ins, so they stay inside
whole-stage code generation; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TASK_ID_COLUMN = "taskId"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def task_id(value: str) -> Column:
    """Literal run id stamped on every result row."""
    return F.lit(value).alias(TASK_ID_COLUMN)


def non_empty(c) -> Column:
    """True for a string that is neither NULL nor ''."""
    return F.coalesce(_c(c), F.lit("")) != F.lit("")


def split_ids(c) -> Column:
    """Comma list -> array of non-empty elements; NULL/'' -> empty array.

    Spark's ``split`` keeps trailing (and inner) empty strings, so they are
    filtered out explicitly.
    """
    parts = F.split(F.coalesce(_c(c), F.lit("")), ",")
    return F.filter(parts, lambda x: x != F.lit(""))


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def _hundredths(n, total) -> Column:
    """Exact HALF_UP of n/total*100 in hundredths, integer arithmetic only."""
    n, total = _c(n).cast("long"), _c(total).cast("long")
    return _div(n * F.lit(20000) + total, total * F.lit(2))


def percent_half_up(n, total) -> Column:
    """n/total*100 rounded HALF_UP to 2 decimals; NULL when total is 0."""
    total_c = _c(total)
    return F.when(total_c > 0, _hundredths(n, total_c) / F.lit(100.0))


def percent_text(n, total) -> Column:
    """Same value as ``percent_half_up`` as fixed two-decimal text ('7.13')."""
    h = _hundredths(n, total)
    return F.concat(_div(h, F.lit(100)).cast("string"), F.lit("."),
                    F.lpad(F.pmod(h, F.lit(100)).cast("string"), 2, "0"))


def hour_key(start_time) -> Column:
    """'yyyy-MM-dd HH' key: the text before the first ':'."""
    return F.substring_index(_c(start_time), ":", 1)


TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def action_ts(text) -> Column:
    """Parse 'yyyy-MM-dd HH:mm:ss' text into a zone-free timestamp."""
    return F.to_timestamp_ntz(_c(text), F.lit(TIME_FORMAT))


def format_ts(ts) -> Column:
    """Zone-free timestamp back to 'yyyy-MM-dd HH:mm:ss' text.

    Casting TIMESTAMP_NTZ to text never consults the session time zone
    (``date_format`` would round-trip through it and shift wall-clock times
    that fall into a daylight-saving gap).
    """
    return F.substring(_c(ts).cast("string"), 1, 19)


def ts_seconds_between(t0, t1) -> Column:
    """Whole seconds from zone-free timestamp t0 to t1, without any time zone."""
    t0, t1 = _c(t0), _c(t1)

    def second_of_day(t):
        return F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)

    return (F.date_diff(t1, t0).cast("long") * 86400 + second_of_day(t1) - second_of_day(t0)).cast("long")


def seconds_between(start_text, end_text) -> Column:
    """Whole seconds between two 'yyyy-MM-dd HH:mm:ss' texts (zone-free)."""
    return ts_seconds_between(action_ts(start_text), action_ts(end_text))


def classify_operation() -> tuple[Column, Column]:
    """(operation_type, operation_obj) of an action; pay > order > search > click."""
    pay, order = F.col("pay_product_ids"), F.col("order_product_ids")
    kw, click = F.col("search_keyword"), F.col("click_product_id")
    kind = (F.when(non_empty(pay), F.lit("pay"))
            .when(non_empty(order), F.lit("order"))
            .when(non_empty(kw), F.lit("search"))
            .when(click > 0, F.lit("click"))
            .otherwise(F.lit("")))
    obj = (F.when(non_empty(pay), pay)
           .when(non_empty(order), order)
           .when(non_empty(kw), kw)
           .when(click > 0, click.cast("string"))
           .otherwise(F.lit("")))
    return kind.alias("operation_type"), obj.alias("operation_obj")


def city_remark(cities: Column, total, top_n: int | None = None) -> Column:
    """Render one group's per-city counts as 'city=share%' text.

    ``cities`` is ``array<struct<neg_n: long, city: string, n: long>>`` (one
    element per city of the group, so bounded by the city dimension). Order:
    most clicks first, then city name. With ``top_n`` the rest is folded into
    one 'other=share%' item.
    """
    ordered = F.array_sort(cities)
    total = _c(total)

    def render(x):
        return F.concat(x.getField("city"), F.lit("="), percent_text(x.getField("n"), total), F.lit("%"))

    if top_n is None:
        return F.array_join(F.transform(ordered, render), ",")
    head = F.slice(ordered, 1, top_n)
    rest = F.filter(ordered, lambda x, i: i >= F.lit(top_n))
    rest_n = F.aggregate(rest, F.lit(0).cast("long"), lambda acc, x: acc + x.getField("n"))
    head_txt = F.array_join(F.transform(head, render), ",")
    other = F.concat(F.lit(",other="), percent_text(rest_n, total), F.lit("%"))
    return F.when(F.size(ordered) > top_n, F.concat(head_txt, other)).otherwise(head_txt)
