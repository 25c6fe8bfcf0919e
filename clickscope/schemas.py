"""Explicit schemas of the input model and of each result table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

L, S, I, D = T.LongType(), T.StringType(), T.IntegerType(), T.DoubleType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


USER_VISIT_ACTION = _struct(
    ("date", S), ("user_id", L), ("user_name", S), ("professional", S),
    ("session_id", S), ("page_id", L), ("action_time", S), ("search_keyword", S),
    ("click_category_id", L), ("click_product_id", L), ("product_name", S),
    ("order_category_ids", S), ("order_product_ids", S),
    ("pay_category_ids", S), ("pay_product_ids", S), ("city_id", L),
)
USER_INFO = _struct(
    ("user_id", L), ("username", S), ("name", S), ("age", I),
    ("professional", S), ("gender", S),
)
PRODUCT_INFO = _struct(("product_id", L), ("product_name", S), ("extend_info", S))
CITY_INFO = _struct(("city_id", L), ("city_name", S), ("area", S))

# Names of the result columns (``contiditions`` is the original's spelling).
SESSION_STAT = _struct(
    ("taskId", S), ("contiditions", S), ("session_count", L),
    ("session_visitLength_le_10s_ratio", D), ("session_visitLength_gt_10s_ratio", D),
    ("session_stepLength_le_5_ratio", D), ("session_stepLength_gt_5_ratio", D),
)
SESSION_INFO = _struct(
    ("taskId", S), ("sessionId", S), ("startTime", S), ("searchKeywords", S),
    ("clickCategoryIds", S), ("stepLength", L), ("visitLength", L),
    ("clickProductIds", S), ("orderCategoryIds", S), ("orderProductIds", S),
    ("payCategoryIds", S), ("payProductIds", S), ("professional", S),
)
CATEGORY_TOP_N = _struct(
    ("taskId", S), ("category_id", S), ("click_count", L), ("order_count", L), ("pay_count", L),
)
TOP_SESSION_PER_CID = _struct(("taskId", S), ("categoryId", S), ("sessionId", S), ("clickCount", L))
PAGE_CONVERT_RATE = _struct(("taskId", S), ("pageJump", S), ("rate", D))
AREA_TOP3 = _struct(("taskId", S), ("area", S), ("product_name", S), ("count", L), ("rank", I), ("city_remark", S))
PROFESSIONAL_STAT = _struct(
    ("taskId", S), ("userCount", L), ("teacher_ratio", D), ("programmer_ratio", D),
    ("PM_ratio", D), ("stu_ratio", D),
)
HOT_PRODUCT_USER = _struct(
    ("taskId", S), ("product_id", L), ("product_name", S), ("user_id", S), ("user_name", S),
    ("action_time", S), ("operation_type", S), ("operation_obj", S),
)


class SchemaMismatch(ValueError):
    pass


def validate_schema(df: DataFrame, expected: T.StructType, exact: bool = False) -> DataFrame:
    """Check that ``df`` carries every expected column with the expected type.

    Extra columns are allowed unless ``exact``; this runs at plan time only.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    problems = []
    for field in expected.fields:
        if field.name not in have:
            problems.append(f"missing column {field.name}")
        elif have[field.name] != field.dataType:
            problems.append(f"{field.name}: {have[field.name].simpleString()} != {field.dataType.simpleString()}")
    if exact:
        extra = set(have) - {f.name for f in expected.fields}
        problems.extend(f"unexpected column {n}" for n in sorted(extra))
    if problems:
        raise SchemaMismatch("; ".join(problems))
    return df
