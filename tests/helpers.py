"""Hand-made model tables for operator tests."""

from __future__ import annotations

from clickscope import schemas
from clickscope.sources.tables import ModelTables

ACTION_FIELDS = [f.name for f in schemas.USER_VISIT_ACTION.fields]


def action(session_id, action_time, *, user_id=1, page_id=1, keyword=None, click_category=-1,
           click_product=-1, order_categories=None, order_products=None, pay_categories=None,
           pay_products=None, city_id=1, action_id=None, date=None):
    return {
        "date": date or action_time[:10], "user_id": user_id, "user_name": None, "professional": None,
        "session_id": session_id, "page_id": page_id, "action_time": action_time,
        "search_keyword": keyword, "click_category_id": click_category, "click_product_id": click_product,
        "product_name": None, "order_category_ids": order_categories, "order_product_ids": order_products,
        "pay_category_ids": pay_categories, "pay_product_ids": pay_products, "city_id": city_id,
        "action_id": action_id,
    }


def actions_df(spark, rows):
    for i, r in enumerate(rows):
        if r["action_id"] is None:
            r["action_id"] = i
    schema = schemas.T.StructType(list(schemas.USER_VISIT_ACTION.fields)
                                  + [schemas.T.StructField("action_id", schemas.L, True)])
    data = [tuple(r[f] for f in ACTION_FIELDS) + (r["action_id"],) for r in rows]
    return spark.createDataFrame(data, schema)


DEFAULT_USERS = [
    (1, "user_1", "name_1", 25, "学生", "男"),
    (2, "user_2", "name_2", 35, "程序员", "女"),
    (3, "user_3", "name_3", 45, "经理", "男"),
    (4, "user_4", "name_4", 55, "老师", "女"),
]
DEFAULT_PRODUCTS = [(i, f"product_{i}", "自营") for i in range(1, 21)]
DEFAULT_CITIES = [(1, "北京", "华北"), (2, "上海", "华东"), (3, "深圳", "华南"), (4, "广州", "华南"),
                  (7, "天津", "华北")]


def tables(spark, rows, users=None, products=None, cities=None) -> ModelTables:
    return ModelTables(
        actions=actions_df(spark, rows),
        users=spark.createDataFrame(users if users is not None else DEFAULT_USERS, schemas.USER_INFO),
        products=spark.createDataFrame(products if products is not None else DEFAULT_PRODUCTS,
                                       schemas.PRODUCT_INFO),
        cities=spark.createDataFrame(cities if cities is not None else DEFAULT_CITIES, schemas.CITY_INFO),
    )


def rows(df, *cols):
    """Sorted plain tuples of the selected columns."""
    data = [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]
    return sorted(data, key=lambda t: tuple((x is None, str(x)) for x in t))
