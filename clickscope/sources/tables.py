"""The model tables: action log plus user, product and city dimensions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from clickscope import schemas


@dataclass(frozen=True)
class ModelTables:
    actions: DataFrame      # user_visit_action (+ optional unique ``action_id`` tie column)
    users: DataFrame        # user_info
    products: DataFrame     # product_info
    cities: DataFrame       # city_info

    def validate(self) -> ModelTables:
        schemas.validate_schema(self.users, schemas.USER_INFO)
        schemas.validate_schema(self.products, schemas.PRODUCT_INFO)
        schemas.validate_schema(self.cities, schemas.CITY_INFO)
        action_cols = [f for f in schemas.USER_VISIT_ACTION.fields
                       if f.name not in ("user_name", "professional", "product_name")]
        schemas.validate_schema(self.actions, schemas.T.StructType(action_cols))
        return self


def duplicate_keys(tables: ModelTables) -> DataFrame:
    """Dimension keys that occur more than once (table, key, n), as a distributed plan.

    The enrichment joins assume unique dimension keys; a duplicate would
    multiply action rows. Empty result = safe.
    """
    from pyspark.sql import functions as F

    parts = []
    for table, df, key in (("user_info", tables.users, "user_id"), ("product_info", tables.products, "product_id"),
                           ("city_info", tables.cities, "city_id")):
        parts.append(df.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"))
                     .filter(F.col("n") > 1).select(F.lit(table).alias("table"), "key", "n"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def read_catalog_tables(spark: SparkSession, database: str | None = None) -> ModelTables:
    """Read the four managed tables, qualified by ``database`` when given."""
    prefix = f"{database}." if database else ""
    return ModelTables(
        actions=spark.table(f"{prefix}user_visit_action"),
        users=spark.table(f"{prefix}user_info"),
        products=spark.table(f"{prefix}product_info"),
        cities=spark.table(f"{prefix}city_info"),
    ).validate()


def write_catalog_tables(tables: ModelTables, database: str | None = None) -> None:
    """Write the four managed tables that ``read_catalog_tables`` reads.

    The action log is partitioned by date, so that a condition on the date
    prunes whole directories; the dimensions are plain tables.
    """
    from clickscope.sources.sinks import overwrite_table

    prefix = f"{database}." if database else ""
    overwrite_table(tables.actions, f"{prefix}user_visit_action", partition_by=["date"])
    for name, df in (("user_info", tables.users), ("product_info", tables.products), ("city_info", tables.cities)):
        overwrite_table(df, f"{prefix}{name}")


# The shop's 26 cities and their areas (id, city, area).
CITY_ROWS = [
    (1, "北京", "华北"), (2, "上海", "华东"), (3, "深圳", "华南"), (4, "广州", "华南"),
    (5, "武汉", "华中"), (6, "南京", "华东"), (7, "天津", "华北"), (8, "成都", "西南"),
    (9, "哈尔滨", "东北"), (10, "大连", "东北"), (11, "沈阳", "东北"), (12, "西安", "西北"),
    (13, "长沙", "华中"), (14, "重庆", "西南"), (15, "济南", "华东"), (16, "石家庄", "华北"),
    (17, "银川", "西北"), (18, "杭州", "华东"), (19, "保定", "华北"), (20, "福州", "华南"),
    (21, "贵阳", "西南"), (22, "青岛", "华东"), (23, "苏州", "华东"), (24, "郑州", "华北"),
    (25, "无锡", "华东"), (26, "厦门", "华南"),
]


def default_city_info(spark: SparkSession) -> DataFrame:
    """The built-in city dimension as a (tiny, literal) DataFrame."""
    return spark.createDataFrame(CITY_ROWS, schemas.CITY_INFO)
