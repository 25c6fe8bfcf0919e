"""Registry: query name -> callable(spark, sf_dir) -> DataFrame.

Every entry reads the full driver tables under ``sf_dir`` through the
fixture mapping and runs one library query with the fixed parameters of
``params``. Demands run on the unfiltered base action set.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clickscope.conditions import Condition
from clickscope.operators import areas, categories, pages, products, professions, sessions
from clickscope.operators.actions import ENRICHMENT, base_actions, hot_users
from clickscope.operators.ordering import measured_buckets
from clickscope.plans.params import (
    FILTERS,
    FIXTURE_PROFESSIONS,
    REMARK_TOP_CITIES,
    RUN_ID,
    SAMPLE_SEED,
    SAMPLE_SIZE,
    TARGET_FLOW,
    VISITS_DATE,
)
from clickscope.plans.sql import area_top3_by_sql, register_model_views
from clickscope.sources import (
    load_fixture_tables,
    overwrite_table,
    read_catalog_tables,
    replace_run,
    write_catalog_tables,
)

Query = Callable[[SparkSession, str], DataFrame]
PROF = ("professional",)


def _on_base(fn: Callable[[DataFrame], DataFrame], enrich: tuple[str, ...] = ()) -> Query:
    """Run ``fn`` on the unfiltered base actions carrying only ``enrich`` columns."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(base_actions(load_fixture_tables(spark, sf_dir), enrich=enrich))
    return run


def _on_tables(fn) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(load_fixture_tables(spark, sf_dir))
    return run


def _filtered(cond: Condition) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return base_actions(load_fixture_tables(spark, sf_dir), cond)
    return run


def _table_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the top-10 categories twice with replace semantics, read back once."""
    top = categories.category_top10(base_actions(load_fixture_tables(spark, sf_dir), enrich=()), RUN_ID)
    table = f"clickscope_category_top10_{uuid.uuid4().hex}"  # managed; no other run's table is replaced
    for _ in range(2):
        overwrite_table(top, table)
    return spark.table(table)


def _catalog_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The date range over catalog tables whose log is partitioned by date."""
    database = f"clickscope_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database}")
    write_catalog_tables(load_fixture_tables(spark, sf_dir), database)
    return base_actions(read_catalog_tables(spark, database), FILTERS["filter_date_range"])


def _runs_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs into one table, one of them repeated: its rows are there once."""
    acts = base_actions(load_fixture_tables(spark, sf_dir), enrich=())
    table = f"clickscope_runs_{uuid.uuid4().hex}"
    for run_id, limit in (("run-a", 3), ("run-b", 10), ("run-a", 10)):
        replace_run(categories.category_top10(acts, run_id, limit), table, run_id)
    return spark.table(table)


def _area_top3_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = register_model_views(load_fixture_tables(spark, sf_dir), prefix=f"v{uuid.uuid4().hex}_")
    return area_top3_by_sql(spark, names)


# rows that make a (session, hour), or a user, hot in the driver's small tables
HOT_ROWS, HOT_USER = 2, 20


def _on_measured(fn: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    """Run ``fn`` on base actions and their measured buckets, with a hot-user join."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = load_fixture_tables(spark, sf_dir)
        acts = base_actions(tables, enrich=PROF, hot=hot_users(tables.actions, HOT_USER))
        return fn(acts, measured_buckets(acts, HOT_ROWS))
    return run


QUERIES: dict[str, Query] = {
    "city_dimension": _on_tables(lambda t: t.cities),
    "base_actions": _filtered(Condition()),
    **{name: _filtered(cond) for name, cond in FILTERS.items()},
    "session_rollup": _on_base(lambda a: sessions.session_rollup(a, RUN_ID), PROF),
    "session_bucket_stats": _on_base(lambda a: sessions.session_bucket_stats(a, RUN_ID, Condition())),
    "hourly_session_counts": _on_base(sessions.hourly_session_counts),
    "session_sample": _on_base(lambda a: sessions.session_sample(a, RUN_ID, SAMPLE_SIZE, SAMPLE_SEED), PROF),
    "category_event_counts": _on_base(categories.category_event_counts),
    "category_top10": _on_base(lambda a: categories.category_top10(a, RUN_ID)),
    "top_sessions_per_top_category": _on_base(lambda a: categories.top_sessions_per_top_category(a, RUN_ID)),
    "targeted_page_views": _on_base(lambda a: pages.targeted_page_views(a, TARGET_FLOW)),
    "page_jumps": _on_base(lambda a: pages.page_jumps(a, TARGET_FLOW)),
    "page_conversion_rate": _on_base(lambda a: pages.page_conversion_rate(a, RUN_ID, TARGET_FLOW)),
    "area_product_clicks": _on_tables(areas.area_product_clicks),
    "city_remark": _on_tables(lambda t: areas.area_product_clicks(t, REMARK_TOP_CITIES)
                              .select("click_product_id", "area", "city_remark")),
    "area_top3_products": _on_tables(areas.area_top3_products),
    "repeat_click_sessions": _on_tables(lambda t: professions.repeat_click_groups(
        base_actions(t, enrich=()), t.users)),
    "professional_share": _on_tables(lambda t: professions.professional_share(
        base_actions(t, enrich=()), t.users, RUN_ID, "session", FIXTURE_PROFESSIONS)),
    "product_click_top10": _on_base(lambda a: products.product_click_top10(a, RUN_ID)),
    "paid_hot_actions": _on_base(products.paid_hot_actions, ENRICHMENT),
    "user_product_purchases": _on_base(products.user_product_purchases),
    "top2_buyers_per_hot_product": _on_base(lambda a: products.top2_buyers_per_hot_product(a, RUN_ID)),
    "hot_product_user_visits": _on_tables(lambda t: products.hot_product_user_visits(
        t, base_actions(t, enrich=("user_name",)), RUN_ID)),
    "hot_product_user_visits_day": _on_tables(lambda t: products.hot_product_user_visits(
        t, base_actions(t, enrich=("user_name",)), RUN_ID, date=VISITS_DATE)),
    "table_overwrite": _table_overwrite,
    "catalog_date_range": _catalog_date_range,
    "runs_replaced": _runs_replaced,
    "area_top3_products_sql": _area_top3_sql,
    "session_rollup_measured": _on_measured(lambda a, b: sessions.session_rollup(a, RUN_ID, b)),
    "page_jumps_measured": _on_measured(lambda a, b: pages.page_jumps(a, TARGET_FLOW, b)),
    "session_sample_large": _on_base(lambda a: sessions.session_sample(a, RUN_ID, SAMPLE_SIZE, SAMPLE_SEED, small=0), PROF),
}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 3 clicked products per area with the city remark."""
    return QUERIES["area_top3_products"](spark, sf_dir)
