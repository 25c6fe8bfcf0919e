"""The batch application: run every demand for one condition and run id.

Each result is appended to its own table (the result table names of the
original application), so repeated runs accumulate, distinguished by
``taskId``. Usage::

    python -m clickscope.plans.app --database shop --condition '{"start_date": "2018-11-01"}'
"""

from __future__ import annotations

import argparse
import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from clickscope import schemas
from clickscope.conditions import Condition
from clickscope.functions import task_id
from clickscope.operators import areas, categories, pages, products, professions, sessions
from clickscope.operators.actions import base_actions, hot_users
from clickscope.operators.ordering import DAY, measured_buckets
from clickscope.session import checkpoint_dir
from clickscope.sources.sinks import append_jdbc, replace_run
from clickscope.sources.tables import ModelTables, duplicate_keys, read_catalog_tables

# Result table names of the original application.
RESULT_TABLES = {
    "session_stat": "session_stat",
    "random_session_info": "random_session_info",
    "category_top10": "category_top10",
    "top10_session_per_top10_cid": "top10_session_per_top10_cid",
    "page_convert_rate": "page_convert_rate",
    "area_top3": "area_top3_product",
    "professional_stat": "professional_stat",
    "hot_product_user_info": "hot_proudct_user_info",
}

Writer = Callable[[str, DataFrame], None]


def append_to_table(name: str, df: DataFrame) -> None:
    df.write.mode("append").saveAsTable(name)


def replace_in_table(run_id: str) -> Writer:
    """A writer that replaces the rows of the same run id and leaves all other runs' rows."""
    def write(name: str, df: DataFrame) -> None:
        replace_run(df, name, run_id)

    return write


def append_to_jdbc(url: str, properties: dict[str, str] | None = None, num_partitions: int | None = None) -> Writer:
    """A writer that appends each result to a JDBC table of its name."""
    def write(name: str, df: DataFrame) -> None:
        append_jdbc(df, url, name, properties, num_partitions)

    return write


@dataclass
class Shared:
    """Results that several demands of one run build on; ``None`` where only one demand wants them."""
    stats: DataFrame | None = None       # per session: start, end, steps (the session mix, the sample's ids)
    top: DataFrame | None = None         # top categories (their report, their top sessions)
    buckets: int | DataFrame = DAY       # time buckets of sessions (conversion rate, sampled sessions)


def _demands(tables: ModelTables, condition: Condition, run_id: str,
             shared: Shared) -> dict[str, tuple[T.StructType, Callable[[DataFrame], DataFrame]]]:
    """Result schema and plan builder of each demand, by result table role.

    Demands 1-5 and the two exercises use the condition-filtered actions; the
    area report reads the raw log, as in the original, and gets the run's id
    here so that its rows, too, can be told apart.
    """
    return {
        "session_stat": (schemas.SESSION_STAT, lambda a: sessions.session_bucket_stats(a, run_id, condition, shared.stats)),
        "random_session_info": (schemas.SESSION_INFO, lambda a: sessions.session_sample(
            a, run_id, stats=shared.stats, buckets=shared.buckets)),
        "category_top10": (schemas.CATEGORY_TOP_N, lambda a: categories.category_top10(a, run_id)
                           if shared.top is None else shared.top),
        "top10_session_per_top10_cid": (schemas.TOP_SESSION_PER_CID,
                                        lambda a: categories.top_sessions_per_top_category(a, run_id, top=shared.top)),
        "page_convert_rate": (schemas.PAGE_CONVERT_RATE,
                              lambda a: pages.page_conversion_rate(a, run_id, condition.target_page_flow, shared.buckets)),
        "area_top3": (schemas.AREA_TOP3, lambda a: areas.area_top3_products(tables).select(task_id(run_id), "*")),
        "professional_stat": (schemas.PROFESSIONAL_STAT, lambda a: professions.professional_share(a, tables.users, run_id)),
        "hot_product_user_info": (schemas.HOT_PRODUCT_USER, lambda a: products.hot_product_user_visits(tables, a, run_id)),
    }


def _share(actions: DataFrame, wanted: list[str], run_id: str, split_rows: int | None) -> Shared:
    """Work out once, and write down, what at least two of the wanted demands need."""
    checkpoint_dir(actions.sparkSession)
    shared = Shared()
    if {"session_stat", "random_session_info"} <= set(wanted):
        shared.stats = sessions.session_stats(actions).checkpoint()
    if {"category_top10", "top10_session_per_top10_cid"} <= set(wanted):
        shared.top = categories.category_top10(actions, run_id).checkpoint()
    if split_rows is not None and {"page_convert_rate", "random_session_info"} & set(wanted):
        hot = measured_buckets(actions, split_rows).checkpoint()
        shared.buckets = DAY if hot.isEmpty() else hot
    return shared


def run_demands(tables: ModelTables, condition: Condition | None = None, run_id: str | None = None,
                write: Writer = append_to_table, only: list[str] | None = None,
                table_prefix: str = "", persist_base: bool = False, split_rows: int | None = None) -> str:
    """Run the demands one after another and hand each result to ``write``.

    Only the wanted demands are planned. The dimension keys are checked to be
    unique first: a repeated key would multiply action rows. The conversion
    rate needs the condition's target page flow; without one it is skipped,
    unless it was asked for by name. What several demands need (``Shared``) is
    worked out once. With ``persist_base`` the enriched, filtered action set is
    kept (memory and disk) while the demands run. With ``split_rows``, hot
    users and hot hours of a session, those with more rows than that, are
    measured first and split (``hot_users``, ``measured_buckets``).
    """
    run_id = run_id or str(uuid.uuid4())
    condition = condition or Condition()
    wanted = [role for role in RESULT_TABLES if only is None or role in only]
    if not condition.target_page_flow and "page_convert_rate" in wanted:
        if only is not None:
            raise ValueError("page_convert_rate needs target_page_flow in the condition")
        print("page_convert_rate skipped: the condition names no target page flow")
        wanted.remove("page_convert_rate")
    repeated = duplicate_keys(tables).take(5)
    if repeated:
        raise ValueError(f"dimension keys are not unique: {[tuple(r) for r in repeated]}")
    hot = None
    if split_rows is not None:
        checkpoint_dir(tables.actions.sparkSession)
        hot = hot_users(tables.actions, split_rows).checkpoint()
    # No demand reads the clicked product's name: skip that join.
    acts = base_actions(tables, condition, enrich=("professional", "user_name"), hot=None if hot is None or hot.isEmpty() else hot)
    try:
        if persist_base:
            acts = acts.persist(StorageLevel.MEMORY_AND_DISK)
        demands = _demands(tables, condition, run_id, _share(acts, wanted, run_id, split_rows))
        for role in wanted:
            schema, plan = demands[role]
            write(f"{table_prefix}{RESULT_TABLES[role]}", schemas.validate_schema(plan(acts), schema, exact=True))
    finally:
        if persist_base:
            acts.unpersist()
    return run_id


# Condition keys of the original application and ours.
CONDITION_KEYS = {
    "startDate": "start_date", "endDate": "end_date", "startAge": "start_age", "endAge": "end_age",
    "professionals": "professionals", "city": "city", "gender": "gender", "keywords": "keywords",
    "categoryIds": "category_ids", "targetPageFlow": "target_page_flow",
}
_LISTS = {"professionals": str, "keywords": str, "category_ids": int, "target_page_flow": int}
_NUMBERS = ("start_age", "end_age", "city")


def _condition_from_json(text: str) -> Condition:
    """A condition from JSON with the original's or our key names.

    Values may be text, as in the original's files: lists comma-joined,
    numbers as digits; an empty value sets no condition.
    """
    data = {}
    for key, value in (json.loads(text) if text else {}).items():
        name = CONDITION_KEYS.get(key, key)
        if value in (None, "", []):
            continue
        if name in _LISTS:
            items = value if isinstance(value, list) else str(value).split(",")
            value = tuple(_LISTS[name](str(x).strip()) for x in items if str(x).strip())
        elif name in _NUMBERS:
            value = int(value)
        data[name] = value
    return Condition(**data)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Run the click-log demands for one condition.")
    parser.add_argument("--database", default=None, help="catalog database holding the four model tables")
    parser.add_argument("--condition", default="{}", help="JSON object of Condition fields")
    parser.add_argument("--run-id", default=None)
    parser.add_argument("--table-prefix", default="")
    parser.add_argument("--jdbc-url", default=None, help="append results to this database instead of the catalog")
    parser.add_argument("--jdbc-properties", default="{}", help="JSON object of connection properties")
    parser.add_argument("--jdbc-connections", type=int, default=None, help="most connections at a time")
    parser.add_argument("--persist-base", action="store_true",
                        help="keep the filtered, enriched actions between demands")
    parser.add_argument("--replace-run", action="store_true",
                        help="replace the rows of an earlier run of the same id instead of appending")
    parser.add_argument("--split-rows", type=int, default=None,
                        help="measure and split users, and hours of a session, with more rows than this")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("clickscope").getOrCreate()
    tables = read_catalog_tables(spark, args.database)
    run_id = args.run_id or str(uuid.uuid4())
    write = replace_in_table(run_id) if args.replace_run else append_to_table
    if args.jdbc_url:
        write = append_to_jdbc(args.jdbc_url, json.loads(args.jdbc_properties), args.jdbc_connections)
    run_id = run_demands(tables, _condition_from_json(args.condition), run_id, write=write,
                         table_prefix=args.table_prefix, persist_base=args.persist_base, split_rows=args.split_rows)
    print(run_id)


if __name__ == "__main__":
    main()
