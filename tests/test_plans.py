"""Plan-shape guards for the properties that matter at scale."""

import pytest

from clickscope.conditions import Condition
from clickscope.operators import areas, categories, pages, products, sessions
from clickscope.operators.actions import attach_product_name, base_actions
from clickscope.sources import load_fixture_tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def t(spark):
    return load_fixture_tables(spark, SF)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    from clickscope.sources.tables import ModelTables
    from tests.helpers import action, tables

    small = tables(spark, [action("s1", "2018-11-01 10:00:00", city_id=7), action("s2", "2018-11-05 10:00:00")])
    paths = {}
    for role in ("actions", "users", "products", "cities"):
        paths[role] = str(tmp_path / role)
        getattr(small, role).write.parquet(paths[role])
    on_disk = ModelTables(**{role: spark.read.parquet(path) for role, path in paths.items()})
    df = base_actions(on_disk, Condition(start_date="2018-11-01", city=7, start_age=20), enrich=()).select("session_id")
    p = plan(df)
    assert "EqualTo(city_id,7)" in p and "GreaterThanOrEqual(date,2018-11-01)" in p
    assert "GreaterThanOrEqual(age,20)" in p
    scans = [line for line in p.splitlines() if "ReadSchema" in line or "FileScan" in line]
    assert scans and not any("search_keyword" in s for s in scans)  # unused columns are pruned
    assert [r["session_id"] for r in df.collect()] == ["s1"]


def test_session_stats_hash_aggregate(t):
    p = plan(sessions.session_bucket_stats(base_actions(t, enrich=()), "r"))
    assert "SortAggregate" not in p and "HashAggregate" in p


def test_per_group_top_k_is_limited_before_the_shuffle(t):
    acts = base_actions(t, enrich=())
    for df in (areas.area_top3_products(t), categories.top_sessions_per_top_category(acts, "r"),
               products.top2_buyers_per_hot_product(acts, "r")):
        assert "WindowGroupLimit" in plan(df)


def test_global_top_k_is_take_ordered(t):
    assert "TakeOrderedAndProject" in plan(categories.category_top10(base_actions(t, enrich=()), "r"))


def test_unused_enrichment_is_not_joined(t):
    p = plan(categories.category_event_counts(base_actions(t, enrich=())))
    assert "LeftSemi" in p and "LeftOuter" not in p


def test_hot_product_filter_is_a_scalar_subquery(t):
    p = plan(products.paid_hot_actions(base_actions(t, enrich=())))
    assert "Subquery" in p and "arrays_overlap" in p and "SortMergeJoin" not in p


def executed(df) -> list[str]:
    df.collect()
    return plan(df).split("Initial Plan")[0].splitlines()


@pytest.mark.parametrize("query", [lambda a: pages.page_jumps(a, [1, 2, 3]), lambda a: pages.page_conversion_rate(a, "r", [1, 2, 3])])
def test_jumps_and_conversion_read_and_ship_the_log_once(t, query):
    lines = executed(query(base_actions(t, enrich=())))
    text = "\n".join(lines)
    assert sum("FileScan" in x and "event_id" in x for x in lines) == 1
    assert text.count("hashpartitioning(session_id") == 1 and "rangepartitioning" not in text


def test_rollup_reads_once_and_ships_twice(t):
    lines = executed(sessions.session_rollup(base_actions(t, enrich=()), "r"))
    assert sum("FileScan" in x and "event_id" in x for x in lines) == 1
    assert "\n".join(lines).count("hashpartitioning(session_id") == 2


def test_building_a_plan_starts_no_job(spark, t):
    from clickscope.plans import QUERIES

    seen = spark.sparkContext.statusTracker()
    for name in ("session_sample", "hot_product_user_visits", "session_rollup", "page_conversion_rate", "area_top3_products"):
        spark.sparkContext.setJobGroup(f"build-{name}", name)
        QUERIES[name](spark, SF)
        assert not seen.getJobIdsForGroup(f"build-{name}"), name
    spark.sparkContext.setJobGroup("none", "none")


def test_rows_without_a_click_are_spread_over_the_product_join(spark, t):
    from pyspark.sql import functions as F

    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    old = {k: spark.conf.get(k) for k in keys}
    spark.conf.set(keys[0], "-1")
    spark.conf.set(keys[1], "false")
    try:
        joined = attach_product_name(t.actions.drop("product_name"), t.products)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len(sizes) == 8 and max(sizes) < 2 * sorted(sizes)[4]


def test_area_report_reads_the_log_once_and_renders_remarks_for_winners_only(t):
    lines = executed(areas.area_top3_products(t))
    assert sum("FileScan" in x and "event_id" in x or "FileScan" in x and "props" in x for x in lines) == 1
    text = "\n".join(lines)
    # top down: remarks, the rank filter's window, the group limit below its exchange, the city lists
    rendered, window = text.index("array_join"), text.index("Window [")
    limit, gathered = text.index("WindowGroupLimit"), text.index("collect_list")
    assert rendered < window < limit < gathered and "array_join" not in text[window:]
    assert "LeftSemi" not in text


def test_date_conditions_reach_the_registered_scan(spark):
    from clickscope.plans import QUERIES

    for name in ("filter_date_range", "filter_combined"):
        scan = next(x for x in plan(QUERIES[name](spark, SF)).splitlines() if "PushedFilters" in x and "events" in x)
        assert "GreaterThanOrEqual(ts," in scan and "LessThan(ts," in scan


def test_area_clicks_aggregate_before_the_city_join(t):
    p = plan(areas.area_product_clicks(t))
    # a partial aggregation on (product, city id) sits below the join with the city dimension
    join_at = p.find("Join")
    assert "keys=[click_product_id" in p[join_at:] and "city_id" in p[join_at:]
