import pytest

from clickscope.conditions import Condition
from clickscope.plans.app import RESULT_TABLES, _condition_from_json, replace_in_table, run_demands
from clickscope.sources import load_fixture_tables
from clickscope.sources.tables import ModelTables

SF = "/root/testdata/sf0.001"


def test_condition_from_json():
    cond = _condition_from_json('{"start_date": "2024-01-02", "category_ids": [1, 2]}')
    assert cond == Condition(start_date="2024-01-02", category_ids=(1, 2))


def test_run_all_demands_appends_per_run(spark):
    tables = load_fixture_tables(spark, SF)
    written = {}

    def capture(name, df):
        written[name] = df.count()

    flow = Condition(target_page_flow=(1, 2, 3))
    run_demands(tables, flow, "r-1", write=capture, table_prefix="t_", persist_base=True)
    assert set(written) == {f"t_{n}" for n in RESULT_TABLES.values()}
    assert written["t_session_stat"] == 1 and written["t_category_top10"] == 10
    run_demands(tables, Condition(), "r-1", only=["category_top10"], table_prefix="app_")
    run_demands(tables, Condition(), "r-2", only=["category_top10"], table_prefix="app_")
    runs = spark.table("app_category_top10").groupBy("taskId").count().collect()
    assert sorted((r["taskId"], r["count"]) for r in runs) == [("r-1", 10), ("r-2", 10)]


def test_condition_takes_the_original_keys_and_text_values():
    cond = _condition_from_json('{"startDate": "2018-11-01", "endDate": "", "startAge": "20", "professionals": "",'
                                ' "keywords": "a, b", "categoryIds": "3,5", "targetPageFlow": "1,2,3", "city": "7"}')
    assert cond == Condition(start_date="2018-11-01", start_age=20, keywords=("a", "b"), category_ids=(3, 5),
                             target_page_flow=(1, 2, 3), city=7)


def test_conversion_rate_needs_a_flow(spark):
    tables = load_fixture_tables(spark, SF)
    names = []
    with pytest.raises(ValueError, match="target_page_flow"):
        run_demands(tables, Condition(), "r", write=lambda n, d: names.append(n), only=["page_convert_rate"])
    run_demands(tables, Condition(), "r", write=lambda n, d: names.append(n))
    assert "page_convert_rate" not in names and len(names) == len(RESULT_TABLES) - 1


def test_only_wanted_plans_are_built_and_area_rows_carry_the_run(spark):
    tables = load_fixture_tables(spark, SF)
    seen = {}
    run_demands(tables, Condition(), "r-9", write=lambda n, d: seen.update({n: d.first()["taskId"]}), only=["area_top3"])
    assert seen == {"area_top3_product": "r-9"}


def test_repeated_dimension_keys_are_refused(spark):
    t = load_fixture_tables(spark, SF)
    double = ModelTables(t.actions, t.users.unionByName(t.users), t.products, t.cities)
    with pytest.raises(ValueError, match="not unique"):
        run_demands(double, Condition(), "r", write=lambda n, d: None)


def log_scans(df):
    """How often the executed plan reads the log, repeated exchanges counted once."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    return sum("FileScan" in line and ("event_id" in line or "event_type" in line or "ts#" in line) for line in text.splitlines())


def test_demands_share_what_they_have_in_common(spark):
    tables = load_fixture_tables(spark, SF)
    rows, scans = {}, {}

    def capture(name, df):
        rows[name] = sorted(map(str, df.collect()))
        scans[name] = log_scans(df)

    condition = Condition(target_page_flow=(1, 2, 3))
    run_demands(tables, condition, "r", write=capture)
    together, rows = rows, {}
    assert scans["session_stat"] == 0 and scans["category_top10"] == 0  # from the shared results, one scan each
    assert scans["random_session_info"] == 1 and scans["top10_session_per_top10_cid"] == 1 and scans["area_top3_product"] == 1
    assert sum(scans.values()) + 2 <= 10  # 13 before demands shared anything
    for role in RESULT_TABLES:
        run_demands(tables, condition, "r", write=capture, only=[role])
    assert rows == together
    rows = {}
    run_demands(tables, condition, "r", write=capture, split_rows=2)  # hot users and hours are split
    assert rows == together


def test_a_repeated_run_replaces_its_results(spark):
    tables = load_fixture_tables(spark, SF)
    for run_id in ("r-1", "r-2", "r-1"):
        run_demands(tables, Condition(), run_id, write=replace_in_table(run_id), only=["category_top10", "session_stat"],
                    table_prefix="again_")
    for name, n in (("again_category_top10", 10), ("again_session_stat", 1)):
        assert sorted((r["taskId"], r["count"]) for r in spark.table(name).groupBy("taskId").count().collect()) == [("r-1", n), ("r-2", n)]
