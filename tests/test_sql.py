from pyspark.sql import functions as F

from clickscope.functions import city_remark
from clickscope.operators import areas
from clickscope.plans.sql import area_top3_by_sql, register_functions, register_model_views
from clickscope.sources import load_fixture_tables

SF = "/root/testdata/sf0.001"


def test_views_are_registered_and_usable_in_sql(spark):
    t = load_fixture_tables(spark, SF)
    names = register_model_views(t, prefix="t_")
    assert spark.table(names["actions"]).count() == t.actions.count()
    per_area = spark.sql(f"SELECT area, count(*) n FROM {names['cities']} GROUP BY area")
    assert sum(r["n"] for r in per_area.collect()) == t.cities.count()


def test_area_report_from_sql_text_equals_the_operator(spark):
    t = load_fixture_tables(spark, SF)
    names = register_model_views(t, prefix="area_")
    report = area_top3_by_sql(spark, names)
    assert "Python" not in report._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, report.collect())) == sorted(map(tuple, areas.area_top3_products(t).collect()))


def test_remark_function_matches_the_column(spark):
    assert register_functions(spark) == ["percent_text", "city_remark"]
    rows = [(1, "a", 1), (1, "b", 2), (1, "c", 2), (2, "z", 5), (3, "x", 57), (3, "y", 743)]
    spark.createDataFrame(rows, "g long, city string, n long").createOrReplaceTempView("remark_rows")
    for shown in (None, 1, 2, 5):
        got = spark.sql(f"SELECT g, city_remark(collect_list(struct(city, n)){'' if shown is None else f', {shown}'}) AS r"
                        " FROM remark_rows GROUP BY g").collect()
        listed = F.collect_list(F.struct((-F.col("n")).alias("neg_n"), "city", "n"))
        want = (spark.table("remark_rows").groupBy("g").agg(listed.alias("cities"), F.sum("n").alias("t"))
                .select("g", city_remark(F.col("cities"), F.col("t"), shown).alias("r")).collect())
        assert {tuple(r) for r in got} == {tuple(r) for r in want}
    assert [tuple(r) for r in spark.sql("SELECT percent_text(57, 800), percent_text(1, 3), percent_text(1, 0)").collect()] \
        == [("7.13", "33.33", None)]
