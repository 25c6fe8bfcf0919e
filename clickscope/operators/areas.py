"""Top clicked products per area with a per-city breakdown."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickscope.functions import city_remark as render_city_remark
from clickscope.sources.tables import ModelTables


def area_product_city_clicks(tables: ModelTables) -> DataFrame:
    """Clicks per (product, area, city); unknown cities are dropped.

    Reads the raw action table (the run condition does not apply here).
    Clicks are counted per (product, city id) first, with map-side partial
    aggregation, so the join to the city dimension sees one row per
    (product, city) instead of every click, whether or not Spark broadcasts
    the dimension.
    """
    clicks = (tables.actions.filter(F.col("click_product_id") > 0)
              .groupBy("click_product_id", "city_id").agg(F.count(F.lit(1)).alias("n")))
    return (clicks.join(tables.cities.select("city_id", "city_name", "area"), "city_id", "inner")
            .groupBy("click_product_id", "area", "city_name")
            .agg(F.sum("n").cast("long").alias("n")))


def area_product_clicks(tables: ModelTables, top_n_cities: int | None = None) -> DataFrame:
    """Per (product, area): click count and the city remark.

    Counted per city first (partial aggregation, so hot products combine
    before the shuffle); the second level gathers at most one element per
    city of the area.
    """
    return _with_remarks(_with_cities(area_product_city_clicks(tables)), top_n_cities)


def _with_cities(per_city: DataFrame) -> DataFrame:
    """Per (product, area): clicks and the list of its cities, at most one element per city of the area."""
    return per_city.groupBy("click_product_id", "area").agg(
        F.sum("n").cast("long").alias("count"),
        F.collect_list(F.struct((-F.col("n")).alias("neg_n"), F.col("city_name").alias("city"),
                                F.col("n").alias("n"))).alias("cities"),
    )


def _with_remarks(groups: DataFrame, top_n_cities: int | None) -> DataFrame:
    return groups.withColumn("city_remark", render_city_remark(F.col("cities"), F.col("count"), top_n_cities)).drop("cities")


def area_top3_products(tables: ModelTables, k: int = 3, top_n_cities: int | None = None) -> DataFrame:
    """Top ``k`` products per area by clicks (ties: product id), then named.

    One pass over the log. The rank filter is a literal bound, so Spark keeps
    only ``k`` rows per area in each map task before the window shuffle; a
    group's city list, bounded by the cities of its area, rides along with its
    count, and remarks are rendered for the winners alone. Products unknown to
    the product dimension are dropped after ranking (their rank is not
    reused). A null area is an area of its own.
    """
    groups = _with_cities(area_product_city_clicks(tables))
    w = Window.partitionBy("area").orderBy(F.desc("count"), F.asc("click_product_id"))
    winners = groups.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= F.lit(k))
    products = tables.products.select(F.col("product_id").alias("click_product_id"), "product_name")
    return (_with_remarks(winners, top_n_cities).join(products, "click_product_id", "inner")
            .select("area", "product_name", "count", "rank", "city_remark"))
