from clickscope.operators import areas
from tests.helpers import action, tables


def test_top3_with_city_remark_and_rank_gap(spark):
    clicks = []
    # area 华北 (cities 1, 7): product 1 x5, product 2 x4, product 30 (unknown) x3, product 3 x1
    for city, product, n in [(1, 1, 3), (7, 1, 2), (1, 2, 4), (7, 30, 3), (1, 3, 1)]:
        clicks += [action("s", "2018-11-26 10:00:00", click_category=1, click_product=product, city_id=city)] * n
    # area 华南 (city 3), unknown city 99 dropped
    clicks += [action("s", "2018-11-26 10:00:00", click_category=1, click_product=4, city_id=3)] * 2
    clicks += [action("s", "2018-11-26 10:00:00", click_category=1, click_product=4, city_id=99)] * 9
    # non-clicks are ignored
    clicks += [action("s", "2018-11-26 10:00:00", keyword="k", city_id=1)] * 9
    t = tables(spark, [dict(c) for c in clicks])
    got = sorted(tuple(r) for r in areas.area_top3_products(t).collect())
    assert got == [
        ("华北", "product_1", 5, 1, "北京=60.00%,天津=40.00%"),
        ("华北", "product_2", 4, 2, "北京=100.00%"),
        # rank 3 (product 30) is unknown to the product table: dropped after ranking
        ("华南", "product_4", 2, 1, "深圳=100.00%"),
    ]
    remarks = {(r["click_product_id"], r["area"]): r["city_remark"]
               for r in areas.area_product_clicks(t, top_n_cities=1).collect()}
    assert remarks[(1, "华北")] == "北京=60.00%,other=40.00%"


def test_top3_keeps_a_city_without_an_area(spark):
    clicks = [action("s", "2018-11-26 10:00:00", click_category=1, click_product=1, city_id=c) for c in (1, 8, 8)]
    cities = [(1, "北京", "华北"), (8, "x", None)]
    got = {tuple(r) for r in areas.area_top3_products(tables(spark, clicks, cities=cities)).collect()}
    assert got == {("华北", "product_1", 1, 1, "北京=100.00%"), (None, "product_1", 2, 1, "x=100.00%")}
