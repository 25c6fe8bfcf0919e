import pytest

from clickscope.operators import products
from clickscope.operators.actions import base_actions
from tests.helpers import action, rows, tables


@pytest.fixture(scope="module")
def t(spark):
    r = [
        # clicks: product 1 x3, product 2 x2, product 3 x1  -> hot top 2 = {1, 2}
        *[action("c", "2018-11-26 09:00:00", user_id=4, click_category=1, click_product=1)] * 3,
        *[action("c", "2018-11-26 09:00:00", user_id=4, click_category=1, click_product=2)] * 2,
        action("c", "2018-11-26 09:00:00", user_id=4, click_category=1, click_product=3),
        # payments
        action("p1", "2018-11-11 10:00:00", user_id=1, pay_categories="1", pay_products="1,1,3"),  # 1 once
        action("p1", "2018-11-11 10:05:00", user_id=1, pay_categories="1", pay_products="1"),
        action("p2", "2018-11-11 11:00:00", user_id=2, pay_categories="1", pay_products="1,2"),
        action("p3", "2018-11-11 12:00:00", user_id=3, pay_categories="1", pay_products="2"),
        action("p3", "2018-11-11 12:01:00", user_id=3, pay_categories="1", pay_products="3"),
        action("p3", "2018-11-12 08:00:00", user_id=3, keyword="again"),
        action("p2", "2018-11-11 11:30:00", user_id=2, order_categories="1", order_products="9"),
    ]
    return tables(spark, [dict(x) for x in r])


def test_hot_products(t):
    got = rows(products.product_click_top10(base_actions(t), "t", k=2), "product_id", "click_count")
    assert got == [(1, 3), (2, 2)]


def test_paid_hot_actions(t):
    acts = base_actions(t)
    got = sorted(r["pay_product_ids"] for r in products.paid_hot_actions(acts, k=2).collect())
    assert got == ["1", "1,1,3", "1,2", "2"]


def test_purchases_count_a_product_once_per_action(t):
    got = rows(products.user_product_purchases(base_actions(t)), "user_id", "product_id", "purchase_count")
    assert got == [(1, 1, 2), (1, 3, 1), (2, 1, 1), (2, 2, 1), (3, 2, 1), (3, 3, 1)]


def test_top_buyers_and_visits(t):
    acts = base_actions(t, enrich=("user_name",))
    buyers = rows(products.top2_buyers_per_hot_product(acts, "t", k_products=2, k_buyers=1),
                  "product_id", "user_id", "purchase_count")
    assert buyers == [(1, 1, 2), (2, 2, 1)]  # product 2: users 2 and 3 tie, lower id wins
    visits = products.hot_product_user_visits(t, acts, "t", date="2018-11-11", k_products=2, k_buyers=1)
    got = [(r["product_id"], r["product_name"], r["user_id"], r["action_time"], r["operation_type"],
            r["operation_obj"]) for r in visits.collect()]
    assert got == [
        (1, "product_1", "1", "2018-11-11 10:00:00", "pay", "1,1,3"),
        (1, "product_1", "1", "2018-11-11 10:05:00", "pay", "1"),
        (2, "product_2", "2", "2018-11-11 11:00:00", "pay", "1,2"),
        (2, "product_2", "2", "2018-11-11 11:30:00", "order", "9"),
    ]
    assert visits.columns[:8] == ["taskId", "product_id", "product_name", "user_id", "user_name", "action_time",
                                  "operation_type", "operation_obj"]


def test_malformed_ids_are_counted_or_fail_loudly(spark):
    clicks = [action("s", f"2018-11-26 09:00:0{i}", click_product=8) for i in range(3)]
    t = tables(spark, [*clicks, action("s", "2018-11-26 10:00:00", pay_products="8,x9,7", user_id=2)])
    acts = base_actions(t)
    assert products.paid_hot_actions(acts).count() == 1
    buyers = products.top2_buyers_per_hot_product(acts, "r").collect()
    assert [(r["product_id"], r["user_id"], r["purchase_count"]) for r in buyers] == [(8, 2, 1)]
    assert products.hot_product_user_visits(t, acts, "r").count() == 1
    with pytest.raises(Exception, match="not a product id: x9"):
        products.user_product_purchases(acts).collect()
