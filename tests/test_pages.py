from clickscope.operators import pages
from clickscope.operators.actions import base_actions
from tests.helpers import action, tables


def test_flow_pairs_any_length():
    assert pages.flow_pairs([1, 2, 3, 4, 5, 6, 7, 8, 9]) == [(i, i + 1) for i in range(1, 9)]
    assert pages.flow_pairs([1, 2, 1, 2]) == [(1, 2), (2, 1)]
    assert pages.flow_pairs([5]) == []


def test_conversion_rate(spark):
    seq = {"a": [1, 2, 3], "b": [1, 2], "c": [1, 3], "d": [2, 3, 2, 3]}
    rows = [action(s, f"2018-11-26 10:00:{i:02d}", page_id=p) for s, ps in seq.items() for i, p in enumerate(ps)]
    acts = base_actions(tables(spark, rows), enrich=())
    views = {r["page_id"]: r["view_count"] for r in pages.targeted_page_views(acts, [1, 2, 3]).collect()}
    assert views == {1: 3, 2: 4, 3: 4}
    rate = {r["pageJump"]: r["rate"] for r in pages.page_conversion_rate(acts, "t", [1, 2, 3]).collect()}
    # 1->2 twice of 3 views of page 1; 2->3 three times of 4 views of page 2
    assert rate == {"1_2": 66.67, "2_3": 75.0}


def test_pairs_absent_from_data_give_no_row(spark):
    rows = [action("s", "2018-11-26 10:00:00", page_id=4), action("s", "2018-11-26 10:00:01", page_id=5)]
    acts = base_actions(tables(spark, rows), enrich=())
    assert pages.page_conversion_rate(acts, "t", [1, 2]).count() == 0
