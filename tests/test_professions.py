from clickscope.operators import professions, sessions
from clickscope.operators.actions import base_actions
from tests.helpers import action, tables


def test_share_of_repeat_click_sessions(spark):
    r = [
        # s1 (user 1, 学生): product 5 twice -> counted
        action("s1", "2018-11-26 10:00:00", user_id=1, click_category=1, click_product=5),
        action("s1", "2018-11-26 10:00:01", user_id=1, click_category=1, click_product=5),
        # s2 (user 2, 程序员): two different products -> not counted
        action("s2", "2018-11-26 10:00:00", user_id=2, click_category=1, click_product=5),
        action("s2", "2018-11-26 10:00:01", user_id=2, click_category=1, click_product=6),
        # s3 (user 4, 老师): product 7 three times -> counted; -1 rows never count
        *[action("s3", f"2018-11-26 10:00:0{i}", user_id=4, click_category=2, click_product=7) for i in range(3)],
        action("s4", "2018-11-26 10:00:00", user_id=3, keyword="x"),
        action("s4", "2018-11-26 10:00:01", user_id=3, keyword="y"),
        # user 1 again in another session: one click each -> per session not counted, per user counted
        action("s5", "2018-11-27 10:00:00", user_id=3, click_category=1, click_product=8),
        action("s6", "2018-11-28 10:00:00", user_id=3, click_category=1, click_product=8),
    ]
    t = tables(spark, r)
    acts = base_actions(t, enrich=())
    row = professions.professional_share(acts, t.users, "t").collect()[0]
    assert row["userCount"] == 2
    assert (row["teacher_ratio"], row["programmer_ratio"], row["PM_ratio"], row["stu_ratio"]) == (50.0, 0.0, 0.0, 50.0)
    by_user = professions.professional_share(acts, t.users, "t", by="user").collect()[0]
    assert by_user["userCount"] == 3 and by_user["PM_ratio"] == 33.33
    empty = professions.professional_share(acts.filter("false"), t.users, "t").collect()[0]
    assert empty["userCount"] == 0 and empty["stu_ratio"] is None


def test_profession_does_not_depend_on_arrival_order(spark):
    rows = [action("s", "2018-11-26 10:00:00", user_id=u, click_product=5, action_id=i) for i, u in enumerate((1, 2, 9))]
    users = [(1, "a", "a", 20, "A", "m"), (2, "b", "b", 20, "B", "m"), (9, "c", "c", 20, "", "m")]
    for order in (rows, rows[::-1]):
        t = tables(spark, list(order), users=users)
        got = professions.repeat_click_groups(base_actions(t, enrich=()), t.users).collect()
        assert [tuple(r) for r in got] == [("s", "B")]  # the last user's profession is empty
        assert sessions.session_rollup(base_actions(t), "r").first()["professional"] == "B"
