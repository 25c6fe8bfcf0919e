"""Invariants on the driver tables, and HALF_UP rounding against Decimal."""

import os
import re
from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickscope.functions import percent_half_up, percent_text
from clickscope.operators import areas, categories, pages, sessions
from clickscope.operators.actions import base_actions
from clickscope.sources import load_fixture_tables

SF = os.environ.get("CLICKSCOPE_INVARIANT_SF", "/root/testdata/sf0.01")
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def t(spark):
    return load_fixture_tables(spark, SF)


def test_bucket_shares_add_up(t):
    r = sessions.session_bucket_stats(base_actions(t, enrich=()), "r").collect()[0]
    assert abs(r["session_visitLength_le_10s_ratio"] + r["session_visitLength_gt_10s_ratio"] - 100) <= 0.01
    assert abs(r["session_stepLength_le_5_ratio"] + r["session_stepLength_gt_5_ratio"] - 100) <= 0.01


def test_rates_are_percentages(t):
    rates = [r["rate"] for r in pages.page_conversion_rate(base_actions(t, enrich=()), "r", range(1, 11)).collect()]
    assert rates and all(0 <= x <= 100 for x in rates)


def test_sample_quota_per_hour(t):
    acts = base_actions(t, enrich=())
    ids = sessions.sample_session_ids(acts, need=1000).collect()
    assert len({r["sessionId"] for r in ids}) == len(ids)
    hours = {r["hour"]: r["session_count"] for r in sessions.hourly_session_counts(acts).collect()}
    total = sum(hours.values())
    per_hour = {}
    for r in ids:
        per_hour[r["hour"]] = per_hour.get(r["hour"], 0) + 1
    for h, n in hours.items():
        assert 0 <= per_hour.get(h, 0) - n * 1000 // total <= 1
    assert len(ids) == 1000


def test_ranks_are_one_to_k(t):
    rows = areas.area_top3_products(t).collect()
    by_area = {}
    for r in rows:
        by_area.setdefault(r["area"], []).append(r["rank"])
    assert all(sorted(v) == list(range(1, len(v) + 1)) for v in by_area.values())
    top = categories.top_sessions_per_top_category(base_actions(t, enrich=()), "r").groupBy("categoryId").count()
    assert all(r["count"] <= 10 for r in top.collect())


def test_city_shares_sum_to_100(t):
    for r in areas.area_product_clicks(t).collect():
        shares = [float(x) for x in re.findall(r"=([0-9.]+)%", r["city_remark"])]
        assert abs(sum(shares) - 100) <= 0.01 * len(shares)


@settings(max_examples=1, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**9), st.integers(1, 10**9)), min_size=200, max_size=200))
def test_half_up_matches_decimal(spark, pairs):
    pairs = [(min(n, d), d) for n, d in pairs] + [(57, 800), (1, 200), (5, 8), (1, 3)]
    df = spark.createDataFrame(pairs, "n long, d long")
    got = df.select(percent_half_up("n", "d").alias("p"), percent_text("n", "d").alias("s")).collect()
    for (n, d), r in zip(pairs, got):
        exp = (Decimal(n) * 100 / Decimal(d)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP) \
            if (Decimal(n) * 10000 % Decimal(d)) else (Decimal(n) * 100 / Decimal(d)).quantize(Decimal("0.01"))
        exact = (Decimal(n * 20000 + d) // Decimal(2 * d)) / 100
        assert Decimal(r["s"]) == exact == exp
        assert r["p"] == float(exact)


def test_percent_null_total(spark):
    r = spark.range(1).select(percent_half_up(F.lit(3), F.lit(0)).alias("p")).collect()[0]
    assert r["p"] is None


def test_a_local_warehouse_is_no_shared_folder_on_a_cluster():
    from types import SimpleNamespace

    from clickscope.session import checkpoint_dir

    def session(master, **conf):
        told = []
        return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: conf.get(k.replace(".", "_"), d)),
                               sparkContext=SimpleNamespace(master=master, setCheckpointDir=told.append)), told

    for master, conf, want in (("yarn", {"spark_checkpoint_dir": "s3://b/x"}, "s3://b/x"),
                               ("yarn", {"spark_sql_warehouse_dir": "hdfs://n/w/"}, "hdfs://n/w/_checkpoints"),
                               ("local[4]", {"spark_sql_warehouse_dir": "file:/w"}, "file:/w/_checkpoints")):
        spark, told = session(master, **conf)
        assert checkpoint_dir(spark) == want and told == [want]
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(session("yarn", spark_sql_warehouse_dir="file:/w")[0])
