"""Driver contract and the DuckDB oracle on the smallest driver tables."""

import os

import pytest

import __spark_entry__ as entry
from clickscope.plans import ORACLE_SQL, QUERIES
from tools.check_oracle import duck, rows_of

SF_DIR = os.environ.get("CLICKSCOPE_ORACLE_SF", "/root/testdata/sf0.001")


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["area", "product_name", "count", "rank", "city_remark"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.skipif(not os.path.exists(SF_DIR), reason="driver tables not present")
@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    con = duck(SF_DIR)
    sdf = entry.queries()[name](spark, SF_DIR)
    s_rows = [tuple(r) for r in sdf.collect()]
    res = con.execute(entry.oracle_sql()[name])
    d_cols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(d_cols)
    assert rows_of(sdf.columns, s_rows) == rows_of(d_cols, res.fetchall())
