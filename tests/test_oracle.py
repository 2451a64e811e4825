"""Every registered query against its DuckDB oracle on the smallest scale factor."""
import pytest

import __spark_entry__ as E
from clickwell.plans.registry import QUERIES, load_all
from oracle_compare import compare, duck, type_diff

SF = "/root/testdata/sf0.001"
# these have no rows on the smallest scale (ranking threshold, rare missing values)
LARGER_SF = "/root/testdata/sf0.01"
LARGER = ("top_segments", "bottom_segments", "segment_chart", "segment_rankings", "profile_missing_experiment")
ORACLE = E.oracle_sql()
load_all()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    sf, con = (LARGER_SF, duck(LARGER_SF)) if name in LARGER else (SF, con)
    df = E.queries()[name](spark, sf)
    rows = [tuple(r) for r in df.collect()]
    assert rows
    res = con.execute(ORACLE[name])
    assert compare(rows, df.columns, res.fetchall(), [d[0] for d in res.description]) is None
    assert type_diff(df.schema, res.description) == {}


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["device_type", "app_category", "site_category", "banner_pos",
                          "impressions", "clicks", "ctr", "click_share"]
