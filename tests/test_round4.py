"""Shared tables are dealt once, and wide rows meet by one join."""

import re

import pytest

from aulaframe.plans import bind_star
from aulaframe.plans import views as V

SF_SMALL = "/root/testdata/sf0.001"


def test_a_shared_table_is_written_as_its_query_deals_it(spark, tmp_path):
    for name in ("region", "nation"):
        spark.range(3).write.parquet(f"{tmp_path}/{name}.parquet")
    got = V.gold(spark, str(tmp_path), "dealt", ["region", "nation"], lambda s, d: s.range(0, 3000, 1, 3))
    assert len(got.inputFiles()) == 3 and got.count() == 3000


@pytest.mark.parametrize("build, key", [(V.score_fact_build, "l_orderkey"), (bind_star.fact_df, "l_orderkey")])
def test_orders_and_line_items_meet_last(spark, build, key):
    plan = build(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"Join (\w+), \((\w+)#", plan).groups() == ("Inner", key)
