"""Undated rows and NULL levels are rows like any other."""

from datetime import datetime

from aulaframe.operators.contingency import crosstab_wide
from aulaframe.plans import bind_io


def test_refresh_lands_undated_rows(spark, tmp_path):
    rows = [(1, 10, datetime(1998, 5, 1)), (2, 11, datetime(2000, 1, 1)), (3, 12, None), (4, 10, None)]
    spark.createDataFrame([(k, c, "O", 1.5, d, "1") for k, c, d in rows],
                          "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string") \
        .write.parquet(f"{tmp_path}/orders.parquet")
    got = {(r.year, r.n, r.total) for r in bind_io.incremental_refresh(spark, str(tmp_path)).collect()}
    assert got == {(1998, 1, 1.5), (2000, 1, 1.5), (None, 2, 3.0)}
    got = {(r.load, r.o_custkey) for r in bind_io.incremental_dimension(spark, str(tmp_path)).collect()}
    assert got == {("first_load", 10), ("second_load", 11), ("second_load", 12)}


def test_crosstab_counts_null_levels(spark):
    df = spark.createDataFrame([("x", "p"), ("x", None), ("x", None), (None, "null"), (None, None)], "a string, b string")
    got = crosstab_wide(df, "a", "b")
    assert got.columns == ["a", "null", "p", "null_"]
    assert {tuple(r) for r in got.collect()} == {("x", 0, 1, 2), (None, 1, 0, 1)}
    assert crosstab_wide(df.filter("b = 'p'"), "a", "b").columns == ["a", "p"]
