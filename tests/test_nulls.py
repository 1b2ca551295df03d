"""Analyses equal their SQL where dates, keys, scores and levels are missing."""

import duckdb
import pytest
from check_oracle import compare, duck
from conftest import SF_SMALL

from aulaframe.plans.registry import load_all
from aulaframe.sources.tables import TABLES

GONE = {
    "orders": {"o_orderdate": 11, "o_custkey": 17, "o_orderpriority": 19, "o_totalprice": 23, "o_orderstatus": 29},
    "lineitem": {"l_quantity": 13, "l_returnflag": 31, "l_suppkey": 37, "l_linestatus": 41},
    "part": {"p_brand": 5, "p_type": 9},
    "customer": {"c_mktsegment": 5},
}
KEY = {"orders": "o_orderkey", "lineitem": "l_orderkey", "part": "p_partkey", "customer": "c_custkey"}
# crosstab_wide: its SQL names the levels, so it has no column for NULL.
# rank_groups: two means that differ in their last bit change places.
NOT_HERE = {"crosstab_wide", "rank_groups"}


@pytest.fixture(scope="module")
def with_nulls(tmp_path_factory):
    folder, con = tmp_path_factory.mktemp("nulls"), duckdb.connect()
    for t in TABLES:
        changed = ", ".join(f"CASE WHEN {KEY[t]} % {k} = 0 THEN NULL ELSE {c} END AS {c}" for c, k in GONE.get(t, {}).items())
        cols = f"* REPLACE ({changed})" if changed else "*"
        con.execute(f"COPY (SELECT {cols} FROM read_parquet('{SF_SMALL}/{t}.parquet')) TO '{folder}/{t}.parquet' (FORMAT parquet)")
    return str(folder)


@pytest.mark.parametrize("name", sorted(n for n, a in load_all().items() if a.body and n not in NOT_HERE))
def test_equals_sql_with_nulls(spark, with_nulls, name):
    got = compare(spark, duck(with_nulls), load_all()[name], with_nulls)
    assert "error" not in got and "type_diff" not in got, got


@pytest.mark.parametrize("name", ["pca_explained", "famd_explained", "famd_scores", "famd_variable_links"])
def test_factors_of_incomplete_rows(spark, with_nulls, name):
    rows = load_all()[name].run(spark, with_nulls).collect()
    assert rows and all(x is not None for r in rows for x in r)
