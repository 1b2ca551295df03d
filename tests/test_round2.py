"""Overflow-safe statistics, NULL-safe keys, storage safety."""

import pytest

from aulaframe.operators.contingency import chi_square_of, cramers_v
from aulaframe.operators.star import build_dim
from aulaframe.streaming.refresh import _read_if_exists


def test_chi_square_of_very_large_counts(spark):
    k = 10**12
    ct = spark.createDataFrame([("a", "x", 30 * k), ("a", "y", 10 * k), ("b", "x", 20 * k)], "a string, b string, n long")
    r = cramers_v(chi_square_of(ct, "a", "b")).first()
    # by hand: expected 33.33, 6.67, 16.67, 3.33 (unobserved)
    e = [100 / 3, 20 / 3, 50 / 3, 10 / 3]
    want = sum((o - x) ** 2 / x for o, x in zip([30, 10, 20, 0], e)) * k
    assert abs(r.chi2 / want - 1) < 1e-9 and r.n == 60 * k and r.dof == 1


def test_dimension_keys_tell_nulls_apart(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None), (None, None)], "x string, y string")
    assert build_dim(df, ["x", "y"], key="k").select("k").distinct().count() == 3


def test_unreadable_dimension_is_not_empty(spark, tmp_path):
    assert _read_if_exists(spark, str(tmp_path / "none")) is None
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part-0.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception):
        _read_if_exists(spark, str(tmp_path / "bad"))


def test_percentile_rank_with_nulls(spark):
    from aulaframe.operators.bivariate import percentile_in

    df = spark.createDataFrame([(None, 1.0), (None, 2.0), (None, None), ("a", 3.0), ("a", 3.0), ("a", 5.0), ("b", None)], "g string, x double")
    for method in ("rank", "window"):
        for by in (None, "g"):
            got = sorted(((r.g, r.x, r.pct_rank) for r in percentile_in(df, "x", by, method=method).collect()), key=str)
            if by:
                want = [("a", 3.0, 0.0), ("a", 3.0, 0.0), ("a", 5.0, 1.0), ("b", None, None), (None, 1.0, 0.0), (None, 2.0, 1.0), (None, None, None)]
            else:
                want = [("a", 3.0, 0.5), ("a", 3.0, 0.5), ("a", 5.0, 1.0), ("b", None, None), (None, 1.0, 0.0), (None, 2.0, 0.25), (None, None, None)]
            assert got == sorted(want, key=str)


def test_rename_plan_numbers_ties_and_null_origins(spark):
    from aulaframe.sources.files import plan_renames

    files = spark.createDataFrame([(1, "t", "p1", ".csv"), (1, "t", "p2", ".csv"), (None, "t", "p3", ".csv")],
                                  "origin int, token string, path string, ext string")
    tokens = spark.createDataFrame([("t", "C", 2021)], "token string, category string, year int")
    got = {r.path: r.final_name for r in plan_renames(files, tokens).collect()}
    assert got == {"p1": "C_2021.csv", "p2": "C_2021 (2).csv", "p3": "C_2021 (3).csv"}
