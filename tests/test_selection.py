"""Radix selection, row numbers and chi-square p-values against brute force."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from aulaframe.functions.columns import chi_square_sf
from aulaframe.operators import contingency as C
from aulaframe.operators import ranking as R
from aulaframe.operators import univariate as U
from aulaframe.sources import files as IO

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]


def _groups():
    r = random.Random(12)
    out = {
        "hot": [7.0] * 4000 + [r.random() for _ in range(300)],
        "spread": [r.choice([-1, 1]) * 10 ** r.uniform(-300, 300) for _ in range(900)],
        "close": [1.0 + k * 2.0 ** -52 for k in range(200)] + [1e300, -1e300],
        "one": [3.25],
        "same": [-0.5] * 50,
        "ends": [float("-inf")] * 3 + [1.0, 2.0] + [float("inf")] * 4,
        None: [1.0, 2.0, 5.0],
    }
    return out


@pytest.fixture(scope="module")
def values(spark):
    rows = [(g, x) for g, xs in _groups().items() for x in xs] + [("hot", None)] * 30 + [("empty", None)] * 5
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "g string, x double").repartition(7)


@pytest.mark.parametrize("open_rows", [1, 20, 500_000])
@pytest.mark.parametrize("buckets", [16, 4096])
def test_quantiles(values, monkeypatch, open_rows, buckets):
    monkeypatch.setattr(R, "OPEN_ROWS", open_rows)
    names = [f"p{i}" for i in range(len(PROBS))]
    got = {r.g: r for r in R.exact_quantiles(values, "x", PROBS, ["g"], names, [F.count("x").alias("n"), F.count("*").alias("rows")], buckets).collect()}
    assert set(got) == {*_groups(), "empty"}
    assert (got["empty"].n, got["empty"].rows, got["empty"].p3, got["hot"].rows - got["hot"].n) == (0, 5, None, 30)
    for g, xs in _groups().items():
        xs = sorted(xs)
        for p, name in zip(PROBS, names):
            k = p * (len(xs) - 1)
            lo, hi = xs[math.floor(k)], xs[math.ceil(k)]
            assert got[g][name] == (lo if lo == hi else lo + (hi - lo) * (k - math.floor(k))), (g, p)


def test_quantiles_of_all_rows_and_of_integers(spark, monkeypatch):
    monkeypatch.setattr(R, "OPEN_ROWS", 10)
    xs = [2**62 + k * k for k in range(300)] + [0, -2**60]
    df = spark.createDataFrame([(x,) for x in xs], "x long")
    assert R.exact_quantiles(df, "x", [0.0, 1.0], names=["a", "z"]).first() == (float(min(xs)), float(max(xs)))
    assert R.exact_quantiles(df.filter("x > 0"), "x", [0.5], names=["m"]).first().m == pytest.approx(np.median(np.array(xs[:300], float)))


def test_nan_is_the_greatest(spark):
    df = spark.createDataFrame([(x,) for x in [1.0, 2.0, float("nan"), float("nan")]], "x double")
    row = R.exact_quantiles(df, "x", [0.0, 1 / 3, 1.0], names=["a", "b", "c"]).first()
    assert (row.a, row.b) == (1.0, 2.0) and math.isnan(row.c)


@pytest.mark.parametrize("open_rows", [1, 500_000])
def test_rows_below(values, monkeypatch, open_rows):
    monkeypatch.setattr(R, "OPEN_ROWS", open_rows)
    got = R.with_rows_below(values, "x", ["g"]).collect()
    assert len(got) == values.count()
    for r in got:
        if r.x is None:
            assert r._below is None and r._size is None
        else:
            xs = _groups()[r.g]
            assert (r._below, r._size) == (sum(y < r.x for y in xs), len(xs))


def test_box_keeps_groups_without_values(values):
    got = {r.module: r for r in U.box_stats(values.filter("g <> 'spread' or g is null").select(F.col("g").alias("module"), F.col("x").alias("score"))).collect()}
    assert set(got) == {"hot", "close", "one", "same", "ends", None, "empty"}
    assert (got["empty"].n, got["empty"].n_out_hi, got["empty"].whisker_lo) == (0, 0, None)
    assert (got["hot"].n, got["hot"].q1, got["hot"].n_out_lo, got["hot"].whisker_lo) == (4300, 7.0, 300, 7.0)


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_row_numbers(spark, partitions):
    rows = [(g, x) for g in ("a", "b", None) for x in range(50)] + [("hot", x) for x in range(900)] + [("tail", None)]
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame(rows, "g string, x int")
    got = R.with_row_number(df, ["g"], [F.col("x")], "k", partitions).collect()
    assert Counter((r.g, r.x, r.k) for r in got) == Counter((g, x, 1 if x is None else x + 1) for g, x in rows)


def test_renames_of_files_without_year_or_origin(spark):
    rows = [("t", None, 2021, f"p{k:03}", ".csv") for k in range(120)] + [("t", "o1", 2021, "a", ".csv"), ("t", "o0", None, "b", ".csv"), ("t", None, None, "c", ".csv")]
    cat = spark.createDataFrame(rows, "token string, origin string, year long, path string, ext string").repartition(5)
    out = IO.plan_renames(cat, spark.createDataFrame([("t", "EXAM")], "token string, category string")).collect()
    by = {r.path: (r.clash_ordinal, r.final_name) for r in out}
    assert by["a"] == (1, "EXAM_2021.csv") and by["p000"] == (2, "EXAM_2021 (2).csv") and by["p119"][0] == 121
    assert (by["b"][0], by["c"][0]) == (1, 2)


# Published upper points of the chi-square distribution
@pytest.mark.parametrize("x, dof, p", [(3.841458820694124, 1, 0.05), (6.634896601021213, 1, 0.01), (5.991464547107979, 2, 0.05),
                                       (18.307038053275146, 10, 0.05), (124.34211340400407, 100, 0.05), (0.0, 3, 1.0)])
def test_p_values(spark, x, dof, p):
    assert spark.createDataFrame([(x, dof)], "x double, k long").select(chi_square_sf("x", "k")).first()[0] == pytest.approx(p, rel=1e-10)


def test_pairs_equal_single_tests(spark, registry):
    df = spark.createDataFrame([(f"a{i % 3}", f"b{i * i % 5}", None if i % 4 else "c", "d") for i in range(400)], "a string, b string, c string, d string")
    got = {(r.var_a, r.var_b): r for r in C.chi_square_pairs(df, ["a", "b", "c", "d"]).collect()}
    assert len(got) == 6
    one = C.chi_square(df, "a", "b").first()
    assert got["a", "b"].chi2 == pytest.approx(one.chi2) and got["a", "b"].dof == one.dof
    assert (got["a", "c"].n, got["a", "c"].cols, got["a", "c"].dof, got["a", "c"].p_value) == (100, 1, 0, None)
    assert got["a", "b"].p_value == pytest.approx(C.chi_square_test(df, "a", "b").first().p_value, rel=1e-9)
