"""Rows that a filter, an inner join or a size switch would leave out."""

import pytest
from pyspark.sql import functions as F

from aulaframe.operators import bivariate as B
from aulaframe.operators import univariate as U


@pytest.mark.parametrize("method", [None, "map", "rank"])
def test_groups_without_a_score_are_rows_at_every_size(spark, monkeypatch, method):
    monkeypatch.setattr(U, "MAP_MAX_DISTINCT", 1)  # any group counts as large
    rows = [("m", "a", 1.0), ("m", "a", 3.0), ("m", "a", None), ("m", "b", None), ("m", None, 5.0), ("m", None, None)]
    long = spark.createDataFrame(rows, "module string, g string, score double")
    how = {"method": method} if method else {}
    by = lambda df, *cols: {r.g: tuple(r[c] for c in cols) for r in df.collect()}
    assert by(U.describe(long, "g", **how), "n", "median") == {"a": (2, 2.0), "b": (0, None), None: (1, 5.0)}
    assert by(U.box_stats(long, "g", **how), "n", "median", "n_out_lo") == {"a": (2, 2.0, 0), "b": (0, None, 0), None: (1, 5.0, 0)}
    assert by(U.quartile_table(long, "g", **how), "median") == {"a": (2.0,), "b": (None,), None: (5.0,)}
    assert by(B.group_stats(long, "g", **how), "n", "median") == {"a": (2, 2.0), "b": (0, None), None: (1, 5.0)}
