"""Factor analysis of many levels, cohorts, rejected values, variable codes,
block extraction and mergeable statistics."""

import pytest
from pyspark.sql import functions as F

from aulaframe.operators import burt as BU
from aulaframe.operators import clean as C
from aulaframe.operators import counts as K
from aulaframe.operators import factor as FA
from aulaframe.operators import quality as Q
from aulaframe.streaming.states import ACCURACY, summarise, value_states


def _mixed(spark, n, levels):
    """Two variables that follow a hidden group, one that doesn't, two scores."""
    g = (F.col("id") * 7919 % 13 % 4)
    return spark.range(n).select(
        "id", F.concat(F.lit("a"), (g * 3 + F.col("id") % 3).cast("string")).alias("a"),
        F.concat(F.lit("b"), (g + (F.col("id") % 17 == 0).cast("long")).cast("string")).alias("b"),
        F.concat(F.lit("c"), (F.col("id") * 31 % levels).cast("string")).alias("c"),
        (g * 2.0 + F.col("id") % 5).alias("x"), (F.col("id") * 37 % 101 - g * 9.0).alias("y"))


@pytest.mark.parametrize("gaps", [False, True])
def test_eigenvalues_and_scores_equal_the_dense_path(spark, gaps):
    df = _mixed(spark, 1500, 6)
    if gaps:
        df = df.withColumn("a", F.when(F.col("id") % 11 != 0, F.col("a"))).withColumn("x", F.when(F.col("id") % 7 != 0, F.col("x")))
    num, cat = ["x", "y"], ["a", "b", "c"]
    dense, enc, _ = FA.famd(df, num, cat)
    wide = BU.famd_wide(df, num, cat, k=2, extra=8)
    assert wide.total_inertia == pytest.approx(dense.total_inertia)
    assert wide.eigenvalues == pytest.approx(dense.eigenvalues[:2], abs=1e-8)
    assert max(wide.residuals) <= 1e-5
    one = {r.id: r for r in FA.scores(dense, enc, ["id"], 1).collect()}
    two = {r.id: r for r in BU.wide_scores(df, wide, ["id"], 1).collect()}
    sign = 1 if one[1].dim1 * two[1].dim1 > 0 else -1
    assert all(abs(one[i].dim1 - sign * two[i].dim1) < 1e-4 for i in one)


def test_fifty_thousand_levels_with_gaps(spark):
    df = _mixed(spark, 100_000, 50_000).withColumn("c", F.when(F.col("id") % 10 != 0, F.col("c")))
    wide = BU.famd_wide(df, ["x"], ["a", "b", "c"], k=1, extra=3, max_rounds=4)
    assert wide.features > 45_000 and wide.eigenvalues[0] > 1 and wide.residuals[0] < 1
    assert wide.loadings.filter("variable = 'c'").count() == wide.features - 1 - sum(df.select(c).distinct().count() for c in "ab")


def test_cohorts_by_hand(spark):
    rows = [(1, 0), (1, 0), (1, 2), (2, 0), (3, 1), (3, 3), (None, 1), (4, None), (5, None), (5, 3)]
    df = spark.createDataFrame(rows, "u int, p int")
    got = K.cohort_retention(df, "u", F.col("p"))
    table = {(r.entry, r.elapsed): (r["size"], r.active) for r in got.collect()}
    assert table == {(0, 0): (2, 2), (0, 1): (2, 0), (0, 2): (2, 1), (0, 3): (2, 0), (1, 0): (2, 2), (1, 1): (2, 0), (1, 2): (2, 1),
                     (3, 0): (1, 1), (None, None): (1, 1)}
    cover = {r.period: (r.new, r.known, r.active, r.returned) for r in K.cohort_coverage(got).collect()}
    assert cover == {0: (2, 2, 2, 0), 1: (2, 4, 2, 0), 2: (0, 4, 1, 1), 3: (1, 5, 2, 1)}
    assert K.cohort_retention(df.limit(0), "u", F.col("p")).count() == 0


def test_rejected_values_and_conformed_ones_are_all_values(spark):
    df = spark.createDataFrame([("f", "1.5", "7"), ("f", "s/d", "99999999999"), ("g", "  ", "x"), (None, None, "8")], "file string, amount string, n string")
    casts = {"amount": "double", "n": "int", "absent": "int"}
    bad = {(r.file, r.column, r.raw, r.reason) for r in C.rejected_values(df, casts, ["file"]).collect()}
    assert bad == {("f", "amount", "s/d", "not_double"), ("g", "amount", "  ", "blank"), ("f", "n", "99999999999", "out_of_range"), ("g", "n", "x", "not_int")}
    done = C.conform(df, casts=casts).agg(F.count("amount").alias("a"), F.count("n").alias("n")).first()
    assert (done.a, done.n) == (1, 2)


def test_schema_inventory(spark):
    parts = {"p": spark.createDataFrame([("1", 2), ("x", None)], "k string, extra int"), "q": spark.createDataFrame([], "k long, was string")}
    got = {(r.file, r.column): (r.found, r.status, r.n_rows, r.n_null, r.n_rejected)
           for r in C.schema_inventory(parts, {"k": "bigint", "label": "string"}, {"was": "label"}).collect()}
    assert got == {("p", "k"): ("string", "type_differs", 2, 0, 1), ("p", "label"): (None, "missing", 2, 2, 0), ("p", "extra"): ("int", "undeclared", 2, 1, 0),
                   ("q", "k"): ("bigint", "ok", 0, 0, 0), ("q", "label"): ("string", "renamed", 0, 0, 0)}


def test_variable_codes(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("few"), "id", F.when(F.col("id") % 2 == 0, F.lit("v")).alias("half"))
    got = {r.variable: r for r in Q.variable_codes(df).collect()}
    assert got["few"].coding == "0=34; 1=33; 2=33" and got["id"].coding is None and got["id"].frequent == ""
    assert (got["half"].n_null, got["half"].coding, got["half"].frequent, got["id"].example_greatest) == (50, "v=50", "v", "99")


def test_block_with_two_headers_and_a_nameless_file(spark):
    rows = [("f", "s", r, c, v) for r, line in enumerate([["X", "1"], ["HEAD", "n"], ["X", "2"], ["HEAD", "n"], ["Y", "3"], ["X", None]]) for c, v in enumerate(line, 1)]
    rows += [("f", "t", 9, 1, "X"), (None, "s", 1, 2, "HEAD"), (None, "s", 2, 1, "X")]
    got = C.extract_block(spark.createDataFrame(rows, "file string, sheet string, row int, col int, value string"), "^HEAD$", 1, "X", 2)
    assert sorted(map(tuple, got.collect()), key=str) == [("f", "s", 2, "X", "2"), ("f", "s", 5, "X", None), (None, "s", 2, "X", None)]


def test_states_of_two_loads_equal_one_and_stay_within_their_bound(spark):
    v = F.when(F.col("id") % 9 != 0, (F.col("id") * 7919 % 1009 - 300) / 7.0)
    df = spark.range(3000).select((F.col("id") % 3).cast("string").alias("g"), v.alias("v"))
    df = df.unionByName(spark.createDataFrame([(None, None), ("z", 0.0)], "g string, v double"))
    probs = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    cut = F.col("v") < 20
    two = value_states(df.filter(cut), ["g"], "v").unionByName(value_states(df.filter(~F.coalesce(cut, F.lit(False))), ["g"], "v"))
    got = {r.g: r for r in summarise(two, ["g"], probs).collect()}
    one = {r.g: r for r in summarise(value_states(df, ["g"], "v"), ["g"], probs).collect()}
    pdf = df.toPandas()
    for g, own in pdf.groupby("g")["v"]:
        x, r = own.dropna(), got[g]
        assert (r.rows, r.n, r.min, r.max) == (len(own), len(x), x.min(), x.max())
        assert r["mean"] == pytest.approx(x.mean()) and (len(x) < 2 or r.sd == pytest.approx(x.std()))
        for name, p in probs.items():
            exact = x.quantile(p, interpolation="lower")
            assert abs(r[name] - exact) <= ACCURACY * abs(exact) + 1e-12 and r[name] == one[g][name]
    assert (got[None].rows, got[None].n, got[None]["mean"], got[None]["median"]) == (1, 0, None, None)


@pytest.mark.parametrize("narrow", [14, 0])
def test_wide_variables_equal_the_dense_path(spark, narrow):
    """One wide variable, and three: levels in the table of rounds, pairs of them joined."""
    df = _mixed(spark, 900, 6).withColumn("a", F.when(F.col("id") % 11 != 0, F.col("a"))).withColumn("x", F.when(F.col("id") % 7 != 0, F.col("x")))
    num, cat = ["x", "y"], ["a", "b", "c"]
    dense, _, _ = FA.famd(df, num, cat)
    wide = BU.famd_wide(df, num, cat, k=1, extra=8, max_rounds=8, narrow=narrow)
    assert wide.total_inertia == pytest.approx(dense.total_inertia) and wide.residuals[0] < 1e-2
    assert wide.eigenvalues[0] == pytest.approx(dense.eigenvalues[0], abs=1e-4)
    assert {(r.variable, r.level) for r in wide.loadings.collect()} == {(c, r[0]) for c in cat for r in df.select(c).na.drop().distinct().collect()} | {("x", None), ("y", None)}


def test_rows_are_counted_without_one_row_a_pair(spark):
    """Thirteen variables: fewer rows leave the scan than come in (before: 91 times as many)."""
    cat = [f"a{i}" for i in range(8)]
    df = spark.range(4000).select(*[(F.col("id") * (2 * i + 3) % 7).alias(c) for i, c in enumerate(cat)], *[(F.col("id") * (i + 2) % 11).alias(f"x{i}") for i in range(5)])
    num = [f"x{i}" for i in range(5)]
    moments = {c: (5.0, 3.0) for c in num}
    places = {i: [str(v) for v in range(7)] for i in range(8)}
    with BU._Rounds(spark) as tables:
        m, levels = BU._feature_rows(BU._coded(df.coalesce(1), num, cat, moments, places, []), [7] * 8, 5, [], tables)
        assert levels is None and spark.read.parquet(tables.paths[0]).count() <= 61
    assert m[:7, :7].sum() == 4000 and m[0, 7] == df.filter("a0 = 0 AND a1 = 0").count()
    assert m[0, 56] == pytest.approx(df.filter("a0 = 0").agg(F.sum((F.col("x0") - 5.0) / 3.0)).first()[0])


def test_a_level_cut_into_chunks_and_partitions_is_whole(spark, monkeypatch):
    monkeypatch.setattr(BU, "CHUNK_ROWS", 50)  # of tasks too: the function is sent with its module's values
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 400).cast("string")).alias("l0"),
                                  (F.col("id") % 4).cast("string").alias("l1"))
    coded = BU._coded(df, [], ["l0", "l1"], {}, {1: ["0", "1", "2", "3"]}, [0])
    with BU._Rounds(spark) as tables:
        m, levels = BU._feature_rows(coded, [4], 1, [0], tables)
        got = {(r.l, r.at): r.m for r in levels.select("l", F.explode(F.arrays_zip("at", "m")).alias("c")).groupBy("l", "c.at").agg(F.sum("c.m").alias("m")).collect()}
    want = {(r.l0, int(r.l1)): float(r["count"]) for r in df.groupBy("l0", "l1").count().collect()}
    want |= {(r.l0, 4): float(r["count"]) for r in df.groupBy("l0").count().collect()}
    assert got == want and m[4, 4] == 3000
