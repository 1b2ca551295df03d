"""PCA / FAMD analyses (#70-76). Component directions are not hash-stable
(sign, near-equal eigenvalues), so only moments and invariants get a SQL
oracle; the rest are rows-only."""

from __future__ import annotations

from pyspark.sql import functions as F

from aulaframe.operators import burt as BU
from aulaframe.operators import factor as FA
from aulaframe.plans.registry import register
from aulaframe.plans.views import MODULES, SCORE_FACT_SQL, score_fact

NUM = MODULES
CAT = ["segment", "stratum", "returnflag"]
KEYS = ["l_orderkey", "l_linenumber"]
TARGET = 0.28  # share of inertia the reference reports reaching


def _famd(spark, sf_dir):
    sf = score_fact(spark, sf_dir).select(*KEYS, *NUM, *CAT)
    return FA.famd(sf, NUM, CAT)


@register("pca_explained")
def pca_explained(spark, sf_dir):
    return FA.explained_table(FA.pca(score_fact(spark, sf_dir).select(*NUM), NUM))


def _moments_sql() -> str:
    parts = []
    for c in NUM:
        parts.append(f"""SELECT '{c}' AS variable, CAST(NULL AS VARCHAR) AS level,
  avg(coalesce((s.{c} - t.m) / t.sd, 0)) AS mean, var_pop(coalesce((s.{c} - t.m) / t.sd, 0)) AS var_pop
FROM score_fact s, (SELECT avg({c}) AS m, stddev_pop({c}) AS sd FROM score_fact) t""")
    for c in CAT:
        parts.append(f"""SELECT '{c}' AS variable, lv.level,
  avg(CASE WHEN s.{c} IS NULL THEN 0 WHEN s.{c} = lv.level THEN (1 - lv.p) / sqrt(lv.p) ELSE -sqrt(lv.p) END) AS mean,
  var_pop(CASE WHEN s.{c} IS NULL THEN 0 WHEN s.{c} = lv.level THEN (1 - lv.p) / sqrt(lv.p) ELSE -sqrt(lv.p) END) AS var_pop
FROM score_fact s, (SELECT {c} AS level, count(*) / (SELECT count({c}) FROM score_fact) AS p
                    FROM score_fact WHERE {c} IS NOT NULL GROUP BY 1) lv
GROUP BY lv.level""")
    return "\nUNION ALL ".join(parts)


@register("famd_encode_moments", floats=("mean", "var_pop"), ctes=(SCORE_FACT_SQL,), sql=_moments_sql())
def famd_encode_moments(spark, sf_dir):
    sf = score_fact(spark, sf_dir).select(*NUM, *CAT)
    enc, cols = FA.famd_encode(sf, NUM, CAT)
    one = enc.agg(*[F.avg(c).alias(f"m__{c}") for c in cols], *[F.var_pop(c).alias(f"v__{c}") for c in cols])
    # encoded name -> (variable, level)
    labels = {f"z_{c}": (c, None) for c in NUM}
    from aulaframe.operators.contingency import levels
    for c in CAT:
        for i, v in enumerate(levels(sf, c)):
            labels[f"i_{c}_{i}"] = (c, v)

    def lit(s):
        return "CAST(NULL AS STRING)" if s is None else "'" + str(s).replace("'", "''") + "'"

    stack = ", ".join(f"{lit(labels[c][0])}, {lit(labels[c][1])}, `m__{c}`, `v__{c}`" for c in cols)
    return one.selectExpr(f"stack({len(cols)}, {stack}) AS (variable, level, mean, var_pop)")


_INERTIA = " + ".join([f"count({c}) / count(*)" for c in NUM] + [f"(count(DISTINCT {c}) - 1) * count({c}) / count(*)" for c in CAT])


@register("famd_inertia", floats=("total_inertia", "eigen_sum"), ctes=(SCORE_FACT_SQL,), sql=f"""
SELECT CAST({_INERTIA} AS DOUBLE) AS total_inertia, CAST({_INERTIA} AS DOUBLE) AS eigen_sum,
       CAST({len(NUM)} + """ + " + ".join(f"count(DISTINCT {c})" for c in CAT) + """ AS BIGINT) AS encoded_columns
FROM score_fact""")
def famd_inertia(spark, sf_dir):
    """Invariant: total inertia = #numeric + sum(levels - 1), each times the
    share of rows that have the value, = sum of all eigenvalues."""
    model, _, cols = _famd(spark, sf_dir)
    return spark.createDataFrame([(model.total_inertia, float(sum(model.eigenvalues)), len(cols))],
                                 "total_inertia double, eigen_sum double, encoded_columns bigint")


_ENCODED = " UNION ALL ".join(
    [f"SELECT i, '{c}' AS f, ({c} - avg({c}) OVER ()) / nullif(stddev_pop({c}) OVER (), 0) AS x FROM r" for c in NUM]
    + [f"""SELECT r.i, '{c}:' || lv.level, CASE WHEN r.{c} IS NULL THEN 0 WHEN r.{c} = lv.level THEN (1 - lv.p) / sqrt(lv.p) ELSE -sqrt(lv.p) END
FROM r, (SELECT {c} AS level, count(*) / (SELECT count({c}) FROM r) AS p FROM r WHERE {c} IS NOT NULL GROUP BY 1) lv""" for c in CAT])


def _spectrum_sql(encoded: str) -> str:
    return f"""
WITH r AS (SELECT row_number() OVER () AS i, * FROM score_fact), x AS (SELECT i, f, coalesce(x, 0) AS x FROM ({encoded})),
g AS (SELECT a.f AS fa, b.f AS fb, sum(a.x * b.x) / (SELECT count(*) FROM r) AS g FROM x a JOIN x b ON a.i = b.i GROUP BY 1, 2)
SELECT sum(g) FILTER (WHERE fa = fb) AS eigen_sum, sum(g * g) AS eigen_square_sum FROM g"""


def _spectrum(spark, model):
    """Sum of the eigenvalues (the trace of the covariance) and of their squares
    (the sum of its squared entries)."""
    e = model.eigenvalues
    return spark.createDataFrame([(float(sum(e)), float(sum(x * x for x in e)))], "eigen_sum double, eigen_square_sum double")


@register("pca_spectrum", floats=("eigen_sum", "eigen_square_sum"), ctes=(SCORE_FACT_SQL,), sql=_spectrum_sql(" UNION ALL ".join(_ENCODED.split(" UNION ALL ")[:len(NUM)])))
def pca_spectrum(spark, sf_dir):
    return _spectrum(spark, FA.pca(score_fact(spark, sf_dir).select(*NUM), NUM))


@register("famd_spectrum", floats=("eigen_sum", "eigen_square_sum"), ctes=(SCORE_FACT_SQL,), sql=_spectrum_sql(_ENCODED))
def famd_spectrum(spark, sf_dir):
    return _spectrum(spark, _famd(spark, sf_dir)[0])


# variables of many levels: institutions, programme cores and territories
WIDE_CAT = ["institution", "core", "character", "department", "region", *CAT]


@register("famd_wide_explained")
def famd_wide_explained(spark, sf_dir):
    """No oracle: eigenvalues of a matrix of several hundred levels. Tests
    compare it with the dense path; ``residual`` bounds its error."""
    model = BU.famd_wide(score_fact(spark, sf_dir).select(*NUM, *WIDE_CAT), NUM, WIDE_CAT, k=2, tol=1e-4, max_rounds=40)
    return BU.wide_explained(model, spark)


@register("famd_explained")
def famd_explained(spark, sf_dir):
    model, _, _ = _famd(spark, sf_dir)
    return FA.explained_table(model)


@register("famd_cumulative")
def famd_cumulative(spark, sf_dir):
    model, _, _ = _famd(spark, sf_dir)
    return FA.explained_table(model, target=TARGET).select("dimension", "cumulative", "dims_for_target")


@register("famd_scores")
def famd_scores(spark, sf_dir):
    model, enc, _ = _famd(spark, sf_dir)
    return FA.scores(model, enc, KEYS)


@register("famd_far_points")
def famd_far_points(spark, sf_dir):
    model, enc, _ = _famd(spark, sf_dir)
    return FA.far_points(FA.scores(model, enc, KEYS), model, KEYS)


@register("famd_variable_links")
def famd_variable_links(spark, sf_dir):
    model, enc, _ = _famd(spark, sf_dir)
    sc = FA.scores(model, enc, KEYS + NUM + CAT)
    return FA.variable_links(sc, NUM, CAT)
