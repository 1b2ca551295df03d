"""Bivariate analyses (#46-63) bound to the score views."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from aulaframe.functions.columns import level_of
from aulaframe.operators import bivariate as B
from aulaframe.operators import univariate as U
from aulaframe.plans.bind_univariate import BOX_COLS, box_sql
from aulaframe.plans.registry import grid, register
from aulaframe.plans.views import MODULES, SCORE_FACT_SQL, SCORE_LONG_SQL, score_fact, score_long

SF = (SCORE_FACT_SQL,)
SL = (SCORE_FACT_SQL, SCORE_LONG_SQL)


def _corr_sql() -> str:
    parts = []
    for a, b in combinations(MODULES, 2):
        parts.append(f"SELECT '{a}' AS var_a, '{b}' AS var_b, corr({a}, {b}) AS r FROM score_fact")
        parts.append(f"SELECT '{b}' AS var_a, '{a}' AS var_b, corr({a}, {b}) AS r FROM score_fact")
    for m in MODULES:
        parts.append(f"SELECT '{m}' AS var_a, '{m}' AS var_b, CAST(1.0 AS DOUBLE) AS r")
    return "corr_m AS (\n" + "\nUNION ALL ".join(parts) + "\n)"


CORR_SQL = _corr_sql()


def _corr(spark, sf_dir):
    return B.corr_matrix(score_fact(spark, sf_dir), MODULES)


@register("corr_matrix", floats=("r",), ctes=SF + (CORR_SQL,), sql="SELECT * FROM corr_m")
def corr_matrix(spark, sf_dir):
    return _corr(spark, sf_dir)


@register("corr_rank", floats=("r", "r2"), ctes=SF + (CORR_SQL,), sql="""
SELECT var_a, var_b, r, r * r AS r2,
       CAST(rank() OVER (ORDER BY abs(r) DESC, var_a, var_b) AS BIGINT) AS pair_rank
FROM corr_m WHERE var_a < var_b""")
def corr_rank(spark, sf_dir):
    return B.corr_rank(_corr(spark, sf_dir))


@register("corr_pivot", floats=("mean_abs_r",), ctes=SF + (CORR_SQL,), sql="""
SELECT var_a, mean_abs_r, CAST(rank() OVER (ORDER BY mean_abs_r DESC, var_a) AS BIGINT) AS pivot_rank
FROM (SELECT var_a, avg(abs(r)) AS mean_abs_r FROM corr_m WHERE var_a <> var_b GROUP BY var_a) t""")
def corr_pivot(spark, sf_dir):
    return B.corr_pivot(_corr(spark, sf_dir))


def _gstats_sql(keys: str, median: bool = True, where: str = "") -> str:
    med = ", quantile_cont(score, 0.5) AS median" if median else ""
    return f"""
SELECT {keys}, module, count(score) AS n, avg(score) AS mean, stddev_samp(score) AS sd,
       var_samp(score) AS var{med}
FROM score_long {where} GROUP BY {keys}, module"""


@register("group_stats_nominal", floats=("mean", "sd", "var") + grid("median"), ctes=SL, sql=_gstats_sql("sex"))
def group_stats_nominal(spark, sf_dir):
    return B.group_stats(score_long(spark, sf_dir), "sex")


@register("group_stats_ordinal", floats=("mean", "sd", "var") + grid("median"), ctes=SL,
          sql=_gstats_sql("stratum, stratum_rank"))
def group_stats_ordinal(spark, sf_dir):
    return B.group_stats(score_long(spark, sf_dir), ["stratum", "stratum_rank"])


@register("box_by_group", floats=BOX_COLS, ctes=SL, sql=box_sql("character, module"))
def box_by_group(spark, sf_dir):
    return U.box_stats(score_long(spark, sf_dir), "character")


@register("two_group_gap", floats=("mean_a", "mean_b", "mean_gap") + grid("median_a", "median_b", "median_gap"),
          ctes=SL, sql="""
SELECT module, count(CASE WHEN sex = 'F' THEN score END) AS n_a, count(CASE WHEN sex = 'O' THEN score END) AS n_b,
       avg(CASE WHEN sex = 'F' THEN score END) AS mean_a, avg(CASE WHEN sex = 'O' THEN score END) AS mean_b,
       quantile_cont(CASE WHEN sex = 'F' THEN score END, 0.5) AS median_a,
       quantile_cont(CASE WHEN sex = 'O' THEN score END, 0.5) AS median_b,
       avg(CASE WHEN sex = 'F' THEN score END) - avg(CASE WHEN sex = 'O' THEN score END) AS mean_gap,
       quantile_cont(CASE WHEN sex = 'F' THEN score END, 0.5) - quantile_cont(CASE WHEN sex = 'O' THEN score END, 0.5) AS median_gap
FROM score_long GROUP BY module""")
def two_group_gap(spark, sf_dir):
    return B.group_gap(score_long(spark, sf_dir), "sex", "F", "O")


def _label_sql(x: str, cuts) -> str:
    labs = B.EFFECT_LABELS
    w = " ".join(f"WHEN {x} < {c} THEN '{lab}'" for c, lab in zip(cuts, labs))
    return f"CASE WHEN {x} IS NULL THEN NULL {w} ELSE '{labs[len(cuts)]}' END"


@register("effect_size_two", floats=("mean_a", "mean_b", "pooled_sd", "d"), ctes=SL, sql=f"""
SELECT module, n_a, n_b, mean_a, mean_b, pooled_sd, d, {_label_sql('abs(d)', B.D_CUTS)} AS magnitude
FROM (
  SELECT *, (mean_a - mean_b) / nullif(pooled_sd, 0) AS d FROM (
    SELECT module, n_a, n_b, mean_a, mean_b,
           sqrt(((n_a - 1) * var_a + (n_b - 1) * var_b) / nullif(n_a + n_b - 2, 0)) AS pooled_sd
    FROM (SELECT module,
            count(CASE WHEN sex = 'F' THEN score END) AS n_a, count(CASE WHEN sex = 'O' THEN score END) AS n_b,
            avg(CASE WHEN sex = 'F' THEN score END) AS mean_a, avg(CASE WHEN sex = 'O' THEN score END) AS mean_b,
            var_samp(CASE WHEN sex = 'F' THEN score END) AS var_a, var_samp(CASE WHEN sex = 'O' THEN score END) AS var_b
          FROM score_long GROUP BY module) s) p) q""")
def effect_size_two(spark, sf_dir):
    return B.effect_size_two(score_long(spark, sf_dir), "sex", "F", "O")


@register("effect_size_eta2", floats=("ssb", "sst", "eta2"), ctes=SL, sql=f"""
SELECT module, groups, n, ssb, sst, ssb / nullif(sst, 0) AS eta2, {_label_sql('ssb / nullif(sst, 0)', B.ETA2_CUTS)} AS magnitude
FROM (
  SELECT g.module, count(*) AS groups, CAST(sum(g.n) AS BIGINT) AS n,
         sum(g.n * (g.m - t.grand) * (g.m - t.grand)) AS ssb, any_value(t.sst) AS sst
  FROM (SELECT module, stratum, count(score) AS n, avg(score) AS m FROM score_long
        WHERE stratum IS NOT NULL GROUP BY module, stratum) g
  JOIN (SELECT module, avg(score) AS grand, var_pop(score) * count(score) AS sst FROM score_long
        WHERE stratum IS NOT NULL GROUP BY module) t USING (module)
  GROUP BY g.module) s""")
def effect_size_eta2(spark, sf_dir):
    return B.effect_size_eta2(score_long(spark, sf_dir), "stratum")


def _ov_sql(q1a, q3a, q1b, q3b):
    inter = f"greatest(0.0, least({q3a}, {q3b}) - greatest({q1a}, {q1b}))"
    union = f"(greatest({q3a}, {q3b}) - least({q1a}, {q1b}))"
    return (f"CASE WHEN {q1a} IS NULL OR {q3a} IS NULL OR {q1b} IS NULL OR {q3b} IS NULL THEN NULL "
            f"WHEN {union} = 0 THEN 1.0 ELSE {inter} / {union} END")


@register("iqr_overlap", floats=("overlap_prev", "overlap_all") + grid("q1", "q3"), ctes=SL, sql=f"""
SELECT module, stratum, prev_group, {_ov_sql('pq1', 'pq3', 'q1', 'q3')} AS overlap_prev, q1, q3,
       {_ov_sql('q1', 'q3', 'p_q1', 'p_q3')} AS overlap_all
FROM (
  SELECT b.module, b.stratum, b.q1, b.q3, p.p_q1, p.p_q3,
         lag(b.stratum) OVER w AS prev_group, lag(b.q1) OVER w AS pq1, lag(b.q3) OVER w AS pq3
  FROM (SELECT module, stratum, stratum_rank, quantile_cont(score, 0.25) AS q1, quantile_cont(score, 0.75) AS q3
        FROM score_long GROUP BY module, stratum, stratum_rank) b
  LEFT JOIN (SELECT module, quantile_cont(score, 0.25) AS p_q1, quantile_cont(score, 0.75) AS p_q3
             FROM score_long GROUP BY module) p USING (module)
  WINDOW w AS (PARTITION BY b.module ORDER BY b.stratum_rank, b.stratum)) t""")
def iqr_overlap(spark, sf_dir):
    long = score_long(spark, sf_dir)
    q = U.quartile_table(long, ["stratum", "stratum_rank"])
    return B.iqr_overlap(q, "stratum", order="stratum_rank", pooled=U.quartile_table(long))


GRADIENT_SQL = """
grad AS (
  SELECT module, stratum, stratum_rank, n, mean, step, extreme_gap,
         bool_and(coalesce(step >= 0, true)) OVER (PARTITION BY module) AS monotonic
  FROM (
    SELECT module, stratum, stratum_rank, n, mean,
      mean - lag(mean) OVER (PARTITION BY module ORDER BY stratum_rank) AS step,
      last_value(mean) OVER (PARTITION BY module ORDER BY stratum_rank ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
      - first_value(mean) OVER (PARTITION BY module ORDER BY stratum_rank ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS extreme_gap
    FROM (SELECT module, stratum, stratum_rank, count(score) AS n, avg(score) AS mean
          FROM score_long WHERE stratum_rank IS NOT NULL GROUP BY module, stratum, stratum_rank) s) t
)"""


def _gradient(spark, sf_dir):
    st = B.group_stats(score_long(spark, sf_dir), ["stratum", "stratum_rank"], median=False)
    return B.gradient(st, "stratum", "stratum_rank")


@register("ordinal_gradient", floats=("mean", "step", "extreme_gap"), ctes=SL + (GRADIENT_SQL,),
          sql="SELECT * FROM grad")
def ordinal_gradient(spark, sf_dir):
    return _gradient(spark, sf_dir)


@register("largest_gap_module", floats=("extreme_gap",), ctes=SL + (GRADIENT_SQL,), sql="""
SELECT (SELECT module FROM grad ORDER BY extreme_gap DESC, module LIMIT 1) AS module,
       max(extreme_gap) AS extreme_gap FROM grad""")
def largest_gap_module(spark, sf_dir):
    return B.largest_gap(_gradient(spark, sf_dir))


SMALL_N = 100  # fixture cells (department x brand) hold 44-160 rows


@register("small_n_flag", floats=("mean", "sd", "var"), ctes=SL, sql=f"""
SELECT *, n < {SMALL_N} AS small FROM ({_gstats_sql('department, core', median=False)}) s""")
def small_n_flag(spark, sf_dir):
    st = B.group_stats(score_long(spark, sf_dir), ["department", "core"], median=False)
    return B.flag_small(st, SMALL_N)


@register("group_mean_range", floats=("min_mean", "max_mean", "min_mean_reliable", "max_mean_reliable"),
          ctes=SL, sql=f"""
SELECT module,
  min(mean) AS min_mean, (array_agg(cell ORDER BY mean, cell))[1] AS min_group,
  max(mean) AS max_mean, (array_agg(cell ORDER BY mean DESC, cell))[1] AS max_group,
  min(mean) FILTER (WHERE NOT small) AS min_mean_reliable,
  (array_agg(cell ORDER BY mean, cell) FILTER (WHERE NOT small))[1] AS min_group_reliable,
  max(mean) FILTER (WHERE NOT small) AS max_mean_reliable,
  (array_agg(cell ORDER BY mean DESC, cell) FILTER (WHERE NOT small))[1] AS max_group_reliable
FROM (SELECT module, cell, avg(score) AS mean, count(score) < {SMALL_N} AS small
      FROM (SELECT department || '/' || core AS cell, module, score FROM score_long) x
      GROUP BY module, cell) s
GROUP BY module""")
def group_mean_range(spark, sf_dir):
    long = score_long(spark, sf_dir).withColumn("cell", F.concat("department", F.lit("/"), "core"))
    st = B.flag_small(B.group_stats(long, "cell", median=False), SMALL_N)
    return B.mean_range(st, "cell")


@register("rank_groups", floats=("mean",), ctes=SL, sql="""
SELECT module, department, count(score) AS n, avg(score) AS mean,
       CAST(rank() OVER (PARTITION BY module ORDER BY avg(score) DESC) AS BIGINT) AS rank
FROM score_long GROUP BY module, department""")
def rank_groups(spark, sf_dir):
    st = B.group_stats(score_long(spark, sf_dir), "department", median=False)
    return B.rank_groups(st, "department")


@register("area_profile", floats=("mean", "sd", "diff"), ctes=SL, sql="""
SELECT module, core, n, mean, sd, diff,
  CAST(rank() OVER (PARTITION BY module ORDER BY diff DESC) AS BIGINT) AS rank_high,
  CAST(rank() OVER (PARTITION BY module ORDER BY diff ASC) AS BIGINT) AS rank_low,
  CAST(rank() OVER (PARTITION BY module ORDER BY sd DESC) AS BIGINT) AS rank_sd
FROM (SELECT module, core, count(score) AS n, avg(score) AS mean, stddev_samp(score) AS sd,
             avg(score) - sum(sum(score)) OVER (PARTITION BY module) / sum(count(score)) OVER (PARTITION BY module) AS diff
      FROM score_long GROUP BY module, core) g""")
def area_profile(spark, sf_dir):
    return B.area_profile(score_long(spark, sf_dir), "core")


@register("box_by_year", floats=BOX_COLS + grid("median_drift"), ctes=SL, sql=f"""
SELECT *, median - lag(median) OVER (PARTITION BY module ORDER BY year) AS median_drift
FROM ({box_sql('year, module')}) b""")
def box_by_year(spark, sf_dir):
    return B.box_drift(U.box_stats(score_long(spark, sf_dir), "year"), "year")


PEAKS_SQL = """
peaks AS (
  SELECT module, period, n, median,
    coalesce(median > lag(median) OVER w AND median > lead(median) OVER w, false) AS peak,
    coalesce(median < lag(median) OVER w AND median < lead(median) OVER w, false) AS valley
  FROM (SELECT module, period, count(score) AS n, quantile_cont(score, 0.5) AS median
        FROM score_long GROUP BY module, period) m
  WINDOW w AS (PARTITION BY module ORDER BY period)
)"""


@register("period_peaks", floats=grid("median"), ctes=SL + (PEAKS_SQL,), sql="SELECT * FROM peaks")
def period_peaks(spark, sf_dir):
    return B.period_peaks(score_long(spark, sf_dir), "period")


@register("peaks_small_n", floats=grid("median", "n_threshold"), ctes=SL + (PEAKS_SQL,), sql="""
SELECT p.module, p.period, p.n, p.median, p.peak, p.valley, t.n_threshold, p.n < t.n_threshold AS small_n
FROM peaks p JOIN (SELECT module, quantile_cont(n, 0.25) AS n_threshold FROM peaks GROUP BY module) t
  USING (module)
WHERE p.peak OR p.valley""")
def peaks_small_n(spark, sf_dir):
    return B.peaks_with_n(B.period_peaks(score_long(spark, sf_dir), "period"))


@register("percentile_national", floats=("pct_rank",), ctes=SF, sql="""
SELECT l_orderkey, l_linenumber, module2, percent_rank() OVER (ORDER BY module2) AS pct_rank
FROM score_fact""")
def percentile_national(spark, sf_dir):
    base = score_fact(spark, sf_dir).select("l_orderkey", "l_linenumber", "module2")
    return B.percentile_in(base, "module2")


@register("percentile_core", floats=("pct_rank",), ctes=SF, sql="""
SELECT core, l_orderkey, l_linenumber, module2,
       percent_rank() OVER (PARTITION BY core ORDER BY module2) AS pct_rank
FROM score_fact""")
def percentile_core(spark, sf_dir):
    base = score_fact(spark, sf_dir).select("core", "l_orderkey", "l_linenumber", "module2")
    return B.percentile_in(base, "module2", by="core")


# Cut points of the performance levels are not published: parameters here.
LEVEL_CUTS = (10.0, 25.0, 40.0)
LEVEL_LABELS = ("I", "II", "III", "IV")


@register("performance_level", ctes=SF, sql="""
SELECT year, level, count(*) AS n FROM (
  SELECT year, CASE WHEN module1 IS NULL THEN NULL WHEN module1 < 10.0 THEN 'I' WHEN module1 < 25.0 THEN 'II'
                    WHEN module1 < 40.0 THEN 'III' ELSE 'IV' END AS level
  FROM score_fact) t GROUP BY year, level""")
def performance_level(spark, sf_dir):
    sf = score_fact(spark, sf_dir)
    return (sf.select("year", level_of("module1", LEVEL_CUTS, LEVEL_LABELS).alias("level"))
            .groupBy("year", "level").agg(F.count(F.lit(1)).alias("n")))
