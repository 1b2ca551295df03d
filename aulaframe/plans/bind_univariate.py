"""Univariate analyses (#35-45) bound to the score views."""

from __future__ import annotations

from aulaframe.operators import univariate as U
from aulaframe.plans.registry import grid, register
from aulaframe.plans.views import SCORE_FACT_SQL, SCORE_LONG_SQL, score_fact, score_long

SF = (SCORE_FACT_SQL,)
SL = (SCORE_FACT_SQL, SCORE_LONG_SQL)

DESCRIBE_SQL = """
desc_m AS (
  SELECT module, count(score) AS n, avg(score) AS mean, stddev_samp(score) AS sd,
         min(score) AS min, quantile_cont(score, 0.25) AS q1, quantile_cont(score, 0.5) AS median,
         quantile_cont(score, 0.75) AS q3, max(score) AS max
  FROM score_long GROUP BY module
)"""


@register("freq_share", floats=("share",), ctes=SF, sql="""
SELECT ethnicity, count(*) AS n, count(*) / sum(count(*)) OVER () AS share
FROM score_fact GROUP BY ethnicity""")
def freq_share(spark, sf_dir):
    return U.freq_table(score_fact(spark, sf_dir), "ethnicity")


@register("topk_institutions", ctes=SF, sql="""
SELECT institution, count(*) AS n,
       CAST(row_number() OVER (ORDER BY count(*) DESC, institution) AS BIGINT) AS rank
FROM score_fact WHERE institution IS NOT NULL AND trim(institution) <> ''
GROUP BY institution ORDER BY n DESC, institution LIMIT 10""")
def topk_institutions(spark, sf_dir):
    return U.top_k(score_fact(spark, sf_dir), "institution", 10)


@register("topk_departments", ctes=SF, sql="""
SELECT department, count(*) AS n,
       CAST(row_number() OVER (ORDER BY count(*) DESC, department) AS BIGINT) AS rank
FROM score_fact WHERE department IS NOT NULL AND trim(department) <> ''
GROUP BY department ORDER BY n DESC, department LIMIT 5""")
def topk_departments(spark, sf_dir):
    return U.top_k(score_fact(spark, sf_dir), "department", 5)


@register("concentration_departments", floats=("share", "cum_share"), ctes=SF, sql="""
SELECT department, count(*) AS n,
       CAST(row_number() OVER (ORDER BY count(*) DESC, department) AS BIGINT) AS rank,
       count(*) / sum(count(*)) OVER () AS share,
       sum(count(*)) OVER (ORDER BY count(*) DESC, department ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
         / sum(count(*)) OVER () AS cum_share
FROM score_fact WHERE department IS NOT NULL GROUP BY department""")
def concentration_departments(spark, sf_dir):
    return U.concentration(score_fact(spark, sf_dir), "department")


@register("describe_modules", floats=("mean", "sd") + grid("min", "q1", "median", "q3", "max"),
          ctes=SL + (DESCRIBE_SQL,), sql="SELECT * FROM desc_m")
def describe_modules(spark, sf_dir):
    return U.describe(score_long(spark, sf_dir))


@register("spread_rank", floats=("mean", "sd", "cv") + grid("iqr", "range"), ctes=SL + (DESCRIBE_SQL,), sql="""
SELECT module, mean, sd, q3 - q1 AS iqr, max - min AS range, sd / nullif(mean, 0) AS cv,
  CAST(rank() OVER (ORDER BY q3 - q1 DESC, module) AS BIGINT) AS rank_iqr,
  CAST(rank() OVER (ORDER BY sd DESC, module) AS BIGINT) AS rank_sd,
  CAST(rank() OVER (ORDER BY max - min DESC, module) AS BIGINT) AS rank_range,
  CAST(rank() OVER (ORDER BY sd / nullif(mean, 0) DESC NULLS LAST, module) AS BIGINT) AS rank_cv,
  CAST(rank() OVER (ORDER BY mean DESC, module) AS BIGINT) AS rank_mean
FROM desc_m""")
def spread_rank(spark, sf_dir):
    return U.spread_rank(U.describe(score_long(spark, sf_dir)))


@register("module_gap", floats=("best_mean", "worst_mean", "gap"), ctes=SL + (DESCRIBE_SQL,), sql="""
SELECT (SELECT module FROM desc_m ORDER BY mean DESC, module LIMIT 1) AS best,
       (SELECT module FROM desc_m ORDER BY mean ASC, module LIMIT 1) AS worst,
       max(mean) AS best_mean, min(mean) AS worst_mean, max(mean) - min(mean) AS gap
FROM desc_m""")
def module_gap(spark, sf_dir):
    return U.module_gap(U.describe(score_long(spark, sf_dir), quartiles=False))


@register("histogram", floats=grid("lo", "hi"), ctes=SF, sql="""
SELECT g.bucket,
       CASE WHEN g.bucket BETWEEN 1 AND 10 THEN 0.0 + (g.bucket - 1) * 5.0 END AS lo,
       CASE WHEN g.bucket BETWEEN 1 AND 10 THEN 0.0 + g.bucket * 5.0 END AS hi,
       coalesce(c.n, 0) AS n
FROM (SELECT range AS bucket FROM range(0, 12)) g
LEFT JOIN (
  SELECT CASE WHEN module1 < 0.0 THEN 0 WHEN module1 = 50.0 THEN 10 WHEN module1 > 50.0 THEN 11
              ELSE CAST(floor(10 * (module1 - 0.0) / 50.0) AS BIGINT) + 1 END AS bucket,
         count(*) AS n
  FROM score_fact WHERE module1 IS NOT NULL GROUP BY 1) c ON g.bucket = c.bucket
WHERE g.bucket BETWEEN 1 AND 10 OR c.n > 0""")
def histogram(spark, sf_dir):
    return U.histogram(score_fact(spark, sf_dir), "module1", 0.0, 50.0, 10)


BOX_COLS = grid("q1", "median", "q3", "iqr", "lo_fence", "hi_fence", "whisker_lo", "whisker_hi", "min", "max")


def box_sql(keys: str) -> str:
    """Oracle text of box statistics grouped by ``keys`` (comma list); a NULL
    key is a group."""
    own = ", ".join(f"s.{k.strip()}" for k in keys.split(","))
    same = " AND ".join(f"s.{k.strip()} IS NOT DISTINCT FROM f.{k.strip()}" for k in keys.split(","))
    return f"""
SELECT {own}, f.q1, f.median, f.q3, f.iqr, f.lo_fence, f.hi_fence, count(s.score) AS n,
       min(CASE WHEN s.score >= f.lo_fence THEN s.score END) AS whisker_lo,
       max(CASE WHEN s.score <= f.hi_fence THEN s.score END) AS whisker_hi,
       CAST(count_if(s.score < f.lo_fence) AS BIGINT) AS n_out_lo, CAST(count_if(s.score > f.hi_fence) AS BIGINT) AS n_out_hi,
       min(s.score) AS min, max(s.score) AS max
FROM score_long s JOIN (
  SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo_fence, q3 + 1.5 * (q3 - q1) AS hi_fence
  FROM (SELECT {keys}, quantile_cont(score, 0.25) AS q1, quantile_cont(score, 0.5) AS median,
               quantile_cont(score, 0.75) AS q3 FROM score_long GROUP BY {keys}) q0
) f ON {same}
GROUP BY {own}, f.q1, f.median, f.q3, f.iqr, f.lo_fence, f.hi_fence"""


@register("box_stats", floats=BOX_COLS, ctes=SL, sql=box_sql("module"))
def box_stats(spark, sf_dir):
    return U.box_stats(score_long(spark, sf_dir))


TREND_SQL = """
trend_y AS (
  SELECT module, year, count(score) AS n, avg(score) AS mean, quantile_cont(score, 0.5) AS median
  FROM score_long GROUP BY module, year
)"""


@register("yearly_means", floats=("mean",) + grid("median"), ctes=SL + (TREND_SQL,), sql="SELECT * FROM trend_y")
def yearly_means(spark, sf_dir):
    return U.trend(score_long(spark, sf_dir), "year")


@register("yearly_change", floats=("mean", "yoy_change", "first_value", "last_value", "total_change"),
          ctes=SL + (TREND_SQL,), sql="""
SELECT module, year, mean,
  mean - lag(mean) OVER (PARTITION BY module ORDER BY year) AS yoy_change,
  first_value(mean) OVER (PARTITION BY module ORDER BY year ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS first_value,
  last_value(mean) OVER (PARTITION BY module ORDER BY year ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_value,
  last_value(mean) OVER (PARTITION BY module ORDER BY year ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
  - first_value(mean) OVER (PARTITION BY module ORDER BY year ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS total_change
FROM trend_y""")
def yearly_change(spark, sf_dir):
    return U.trend_change(U.trend(score_long(spark, sf_dir), "year", median=False), "year")


@register("trend_summary", floats=("volatility",), ctes=SL + (TREND_SQL,), sql="""
SELECT module, best_time, worst_time, volatility, non_decreasing, times_leader,
       CAST(rank() OVER (ORDER BY volatility DESC, module) AS BIGINT) AS volatility_rank
FROM (
  SELECT module,
    (array_agg(year ORDER BY mean DESC, year))[1] AS best_time,
    (array_agg(year ORDER BY mean ASC, year))[1] AS worst_time,
    stddev_samp(mean) AS volatility,
    bool_and(coalesce(delta >= 0, true)) AS non_decreasing,
    CAST(count_if(leader) AS BIGINT) AS times_leader
  FROM (SELECT module, year, mean,
               mean - lag(mean) OVER (PARTITION BY module ORDER BY year) AS delta,
               row_number() OVER (PARTITION BY year ORDER BY mean DESC, module) = 1 AS leader
        FROM trend_y) d
  GROUP BY module) s""")
def trend_summary(spark, sf_dir):
    return U.trend_summary(U.trend(score_long(spark, sf_dir), "year", median=False), "year")
