"""Count-table analyses (#85-92) on the funnel view and the base tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from aulaframe.operators import budget as BU
from aulaframe.operators import counts as K
from aulaframe.plans.registry import register
from aulaframe.plans.views import (BUDGET_MONTH_SQL, FUNNEL_LONG_SQL, FUNNEL_ORDER, SCORE_FACT_SQL,
                                   budget_month, funnel_long, score_fact)
from aulaframe.sources.tables import Tables

FL = (FUNNEL_LONG_SQL,)


@register("counts_rollup", ctes=FL, sql="""
SELECT category, day, CAST(sum(n) AS BIGINT) AS total, CAST(grouping(category, day) AS BIGINT) AS level
FROM funnel_long GROUP BY ROLLUP (category, day)""")
def counts_rollup(spark, sf_dir):
    return K.rollup_counts(funnel_long(spark, sf_dir), ["category", "day"])


@register("counts_grouping_sets", ctes=FL, sql="""
SELECT category, user_id, CAST(sum(n) AS BIGINT) AS total, CAST(grouping(category, user_id) AS BIGINT) AS level
FROM funnel_long GROUP BY GROUPING SETS ((category), (user_id), ())""")
def counts_grouping_sets(spark, sf_dir):
    return K.grouping_set_counts(funnel_long(spark, sf_dir), [["category"], ["user_id"], []])


WIDE_SQL = """
funnel_w AS (
  SELECT day, """ + ", ".join(
    f"CAST(coalesce(sum(n) FILTER (WHERE category = '{c}'), 0) AS BIGINT) AS {c}" for c in FUNNEL_ORDER) + """
  FROM funnel_long GROUP BY day
)"""


def _wide(spark, sf_dir):
    return K.funnel_wide(funnel_long(spark, sf_dir), ["day"], "category", FUNNEL_ORDER)


@register("funnel_wide", ctes=FL + (WIDE_SQL,), sql="SELECT * FROM funnel_w")
def funnel_wide(spark, sf_dir):
    return _wide(spark, sf_dir)


@register("funnel_indicators", floats=("admission_rate", "uptake_rate", "graduation_rate"),
          ctes=FL + (WIDE_SQL,), sql="""
SELECT day, admitted / nullif(applied, 0) AS admission_rate, first_year / nullif(admitted, 0) AS uptake_rate,
       graduated / nullif(enrolled, 0) AS graduation_rate
FROM funnel_w""")
def funnel_indicators(spark, sf_dir):
    return K.indicators(_wide(spark, sf_dir), ["day"])


@register("count_trend", ctes=FL + (WIDE_SQL,), sql="""
SELECT day, enrolled, graduated, enrolled - lag(enrolled) OVER (ORDER BY day) AS enrolled_change,
       graduated - lag(graduated) OVER (ORDER BY day) AS graduated_change
FROM funnel_w""")
def count_trend(spark, sf_dir):
    return K.count_trend(_wide(spark, sf_dir), "day", ["enrolled", "graduated"])


# weeks since Monday 1969-12-29
WEEK_SQL = "(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) + 3) // 7"
COHORT_SQL = f"""
seen_weeks AS (SELECT DISTINCT event_type, user_id, {WEEK_SQL} AS week FROM events),
entries AS (SELECT event_type, user_id, min(week) AS entry FROM seen_weeks GROUP BY 1, 2),
cohort_sizes AS (SELECT event_type, entry, count(*) AS size FROM entries GROUP BY 1, 2),
last_weeks AS (SELECT event_type, max(week) AS last FROM seen_weeks GROUP BY 1),
cohorts AS (
  SELECT c.event_type, c.entry, CAST(e.elapsed AS BIGINT) AS elapsed, c.size,
         (SELECT count(*) FROM entries n JOIN seen_weeks w ON n.user_id IS NOT DISTINCT FROM w.user_id AND n.event_type IS NOT DISTINCT FROM w.event_type
          WHERE n.event_type IS NOT DISTINCT FROM c.event_type AND n.entry = c.entry AND w.week = c.entry + e.elapsed) AS active
  FROM cohort_sizes c JOIN last_weeks l ON c.event_type IS NOT DISTINCT FROM l.event_type, unnest(range(0, l.last - c.entry + 1)) AS e(elapsed)
  WHERE c.entry IS NOT NULL
  UNION ALL SELECT event_type, entry, NULL, size, size FROM cohort_sizes WHERE entry IS NULL
)"""


def _cohorts(spark, sf_dir):
    week = F.floor((F.unix_date(F.to_date("ts")) + 3) / 7)
    return K.cohort_retention(Tables(spark, sf_dir).events, "user_id", week, ["event_type"])


@register("cohort_retention", floats=("retention",), ctes=(COHORT_SQL,), sql="""
SELECT *, CASE WHEN entry IS NOT NULL THEN active / size END AS retention FROM cohorts""")
def cohort_retention(spark, sf_dir):
    """Weekly cohorts of users for each kind of event."""
    return _cohorts(spark, sf_dir)


@register("cohort_coverage", floats=("coverage",), ctes=(COHORT_SQL,), sql="""
SELECT event_type, period, CAST("new" AS BIGINT) AS "new", CAST(known AS BIGINT) AS known, active, CAST(active - "new" AS BIGINT) AS returned, active / known AS coverage
FROM (SELECT event_type, period, "new", active, sum("new") OVER (PARTITION BY event_type ORDER BY period) AS known
      FROM (SELECT w.event_type, w.week AS period, count(*) AS active, count_if(n.entry = w.week) AS "new"
            FROM seen_weeks w JOIN entries n ON n.user_id IS NOT DISTINCT FROM w.user_id AND n.event_type IS NOT DISTINCT FROM w.event_type
            WHERE w.week IS NOT NULL GROUP BY 1, 2))""")
def cohort_coverage(spark, sf_dir):
    return K.cohort_coverage(_cohorts(spark, sf_dir), ["event_type"])


@register("staff_ratios", floats=("students_per_staff",), sql="""
SELECT coalesce(s.nation, t.nation) AS nation, coalesce(s.students, 0) AS students, coalesce(t.staff, 0) AS staff,
       coalesce(s.students, 0) / nullif(coalesce(t.staff, 0), 0) AS students_per_staff
FROM (SELECT c_nationkey AS nation, count(*) AS students FROM customer GROUP BY 1) s
FULL OUTER JOIN (SELECT s_nationkey AS nation, count(*) AS staff FROM supplier GROUP BY 1) t ON s.nation = t.nation""")
def staff_ratios(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return K.staff_ratios(t.customer.select(F.col("c_nationkey").alias("nation")),
                          t.supplier.select(F.col("s_nationkey").alias("nation")), "nation")


@register("join_audit", sql="""
SELECT CAST(coalesce(sum(l), 0) AS BIGINT) AS left_rows, CAST(coalesce(sum(r), 0) AS BIGINT) AS right_rows,
       CAST(count_if(l IS NOT NULL AND r IS NOT NULL) AS BIGINT) AS matched_keys,
       CAST(count_if(r IS NULL) AS BIGINT) AS left_only_keys, CAST(count_if(l IS NULL) AS BIGINT) AS right_only_keys,
       max(l) AS left_max_multiplicity, max(r) AS right_max_multiplicity,
       CAST(coalesce(sum(l * r), 0) AS BIGINT) AS inner_join_rows
FROM (SELECT c_nationkey AS k, count(*) AS l FROM customer GROUP BY 1) a
FULL OUTER JOIN (SELECT s_nationkey AS k, count(*) AS r FROM supplier GROUP BY 1) b USING (k)""")
def join_audit(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return K.join_audit(t.customer.select(F.col("c_nationkey").alias("k")),
                        t.supplier.select(F.col("s_nationkey").alias("k")), ["k"]) \
        .withColumn("inner_join_rows", F.col("inner_join_rows").cast("bigint"))


@register("yearly_cross", floats=("mean_quantity",), ctes=(BUDGET_MONTH_SQL,), sql="""
SELECT coalesce(a.year, b.year, c.year) AS year, a.n_orders, b.mean_quantity, c.appropriation
FROM (SELECT CAST(year(o_orderdate) AS BIGINT) AS year, count(*) AS n_orders FROM orders GROUP BY 1) a
FULL OUTER JOIN (SELECT CAST(year(l_shipdate) AS BIGINT) AS year, avg(l_quantity) AS mean_quantity
                 FROM lineitem GROUP BY 1) b ON a.year IS NOT DISTINCT FROM b.year
FULL OUTER JOIN (SELECT year, max(appropriation) AS appropriation FROM budget_month GROUP BY year) c
  ON coalesce(a.year, b.year) IS NOT DISTINCT FROM c.year""")
def yearly_cross(spark, sf_dir):
    t = Tables(spark, sf_dir)
    a = t.orders.groupBy(F.year("o_orderdate").cast("bigint").alias("year")).agg(
        F.count(F.lit(1)).alias("n_orders"))
    b = t.lineitem.groupBy(F.year("l_shipdate").cast("bigint").alias("year")).agg(
        F.avg("l_quantity").alias("mean_quantity"))
    c = BU.annual_close(budget_month(spark, sf_dir)).select("year", "appropriation")
    return K.yearly_cross([a, b, c])


@register("territory_gap", floats=("mean", "gap"), ctes=(SCORE_FACT_SQL,), sql="""
SELECT department, n, mean, gap, CAST(rank() OVER (ORDER BY gap DESC) AS BIGINT) AS rank
FROM (SELECT department, count(module2) AS n, avg(module2) AS mean,
             avg(module2) - sum(sum(module2)) OVER () / sum(count(module2)) OVER () AS gap
      FROM score_fact GROUP BY department) g""")
def territory_gap(spark, sf_dir):
    return K.territory_gap(score_fact(spark, sf_dir), "department", "module2")


