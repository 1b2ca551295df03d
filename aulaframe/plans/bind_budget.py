"""Budget-series analyses (#77-84) on the cumulative monthly view."""

from __future__ import annotations

from aulaframe.operators import budget as BU
from aulaframe.plans.registry import register
from aulaframe.plans.views import BUDGET_MONTH_SQL, budget_month, budget_month_gap

BM = (BUDGET_MONTH_SQL,)


@register("budget_columns", ctes=BM, sql="""
SELECT year, month, appropriation, commitments, obligations, payments,
       appropriation - commitments AS balance,
       commitments / nullif(appropriation, 0) AS commit_ratio,
       obligations / nullif(appropriation, 0) AS obligation_ratio,
       payments / nullif(appropriation, 0) AS payment_ratio,
       obligations / nullif(commitments, 0) AS obligation_commit_ratio,
       payments / nullif(obligations, 0) AS payment_obligation_ratio
FROM budget_month""")
def budget_columns(spark, sf_dir):
    return BU.budget_columns(budget_month(spark, sf_dir))


@register("budget_violations", ctes=BM, sql="\nUNION ALL ".join(
    f"SELECT '{r}' AS rule, count(*) AS n_rows, CAST(count_if(coalesce({p}, false)) AS BIGINT) AS n_violations "
    f"FROM budget_month" for r, p in BU.LADDER_RULES.items()))
def budget_violations(spark, sf_dir):
    return BU.validate_budget(budget_month(spark, sf_dir))


def _missing_sql(view: str) -> str:
    return f"""
SELECT y.year, CAST(m.range AS BIGINT) AS month
FROM (SELECT DISTINCT year FROM {view}) y, range(1, 13) m
WHERE NOT EXISTS (SELECT 1 FROM {view} b WHERE b.year = y.year AND b.month = m.range)"""


@register("missing_months", ctes=BM, sql=_missing_sql("budget_month"))
def missing_months(spark, sf_dir):
    return BU.missing_months(budget_month(spark, sf_dir))


@register("missing_months_gap", ctes=BM, sql=_missing_sql("budget_month_gap"))
def missing_months_gap(spark, sf_dir):
    return BU.missing_months(budget_month_gap(spark, sf_dir))


FLOW_SQL = """
flow AS (
  SELECT year, month,
    commitments - coalesce(lag(commitments) OVER w, 0.0) AS commitments_flow,
    obligations - coalesce(lag(obligations) OVER w, 0.0) AS obligations_flow,
    payments - coalesce(lag(payments) OVER w, 0.0) AS payments_flow,
    month - coalesce(lag(month) OVER w, 0) AS months_covered
  FROM budget_month_gap WINDOW w AS (PARTITION BY year ORDER BY month)
)"""


@register("monthly_flow", ctes=BM + (FLOW_SQL,), sql="SELECT * FROM flow")
def monthly_flow(spark, sf_dir):
    return BU.monthly_flow(budget_month_gap(spark, sf_dir))


@register("peak_months", floats=("share",), ctes=BM + (FLOW_SQL,), sql="""
SELECT * FROM (
  SELECT year, month, commitments_flow AS flow,
         commitments_flow / sum(commitments_flow) OVER (PARTITION BY year) AS share,
         CAST(rank() OVER (PARTITION BY year ORDER BY commitments_flow DESC, month) AS BIGINT) AS rank
  FROM flow) t WHERE rank <= 3""")
def peak_months(spark, sf_dir):
    return BU.peak_months(BU.monthly_flow(budget_month_gap(spark, sf_dir)), "commitments_flow", 3)


CLOSE_SQL = """
close_y AS (
  SELECT year, month AS close_month, appropriation, commitments, obligations, payments
  FROM (SELECT *, row_number() OVER (PARTITION BY year ORDER BY month DESC) AS rn FROM budget_month) t
  WHERE rn = 1
)"""


@register("annual_close", ctes=BM + (CLOSE_SQL,), sql="SELECT * FROM close_y")
def annual_close(spark, sf_dir):
    return BU.annual_close(budget_month(spark, sf_dir))


@register("budget_yoy", floats=tuple(f"{c}_pct" for c in BU.STAGES), ctes=BM + (CLOSE_SQL,), sql="""
SELECT *, """ + ",\n".join(
    f"{c} - lag({c}) OVER (ORDER BY year) AS {c}_change, "
    f"({c} - lag({c}) OVER (ORDER BY year)) / nullif(lag({c}) OVER (ORDER BY year), 0) AS {c}_pct"
    for c in BU.STAGES) + " FROM close_y")
def budget_yoy(spark, sf_dir):
    return BU.compare_years(BU.annual_close(budget_month(spark, sf_dir)))
