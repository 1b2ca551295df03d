"""Budget-execution series (#77-84).

Input: one row per (year, month) with cumulative-within-year amounts:
appropriation (1), commitments (2), obligations (3), payments (4). Windows
are partitioned by year, i.e. at most 12 rows per window.

Ratios (5)-(10) follow the published formulas. Definitions chosen here:
the stage-order ladder check (``validate_budget``), the flow of a month =
cumulative minus the previous present month's cumulative with
``months_covered`` > 1 after a gap (``monthly_flow``), and a missing month
is a row absent from the 12-month calendar of each year present, never a
zero (``missing_months``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aulaframe.functions.columns import safe_ratio
from aulaframe.operators.quality import rule_violations

STAGES = ["appropriation", "commitments", "obligations", "payments"]

# The stage-order ladder of budget execution (violations).
LADDER_RULES = {
    "payments_above_obligations": "payments > obligations",
    "obligations_above_commitments": "obligations > commitments",
    "commitments_above_appropriation": "commitments > appropriation",
}


def budget_columns(df: DataFrame) -> DataFrame:
    """Derived columns (5)-(10): uncommitted balance = (1)-(2) and the
    execution ratios (2)/(1), (3)/(1), (4)/(1), (3)/(2), (4)/(3)."""
    a, c, o, p = (F.col(x) for x in STAGES)
    return df.select(
        "year", "month", *STAGES,
        (a - c).alias("balance"),
        safe_ratio(c, a).alias("commit_ratio"),
        safe_ratio(o, a).alias("obligation_ratio"),
        safe_ratio(p, a).alias("payment_ratio"),
        safe_ratio(o, c).alias("obligation_commit_ratio"),
        safe_ratio(p, o).alias("payment_obligation_ratio"))


def validate_budget(df: DataFrame) -> DataFrame:
    """Count months that break payments <= obligations <= commitments <=
    appropriation."""
    return rule_violations(df, LADDER_RULES)


def missing_months(df: DataFrame, year: str = "year", month: str = "month") -> DataFrame:
    """(year, month) pairs of the calendar of the years present that have
    no row: each year is expanded to its 12 months (sequence + explode),
    then anti-joined with the series."""
    cal = (df.select(year).distinct()
           .withColumn(month, F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(12).cast("bigint")))))
    return cal.join(df.select(year, month), [year, month], "left_anti")


def monthly_flow(df: DataFrame, cols: Sequence[str] = ("commitments", "obligations", "payments"),
                 year: str = "year", month: str = "month") -> DataFrame:
    """Monthly flow from cumulative reports over the months present:
    x - previous cumulative of the same year (0 for the first month);
    ``months_covered`` > 1 when the previous month is missing, because the
    flow then spans several months."""
    w = Window.partitionBy(year).orderBy(month)
    out = df.select(year, month,
                    *[(F.col(c) - F.coalesce(F.lag(c).over(w), F.lit(0.0))).alias(f"{c}_flow") for c in cols],
                    (F.col(month) - F.coalesce(F.lag(month).over(w), F.lit(0).cast("bigint"))).alias("months_covered"))
    return out


def peak_months(flow: DataFrame, col: str, k: int = 3, year: str = "year",
                month: str = "month") -> DataFrame:
    """Months where the yearly flow concentrates: share of the year and
    the top ``k`` months per year."""
    w = Window.partitionBy(year)
    r = Window.partitionBy(year).orderBy(F.desc(col), month)
    out = flow.select(year, month, F.col(col).alias("flow"),
                      F.try_divide(F.col(col), F.sum(col).over(w)).alias("share"),
                      F.rank().over(r).cast("bigint").alias("rank"))
    return out.filter(F.col("rank") <= k)


def annual_close(df: DataFrame, year: str = "year", month: str = "month",
                 cols: Sequence[str] = STAGES) -> DataFrame:
    """Definitive annual values: the December cut, or the last month
    available (``max_by`` per year, no sort of the series)."""
    s = F.struct(F.col(month).alias("close_month"), *[F.col(c) for c in cols])
    return df.groupBy(year).agg(F.max_by(s, F.struct(F.col(month).isNotNull(), F.col(month))).alias("_c")).select(year, "_c.*")


def compare_years(close: DataFrame, cols: Sequence[str] = STAGES, year: str = "year") -> DataFrame:
    """Change and relative change of each annual value from the previous
    year."""
    w = Window.orderBy(F.asc_nulls_last(year))  # one row per year
    out = close
    for c in cols:
        prev = F.lag(c).over(w)
        out = out.withColumn(f"{c}_change", F.col(c) - prev) \
                 .withColumn(f"{c}_pct", F.try_divide(F.col(c) - prev, prev))
    return out
