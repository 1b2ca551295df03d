"""Count tables: roll-ups, funnel pivots, indicators, join-safety audits
and year-level crosses (#85-92). Aggregate first, join aggregates after.

Definitions chosen here (the source analysis names the indicators but gives
no formulas): same-period ratios admission = admitted/applied, uptake =
first_year/admitted, graduation = graduated/enrolled (``indicators``); the
join audit's measures (``join_audit``); the territorial gap = group mean
minus the row-weighted national mean (``territory_gap``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aulaframe.functions.columns import safe_ratio


def rollup_counts(df: DataFrame, by: Sequence[str], measure: str = "n") -> DataFrame:
    """Totals with hierarchical subtotals (``rollup``) and their level."""
    by = list(by)
    return df.rollup(*by).agg(F.sum(measure).alias("total"),
                              F.grouping_id(*by).cast("bigint").alias("level"))


def grouping_set_counts(df: DataFrame, sets: Sequence[Sequence[str]], measure: str = "n") -> DataFrame:
    """Totals for arbitrary grouping sets in one aggregation pass."""
    cols = sorted({c for s in sets for c in s})
    gs = [[F.col(c) for c in s] for s in sets]
    return df.groupingSets(gs, *cols).agg(F.sum(measure).alias("total"),
                                          F.grouping_id(*cols).cast("bigint").alias("level"))


def funnel_wide(df: DataFrame, keys: Sequence[str], cat: str, values: Sequence[str],
                measure: str = "n") -> DataFrame:
    """Long (category, n) -> one column per funnel stage (0 when absent)."""
    w = df.groupBy(*keys).pivot(cat, list(values)).agg(F.sum(measure))
    return w.select(*keys, *[F.coalesce(F.col(v), F.lit(0).cast("bigint")).alias(v) for v in values])


def indicators(wide: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Same-period ratios (NOT cohort rates): admission = admitted/applied,
    uptake = first_year/admitted, graduation = graduated/enrolled."""
    return wide.select(*keys,
                       safe_ratio("admitted", "applied").alias("admission_rate"),
                       safe_ratio("first_year", "admitted").alias("uptake_rate"),
                       safe_ratio("graduated", "enrolled").alias("graduation_rate"))


def count_trend(wide: DataFrame, time: str, cols: Sequence[str]) -> DataFrame:
    """Counts per time unit and their change from the previous unit."""
    w = Window.orderBy(time)  # one row per time unit
    return wide.select(time, *cols, *[(F.col(c) - F.lag(c).over(w)).alias(f"{c}_change") for c in cols])


def staff_ratios(students: DataFrame, staff: DataFrame, key: str) -> DataFrame:
    """Students and staff per key (each aggregated first), full outer join,
    students per staff member."""
    s = students.groupBy(key).agg(F.count(F.lit(1)).alias("students"))
    t = staff.groupBy(key).agg(F.count(F.lit(1)).alias("staff"))
    j = s.join(t, key, "full_outer")
    return j.select(key, F.coalesce("students", F.lit(0).cast("bigint")).alias("students"),
                    F.coalesce("staff", F.lit(0).cast("bigint")).alias("staff"),
                    safe_ratio("students", "staff").alias("students_per_staff"))


def cohort_retention(df: DataFrame, unit: str, period: Column, by: Sequence[str] = ()) -> DataFrame:
    """Cohorts by the period in which a unit is first seen: ``by``, entry,
    elapsed, size, active, retention, for every elapsed period up to the last
    one of its group (0 where none came back). ``period``: whole numbers.

    One shuffle by unit: a unit's rows are reduced to its periods before it, so
    a unit with very many rows weighs as much as its periods. All else is on the
    table of entry and elapsed periods. Rows without a period place no unit;
    units that have no others are the cohort NULL (elapsed NULL, active = size,
    retention NULL). A NULL unit is one unit.
    """
    by = list(by)
    seen = df.select(*by, F.col(unit).alias("_unit"), period.cast("bigint").alias("_p")) \
        .groupBy(*by, "_unit").agg(F.collect_set("_p").alias("_seen")) \
        .withColumn("entry", F.array_min("_seen"))
    cell = seen.select(*by, "entry", F.explode_outer("_seen").alias("_p")) \
        .groupBy(*by, "entry", (F.col("_p") - F.col("entry")).alias("elapsed")).agg(F.count(F.lit(1)).alias("active"))
    cohort = cell.groupBy(*by, "entry").agg(
        F.max(F.when(F.coalesce("elapsed", F.lit(0)) == 0, F.col("active"))).alias("size"), F.max(F.col("entry") + F.col("elapsed")).alias("_last"),
        F.map_from_entries(F.array_compact(F.collect_list(F.when(F.col("elapsed").isNotNull(), F.struct("elapsed", "active"))))).alias("_active"))
    last = F.max("_last").over(Window.partitionBy(*by))  # one row a cohort
    dense = cohort.withColumn("_last", last) \
        .withColumn("elapsed", F.explode_outer(F.sequence(F.lit(0).cast("bigint"), F.col("_last") - F.col("entry"))))
    active = F.when(F.col("entry").isNull(), F.col("size")).otherwise(F.coalesce(F.try_element_at("_active", "elapsed"), F.lit(0).cast("bigint")))
    return dense.select(*by, "entry", "elapsed", "size", active.alias("active"),
                        F.when(F.col("entry").isNotNull(), F.try_divide(active, F.col("size"))).alias("retention"))


def cohort_coverage(cohorts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """From the cohort table, per period: units that are new, units seen so far
    (known), active units, those of them that came back, and coverage = active
    / known. The cohort NULL has no period."""
    by = list(by)
    per = cohorts.filter(F.col("entry").isNotNull()).groupBy(*by, (F.col("entry") + F.col("elapsed")).alias("period")).agg(
        F.sum(F.when(F.col("elapsed") == 0, F.col("size")).otherwise(0)).alias("new"), F.sum("active").alias("active"))
    so_far = Window.partitionBy(*by).orderBy("period")  # one row a period
    return per.withColumn("known", F.sum("new").over(so_far)) \
        .select(*by, "period", "new", "known", "active", (F.col("active") - F.col("new")).alias("returned"),
                F.try_divide("active", "known").alias("coverage"))


def join_audit(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Before crossing sources of different grain: key multiplicities per
    side, matched / left-only / right-only keys, the largest multiplicity on
    each side and the number of rows an inner join would produce."""
    keys = list(keys)
    lc = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_l"))
    rc = right.groupBy(*keys).agg(F.count(F.lit(1)).alias("_r"))
    j = lc.join(rc, keys, "full_outer")
    both = F.col("_l").isNotNull() & F.col("_r").isNotNull()
    return j.agg(
        F.coalesce(F.sum("_l"), F.lit(0)).cast("bigint").alias("left_rows"),
        F.coalesce(F.sum("_r"), F.lit(0)).cast("bigint").alias("right_rows"),
        F.count_if(both).alias("matched_keys"),
        F.count_if(F.col("_r").isNull()).alias("left_only_keys"),
        F.count_if(F.col("_l").isNull()).alias("right_only_keys"),
        F.max("_l").alias("left_max_multiplicity"),
        F.max("_r").alias("right_max_multiplicity"),
        F.coalesce(F.sum(F.when(both, F.col("_l").cast("decimal(19,0)") * F.col("_r").cast("decimal(19,0)"))), F.lit(0))
        .cast("decimal(38,0)").alias("inner_join_rows"))


def yearly_cross(parts: Sequence[DataFrame], year: str = "year") -> DataFrame:
    """Full outer join of per-year aggregates (each one row per year; rows
    without a year meet)."""
    out = parts[0]
    for p in parts[1:]:
        other = p.withColumnRenamed(year, "_year")
        out = out.join(other, F.col(year).eqNullSafe(F.col("_year")), "full_outer") \
            .withColumn(year, F.coalesce(year, "_year")).drop("_year")
    return out


def territory_gap(df: DataFrame, by: str, value: str) -> DataFrame:
    """Group mean minus the national (row-weighted) mean, ranked."""
    g = df.groupBy(by).agg(F.count(value).alias("n"), F.sum(value).alias("_s"), F.avg(value).alias("mean"))
    nat = F.sum("_s").over(Window.partitionBy()) / F.sum("n").over(Window.partitionBy())
    g = g.withColumn("gap", F.col("mean") - nat)
    return g.select(by, "n", "mean", "gap",
                    F.rank().over(Window.orderBy(F.desc("gap"))).cast("bigint").alias("rank"))
