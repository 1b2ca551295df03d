"""Univariate analyses (frequency, descriptive, box plot, trend).

Conventions
- Scores arrive in long form (``module``, ``score``) built with ``unpivot``,
  so one aggregation pass serves every module.
- Quantiles are exact with linear interpolation. ``method`` chooses how:
  ``"rank"`` (default at every size) - radix selection
  (:mod:`aulaframe.operators.ranking`): groups x slices counters are shuffled,
  no group is ever held in one task;
  ``"map"`` - Spark's ``percentile`` in the same pass as the moments; its
  per-group buffer is a value -> count map, fine when the domain is small
  (scores on a 0-300 integer scale) but unbounded for continuous measures,
  so it is a caller's explicit choice;
  ``"approx"`` - ``percentile_approx`` (bounded sketch, approximate).
  A group whose values are all NULL is a row with n = 0 and NULL statistics
  by every method; NULL values are not counted.
- Shares over a total are computed on the aggregated table (one row per
  category), never with an unpartitioned window over raw rows.

Definitions chosen here (the source analysis states none): box-plot fences
at Q1 - 1.5*IQR / Q3 + 1.5*IQR with whiskers at the extreme values inside
them (``box_stats``, parameter ``k``); a NULL time unit or group comes last; concentration ordered by count desc
then key (``concentration``); volatility = sample sd of the yearly values
and a leader = highest mean of the year (``trend_summary``); the spread
ranking reports IQR, sd, range and CV side by side (``spread_rank``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aulaframe.operators.ranking import cut, exact_quantiles, fit, join_on_keys

QUARTILES = [0.25, 0.5, 0.75]
DEFAULT_METHOD = "rank"
# per-group distinct values for which one percentile map is small (~100 bytes
# per boxed entry: <= ~100 MB in the task that merges the largest group)
MAP_MAX_DISTINCT = 1_000_000


def _cols(by: str | Sequence[str] | None) -> list[str]:
    if by is None:
        return []
    return [by] if isinstance(by, str) else list(by)


def quantiles(x: str | Column, probs: Sequence[float], approx: bool = False,
              accuracy: int = 10000) -> Column:
    """Array of quantiles of ``x`` as one aggregate expression (``map`` or
    ``approx`` methods)."""
    c = F.col(x) if isinstance(x, str) else x
    arr = F.array(*[F.lit(float(p)) for p in probs])
    if approx:
        return F.percentile_approx(c, arr, accuracy)
    return F.percentile(c, arr)


def aggregate_with_quantiles(long: DataFrame, keys: Sequence[str], value: str, aggs: Sequence[Column],
                             probs: Sequence[float], names: Sequence[str],
                             method: str = DEFAULT_METHOD) -> DataFrame:
    """Per-group aggregates plus exact quantiles: the moments come with the
    first pass of the selection, or everything from ONE aggregation with the
    ``map`` and ``approx`` methods."""
    keys = list(keys)
    if method == "rank":
        return exact_quantiles(long, value, probs, keys, names, aggs)
    q = quantiles(value, probs, approx=(method == "approx"))
    out = long.groupBy(*keys).agg(*aggs, q.alias("_q"))
    return out.select("*", *[F.col("_q")[i].alias(n) for i, n in enumerate(names)]).drop("_q")


def quantile_table(long: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float],
                   names: Sequence[str], method: str = DEFAULT_METHOD) -> DataFrame:
    """One row per group with the requested quantiles as columns."""
    keys = list(keys)
    if method == "rank":
        return exact_quantiles(long, value, probs, keys, names)
    q = quantiles(value, probs, approx=(method == "approx"))
    return long.groupBy(*keys).agg(q.alias("_q")).select(
        *keys, *[F.col("_q")[i].alias(n) for i, n in enumerate(names)])


# ------------------------------------------------------------------ frequency

def freq_table(df: DataFrame, col: str, keep_null: bool = True) -> DataFrame:
    """Count and share of each value of ``col`` (NULL kept as a category)."""
    src = df if keep_null else df.filter(F.col(col).isNotNull())
    agg = src.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    # window over the aggregated table: one row per category
    return agg.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))


def top_k(df: DataFrame, col: str, k: int) -> DataFrame:
    """The ``k`` most frequent reported values (NULL / blank excluded);
    ties broken by value so the result is deterministic."""
    src = df.filter(F.col(col).isNotNull() & (F.trim(F.col(col).cast("string")) != ""))
    agg = src.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    w = Window.orderBy(F.desc("n"), F.asc(col))
    # orderBy+limit plans as TakeOrderedAndProject (per-partition top-k)
    top = agg.orderBy(F.desc("n"), F.asc(col)).limit(k)
    return top.withColumn("rank", F.row_number().over(w).cast("bigint"))


def concentration(df: DataFrame, col: str) -> DataFrame:
    """Cumulative share of rows by category rank (count desc, value asc)."""
    agg = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    w = Window.orderBy(F.desc("n"), F.asc(col))
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    tot = F.sum("n").over(Window.partitionBy())
    return agg.select(
        col, "n",
        F.row_number().over(w).cast("bigint").alias("rank"),
        (F.col("n") / tot).alias("share"),
        (F.sum("n").over(run) / tot).alias("cum_share"))


# --------------------------------------------------------------- descriptive

def describe(long: DataFrame, by: str | Sequence[str] | None = None,
             value: str = "score", key: str = "module", method: str = DEFAULT_METHOD,
             quartiles: bool = True) -> DataFrame:
    """n, mean, sd, min, Q1, median, Q3, max per ``key`` (and ``by``).
    Moments come from one pass of partial/final hash aggregation; without
    ``quartiles`` there is no other."""
    keys = _cols(by) + [key]
    mom = [F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd"),
           F.min(value).alias("min"), F.max(value).alias("max")]
    if not quartiles:
        return long.groupBy(*keys).agg(*mom)
    qn = ["q1", "median", "q3"]
    out = aggregate_with_quantiles(long, keys, value, mom, QUARTILES, qn, method)
    return out.select(*keys, "n", "mean", "sd", "min", "q1", "median", "q3", "max")


def spread_rank(desc: DataFrame, key: str = "module") -> DataFrame:
    """Rank modules by every spread measure (IQR, sd, range, CV) and by
    mean; the reference's own ranking depends on the measure, so all are
    reported side by side."""
    d = desc.select(key, "mean", "sd",
                    (F.col("q3") - F.col("q1")).alias("iqr"),
                    (F.col("max") - F.col("min")).alias("range"),
                    F.try_divide(F.col("sd"), F.col("mean")).alias("cv"))
    out = d
    for m in ("iqr", "sd", "range", "cv", "mean"):
        out = out.withColumn(f"rank_{m}", F.rank().over(Window.orderBy(F.desc(m), F.asc(key))).cast("bigint"))
    return out


def module_gap(desc: DataFrame, key: str = "module") -> DataFrame:
    """Gap between the best and the worst module mean (ties -> first key)."""
    return desc.agg(
        F.min_by(F.col(key), F.when(F.col("mean").isNotNull(), F.struct(-F.col("mean"), F.col(key)))).alias("best"),
        F.min_by(F.col(key), F.when(F.col("mean").isNotNull(), F.struct(F.col("mean"), F.col(key)))).alias("worst"),
        F.max("mean").alias("best_mean"),
        F.min("mean").alias("worst_mean"),
        (F.max("mean") - F.min("mean")).alias("gap"))


def histogram(df: DataFrame, col: str, lo: float, hi: float, bins: int) -> DataFrame:
    """Equal-width histogram on [lo, hi]; the last bin is closed, values
    outside the range are counted in bins 0 and bins+1; empty bins get 0."""
    x = F.col(col)
    b = (F.when(x < F.lit(float(lo)), F.lit(0))
         .when(x == F.lit(float(hi)), F.lit(bins))
         .when(x > F.lit(float(hi)), F.lit(bins + 1))
         .otherwise(F.floor(F.lit(bins) * (x - F.lit(float(lo))) / F.lit(float(hi - lo))) + 1)
         ).cast("bigint")
    counts = df.filter(F.col(col).isNotNull()).groupBy(b.alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"))
    spark = df.sparkSession
    w = (hi - lo) / bins
    grid = spark.range(0, bins + 2).withColumnRenamed("id", "bucket")
    out = grid.join(counts, "bucket", "left").select(
        "bucket",
        F.when((F.col("bucket") >= 1) & (F.col("bucket") <= bins),
               F.lit(float(lo)) + (F.col("bucket") - 1) * F.lit(w)).alias("lo"),
        F.when((F.col("bucket") >= 1) & (F.col("bucket") <= bins),
               F.lit(float(lo)) + F.col("bucket") * F.lit(w)).alias("hi"),
        F.coalesce(F.col("n"), F.lit(0).cast("bigint")).alias("n"))
    # keep the overflow buckets only when they hold values
    return out.filter((F.col("bucket").between(1, bins)) | (F.col("n") > 0))


def quartile_table(long: DataFrame, by: str | Sequence[str] | None = None,
                   value: str = "score", key: str = "module", method: str = DEFAULT_METHOD) -> DataFrame:
    """Q1, median, Q3 per group and module."""
    return quantile_table(long, _cols(by) + [key], value, QUARTILES, ["q1", "median", "q3"], method)


def box_stats(long: DataFrame, by: str | Sequence[str] | None = None,
              value: str = "score", key: str = "module", k: float = 1.5,
              method: str = DEFAULT_METHOD) -> DataFrame:
    """Box-plot statistics: quartiles, IQR, fences Q1-k*IQR / Q3+k*IQR,
    whiskers (extreme values inside the fences) and outlier counts.

    Quartiles, n and extremes come from the selection; one more scan, with the
    fences of each group joined to it, counts what lies outside and finds the
    whiskers by conditional aggregates.
    """
    keys = _cols(by) + [key]
    qn = ["q1", "median", "q3"]
    aggs = [F.count(value).alias("n"), F.min(value).alias("min"), F.max(value).alias("max")]
    q = aggregate_with_quantiles(long, keys, value, aggs, QUARTILES, qn, method)
    q = cut(q.withColumn("iqr", F.col("q3") - F.col("q1"))
            .withColumn("lo_fence", F.col("q1") - F.lit(k) * F.col("iqr"))
            .withColumn("hi_fence", F.col("q3") + F.lit(k) * F.col("iqr")))
    j = join_on_keys(long.select(*keys, value), fit(q.select(*keys, "lo_fence", "hi_fence")), keys, "left")
    v = F.col(value)
    sides = j.groupBy(*keys).agg(
        F.min(F.when(v >= F.col("lo_fence"), v)).alias("whisker_lo"),
        F.max(F.when(v <= F.col("hi_fence"), v)).alias("whisker_hi"),
        F.count_if(v < F.col("lo_fence")).alias("n_out_lo"),
        F.count_if(v > F.col("hi_fence")).alias("n_out_hi"))
    return join_on_keys(sides, q, keys, "left").select(
        *keys, "q1", "median", "q3", "iqr", "lo_fence", "hi_fence", "n", "whisker_lo", "whisker_hi",
        "n_out_lo", "n_out_hi", "min", "max")


# -------------------------------------------------------------------- trends

def trend(long: DataFrame, time: str = "year", value: str = "score",
          key: str = "module", method: str = DEFAULT_METHOD, median: bool = True) -> DataFrame:
    """Mean and median per module and time unit (both: the reference's
    'improvement' claims differ between the two; ``median=False`` leaves the
    latter out)."""
    keys = [key, time]
    aggs = [F.count(value).alias("n"), F.avg(value).alias("mean")]
    if not median:
        return long.groupBy(*keys).agg(*aggs)
    return aggregate_with_quantiles(long, keys, value, aggs, [0.5], ["median"], method)


def trend_change(tr: DataFrame, time: str = "year", key: str = "module",
                 measure: str = "mean") -> DataFrame:
    """Year-over-year change and first-to-last change of ``measure``."""
    w = Window.partitionBy(key).orderBy(F.asc_nulls_last(time))
    full = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    m = F.col(measure)
    return tr.select(
        key, time, measure,
        (m - F.lag(m).over(w)).alias("yoy_change"),
        F.first(m).over(full).alias("first_value"),
        F.last(m).over(full).alias("last_value"),
        (F.last(m).over(full) - F.first(m).over(full)).alias("total_change"))


def trend_summary(tr: DataFrame, time: str = "year", key: str = "module",
                  measure: str = "mean") -> DataFrame:
    """Per module: best and worst time unit, volatility (sample sd of the
    yearly values), non-decreasing flag, and how often it leads the year."""
    w = Window.partitionBy(key).orderBy(F.asc_nulls_last(time))
    lead_w = Window.partitionBy(time).orderBy(F.desc(measure), F.asc(key))
    d = tr.select(key, time, measure,
                  (F.col(measure) - F.lag(measure).over(w)).alias("_delta"),
                  (F.row_number().over(lead_w) == 1).alias("_leader"))
    out = d.groupBy(key).agg(
        F.min_by(F.col(time), F.when(F.col(measure).isNotNull(), F.struct(-F.col(measure), F.col(time).isNull(), F.col(time)))).alias("best_time"),
        F.min_by(F.col(time), F.when(F.col(measure).isNotNull(), F.struct(F.col(measure), F.col(time).isNull(), F.col(time)))).alias("worst_time"),
        F.stddev_samp(measure).alias("volatility"),
        F.bool_and(F.coalesce(F.col("_delta") >= 0, F.lit(True))).alias("non_decreasing"),
        F.count_if(F.col("_leader")).alias("times_leader"))
    return out.withColumn(
        "volatility_rank", F.rank().over(Window.orderBy(F.desc("volatility"), F.asc(key))).cast("bigint"))
