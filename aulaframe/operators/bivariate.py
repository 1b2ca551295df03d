"""Bivariate analyses: numeric x numeric and numeric x category.

Everything aggregates first (one row per group and module) and applies
windows or joins to those small tables afterwards; raw rows only ever go
through partial/final hash aggregation.

Definitions chosen here (the source analysis states none): pooled-sd
standardised difference for two groups and eta^2 = SSB/SST for k groups,
with Cohen's conventional labels as parameters (``effect_size_two``,
``effect_size_eta2``); IQR overlap = |intersection| / |union| of
neighbouring groups (``iqr_overlap``); small-sample threshold default 30
(``flag_small``); a peak / valley is strictly above / below both
neighbouring periods, ends excluded (``period_peaks``); small-n peaks are
below the per-module 25th percentile of period sizes (``peaks_with_n``);
percentile rank = rows below / (n - 1) (``percentile_in``).
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aulaframe.functions.columns import safe_corr
from aulaframe.operators.ranking import join_on_keys, with_rows_below
from aulaframe.operators.univariate import DEFAULT_METHOD, _cols, aggregate_with_quantiles

# Conventional effect-size cut points (Cohen); parameters,
# not findings.
D_CUTS = (0.2, 0.5, 0.8)
ETA2_CUTS = (0.01, 0.06, 0.14)
EFFECT_LABELS = ("negligible", "small", "moderate", "large")


def _label(x: Column, cuts: Sequence[float], labels: Sequence[str] = EFFECT_LABELS) -> Column:
    e = F.when(x.isNull(), F.lit(None).cast("string"))
    for c, lab in zip(cuts, labels):
        e = e.when(x < F.lit(c), F.lit(lab))
    return e.otherwise(F.lit(labels[len(cuts)]))


# ------------------------------------------------------------- correlation

def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson matrix in long form (var_a, var_b, r), both orders and the
    unit diagonal, from ONE aggregation with one ``corr`` per pair."""
    pairs = list(combinations(cols, 2))
    one = df.agg(*[safe_corr(a, b).alias(f"{a}__{b}") for a, b in pairs])
    entries = [f"'{a}', '{b}', `{a}__{b}`, '{b}', '{a}', `{a}__{b}`" for a, b in pairs]
    entries += [f"'{c}', '{c}', CAST(1.0 AS DOUBLE)" for c in cols]
    n = 2 * len(pairs) + len(cols)
    # one scan, one aggregate row, expanded into the long matrix
    return one.selectExpr(f"stack({n}, {', '.join(entries)}) AS (var_a, var_b, r)")


def corr_rank(matrix: DataFrame) -> DataFrame:
    """Unordered pairs with r, shared variance r^2 and rank by |r|."""
    p = matrix.filter(F.col("var_a") < F.col("var_b"))
    w = Window.orderBy(F.desc(F.abs("r")), "var_a", "var_b")
    return p.select("var_a", "var_b", "r", (F.col("r") * F.col("r")).alias("r2"),
                    F.rank().over(w).cast("bigint").alias("pair_rank"))


def corr_pivot(matrix: DataFrame) -> DataFrame:
    """Mean |r| of each variable with the others; the pivot variable has the
    highest value (rank 1)."""
    m = matrix.filter(F.col("var_a") != F.col("var_b")).groupBy("var_a").agg(
        F.avg(F.abs("r")).alias("mean_abs_r"))
    return m.withColumn("pivot_rank", F.rank().over(
        Window.orderBy(F.desc("mean_abs_r"), "var_a")).cast("bigint"))


# ------------------------------------------------------------ group stats

def group_stats(long: DataFrame, by: str | Sequence[str], value: str = "score",
                key: str = "module", median: bool = True, method: str = DEFAULT_METHOD) -> DataFrame:
    """n, mean, sd (and median) per category and module."""
    keys = _cols(by) + [key]
    aggs = [F.count(value).alias("n"), F.avg(value).alias("mean"),
            F.stddev_samp(value).alias("sd"), F.var_samp(value).alias("var")]
    if not median:
        return long.groupBy(*keys).agg(*aggs)
    return aggregate_with_quantiles(long, keys, value, aggs, [0.5], ["median"], method)


def flag_small(stats: DataFrame, min_n: int = 30) -> DataFrame:
    """Small-sample flag: groups with fewer than ``min_n`` rows."""
    return stats.withColumn("small", F.col("n") < F.lit(min_n))


def group_gap(long: DataFrame, by: str, a: str, b: str, value: str = "score",
              key: str = "module", method: str = DEFAULT_METHOD) -> DataFrame:
    """Mean and median gap between two groups: both groups' statistics from one
    selection, side by side by conditional aggregation."""
    stats = aggregate_with_quantiles(long.filter(F.col(by).isin(a, b)), [key, by], value,
                                     [F.count(value).alias("n"), F.avg(value).alias("mean")], [0.5], ["median"], method)
    side = [F.max(F.when(F.col(by) == F.lit(g), F.col(c))).alias(f"{c}_{s}") for c in ("n", "mean", "median") for s, g in (("a", a), ("b", b))]
    out = join_on_keys(long.select(key).distinct(), stats.groupBy(key).agg(*side), [key], "left")
    none = F.lit(0).cast("bigint")
    return out.select(key, F.coalesce("n_a", none).alias("n_a"), F.coalesce("n_b", none).alias("n_b"), "mean_a", "mean_b", "median_a", "median_b",
                      (F.col("mean_a") - F.col("mean_b")).alias("mean_gap"), (F.col("median_a") - F.col("median_b")).alias("median_gap"))


def effect_size_two(long: DataFrame, by: str, a: str, b: str, value: str = "score",
                    key: str = "module", cuts: Sequence[float] = D_CUTS) -> DataFrame:
    """Standardised mean difference (pooled sd) between groups a and b."""
    va = F.when(F.col(by) == F.lit(a), F.col(value))
    vb = F.when(F.col(by) == F.lit(b), F.col(value))
    s = long.groupBy(key).agg(
        F.count(va).alias("n_a"), F.count(vb).alias("n_b"),
        F.avg(va).alias("mean_a"), F.avg(vb).alias("mean_b"),
        F.var_samp(va).alias("var_a"), F.var_samp(vb).alias("var_b"))
    pooled = F.sqrt(F.try_divide((F.col("n_a") - 1) * F.col("var_a") + (F.col("n_b") - 1) * F.col("var_b"),
                                 (F.col("n_a") + F.col("n_b") - 2).cast("double")))
    d = F.try_divide(F.col("mean_a") - F.col("mean_b"), pooled)
    return s.select(key, "n_a", "n_b", "mean_a", "mean_b", pooled.alias("pooled_sd"),
                    d.alias("d"), _label(F.abs(d), cuts).alias("magnitude"))


def effect_size_eta2(long: DataFrame, by: str, value: str = "score", key: str = "module",
                     cuts: Sequence[float] = ETA2_CUTS) -> DataFrame:
    """eta^2 = SSB / SST from per-group n, mean and variance (two-level
    aggregation; SST = sum over groups of (n_g-1)var_g + n_g(m_g-m)^2)."""
    g = long.filter(F.col(by).isNotNull()).groupBy(key, by).agg(
        F.count(value).alias("n"), F.avg(value).alias("m"), F.var_pop(value).alias("vp"))
    w = Window.partitionBy(key)
    grand = F.sum(F.col("n") * F.col("m")).over(w) / F.sum("n").over(w)
    g = g.withColumn("grand", grand)
    out = g.groupBy(key).agg(
        F.count(F.lit(1)).alias("groups"),
        F.sum("n").alias("n"),
        F.sum(F.col("n") * (F.col("m") - F.col("grand")) ** 2).alias("ssb"),
        F.sum(F.col("n") * F.col("vp") + F.col("n") * (F.col("m") - F.col("grand")) ** 2).alias("sst"))
    eta = F.try_divide(F.col("ssb"), F.col("sst"))
    return out.select(key, "groups", "n", "ssb", "sst", eta.alias("eta2"),
                      _label(eta, cuts).alias("magnitude"))


def iqr_overlap(box: DataFrame, by: str, order: str | None = None, key: str = "module",
                pooled: DataFrame | None = None) -> DataFrame:
    """Overlap of interquartile ranges of consecutive groups (in ``order``,
    default the group value): |intersection| / |union|; 0 when disjoint,
    1 when both are the same point. Only neighbours are compared, so the
    output is linear in the number of groups. With ``pooled`` (box stats of
    all rows per module) each group's overlap with the overall IQR is added.
    """
    order = order or by
    w = Window.partitionBy(key).orderBy(F.asc_nulls_last(order), F.asc_nulls_last(by))

    def ov(q1a, q3a, q1b, q3b):
        inter = F.greatest(F.lit(0.0), F.least(q3a, q3b) - F.greatest(q1a, q1b))
        union = F.greatest(q3a, q3b) - F.least(q1a, q1b)
        known = q1a.isNotNull() & q3a.isNotNull() & q1b.isNotNull() & q3b.isNotNull()
        return F.when(known, F.when(union == 0, F.lit(1.0)).otherwise(inter / union))

    b = box.select(key, by, order, "q1", "q3") if order != by else box.select(key, by, "q1", "q3")
    out = b.select(
        key, by,
        F.lag(by).over(w).alias("prev_group"),
        ov(F.lag("q1").over(w), F.lag("q3").over(w), F.col("q1"), F.col("q3")).alias("overlap_prev"),
        "q1", "q3")
    if pooled is not None:
        p = pooled.select(key, F.col("q1").alias("p_q1"), F.col("q3").alias("p_q3"))
        out = out.join(p, key, "left").withColumn(
            "overlap_all", ov(F.col("q1"), F.col("q3"), F.col("p_q1"), F.col("p_q3"))
        ).drop("p_q1", "p_q3")
    return out


def gradient(stats: DataFrame, level: str, rank: str, key: str = "module") -> DataFrame:
    """Ordinal gradient: step between consecutive levels, extreme-to-extreme
    gap and a monotonic (non-decreasing) flag per module."""
    s = stats.filter(F.col(rank).isNotNull())
    w = Window.partitionBy(key).orderBy(rank)
    full = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    step = F.col("mean") - F.lag("mean").over(w)
    d = s.select(key, level, rank, "n", "mean", step.alias("step"),
                 (F.last("mean").over(full) - F.first("mean").over(full)).alias("extreme_gap"))
    mono = F.bool_and(F.coalesce(F.col("step") >= 0, F.lit(True))).over(Window.partitionBy(key))
    return d.withColumn("monotonic", mono)


def largest_gap(grad: DataFrame, key: str = "module") -> DataFrame:
    """Module with the largest extreme-to-extreme gap."""
    g = grad.select(key, "extreme_gap").distinct()
    return g.agg(F.min_by(F.col(key), F.struct(-F.col("extreme_gap"), F.col(key))).alias(key),
                 F.max("extreme_gap").alias("extreme_gap"))


def mean_range(stats: DataFrame, by: str, key: str = "module") -> DataFrame:
    """Lowest and highest group mean per module, over all groups and over
    the groups that are not flagged small."""
    ok = F.col("small") == F.lit(False)
    known = F.col("mean").isNotNull()  # a group without values is neither
    lo_all = F.min_by(F.col(by), F.when(known, F.struct(F.col("mean"), F.col(by))))
    hi_all = F.min_by(F.col(by), F.when(known, F.struct(-F.col("mean"), F.col(by))))
    lo_ok = F.min_by(F.when(ok, F.col(by)), F.when(ok & known, F.struct(F.col("mean"), F.col(by))))
    hi_ok = F.min_by(F.when(ok, F.col(by)), F.when(ok & known, F.struct(-F.col("mean"), F.col(by))))
    return stats.groupBy(key).agg(
        F.min("mean").alias("min_mean"), lo_all.alias("min_group"),
        F.max("mean").alias("max_mean"), hi_all.alias("max_group"),
        F.min(F.when(ok, F.col("mean"))).alias("min_mean_reliable"), lo_ok.alias("min_group_reliable"),
        F.max(F.when(ok, F.col("mean"))).alias("max_mean_reliable"), hi_ok.alias("max_group_reliable"))


def rank_groups(stats: DataFrame, by: str, key: str = "module") -> DataFrame:
    """Rank of each group's mean within its module (1 = highest)."""
    w = Window.partitionBy(key).orderBy(F.desc("mean"))
    return stats.select(key, by, "n", "mean", F.rank().over(w).cast("bigint").alias("rank"))


def area_profile(long: DataFrame, by: str, value: str = "score", key: str = "module") -> DataFrame:
    """Per group and module: mean minus the overall module mean (computed
    from the group sums, i.e. the row-weighted mean), rank from the top and
    from the bottom, and rank of dispersion (sd)."""
    g = long.groupBy(key, by).agg(F.count(value).alias("n"), F.sum(value).alias("_s"),
                                  F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd"))
    wm = Window.partitionBy(key)
    overall = F.sum("_s").over(wm) / F.sum("n").over(wm)
    g = g.withColumn("diff", F.col("mean") - overall)
    return g.select(
        key, by, "n", "mean", "sd", "diff",
        F.rank().over(Window.partitionBy(key).orderBy(F.desc("diff"))).cast("bigint").alias("rank_high"),
        F.rank().over(Window.partitionBy(key).orderBy(F.asc("diff"))).cast("bigint").alias("rank_low"),
        F.rank().over(Window.partitionBy(key).orderBy(F.desc("sd"))).cast("bigint").alias("rank_sd"))


def box_drift(box: DataFrame, time: str = "year", key: str = "module") -> DataFrame:
    """Change of the median between consecutive time units."""
    w = Window.partitionBy(key).orderBy(F.asc_nulls_last(time))
    return box.withColumn("median_drift", F.col("median") - F.lag("median").over(w))


def period_peaks(long: DataFrame, period: str = "period", value: str = "score",
                 key: str = "module", method: str = DEFAULT_METHOD) -> DataFrame:
    """Median per period; a peak (valley) is strictly above (below) both
    neighbours; the first and last periods are never peaks."""
    m = aggregate_with_quantiles(long, [key, period], value, [F.count(value).alias("n")],
                                 [0.5], ["median"], method)
    w = Window.partitionBy(key).orderBy(F.asc_nulls_last(period))
    prev, nxt = F.lag("median").over(w), F.lead("median").over(w)
    return m.select(key, period, "n", "median",
                    F.coalesce((F.col("median") > prev) & (F.col("median") > nxt), F.lit(False)).alias("peak"),
                    F.coalesce((F.col("median") < prev) & (F.col("median") < nxt), F.lit(False)).alias("valley"))


def peaks_with_n(peaks: DataFrame, key: str = "module", q: float = 0.25) -> DataFrame:
    """Peaks and valleys whose period has fewer rows than the ``q``
    quantile of period sizes (per module)."""
    thr = peaks.groupBy(key).agg(F.percentile("n", q).alias("n_threshold"))
    p = peaks.filter(F.col("peak") | F.col("valley")).join(thr, key)
    return p.withColumn("small_n", F.col("n") < F.col("n_threshold"))


# ------------------------------------------------------- percentile ranks

def percentile_in(df: DataFrame, col: str, by: str | Sequence[str] | None = None,
                  out: str = "pct_rank", method: str = "rank") -> DataFrame:
    """Exact ``percent_rank`` of ``col`` (nationally or within ``by``):
    (rows strictly below) / (n - 1), by
    :func:`~aulaframe.operators.ranking.with_rows_below`, so no task ever holds a
    whole group. NULL values have no rank and don't count; NULL group keys are a
    group of their own.

    ``method="window"`` is a caller's choice for groups known to be small:
    Spark's window, one sort per group, with the same results."""
    keys = _cols(by)
    if method == "window":
        # NULL values form their own partition so they do not shift ranks
        w = Window.partitionBy(*keys, F.col(col).isNull()).orderBy(col)
        return df.withColumn(out, F.when(F.col(col).isNotNull(), F.percent_rank().over(w)))
    r = with_rows_below(df, col, keys)
    share = F.when(F.col("_size") > 1, F.col("_below") / (F.col("_size") - 1)).when(F.col("_size") == 1, F.lit(0.0))
    return r.withColumn(out, share).select(*df.columns, out)
