"""Category x category analyses (contingency tables, chi-square).

Tables are aggregated first (one row per observed cell); margins come from
windows over that small table. The chi-square statistic sums (o - e)^2 / e over
the observed cells and adds what the empty ones expect, n - sum(e): the textbook
sum over the full grid, of which no table is made. Several attribute pairs are
counted in one scan (``chi_square_pairs``); p-values are column expressions.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aulaframe.functions.columns import chi_square_sf
from aulaframe.operators.ranking import cut

MAX_PIVOT_LEVELS = 1000


def crosstab(df: DataFrame, a: str, b: str) -> DataFrame:
    """Long contingency table: observed cells with their count."""
    return df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))


def levels(df: DataFrame, col: str, max_levels: int = MAX_PIVOT_LEVELS) -> list:
    """Distinct non-null levels of a category column (bounded, checked)."""
    vals = (df.select(col).filter(F.col(col).isNotNull()).distinct()
            .orderBy(col).limit(max_levels + 1).collect())
    if len(vals) > max_levels:
        raise ValueError(f"{col} has more than {max_levels} levels; use the long form")
    return [r[0] for r in vals]


def crosstab_wide(df: DataFrame, a: str, b: str, values: Sequence | None = None) -> DataFrame:
    """Wide table: one row per level of ``a``, one count column per level
    of ``b`` (0 for empty cells). Rows whose ``b`` is NULL, if there are any,
    are counted in a last column ``null`` (with underscores added while a
    level has that name). Passing ``values`` (None for NULL) avoids the extra
    jobs that discover the levels."""
    if values is None:
        values = levels(df, b) + [None] * (not df.filter(F.col(b).isNull()).isEmpty())
    values = list(values)
    names = [str(v) for v in values if v is not None]
    null = "null"
    while null in names:
        null += "_"
    w = df.groupBy(a).pivot(b, values).agg(F.count(F.lit(1))).toDF(a, *[f"_c{i}" for i in range(len(values))])
    return w.select(a, *[F.coalesce(F.col(f"_c{i}"), F.lit(0).cast("bigint")).alias(null if v is None else str(v))
                         for i, v in enumerate(values)])


def crosstab_pct(ct: DataFrame, a: str, b: str) -> DataFrame:
    """Row, column and total percentages of a long table."""
    n = F.col("n")
    return ct.select(
        a, b, "n",
        (n / F.sum(n).over(Window.partitionBy(a))).alias("row_pct"),
        (n / F.sum(n).over(Window.partitionBy(b))).alias("col_pct"),
        (n / F.sum(n).over(Window.partitionBy())).alias("total_pct"))


def crosstab_margins(df: DataFrame, a: str, b: str) -> DataFrame:
    """Cells plus row, column and grand margins via ``cube``;
    ``margin`` = grouping_id (0 cell, 1 row margin, 2 column margin, 3 total)."""
    c = df.cube(a, b).agg(F.count(F.lit(1)).alias("n"),
                          F.grouping_id(a, b).cast("bigint").alias("margin"))
    grand = F.max(F.when(F.col("margin") == 3, F.col("n"))).over(Window.partitionBy())
    return c.withColumn("pct_of_total", F.col("n") / grand)


def chi_square(df: DataFrame, a: str, b: str) -> DataFrame:
    """Pearson chi-square of independence: statistic, degrees of freedom,
    number of levels and rows; NULL categories excluded."""
    return chi_square_of(crosstab(df.filter(F.col(a).isNotNull() & F.col(b).isNotNull()), a, b), a, b)


def chi_square_of(ct: DataFrame, a: str, b: str) -> DataFrame:
    """The statistic from counted cells (a, b, n). Sums and products are
    doubles, so counts of any size fit. Over the observed cells it is
    sum((o - e)^2 / e); the cells that were never observed add their expected
    counts, n - sum(e)."""
    d = ct.withColumn("o", F.col("n").cast("double"))
    n_all = F.sum("o").over(Window.partitionBy())
    e = F.sum("o").over(Window.partitionBy(a)) * F.sum("o").over(Window.partitionBy(b)) / n_all
    cells = d.select(a, b, "o", e.alias("e"), F.sum("n").over(Window.partitionBy()).alias("n_all"))
    s = cells.agg(
        (F.sum((F.col("o") - F.col("e")) * (F.col("o") - F.col("e")) / F.col("e"))
         + F.first("n_all").cast("double") - F.sum("e")).alias("chi2"),
        F.first("n_all").alias("n"),
        F.count_distinct(a).alias("rows"),
        F.count_distinct(b).alias("cols"))
    return s.withColumn("dof", (F.col("rows") - 1) * (F.col("cols") - 1))


def chi_square_pairs(df: DataFrame, attributes: Sequence[str]) -> DataFrame:
    """Chi-square test of every pair of attributes: var_a, var_b, chi2, n, rows,
    cols, dof, p_value, cramers_v. One scan: each row counts in one cell of each
    pair, summed before the single shuffle of cells; margins and totals come
    from the cells. A row counts in the pairs whose two values it has; a pair
    without such rows has no row, one with a single level on a side dof 0 and
    no p-value."""
    level = lambda c: F.col(c).cast("string")
    pairs = F.array(*[F.struct(F.lit(a).alias("var_a"), F.lit(b).alias("var_b"), level(a).alias("level_a"), level(b).alias("level_b"))
                      for a, b in combinations(attributes, 2)])
    pair = ["var_a", "var_b"]
    cells = cut(df.select(F.explode(pairs).alias("c")).select("c.*").filter("level_a is not null and level_b is not null")
                .groupBy(*pair, "level_a", "level_b").agg(F.count(F.lit(1)).alias("n")))
    side = lambda c, total: cells.groupBy(*pair, c).agg(F.sum(F.col("n").cast("double")).alias(total))
    by_a, by_b = side("level_a", "na"), side("level_b", "nb")
    size = cells.groupBy(*pair).agg(F.sum("n").alias("n_all"))
    e = F.col("na") * F.col("nb") / F.col("n_all")
    joined = cells.join(by_a, [*pair, "level_a"]).join(by_b, [*pair, "level_b"]).join(size, pair).withColumn("e", e)
    stat = joined.groupBy(*pair).agg(
        F.sum((F.col("n") - F.col("e")) * (F.col("n") - F.col("e")) / F.col("e")).alias("seen"),
        (F.first("n_all") - F.sum("e")).alias("unseen"), F.count(F.lit(1)).alias("cells"), F.first("n_all").alias("n"))
    counted = stat.join(by_a.groupBy(*pair).agg(F.count(F.lit(1)).alias("rows")), pair).join(by_b.groupBy(*pair).agg(F.count(F.lit(1)).alias("cols")), pair)
    # without an empty cell nothing is added: n - sum(e) would only be rounding
    chi2 = F.col("seen") + F.when(F.col("cells") < F.col("rows") * F.col("cols"), F.col("unseen")).otherwise(0.0)
    tested = counted.withColumn("dof", (F.col("rows") - 1) * (F.col("cols") - 1)).withColumn("chi2", chi2)
    return cramers_v(tested.withColumn("p_value", chi_square_sf("chi2", "dof"))).select(*pair, "chi2", "n", "rows", "cols", "dof", "p_value", "cramers_v")


def cramers_v(chi: DataFrame) -> DataFrame:
    """Cramer's V = sqrt(chi2 / (n * min(r-1, c-1)))."""
    k = F.least(F.col("rows") - 1, F.col("cols") - 1)
    return chi.withColumn("cramers_v", F.sqrt(F.try_divide(F.col("chi2"), (F.col("n") * k).cast("double"))))


def chi_square_test(df: DataFrame, a: str, b: str) -> DataFrame:
    """Statistic, degrees of freedom and p-value from ``pyspark.ml``'s
    ChiSquareTest (distributed counting; levels indexed with StringIndexer)."""
    from pyspark.ml.feature import StringIndexer, VectorAssembler
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.stat import ChiSquareTest

    src = df.select(a, b).filter(F.col(a).isNotNull() & F.col(b).isNotNull())
    idx = StringIndexer(inputCols=[a, b], outputCols=["_ia", "_ib"],
                        stringOrderType="alphabetAsc").fit(src).transform(src)
    vec = VectorAssembler(inputCols=["_ib"], outputCol="_f").transform(idx)
    r = ChiSquareTest.test(vec, "_f", "_ia")
    return r.select(vector_to_array("statistics")[0].alias("chi2"),
                    F.col("degreesOfFreedom")[0].cast("bigint").alias("dof"),
                    vector_to_array("pValues")[0].alias("p_value"))


def share_by_level(df: DataFrame, level: str, rank: str, b: str, value) -> DataFrame:
    """Share of ``b == value`` within each ordered level, and its change
    from the previous level."""
    g = df.filter(F.col(rank).isNotNull()).groupBy(level, rank).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(b) == F.lit(value)).alias("n_value"))
    g = g.withColumn("share", F.col("n_value") / F.col("n"))
    w = Window.orderBy(rank)  # one row per level: a handful of rows
    return g.withColumn("change", F.col("share") - F.lag("share").over(w))


def mix_over_time(df: DataFrame, period: str, cat: str) -> DataFrame:
    """Category mix per period: share, change from the previous period, and
    per category the lowest / highest share and the periods where they
    occur."""
    ct = crosstab(df, period, cat)
    ct = ct.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(period)))
    w = Window.partitionBy(cat).orderBy(F.asc_nulls_last(period))
    wc = Window.partitionBy(cat)
    lo = F.min_by(F.col(period), F.struct(F.col("share"), F.col(period).isNull(), F.col(period))).over(wc)
    hi = F.min_by(F.col(period), F.struct(-F.col("share"), F.col(period).isNull(), F.col(period))).over(wc)
    return ct.select(period, cat, "n", "share",
                     (F.col("share") - F.lag("share").over(w)).alias("change"),
                     F.min("share").over(wc).alias("min_share"), lo.alias("min_period"),
                     F.max("share").over(wc).alias("max_share"), hi.alias("max_period"))
