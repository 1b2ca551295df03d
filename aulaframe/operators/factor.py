"""Principal components and factor analysis of mixed data (FAMD), #70-76.

FAMD encoding (published method): numeric variables are z-scored with the
population sd; each level l (share p) of a categorical variable becomes
the column (1 - p) / sqrt(p) for members and -sqrt(p) otherwise. A PCA of
the *unscaled* encoded matrix then gives the FAMD dimensions; the total
inertia equals (#numeric) + sum(levels - 1).

Work split: one aggregation computes every moment and level share; the
encoding is a projection of literal-coefficient expressions; ``pyspark.ml``
PCA aggregates the p x p covariance across executors (tree aggregate) and
eigen-decomposes that small matrix on the driver. Rows never leave the
executors. Eigenvector signs are fixed so that the largest-magnitude
loading of each component is positive.

Definitions chosen here (the source analysis names the goals only): far
points ranked by eigenvalue-scaled squared distance in the first factor
plane (``far_points``); variable links = squared correlation for numeric
and correlation ratio eta^2 for categorical variables (``variable_links``).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aulaframe.functions.columns import safe_corr
from aulaframe.operators.contingency import MAX_PIVOT_LEVELS as MAX_LEVELS


@dataclass
class FactorModel:
    columns: list[str]          # encoded column names
    eigenvalues: list[float]    # population inertia of each component
    explained: list[float]      # share of total inertia
    loadings: list[list[float]]  # p x k, sign-fixed
    total_inertia: float
    pca_model: object
    n: int


def _levels_all(df: DataFrame, cat: Sequence[str], max_levels: int = MAX_LEVELS) -> dict[str, list]:
    """Distinct levels of every categorical column in ONE job (bounded and
    checked: at most ``max_levels`` per column are collected)."""
    if not cat:
        return {}
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("v"), F.col(c).cast("string").alias("l")) for c in cat]))
    lv = df.select(pairs.alias("x")).select("x.*").filter(F.col("l").isNotNull()).distinct()
    rows = lv.limit(max_levels * len(cat) + 1).collect()
    out: dict[str, list] = {c: [] for c in cat}
    for r in rows:
        out[r["v"]].append(r["l"])
    if len(rows) > max_levels * len(cat) or any(len(v) > max_levels for v in out.values()):
        raise ValueError(f"a categorical column has more than {max_levels} levels")
    return {c: sorted(v) for c, v in out.items()}


def _encode(df: DataFrame, num: Sequence[str], cat: Sequence[str],
            keep: Sequence[str] = ()) -> tuple[DataFrame, list[str], int, float]:
    """Encoded columns, their names, the row count and the total inertia
    (sum of the encoded columns' population variances: 1 per non-constant
    numeric variable, 1 - p per level), all from one statistics pass. A missing
    value stands at the variable's mean (0 in each of its columns): it moves its
    row nowhere, and the variable's inertia shrinks to the share of rows that
    have a value. Means, deviations and shares are of these rows."""
    lv = _levels_all(df, cat)
    aggs = [F.count(F.lit(1)).alias("_n")]
    for c in num:
        aggs += [F.avg(c).alias(f"m__{c}"), F.stddev_pop(c).alias(f"s__{c}"), F.count(c).alias(f"n__{c}")]
    for c in cat:
        aggs.append(F.count(c).alias(f"n__{c}"))
        for i, v in enumerate(lv[c]):
            aggs.append(F.count_if(F.col(c).cast("string") == F.lit(v)).alias(f"p__{c}__{i}"))
    st = df.agg(*aggs).first().asDict()
    n = st["_n"]
    exprs, names, total = [], [], 0.0
    for c in num:
        m, sd = st[f"m__{c}"], st[f"s__{c}"]
        z = (F.col(c) - F.lit(m).cast("double")) / F.lit(sd if sd else 1.0)
        exprs.append(F.coalesce(z, F.lit(0.0)).alias(f"z_{c}"))
        names.append(f"z_{c}")
        total += st[f"n__{c}"] / n if sd else 0.0
    for c in cat:
        for i, v in enumerate(lv[c]):
            p = st[f"p__{c}__{i}"] / st[f"n__{c}"]
            name = f"i_{c}_{i}"
            exprs.append(F.when(F.col(c).isNull(), F.lit(0.0)).when(F.col(c).cast("string") == F.lit(v), F.lit((1 - p) / math.sqrt(p)))
                         .otherwise(F.lit(-math.sqrt(p))).alias(name))
            names.append(name)
            total += (1.0 - p) * st[f"n__{c}"] / n
    return df.select(*keep, *exprs), names, n, total


def famd_encode(df: DataFrame, num: Sequence[str], cat: Sequence[str],
                keep: Sequence[str] = ()) -> tuple[DataFrame, list[str]]:
    """Encoded columns for FAMD (plus ``keep`` passthrough columns)."""
    enc, names, _, _ = _encode(df, num, cat, keep)
    return enc, names


def _fit(enc: DataFrame, cols: list[str], k: int, n: int, total: float) -> FactorModel:
    from pyspark.ml.feature import PCA, VectorAssembler

    vec = VectorAssembler(inputCols=cols, outputCol="_v").transform(enc)
    model = PCA(k=k, inputCol="_v", outputCol="_pc").fit(vec)
    # total inertia = trace of the (population) covariance, known from the
    # encoding statistics (no extra pass over the data)
    explained = [float(x) for x in model.explainedVariance.toArray()]
    pc = model.pc.toArray()  # p x k
    loadings = []
    for j in range(pc.shape[1]):
        col = pc[:, j]
        sign = 1.0 if col[abs(col).argmax()] >= 0 else -1.0
        loadings.append([float(x) * sign for x in col])
    loadings_pk = [[loadings[j][i] for j in range(len(loadings))] for i in range(len(cols))]
    return FactorModel(cols, [e * total for e in explained], explained, loadings_pk, total, model, n)


def famd(df: DataFrame, num: Sequence[str], cat: Sequence[str], k: int | None = None) -> tuple[FactorModel, DataFrame, list[str]]:
    """Fit FAMD; returns (model, encoded rows, encoded column names)."""
    enc, cols, n, total = _encode(df, num, cat, keep=df.columns)
    return _fit(enc, cols, k or len(cols), n, total), enc, cols


def pca(df: DataFrame, cols: Sequence[str], k: int | None = None) -> FactorModel:
    """PCA of standardised numeric variables (z-scores), i.e. of the
    correlation matrix."""
    enc, names, n, total = _encode(df, cols, [], keep=())
    return _fit(enc, names, k or len(names), n, total)


def explained_table(model: FactorModel, target: float | None = None) -> DataFrame:
    """Eigenvalue, explained and cumulative explained share per dimension;
    ``dims_for_target`` = smallest number of dimensions reaching ``target``."""
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    rows = [(i + 1, model.eigenvalues[i], model.explained[i]) for i in range(len(model.explained))]
    t = spark.createDataFrame(rows, "dimension int, eigenvalue double, explained double")
    w = Window.orderBy("dimension").rowsBetween(Window.unboundedPreceding, 0)
    t = t.withColumn("cumulative", F.sum("explained").over(w))
    if target is not None:
        reach = F.min(F.when(F.col("cumulative") >= F.lit(target), F.col("dimension"))).over(Window.partitionBy())
        t = t.withColumn("dims_for_target", reach)
    return t


def scores(model: FactorModel, enc: DataFrame, keys: Sequence[str], dims: int = 2) -> DataFrame:
    """Row coordinates on the first ``dims`` dimensions (sign-fixed): a
    projection with literal loadings, evaluated row by row on executors."""
    out = [F.col(k) for k in keys]
    for j in range(dims):
        expr = None
        for i, c in enumerate(model.columns):
            term = F.col(c) * F.lit(model.loadings[i][j])
            expr = term if expr is None else expr + term
        out.append(expr.alias(f"dim{j + 1}"))
    return enc.select(*out)


def far_points(sc: DataFrame, model: FactorModel, keys: Sequence[str], top: int = 20) -> DataFrame:
    """Individuals farthest from the origin of the factor plane: squared
    distance scaled by each dimension's eigenvalue (a Mahalanobis-type
    distance), top-k report (orderBy + limit = per-partition top-k)."""
    d2 = (F.col("dim1") ** 2) / F.lit(model.eigenvalues[0]) + (F.col("dim2") ** 2) / F.lit(model.eigenvalues[1])
    return (sc.withColumn("distance2", d2)
            .orderBy(F.desc("distance2"), *[F.asc(k) for k in keys]).limit(top))


def variable_links(df_with_scores: DataFrame, num: Sequence[str], cat: Sequence[str],
                   dims: int = 2) -> DataFrame:
    """Link of each variable to each dimension: squared correlation for
    numeric variables, correlation ratio eta^2 for categorical ones (rows
    without the value don't count). One scan: score sums for every level of
    every categorical variable and for all rows at once (grouping sets), summed
    before the shuffle; all else is arithmetic on that table."""
    dim = [f"dim{j}" for j in range(1, dims + 1)]
    sums = [F.count(F.lit(1)).alias("n")]
    for d in dim:
        sums += [F.sum(d).alias(f"s_{d}"), F.sum(F.col(d) * F.col(d)).alias(f"q_{d}"), *[(safe_corr(c, d) ** 2).alias(f"r_{d}_{i}") for i, c in enumerate(num)]]
    sets = [[c] for c in cat] + [[]]
    g = df_with_scores.groupingSets(sets, *cat).agg(*sums, *[F.grouping(c).alias(f"g_{i}") for i, c in enumerate(cat)]) if cat else df_with_scores.agg(*sums)
    links = []
    for j, d in enumerate(dim, start=1):
        for i, c in enumerate(num):
            whole = reduce(lambda x, y: x & y, [F.col(f"g_{k}") == 1 for k in range(len(cat))], F.lit(True))
            links.append((c, j, F.max(F.when(whole, F.col(f"r_{d}_{i}")))))
        for i, c in enumerate(cat):
            own = (F.col(f"g_{i}") == 0) & F.col(c).isNotNull()
            total = lambda x, own=own: F.sum(F.when(own, x))
            n, s_, q = total(F.col("n")), total(F.col(f"s_{d}")), total(F.col(f"q_{d}"))
            between = total(F.col(f"s_{d}") * F.col(f"s_{d}") / F.col("n")) - s_ * s_ / n
            links.append((c, j, F.try_divide(between, q - s_ * s_ / n)))
    one = g.agg(*[e.alias(f"l_{k}") for k, (_, _, e) in enumerate(links)])
    rows = ", ".join(f"'{c}', `l_{k}`, {j}" for k, (c, j, _) in enumerate(links))
    return one.selectExpr(f"stack({len(links)}, {rows}) AS (variable, link, dimension)")
