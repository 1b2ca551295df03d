"""Data-quality profile: dictionary, missingness, rule violations, extremes.

Every profile is ONE aggregation over the data (one pass, partial
aggregation), then ``stack`` turns the single wide row into long form.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aulaframe.operators.clean import small_side


def _stack(one: DataFrame, ids: Sequence[str], names: Sequence[str], fields: Sequence[str],
           name_col: str = "variable") -> DataFrame:
    """Turn prefixed columns ``{field}__{name}`` of a wide row into rows."""
    cols = ", ".join(f"'{n}', " + ", ".join(f"`{f}__{n}`" for f in fields) for n in names)
    out = ", ".join([name_col] + list(fields))
    sel = [f"`{i}`" for i in ids] + [f"stack({len(names)}, {cols}) AS ({out})"]
    return one.selectExpr(*sel)


def variable_dictionary(df: DataFrame, meta: DataFrame | None = None,
                        exact: bool = False) -> DataFrame:
    """Per column: Spark type, rows, NULLs, distinct non-null values
    (+ description and coding when ``meta`` (variable, description, coding)
    is given). ``exact=False`` uses HyperLogLog (``approx_count_distinct``),
    which avoids the row expansion Spark needs for many exact distinct
    counts in one pass: use it for wide tables at scale."""
    cols = df.columns
    dist = F.count_distinct if exact else F.approx_count_distinct
    one = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.count(F.col(f"`{c}`")).alias(f"nonnull__{c}") for c in cols],
                 *[dist(F.col(f"`{c}`")).alias(f"distinct__{c}") for c in cols])
    long = _stack(one, ["_rows"], cols, ["nonnull", "distinct"])
    types = df.sparkSession.createDataFrame(
        [(f.name, f.dataType.simpleString()) for f in df.schema.fields], "variable string, dtype string")
    # one row per column of the input schema: bounded by the schema width
    out = (long.join(F.broadcast(types), "variable")
           .select("variable", "dtype", F.col("_rows").alias("n_rows"),
                   (F.col("_rows") - F.col("nonnull")).alias("n_null"),
                   F.col("distinct").cast("bigint").alias("n_distinct")))
    if meta is not None:
        out = out.join(small_side(meta), "variable", "left")
    return out


def variable_codes(df: DataFrame, max_codes: int = 20, frequent: float = 0.05, tracked: int = 10_000) -> DataFrame:
    """Per column: rows, NULLs, its coding (``value=count`` in the order of the
    values, NULL where it has more than ``max_codes`` of them), the values that
    at least a share ``frequent`` of the rows has, and the least and greatest
    value as examples. One scan; a column's values are counted in a mergeable
    summary of ``tracked`` values, exact while a column has fewer than three
    quarters as many and within a few ten-thousandths of the rows beyond."""
    cols = df.columns
    most = max(max_codes, int(1 / frequent)) + 2  # the summary counts NULL as a value
    one = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.count(F.col(f"`{c}`")).alias(f"nonnull__{c}") for c in cols],
                 *[F.min(F.col(f"`{c}`")).cast("string").alias(f"least__{c}") for c in cols],
                 *[F.max(F.col(f"`{c}`")).cast("string").alias(f"greatest__{c}") for c in cols],
                 *[F.expr(f"approx_top_k(CAST(`{c}` AS STRING), {most}, {tracked})").alias(f"top__{c}") for c in cols])
    long = _stack(one, ["_rows"], cols, ["nonnull", "least", "greatest", "top"])
    top = F.array_sort(F.filter("top", lambda x: x["item"].isNotNull()))
    text = F.concat_ws("; ", F.transform(top, lambda x: F.concat(x["item"], F.lit("="), x["count"].cast("string"))))
    often = F.filter(top, lambda x: x["count"] >= F.lit(frequent) * F.col("_rows"))
    return long.select("variable", F.col("_rows").alias("n_rows"), (F.col("_rows") - F.col("nonnull")).alias("n_null"),
                       F.when(F.size(top) <= max_codes, text).alias("coding"),
                       F.concat_ws("; ", F.transform(often, lambda x: x["item"])).alias("frequent"),
                       F.col("least").alias("example_least"), F.col("greatest").alias("example_greatest"))


def missing_profile(df: DataFrame, by: str | Sequence[str], cols: Sequence[str] | None = None) -> DataFrame:
    """NULL count and share per column and group."""
    by = [by] if isinstance(by, str) else list(by)
    cols = [c for c in (cols or df.columns) if c not in by]
    one = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"),
                              *[F.count_if(F.col(c).isNull()).alias(f"nulls__{c}") for c in cols])
    long = _stack(one, by + ["n"], cols, ["nulls"])
    return long.withColumn("null_share", F.col("nulls") / F.col("n"))


def rule_violations(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Count rows violating each rule (``rules``: name -> SQL predicate
    that is TRUE for a violation), in one pass."""
    one = df.agg(F.count(F.lit(1)).alias("n_rows"),
                 *[F.count_if(F.coalesce(F.expr(p), F.lit(False))).alias(f"viol__{r}")
                   for r, p in rules.items()])
    return _stack(one, ["n_rows"], list(rules), ["viol"], name_col="rule") \
        .withColumnRenamed("viol", "n_violations")


def flag_extremes(long: DataFrame, limits: DataFrame, value: str = "score",
                  key: str = "module") -> DataFrame:
    """Rows at or beyond each module's scale limits (``limits``: key, lo,
    hi; a handful of rows, broadcast): zeros and scale limits are special
    records, not ordinary scores."""
    j = long.join(small_side(limits), key)
    v = F.col(value)
    return j.groupBy(key).agg(
        F.count(v).alias("n"),
        F.count_if(v <= F.col("lo")).alias("n_at_low"),
        F.count_if(v >= F.col("hi")).alias("n_at_high"),
        F.count_if(v == 0).alias("n_zero"))
