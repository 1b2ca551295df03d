"""Mergeable statistics of a refreshed table.

Each load leaves, beside its rows, a small table of states: per group and value
bucket the rows, their mean, squared deviations and extremes. Buckets grow by
the factor (1 + a) / (1 - a), so a value lies within a share a of its bucket's
middle whatever its size. States of several loads are put together by adding
counts and combining moments (parallel variance), so a new load is read alone
and earlier ones never again. Counts, extremes, means and deviations are those
of all rows; quantiles (the value of rank floor(p (n - 1)), from 0) are within
a share ``accuracy`` of the exact value.

NULL groups are a group. NULL values have no bucket: they count in ``rows``
alone. Non-finite values are treated as NULL.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ACCURACY = 0.005


def growth(accuracy: float = ACCURACY) -> float:
    return (1 + accuracy) / (1 - accuracy)


def value_states(df: DataFrame, by: Sequence[str], value: str, accuracy: float = ACCURACY) -> DataFrame:
    """The states of one load: ``by``, sign, bucket, rows, n, mean, m2, lo, hi.
    Groups times buckets are shuffled (about 230 buckets a factor of ten)."""
    x = F.col(value).cast("double")
    v = F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)
    bucket = F.when(F.col("_v") != 0, F.ceil(F.log(F.abs("_v")) / F.lit(math.log(growth(accuracy))))).otherwise(0)
    return df.select(*by, v.alias("_v")).withColumn("sign", F.signum("_v").cast("int")) \
        .withColumn("bucket", F.when(F.col("_v").isNotNull(), bucket).cast("bigint")) \
        .groupBy(*by, "sign", "bucket").agg(F.count(F.lit(1)).alias("rows"), F.count("_v").alias("n"), F.avg("_v").alias("mean"),
                                            (F.var_pop("_v") * F.count("_v")).alias("m2"), F.min("_v").alias("lo"), F.max("_v").alias("hi"))


def summarise(states: DataFrame, by: Sequence[str], probs: dict[str, float], accuracy: float = ACCURACY) -> DataFrame:
    """``by``, rows, n, mean, sd (sample), min, max and a quantile for each
    entry of ``probs``, from the states of any number of loads."""
    by = list(by)
    group = Window.partitionBy(*by)  # a group's buckets: bounded by the range of its values
    parts = states.groupBy(*by, "sign", "bucket").agg(
        F.sum("rows").alias("rows"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("mean")).alias("sum"),
        F.collect_list(F.struct("n", "mean", "m2")).alias("loads"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    total = parts.withColumn("all", F.sum("n").over(group)).withColumn("centre", F.sum("sum").over(group) / F.col("all"))
    within = F.aggregate(F.filter("loads", lambda s: s["n"] > 0), F.lit(0.0),
                         lambda a, s: a + s["m2"] + s["n"] * (s["mean"] - F.col("centre")) * (s["mean"] - F.col("centre")))
    order = group.orderBy("sign", F.col("sign") * F.col("bucket"))
    placed = total.withColumn("upto", F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    g = growth(accuracy)
    middle = F.col("sign") * F.pow(F.lit(g), F.col("bucket").cast("double")) * (2 / (1 + g))
    shown = F.least(F.greatest(middle, F.col("lo")), F.col("hi"))
    rank = lambda p: F.floor(F.lit(p) * (F.col("all") - 1))
    at = lambda p: F.max(F.when((F.col("n") > 0) & (F.col("upto") > rank(p)) & (F.col("upto") - F.col("n") <= rank(p)), shown))
    return placed.groupBy(*by).agg(
        F.sum("rows").alias("rows"), F.sum("n").alias("n"), F.max("centre").alias("mean"),
        F.sqrt(F.try_divide(F.sum(within), F.sum("n") - 1)).alias("sd"), F.min("lo").alias("min"), F.max("hi").alias("max"),
        *[at(p).alias(name) for name, p in probs.items()])
