"""Exact quantiles, ranks and row numbers without single-task windows, value
tables or per-group maps.

Quantiles and ranks are found by radix selection. One scan gives each group its
size and range (with whatever moments are asked for); the next counts rows in
up to ``BUCKETS`` equal slices of each group's range, with the least and greatest
value of each, so what is shuffled is groups x slices counters, whatever the
number of values. Running sums tell how many rows lie below a slice. A slice
whose least and greatest value are equal needs no further look (a third of all
rows may share it); of the others, only those that hold a target rank are looked
at again, sliced once more if they still have more than ``OPEN_ROWS`` rows,
sorted otherwise. Infinities and NaN (the greatest, as Spark orders it) have
slices of their own. The slices need only be monotone in the value, so rounding
in their bounds changes costs and never results.

Row numbers come from one range partitioning on the whole key: numbers within
the partitions, and an offset for each group that goes on from one partition to
the next (at most two groups a partition).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from aulaframe.session import checkpoint_dir

BUCKETS = 4096  # slices of a range, at most;
SLICE_ROWS = 1000  # fewer where that leaves a slice about so many rows
OPEN_ROWS = 500_000  # rows of a slice that one task sorts
LEVELS = 5  # then a slice is sorted whatever its size (its values differ in their last bits alone)
BROADCAST_BYTES = 64 << 20  # small tables are broadcast only below this (measured)


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _bytes(df: DataFrame) -> Column:
    """Size of the rows, as an aggregate: 16 bytes a value and the bytes of the texts."""
    texts = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c, t in df.dtypes if t in ("string", "binary")]
    return F.sum(reduce(lambda x, y: x + y, texts, F.lit(16 * len(df.columns))).cast("bigint"))


def fit(df: DataFrame, max_rows: int | None = None) -> DataFrame:
    """``df``, to be broadcast if its measured size allows: at most
    BROADCAST_BYTES (and ``max_rows``)."""
    rows, size = (df if max_rows is None else df.limit(max_rows + 1)).agg(F.count(F.lit(1)), _bytes(df)).first()
    return F.broadcast(df) if (size or 0) <= BROADCAST_BYTES and (max_rows is None or rows <= max_rows) else df


def _cut_measured(df: DataFrame, **aggs: Column) -> tuple[DataFrame, dict]:
    """``cut`` with aggregates over its rows, and their ``bytes``, observed
    while they are written."""
    seen = Observation()
    out = cut(df.observe(seen, _bytes(df).alias("bytes"), *[a.alias(k) for k, a in aggs.items()]))
    return out, seen.get


def _hint(df: DataFrame, size: int | None) -> DataFrame:
    return F.broadcast(df) if (size or 0) <= BROADCAST_BYTES else fit(df)


def join_on_keys(a: DataFrame, b: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join two tables on their keys, NULL keys matching NULL."""
    keys = list(keys)
    if not keys:
        raise ValueError("join_on_keys needs at least one key")
    other = b.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[c for c in b.columns if c not in keys])
    same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    out = a.join(other, same, how)
    return out if how in ("left_semi", "left_anti") else out.drop(*[f"_k_{k}" for k in keys])


def _finite(x: Column) -> Column:
    d = x.cast("double")
    return F.when(~F.isnan(d) & (F.abs(d) != F.lit(float("inf"))), x)


def _slices(rows: str, buckets: int) -> Column:
    """Slices that a range with so many rows is cut into."""
    return F.greatest(F.lit(16), F.least(F.lit(buckets), F.ceil(F.col(rows) / SLICE_ROWS))).cast("bigint").alias("_m")


def _slice(x: Column, lo: Column, hi: Column, n: Column) -> Column:
    """Slice 0 .. n - 1 of [lo, hi]; -1, n and n + 1 for the infinities and NaN."""
    d, a, z = (c.cast("double") / 2 for c in (x, lo, hi))
    inside = F.least(F.floor(F.coalesce(F.try_divide(d - a, z - a), F.lit(0.0)) * n), n - 1)
    return F.when(F.isnan(d), n + 1).when(d == float("inf"), n).when(d == float("-inf"), -1).otherwise(inside)


def _ranges(df: DataFrame, col: str, keys: list[str], aggs: Sequence[Column] = ()) -> tuple[DataFrame, dict]:
    """One row a group: size, finite range, ``aggs``."""
    x = F.col(col)
    return _cut_measured(df.groupBy(*keys).agg(F.count(x).alias("_n"), F.min(_finite(x)).alias("_lo"), F.max(_finite(x)).alias("_hi"), *aggs))


def _first_slices(ranges: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    zero = F.lit(0).cast("bigint")
    return ranges.filter("_n > 0").select(*keys, "_n", "_lo", "_hi", _slices("_n", buckets), zero.alias("_path"), zero.alias("_off"))


def _deeper() -> Column:
    """Number of a slice of a slice: one base-8192 digit a level."""
    return F.col("_path") * 8192 + F.col("_b") + 2


def _counted(placed: DataFrame, col: str, keys: list[str]) -> tuple[DataFrame, dict]:
    """Per slice: rows ``_c``, least and greatest value, rows of its group
    below it. The running sum is over the slices of one range. Also ``most``,
    the rows of the largest slice of several values."""
    c, seen = _cut_measured(placed.groupBy(*keys, "_path", "_b").agg(
        F.count(F.lit(1)).alias("_c"), F.min(col).alias("_mn"), F.max(col).alias("_mx"), F.max("_off").alias("_off"), F.max("_n").alias("_n")),
        most=F.max(F.when(F.col("_mn") != F.col("_mx"), F.col("_c"))))
    run = Window.partitionBy(*keys, "_path").orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    return c.withColumn("_below", F.col("_off") + F.sum("_c").over(run) - F.col("_c")).drop("_off"), seen


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float], by: Sequence[str] = (),
                    names: Sequence[str] | None = None, aggs: Sequence[Column] = (), buckets: int = BUCKETS) -> DataFrame:
    """One row a group: its keys, ``aggs``, and exact quantiles with linear
    interpolation (the ``percentile`` / ``quantile_cont`` definition: position
    p * (n - 1) between the order statistics at its floor and ceiling). NULL
    values don't count; a group without values has NULL quantiles."""
    keys, names = list(by), list(names) if names else [f"q{int(round(p * 100))}" for p in probs]
    if not keys:
        return exact_quantiles(df.withColumn("_g", F.lit(1)), col, probs, ["_g"], names, aggs, buckets).drop("_g")
    src = df.filter(F.col(col).isNotNull()).select(*keys, col)
    ranges, seen = _ranges(df, col, keys, aggs)
    places = [F.lit(float(p)) * (F.col("_n") - 1) for p in probs]
    ks = [k for pos in places for k in (F.floor(pos), F.ceil(pos))]
    here = lambda k: (F.col("_below") <= k) & (k < F.col("_below") + F.col("_c"))
    wanted = reduce(lambda x, y: x | y, [here(k) for k in ks])

    live, todo, found = src.withColumn("_path", F.lit(0).cast("bigint")), _first_slices(ranges, keys, buckets), []
    for level in range(LEVELS):
        placed = join_on_keys(live, _hint(todo, seen["bytes"]), keys + ["_path"]).withColumn("_b", _slice(F.col(col), F.col("_lo"), F.col("_hi"), F.col("_m")))
        counts, seen = _counted(placed, col, keys)
        hit, one_value = counts.filter(wanted), F.col("_mn") == F.col("_mx")
        found.append(hit.filter(one_value).select(*keys, F.col("_mn").alias(col), "_c", "_below", "_n"))
        todo, most = hit.filter(~one_value), seen["most"]
        if most and most > OPEN_ROWS:  # some slice is that large; one that is wanted?
            most = todo.agg(F.max("_c")).first()[0]
        if most is None:
            break
        if most <= OPEN_ROWS or level == LEVELS - 1:
            slices = _hint(todo.select(*keys, "_path", "_b", F.col("_below").alias("_from")), seen["bytes"])
            values = join_on_keys(placed, slices, keys + ["_path", "_b"]).groupBy(*keys, "_path", "_b", col).agg(
                F.count(F.lit(1)).alias("_c"), F.max("_from").alias("_from"), F.max("_n").alias("_n"))
            run = Window.partitionBy(*keys, "_path", "_b").orderBy(col).rowsBetween(Window.unboundedPreceding, 0)
            found.append(values.select(*keys, col, "_c", (F.col("_from") + F.sum("_c").over(run) - F.col("_c")).alias("_below"), "_n"))
            break
        todo = todo.select(*keys, "_n", F.col("_mn").alias("_lo"), F.col("_mx").alias("_hi"), _slices("_c", buckets), _deeper().alias("_path"), F.col("_below").alias("_off"))
        live = placed.select(*keys, col, _deeper().alias("_path"))

    stats = [F.max(F.when(here(k), F.col(col))).cast("double").alias(f"_s{i}") for i, k in enumerate(ks)]
    read = reduce(DataFrame.unionByName, found).groupBy(*keys).agg(F.max("_n").alias("_n"), *stats)
    out = []
    for i, (pos, name) in enumerate(zip(places, names)):
        lo, hi = F.col(f"_s{2 * i}"), F.col(f"_s{2 * i + 1}")
        out.append(F.when(lo == hi, lo).otherwise(lo + (hi - lo) * (pos - F.floor(pos))).alias(name))
    return join_on_keys(ranges.drop("_n", "_lo", "_hi"), read.select(*keys, *out), keys, "left")


def with_rows_below(df: DataFrame, col: str, by: Sequence[str] = (), below: str = "_below", size: str = "_size",
                    buckets: int = BUCKETS) -> DataFrame:
    """Every row of ``df`` with the number of rows of its group whose ``col`` is
    strictly less, and the group's number of values. NULL values have neither
    and don't count; NULL keys are a group of their own. Rows are shuffled once,
    by group and slice; rows of a slice of one value need no sorting and are
    spread."""
    keys = list(by) or ["_g"]
    rows = (df if by else df.withColumn("_g", F.lit(1))).withColumn("_path", F.when(F.col(col).isNotNull(), F.lit(0).cast("bigint")))
    ranges, seen = _ranges(rows, col, keys)
    todo, done, size_of_all = _first_slices(ranges, keys, buckets), [], 0
    for level in range(LEVELS):
        wide = join_on_keys(rows, _hint(todo, seen["bytes"]), keys + ["_path"], "left").withColumn("_b", F.when(F.col("_n").isNotNull(), _slice(F.col(col), F.col("_lo"), F.col("_hi"), F.col("_m"))))
        placed = wide.filter("_b is not null").select(*keys, "_path", "_b", col, "_n", "_off")
        counts, seen = _counted(placed, col, keys)
        counts, size_of_all = counts.withColumn("_path", _deeper()), size_of_all + (seen["bytes"] or 0)
        rows = wide.withColumn("_path", F.coalesce(_deeper(), "_path")).select(*rows.columns)
        large = (F.col("_mn") != F.col("_mx")) & (F.col("_c") > OPEN_ROWS)
        if level == LEVELS - 1 or (seen["most"] or 0) <= OPEN_ROWS:
            done.append(counts)
            break
        done.append(counts.filter(~large))
        todo = counts.filter(large).select(*keys, "_n", F.col("_mn").alias("_lo"), F.col("_mx").alias("_hi"), _slices("_c", buckets), "_path", F.col("_below").alias("_off"))
    slices = reduce(DataFrame.unionByName, done).select(*keys, "_path", F.col("_n").alias(size), F.col("_below").alias("_from"), (F.col("_mn") != F.col("_mx")).alias("_open"))
    j = join_on_keys(rows, _hint(slices, size_of_all), keys + ["_path"], "left")
    spread = F.when(F.col("_open"), F.lit(0).cast("bigint")).otherwise(F.monotonically_increasing_id() % 1024)
    one = Window.partitionBy(*keys, "_path", "_spread").orderBy(col)
    j = j.withColumn("_spread", spread).withColumn("_r", F.rank().over(one))
    rank = F.col("_from") + F.when(F.col("_open"), F.col("_r") - 1).otherwise(0)
    return j.withColumn(below, rank).select(*df.columns, below, size)


def rows_below(df: DataFrame, col: str, by: Sequence[str] = (), buckets: int = BUCKETS) -> DataFrame:
    """Distinct (by, col) values with ``_c`` (multiplicity), ``_n`` (group
    size) and ``_below`` (rows of the group strictly below the value)."""
    known = df.filter(F.col(col).isNotNull()).select(*by, col)
    return with_rows_below(known, col, by, "_below", "_n", buckets).groupBy(*by, col).agg(
        F.count(F.lit(1)).alias("_c"), F.max("_n").alias("_n"), F.max("_below").alias("_below"))


def with_row_number(df: DataFrame, by: Sequence[str], order: Sequence[Column], out: str = "row_number",
                    partitions: int | None = None) -> DataFrame:
    """``row_number`` of every row in its group. Rows are dealt by ranges of
    (``by``, ``order``), so a group of any size lies in as many tasks as it
    takes; each is numbered there and starts where the same group ended in the
    partitions before. ``order`` should tell a group's rows apart."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order_cols = [f"_o{i}" for i in range(len(order))]
    keyed = df.select("*", *[o.alias(c) for o, c in zip(order, order_cols)])
    dealt = cut(keyed.repartitionByRange(n, *by, *order_cols).withColumn("_part", F.spark_partition_id()))
    per = dealt.groupBy(*by, "_part").agg(F.count(F.lit(1)).alias("_rows"))
    # a group lies in consecutive partitions: only those that it shares with others' ends matter
    run = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = per.withColumn("_before", F.sum("_rows").over(run)).filter("_before is not null").select(*by, "_part", "_before")
    numbered = join_on_keys(dealt, fit(cut(before)), [*by, "_part"], "left")
    own = F.row_number().over(Window.partitionBy(*by, "_part").orderBy(*order_cols))
    return numbered.withColumn(out, (own + F.coalesce("_before", F.lit(0))).cast("bigint")).select(*df.columns, out)
