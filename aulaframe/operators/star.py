"""Star schema: de-duplicated staging, dimensions, fact, star queries and
integrity checks, and incremental extension of a dimension.

Scale notes
- De-duplication uses ``max_by`` aggregation, not a ``row_number`` window:
  partial (map-side) aggregation keeps one survivor per key per partition,
  so a key holding a third of all rows never lands whole in one task.
- Dimensions keyed by their natural key need no shuffle of their own;
  profile dimensions (distinct attribute combinations) get a stable
  ``xxhash64`` key, computable row by row with no global ordering.
- Fact-to-dimension joins are plain equi-joins: Spark's size-checked
  auto-broadcast / AQE pick broadcast for small dimensions and sort-merge
  (with skew splitting) for the long ones.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aulaframe.operators.ranking import join_on_keys

UNKNOWN_KEY = -1  # of the member that stands for late and missing ones


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep one row per key: the greatest by ``order`` (lexicographic,
    descending), with every remaining column appended as a tie-break so the
    survivor is deterministic."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys and c not in order]
    # the struct is both the ordering and the payload: max() of it is the
    # survivor (lexicographic: order columns first, then the rest)
    ranked = F.struct(*[F.col(c) for c in list(order) + rest])
    agg = df.groupBy(*keys).agg(F.max(ranked).alias("_s"))
    return agg.select(*keys, *[F.col(f"_s.{c}").alias(c) for c in df.columns if c not in keys])


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their multiplicity."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") > 1))


def build_dim(df: DataFrame, cols: Sequence[str], key: str | None = None,
              natural: Sequence[str] | None = None) -> DataFrame:
    """Dimension = distinct attribute rows. If ``natural`` is given the key is
    the natural key (already unique); otherwise ``key`` is a stable
    ``xxhash64`` of the attribute combination, with a marker for each NULL
    (the hash itself skips NULLs)."""
    d = df.select(*cols).distinct() if natural is None else df.select(*cols)
    if key and natural is None:
        d = d.withColumn(key, F.xxhash64(*[x for c in cols for x in (F.col(c).isNull(), F.col(c))]))
    return d


def key_collisions(dim: DataFrame, key: str) -> DataFrame:
    """Surrogate keys that several different members share: key, members."""
    members = dim.select(key, F.struct(*[F.col(c) for c in dim.columns if c != key]).alias("_m")).distinct()
    return members.groupBy(key).agg(F.count(F.lit(1)).alias("members")).filter("members > 1")


def with_unknown(dim: DataFrame, key: str) -> DataFrame:
    """The dimension and its unknown member, which facts without a member of
    their own point to: ``UNKNOWN_KEY``, every attribute NULL."""
    row = dim.sparkSession.range(1).select(*[
        (F.lit(UNKNOWN_KEY) if c == key else F.lit(None)).cast(t).alias(c) for c, t in dim.dtypes])
    return dim.unionByName(row)


def build_fact(stage: DataFrame, dims: dict[str, tuple[DataFrame, dict[str, str], str]],
               keep: Sequence[str]) -> DataFrame:
    """Looks up each dimension's key by the staged natural key and keeps the
    columns in ``keep``. ``dims``: name of the key column in the fact ->
    (dimension, staged column -> dimension column, key). NULL meets NULL; a row
    without a member (late or missing) stays, with ``UNKNOWN_KEY``. A dimension
    must have one row for each natural key."""
    f = stage
    for i, (name, (dim, on, key)) in enumerate(dims.items()):
        look = dim.select(*[F.col(d).alias(f"_d{i}_{j}") for j, d in enumerate(on.values())], F.col(key).alias(f"_key{i}"))
        same = reduce(lambda x, y: x & y, [F.col(s).eqNullSafe(F.col(f"_d{i}_{j}")) for j, s in enumerate(on)])
        f = f.join(look, same, "left").withColumn(name, F.coalesce(F.col(f"_key{i}"), F.lit(UNKNOWN_KEY).cast(dim.schema[key].dataType)))
    return f.select(*keep)


def check_star(stage_rows: DataFrame, fact: DataFrame,
               dims: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Integrity report as (check, value) rows: fact and staging row counts,
    orphans per dimension (fact keys missing from the dimension; NULL meets
    NULL) and duplicate keys per dimension."""
    # one pass over the fact: left joins to each dimension's DISTINCT keys
    # (so a duplicated dimension key cannot multiply fact rows) with a
    # presence flag, then a single aggregation counts rows and orphans
    f = fact.select(*{key for _, key in dims.values()})
    for name, (dim, key) in dims.items():
        f = join_on_keys(f, dim.select(key).distinct().withColumn(f"_in_{name}", F.lit(True)), [key], "left")
    counts = f.agg(F.count(F.lit(1)).alias("fact_rows"),
                   *[F.count_if(F.col(f"_in_{name}").isNull()).alias(f"orphans_{name}") for name in dims])
    names = ["fact_rows"] + [f"orphans_{name}" for name in dims]
    stack = ", ".join(f"'{n}', `{n}`" for n in names)
    parts = [counts.selectExpr(f"stack({len(names)}, {stack}) AS (check, value)"),
             stage_rows.agg(F.count(F.lit(1)).alias("value")).select(F.lit("staging_rows").alias("check"), "value")]
    for name, (dim, key) in dims.items():
        dup = dim.groupBy(key).count().filter("count > 1")
        parts.append(dup.agg(F.count(F.lit(1)).alias("value"))
                     .select(F.lit(f"duplicate_keys_{name}").alias("check"), "value"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def extend_dim(dim: DataFrame, new: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Add members of ``new`` whose key is not yet in ``dim`` (left anti join
    + union): the dimension grows one year at a time without rebuilding. NULL is
    a key like others; of rows that repeat a key the smallest is added."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in new.columns if c not in keys]
    one = new.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_m")).select(*keys, "_m.*") if rest else new.select(*keys).distinct()
    return dim.unionByName(join_on_keys(one, dim.select(*keys), keys, "left_anti"), allowMissingColumns=True)


def star_query(fact: DataFrame, dims: dict[str, tuple[DataFrame, str]],
               by: Sequence[str], aggs: Sequence) -> DataFrame:
    """Fact joined to the dimensions it needs, aggregated by dimension
    attributes."""
    f = fact
    for _, (dim, key) in dims.items():
        f = f.join(dim, key, "inner")
    return f.groupBy(*by).agg(*aggs)
