"""Mixing sources to target weights with hash-threshold histograms.

Every document has a 60-bit hash of its id. The words that a source lacks after
whole copies are taken by the documents below a hash threshold of that source.
The threshold is found by histograms: words are summed by source and hash
bucket, the running sum finds the bucket in which the budget ends, and only the
documents of that boundary bucket are summed again by the next digits of the
hash, until the bucket is one hash value. No document is ever sorted.
Thresholds are nested: a larger budget keeps all documents of a smaller one.

Defined results: null text has size 0; null source is a source of its own, last
in order; documents that share a hash (a repeated id) are decided together;
null ids hash like an id of their own; a source without words gets target 0; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aulaframe.llm.common import WORD, cut, documents

#: hexadecimal digits of a hash, and digits that one histogram resolves
HASH_DIGITS, LEVEL_DIGITS = 15, 3


def hash_of(doc_id):
    """60-bit hash of an id, as a long."""
    hexed = F.substring(F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("null")).cast("binary")), 1, HASH_DIGITS)
    return F.conv(hexed, 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights=(3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Per source (columns source, source_size): weight and target.

    ``share`` times all words are shared by weight; a target stops at ``most``
    times its source's words and the excess is reshared by weight. The fixed
    point is min(cap, level * weight): ordered by cap / weight, the sources up
    to some place are at their cap and the rest share what is left. The table
    has one row per source, not per document, and so have its windows.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    t = sizes.withColumn("weight", w).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    whole = Window.partitionBy()
    t = t.withColumn("capped", F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    t = t.withColumn("open_weight", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
    t = t.withColumn("level", (F.sum("source_size").over(whole) * F.lit(float(share)) - F.col("capped")) / F.col("open_weight"))
    # the first source whose cap is not reached sets the level of the rest
    t = t.withColumn("place", F.row_number().over(order))
    level = F.min(F.when(F.col("cap") > F.col("level") * F.col("weight"), F.struct("place", "level"))).over(whole)["level"]
    return t.select("source", "source_size", "weight",
                    F.least("cap", F.coalesce(level * F.col("weight"), F.col("cap"))).alias("target"))


def _thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """(source, threshold): documents with a hash below it are taken. ``rows``:
    source, size, h; ``budgets``: source, extra."""
    state = budgets.select("source", "extra", F.lit(0).cast("long").alias("low"), F.lit(0).cast("long").alias("before"))
    for level in range(HASH_DIGITS // LEVEL_DIGITS):
        shift = 4 * (HASH_DIGITS - LEVEL_DIGITS * (level + 1))
        last = level == HASH_DIGITS // LEVEL_DIGITS - 1
        s = state.alias("s")
        inside = rows.alias("r").join(s, F.col("r.source").eqNullSafe(F.col("s.source"))
                                      & (F.shiftright("r.h", shift + 4 * LEVEL_DIGITS) == F.col("s.low")))
        hist = inside.groupBy("s.source", "s.extra", "s.before", F.shiftright("r.h", shift).alias("bucket")) \
            .agg(F.sum("r.size").alias("words"))
        run = Window.partitionBy("source").orderBy("bucket")
        hist = hist.withColumn("upto", F.col("before") + F.sum("words").over(run)) \
            .withColumn("start", F.col("upto") - F.col("words"))
        # the boundary bucket: the budget ends in it; at one hash value, it is
        # taken if that comes nearer to the budget
        if last:
            at = F.col("start") + F.col("words") / 2 > F.col("extra")
            state = hist.groupBy("source").agg(F.coalesce(F.min(F.when(at, F.col("bucket"))), F.max("bucket") + 1).alias("low"))
        else:
            state = cut(hist.filter("upto > extra").groupBy("source").agg(F.min(F.struct("bucket", "extra", "start")).alias("b"))
                        .select("source", F.col("b.extra").alias("extra"), F.col("b.bucket").alias("low"),
                                F.col("b.start").cast("long").alias("before")))
    return state.select("source", F.col("low").alias("threshold"))


def mix(docs: DataFrame, weights=(3, 1, 2), share: float = 1.5, most: float = 2.0, text: str = "text",
        doc_id: str = "doc_id", source: str = "source", keep: tuple[str, ...] = ()) -> DataFrame:
    """Per row of ``docs``: doc_id, size, source_size, target, taken (words,
    repeats counted), copies, and with ``keep`` a struct kept_columns of the
    columns named."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"),
                       F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
                       hash_of(doc_id).alias("h"), *[F.struct(*keep).alias("kept_columns")] * bool(keep))
    thin = cut(rows.select("doc_id", "source", "size", "h"))
    sizes = thin.groupBy("source").agg(F.sum("size").alias("source_size"))
    target = cut(source_targets(sizes, weights, share, most))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    target = target.withColumn("whole", whole.cast("long")) \
        .withColumn("extra", F.col("target") - F.col("whole") * F.col("source_size"))
    limit = _thresholds(thin.select("source", "size", "h"), target.filter("extra > 0"))
    plan = target.alias("t").join(limit.alias("l"), F.col("t.source").eqNullSafe(F.col("l.source")), "left") \
        .select(F.col("t.source").alias("s"), "source_size", "target", "whole", "extra", "threshold")
    # one row per source: left to the size-checked automatic broadcast. Cut, so
    # that it is shuffled by itself otherwise and the skew join can split a hot source
    plan = cut(plan)
    base = rows if keep else thin
    j = base.join(plan, F.col("source").eqNullSafe(F.col("s")))
    more = F.when(F.col("extra") > 0, F.coalesce(F.col("h") < F.col("threshold"), F.lit(True))).otherwise(False)
    copies = (F.col("whole") + more.cast("long")).alias("copies")
    j = j.withColumn("copies", copies)
    return j.select("doc_id", "size", F.col("source_size").cast("long").alias("source_size"), "target",
                    (F.col("size") * F.col("copies")).alias("taken"), "copies",
                    *["kept_columns"] * bool(keep))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 15) AS BIGINT) AS h
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY 1),
w AS (SELECT *, CAST([3, 1, 2][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)] AS DOUBLE) AS weight,
             2.0::DOUBLE * source_size AS cap FROM s),
o AS (SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
             sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight,
             sum(source_size) OVER () * 1.5::DOUBLE AS budget FROM w),
p AS (SELECT *, (budget - capped) / open_weight AS upto, row_number() OVER (ORDER BY cap / weight, source NULLS LAST) AS place FROM o),
l AS (SELECT *, (SELECT arg_min(upto, place) FROM p WHERE cap > upto * weight) AS level FROM p),
t AS (SELECT source, source_size, least(cap, coalesce(level * weight, cap)) AS target FROM l),
x AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM t),
g AS (SELECT source, h, sum(size) AS words FROM d GROUP BY 1, 2),
c AS (SELECT source, h, words, sum(words) OVER (PARTITION BY source ORDER BY h) - words AS start FROM g)
SELECT d.doc_id, d.size, x.source_size, x.target,
       CAST(d.size * (x.whole + CASE WHEN x.target - x.whole * x.source_size > 0
                      AND c.start + c.words / 2.0 <= x.target - x.whole * x.source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM d JOIN x ON d.source IS NOT DISTINCT FROM x.source
       JOIN c ON d.source IS NOT DISTINCT FROM c.source AND d.h = c.h
"""
