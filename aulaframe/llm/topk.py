"""Exact top-k inner products by pivot-table elimination.

Inner products become distances: with M the largest squared norm, every
candidate x gets the extra component sqrt(M - |x|^2) and every query q a zero,
so |q' - x'|^2 = |q|^2 + M - 2 q.x, and the nearest candidates are those of the
highest inner product. Distances of all vectors to ``pivots`` pivots are
tabulated; the triangle inequality makes the largest difference over the
pivots a lower bound of each distance, that is an upper bound of the score.
Candidates are evaluated in the order of their bounds, a slice at a time,
until no remaining bound can reach the k-th score (ties included).

Queries and candidates are cut into blocks of bounded size; a task handles one
query block against one candidate block (a stated query set against all rows)
and returns k rows a query. A first pass over one candidate block a query block
gives a score that the k-th best can't fall below, so the other blocks stop
earlier.

Bounds allow for the rounding of the distances (``_ROUNDING`` of the largest
norm). Scores are exact: in doubles while the largest norm, which no sum of
products exceeds, is below 2^53, in whole numbers above.

Defined results: vectors that are null or hold null or non-finite components
take no part; every row is a query and a candidate of its own, also rows that
repeat an id, and a query never meets its own row only; ids that are null are
never queries and are ranked last among ties; a shorter vector counts as padded
with zeros; a score beyond the range of long counts as its end; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aulaframe.llm.common import cut, hash_sample, table

QUERY_BLOCK, CANDIDATE_BLOCK, PIVOTS, SLICE = 512, 2048, 48, 256
#: rounding of a squared distance, as a share of the largest squared norm and a component
_ROUNDING = 32 * 2.0 ** -53
_LONG = 2 ** 63 - 1
_FOUND = "query_row long, query_id long, vec_id long, score long"


def _matrix(vectors, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def _pivot_table(x: np.ndarray, lift: np.ndarray, pivots: np.ndarray, room: float) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest distance of lifted vectors to the pivots (whose lift is
    zero), for squares that are right within ``room``."""
    sq = (x * x).sum(1)[:, None] + (lift * lift)[:, None] + (pivots * pivots).sum(1)[None] - 2 * x @ pivots.T
    return np.sqrt(np.maximum(sq - room, 0)), np.sqrt(np.maximum(sq, 0) + room)


def _whole(x: np.ndarray, largest: float) -> np.ndarray:
    """Whole-number vectors in a type whose sums of products are exact."""
    if largest < 2.0 ** 52:
        return x
    if largest < 2.0 ** 61:
        return x.astype(np.int64)
    return np.array([[int(v) for v in row] for row in x.tolist()], object).reshape(x.shape)


def _scores(c: np.ndarray, q: np.ndarray) -> np.ndarray:
    s = c @ q
    return np.array([max(-_LONG, min(_LONG, v)) for v in s], np.int64) if s.dtype == object else s


def search_block(q_rows, q, c_rows, c_ids, c, largest: float, pivots: np.ndarray, k: int, floor=None):
    """Exact best k of a candidate block for every query; rows of the same
    number are the same row. ``floor``: per query a score that the overall k-th
    best is known to reach. Returns triples of the query's place, id and score
    and how many inner products were evaluated."""
    c_norm = (c * c).sum(1)
    room = _ROUNDING * (c.shape[1] + 8) * largest
    nearest, farthest = _pivot_table(c, np.sqrt(np.maximum(largest - c_norm, 0)), pivots, room)
    q_norm = (q * q).sum(1)
    q_nearest, q_farthest = _pivot_table(q, np.zeros(len(q)), pivots, room)
    null = np.array([i is None for i in c_ids], bool)
    ids = np.array([0 if i is None else i for i in c_ids], np.int64)
    c_rows, whole_c, whole_q = np.asarray(c_rows, np.int64), _whole(c, largest), _whole(q, largest)
    rows, evaluated = [], 0
    for i in range(len(q)):
        lower = np.maximum(nearest - q_farthest[i], q_nearest[i] - farthest).max(1)
        # upper bound of the score, with room for rounding; scores are whole numbers
        upper = np.floor((q_norm[i] + largest - np.maximum(lower, 0) ** 2) / 2 + room + 1e-3)
        order = np.argsort(-upper, kind="stable")
        least = -math.inf if floor is None else floor[i]
        scores, places = _scores(whole_c[:0], whole_q[i]), np.empty(0, np.int64)
        for at in range(0, len(order), SLICE):
            some = order[at:at + SLICE]
            some = some[upper[some] >= least]
            if not len(some):
                break
            some = some[c_rows[some] != q_rows[i]]
            evaluated += len(some)
            scores, places = np.append(scores, _scores(whole_c[some], whole_q[i])), np.append(places, some)
            if len(scores) >= k:
                best = np.lexsort((ids[places], null[places], -scores))[:k]
                scores, places = scores[best], places[best]
                least = max(least, scores[-1])
        best = np.lexsort((ids[places], null[places], -scores))[:k]
        rows += [(i, None if null[p] else int(ids[p]), int(s)) for s, p in zip(scores[best], places[best])]
    return rows, evaluated


def _task(largest: float, width: int, pivots, k: int):
    def run(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(left) and len(right):
            floor = left["floor"].fillna(-math.inf).to_numpy() if "floor" in left else None
            ids = [None if n else i for i, n in zip(right["c_id"].tolist(), right["c_null"].tolist())]
            rows, _ = search_block(left["row"].to_numpy(), _matrix(left["v"], width), right["c_row"].to_numpy(), ids, _matrix(right["c_v"], width),
                                   largest, pivots.value, k, floor)
        query, found, score = zip(*rows) if rows else ((), (), ())
        own = left[["row", "vec_id"]].to_numpy(np.int64)[np.array(query, np.int64)]
        # each column is made with its type: a null id would turn the others to floats
        return pd.DataFrame({"query_row": own[:, 0], "query_id": own[:, 1], "vec_id": pd.array(found, "Int64"), "score": np.array(score, np.int64)})

    return run


def top_k(vectors: DataFrame, is_query, k: int = 20, scale: int = 64, vec_id: str = "vec_id",
          embedding: str = "embedding", pivots: int = PIVOTS) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` highest inner products of the
    vectors floor(scale * x) for every row where ``is_query`` (a column over
    vec_id) holds."""
    spark = vectors.sparkSession
    finite = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    # a double of 2^53 and more is whole (floor gives a long, which ends at 2^63)
    floored = lambda y: F.when(F.abs(y) < 2.0 ** 53, F.floor(y).cast("double")).otherwise(y)
    src = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("e")) \
        .filter(F.col("e").isNotNull() & F.coalesce(finite, F.lit(False))) \
        .select(F.monotonically_increasing_id().alias("row"), "vec_id", F.transform("e", lambda x: floored(x * scale)).alias("v"))
    src = cut(src.withColumn("norm", F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)))
    stats = src.agg(F.count("*").alias("n"), F.max("norm").alias("m"), F.max(F.size("v")).alias("w"),
                    F.count(F.when(is_query(F.col("vec_id")), 1)).alias("q")).first()
    width, largest = int(stats.w or 1), float(stats.m or 0.0)
    # pivots: a fixed number of vectors, the first in hash order
    picked = hash_sample(src, pivots, "vec_id", "norm", total=stats.n).select("v").collect()
    table = spark.sparkContext.broadcast(_matrix([r.v for r in picked], width))
    cand_blocks = max(1, -(-stats.n // CANDIDATE_BLOCK))
    query_blocks = max(1, -(-stats.q // QUERY_BLOCK))
    cand = src.select(F.col("row").alias("c_row"), F.coalesce("vec_id", F.lit(0).cast("long")).alias("c_id"), F.col("vec_id").isNull().alias("c_null"), F.col("v").alias("c_v"), F.pmod(F.xxhash64("row"), F.lit(cand_blocks)).alias("cb"))
    query = src.filter(is_query(F.col("vec_id"))) \
        .select("row", "vec_id", "v", F.pmod(F.xxhash64("row"), F.lit(query_blocks)).alias("qb"))
    task = _task(largest, width, table, k)
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), F.col("vec_id").isNull(), "vec_id")

    # first pass: candidate block qb mod blocks; gives each query a floor
    once = query.withColumn("cb", F.pmod("qb", F.lit(cand_blocks)))
    used = cand.withColumn("qb", F.explode(F.sequence(F.col("cb"), F.greatest(F.lit(query_blocks - 1), F.col("cb")), F.lit(cand_blocks)))) \
        .filter(F.col("qb") < query_blocks)
    first = cut(once.groupBy("qb", "cb").cogroup(used.groupBy("qb", "cb")).applyInPandas(task, _FOUND))
    floor = first.withColumn("r", F.row_number().over(best)).filter(F.col("r") == k).select(F.col("query_row").alias("row"), F.col("score").cast("double").alias("floor"))
    # then all other block pairs
    others = query.join(floor, "row", "left") \
        .withColumn("cb", F.explode(F.sequence(F.lit(0), F.lit(cand_blocks - 1)))).filter(F.col("cb") != F.pmod("qb", F.lit(cand_blocks)))
    rest = cand.withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))).filter(F.col("cb") != F.pmod("qb", F.lit(cand_blocks)))
    more = others.groupBy("qb", "cb").cogroup(rest.groupBy("qb", "cb")).applyInPandas(task, _FOUND)
    return first.union(more).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")


def op8_pivot_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), lambda i: i % 20 == 0)


OP8_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
