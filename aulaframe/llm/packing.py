"""Packing documents into fixed windows: best-fit decreasing over the corpus.

Documents are tokenised once; a document longer than a window is cut into full
windows and a rest. Best-fit decreasing only looks at piece lengths, and there
are at most ``window`` of them, so the plan is made from the histogram of
lengths: ``best_fit`` walks the lengths downwards, a segment tree indexed by
remaining capacity finds the tightest open window, and all equal pieces that
meet equal windows are placed in one step. The plan has a few thousand steps at
any corpus size (bounded by the window, not by the data). Pieces then look up
their place by their rank within their length. Ranks come from salted counts:
the rows of one length are split over about the square root of their number of
salts, so that neither a salt's rows nor a length's salts meet in a large group.

Defined results: null or empty text gives the single end id; repeated rows are
documents of their own; null ids are kept; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aulaframe.llm.common import cut, documents
from aulaframe.llm.tokens import DEFAULT_VOCABULARY, encoder

_PIECES = "doc_id long, start long, length int, ids_crc32 long, doc_tokens long, tie long"


class CapacityTree:
    """Segment tree over remaining capacities 0..n: ``tightest(c)`` is the
    smallest capacity of at least c that has an open window."""

    def __init__(self, n: int):
        self.size = 1 << max(1, n).bit_length()
        self.any = [False] * (2 * self.size)

    def mark(self, c: int, on: bool) -> None:
        i = c + self.size
        self.any[i] = on
        while i > 1:
            i //= 2
            self.any[i] = self.any[2 * i] or self.any[2 * i + 1]

    def tightest(self, c: int) -> int | None:
        i = c + self.size
        if self.any[i]:
            return c
        while i > 1:
            if i % 2 == 0 and self.any[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if self.any[2 * i] else 2 * i + 1
                return i - self.size
            i //= 2
        return None


def best_fit(counts: dict[int, int], window: int) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing of ``counts[length]`` pieces into windows. Steps
    (length, rank, n, first_window, offset): the pieces of that length with
    ranks rank..rank+n-1 go to windows first_window.. in turn, at offset."""
    tree = CapacityTree(window)
    open_at: dict[int, list[tuple[int, int]]] = {}  # capacity -> groups (first window, windows)
    steps, windows = [], 0
    for length in sorted((c for c in counts if counts[c]), reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = tree.tightest(length)
            fresh = room is None
            if fresh:
                first, have, room = windows, left, window
            else:
                first, have = open_at[room].pop()
            # a window that a piece has met is the tightest for the next equal
            # piece, until it is full: ``deep`` pieces each go to ``n`` windows
            deep = room // length
            n = min(have, left // deep)
            if not n:
                n, deep = 1, left
            if fresh:
                windows += n
            elif n < have:
                open_at[room].append((first + n, have - n))
            if not fresh and not open_at[room]:
                tree.mark(room, False)
            for layer in range(deep):
                steps.append((length, rank + layer * n, n, first, window - room + layer * length))
            rest = room - deep * length
            if rest:
                open_at.setdefault(rest, []).append((first, n))
                tree.mark(rest, True)
            rank, left = rank + deep * n, left - deep * n
    return steps


def _cut_into_pieces(vocabulary: str, end_id: int, window: int):
    def run(batches):
        enc = encoder(vocabulary)
        for b in batches:
            texts, docs, ties = b.column(0).cast(pa.binary()), b.column(1), b.column(2)
            rows = []
            for t, d, tie in zip(texts, docs.to_pylist(), ties.to_pylist()):
                ids = np.append(enc.encode(t.as_py()).astype("<u4"), np.uint32(end_id))
                for start in range(0, len(ids), window):
                    part = ids[start:start + window]
                    rows.append((d, start, len(part), zlib.crc32(part.tobytes()), len(ids), tie))
            cols = list(zip(*rows)) or [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()])],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "tie"])

    return run


def _place(steps_by_length):
    """Rank within a length -> window and offset, by binary search."""
    def run(batches):
        plan = steps_by_length.value
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            seq, off = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for size in np.unique(length):
                ranks, firsts, offsets = plan[int(size)]
                at = np.flatnonzero(length == size)
                k = np.searchsorted(ranks, rank[at], "right") - 1
                seq[at], off[at] = firsts[k] + rank[at] - ranks[k], offsets[k]
            keep = b.select(["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
            yield pa.RecordBatch.from_arrays([*keep.columns, pa.array(seq), pa.array(off)],
                                             [*keep.schema.names, "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, window: int = 2048, vocabulary: str = DEFAULT_VOCABULARY, end_id: int = 1,
         text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset."""
    spark = docs.sparkSession
    src = docs.select(F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"), F.col(doc_id).cast("long").alias("doc_id"),
                      F.monotonically_increasing_id().alias("tie"))
    pieces = cut(src.mapInArrow(_cut_into_pieces(vocabulary, end_id, window), _PIECES))
    # at most ``window`` rows, whatever the corpus
    counts = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan: dict[int, list] = {}
    for length, rank, _, first, offset in best_fit(counts, window):
        plan.setdefault(length, []).append((rank, first, offset))
    shared = spark.sparkContext.broadcast({k: tuple(np.array(c, np.int64) for c in zip(*v)) for k, v in plan.items()})
    salts = max(1, math.isqrt(max(counts.values(), default=1)))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "start", "tie"), F.lit(salts)))
    before = salted.groupBy("length", "salt").agg(F.count("*").alias("n")) \
        .withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n"))
    within = Window.partitionBy("length", "salt").orderBy("doc_id", "start", "tie")
    ranked = salted.withColumn("k", F.row_number().over(within) - 1) \
        .join(before.select("length", "salt", "before"), ["length", "salt"]) \
        .select("doc_id", F.col("start"), F.col("length").cast("long").alias("length"), "ids_crc32", "doc_tokens",
                (F.col("before") + F.col("k")).alias("rank"))
    return ranked.mapInArrow(_place(shared), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
                                             "sequence_id long, offset long")


def op1_pack_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir))
