"""Toxicity by class-conditional Kneser-Ney models.

Two interpolated Kneser-Ney models, of toxic and of ordinary text, share their
backoff. A class's bigrams back off to its words, its words to its stems of five
and of four letters (which hold the inflected forms of a rare word together),
and these to the same continuation counts for both classes (after how many
different words something was seen, in either class), so an expression that is
rare in both is no evidence. A text is
compared by its length-normalised log-likelihoods under both models, over the
whole text and over its strongest expressions, and a logistic calibration on
labelled rows that took no part in the counts turns these into a probability.

Labels are read from a bounded sample of labelled rows (``max_per_class`` of
each class in hash order); rows whose crc32(id as text) mod 5 is 0 are never
used. Words are hashed to fixed tables, so the model that is sent to the tasks
has a fixed size. Every whole text is scored; label, language, source and id
are no inputs of a score.

Defined results: null or empty text has no evidence and gets the score of the
calibration's zero; without labels of both classes every score is 0; several
labels of an id count as the highest; a null id is never held out; repeated rows
get equal scores; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aulaframe.llm.common import cut, documents, hash_sample, labels

WORDS, PAIRS = 1 << 18, 1 << 20
DISCOUNT, MAX_PER_CLASS, EVIDENCE = 0.75, 6000, 5
_WORD = re.compile(r"[^\W\d_]+")


def fold(doc_id):
    """crc32 of the id as text, modulo 5; a null id counts as 1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5, F.lit(1))


class _Buckets(dict):
    """Word -> buckets of the word and of its stems, packed into one integer."""

    def __missing__(self, word: str) -> int:
        w, five, four = (xxhash.xxh64_intdigest(x.encode()) % WORDS for x in (word, word[:5], word[:4]))
        packed = w + (five + four * WORDS) * WORDS
        if len(self) < 400_000:
            self[word] = packed
        return packed


def words_of(text: str, buckets: dict) -> np.ndarray:
    words = _WORD.findall(text.lower())
    return np.fromiter(map(buckets.__getitem__, words), np.int64, len(words))


def _pair(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    h = (v * WORDS + w).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (h >> np.uint64(44)).astype(np.int64)  # 20 bits: PAIRS


def _count(batches):
    """Counts within a task: packed words (pair false) and pairs of word
    buckets (pair true), by class."""
    buckets = _Buckets()
    for b in batches:
        found: dict = {}
        for text, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            w = words_of(text, buckets)
            found.setdefault((toxic, False), []).append(w)
            found.setdefault((toxic, True), []).append((w[:-1] % WORDS) * WORDS + w[1:] % WORDS)
        for (toxic, pair), keys in found.items():
            k, c = np.unique(np.concatenate(keys), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(k), toxic)), pa.array([pair] * len(k), pa.bool_()), pa.array(k), pa.array(c.astype(np.int64))],
                ["toxic", "pair", "k", "c"])


class KneserNey:
    """Log-likelihood ratios toxic : ordinary, from fixed-size tables. ``levels``:
    counts of words, five-letter and four-letter stems, each (2, WORDS);
    ``continuation``: shared continuation counts of words."""

    def __init__(self, levels, pair, context, followers, continuation, shared5, shared4):
        total = np.maximum(levels[0].sum(1, keepdims=True), 1)
        self.own = [(np.maximum(c - DISCOUNT, 0) / total).astype(np.float32) for c in levels]
        self.open = [(DISCOUNT * (c > 0).sum(1, keepdims=True) / total)[:, 0] if c.any() else np.ones(2) for c in levels]
        self.shared = [((c + 0.5) / (c.sum() + 0.5 * WORDS)).astype(np.float32) for c in (continuation, shared5, shared4)]
        self.left = np.where(context > 0, DISCOUNT * followers / np.maximum(context, 1), 1.0).astype(np.float32)
        # tables are gathered at random; single precision halves the traffic
        self.pair, self.context = pair.astype(np.float32), np.maximum(context, 1).astype(np.float32)

    def words(self, packed: np.ndarray) -> list[np.ndarray]:
        """Probabilities of the words under the ordinary and the toxic model."""
        places = packed % WORDS, packed // WORDS % WORDS, packed // WORDS // WORDS
        word, five, four = (s[p] for s, p in zip(self.shared, places))
        out = []
        for k in (0, 1):
            p = self.own[2][k][places[2]] + self.open[2][k] * four
            p = self.own[1][k][places[1]] + self.open[1][k] * p * np.minimum(five / four, 1)
            out.append(self.own[0][k][places[0]] + self.open[0][k] * p * np.minimum(word / five, 1))
        return out

    def evidence(self, packed: np.ndarray) -> tuple[float, ...]:
        """Length-normalised ratio of the text, and of its strongest words."""
        if not len(packed):
            return (0.0,) * EVIDENCE
        p = self.words(packed)
        alone = np.log(p[1] / p[0])
        r = alone.copy()
        if len(packed) > 1:
            w = packed % WORDS
            v, h = w[:-1], _pair(w[:-1], w[1:])
            both = [np.maximum(self.pair[k][h] - DISCOUNT, 0) / self.context[k][v] + self.left[k][v] * p[k][1:] for k in (0, 1)]
            r[1:] = np.log(both[1] / both[0])
        u = np.sort(alone)[::-1][:4]
        return float(r.mean()), float(u[0]), float(u[:2].mean()), float(u.sum() / 4), float(np.log1p(len(packed)))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Newton steps of a ridge logistic regression; x with a column of ones."""
    b = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        g = x.T @ (weight * (y - p)) - penalty * b
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9), g)
        b += step
        if np.abs(step).max() < 1e-6:
            break
    return b


def _table(df: DataFrame, shape, *keys: str) -> np.ndarray:
    """A grouped table of at most ``prod(shape)`` rows as an array."""
    t, out = df.toArrow(), np.zeros(shape)
    out[tuple(t.column(k).to_numpy() for k in keys)] = t.column("c").to_numpy()
    return out


def fit(docs: DataFrame, marks: DataFrame, text: str = "text", doc_id: str = "doc_id", max_per_class: int = MAX_PER_CLASS):
    """(model, calibration weights), or None without labels of both classes."""
    spark = docs.sparkSession
    known = marks.filter("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").cast("long").alias("toxic")) \
        .withColumn("fold", fold("doc_id")).filter("fold <> 0")
    known = cut(known)
    all_of = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(all_of) < 2:
        return None
    some = [hash_sample(known.filter(F.col("toxic") == k), max_per_class, "doc_id", total=all_of[k]) for k in (0, 1)]
    # at most 2 * max_per_class rows of three numbers
    sample = cut(some[0].union(some[1])).withColumnRenamed("doc_id", "labelled")
    rows = docs.select(F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"), F.col(doc_id).cast("long").alias("d")) \
        .join(F.broadcast(sample), F.col("d") == F.col("labelled")).select("text", "toxic", "fold")
    counted = cut(rows.filter("fold <> 1").select("text", "toxic").mapInArrow(_count, "toxic long, pair boolean, k long, c long")
                  .groupBy("toxic", "pair", "k").agg(F.sum("c").alias("c")))
    single, pairs = counted.filter("not pair"), counted.filter("pair")
    part = lambda level: F.pmod(F.floor(F.col("k") / float(WORDS ** level)), F.lit(WORDS)).alias("w")
    v, w = F.floor(F.col("k") / float(WORDS)).alias("w"), F.pmod("k", F.lit(WORDS)).alias("w")
    sized = lambda df, *by: _table(df.groupBy("toxic", *by).agg(F.sum("c").alias("c")), (2, WORDS), "toxic", "w")
    types = lambda df, by: _table(df.select("k", by).distinct().groupBy("w").agg(F.count("*").alias("c")), (WORDS,), "w")
    levels = [sized(single, part(level)) for level in range(3)]
    followers = _table(pairs.groupBy("toxic", v).agg(F.count("*").alias("c")), (2, WORDS), "toxic", "w")
    # stems have no pairs of their own: their continuation is their different words
    tables = levels, sized(pairs, v), followers, types(pairs, w), types(single, part(1)), types(single, part(2))

    def hashed(batches):
        for b in batches:
            k = b.column(1).to_numpy()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(_pair(k // WORDS, k % WORDS)), b.column(2)], ["toxic", "h", "c"])

    pair = _table(pairs.select("toxic", "k", "c").mapInArrow(hashed, "toxic long, h long, c long")
                  .groupBy("toxic", "h").agg(F.sum("c").alias("c")), (2, PAIRS), "toxic", "h")
    model = KneserNey(tables[0], pair, *tables[1:])
    shared = spark.sparkContext.broadcast(model)

    def told(batches):
        buckets = _Buckets()
        for b in batches:
            e = [shared.value.evidence(words_of(t, buckets)) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(e, pa.list_(pa.float64()))], ["toxic", "e"])

    t = rows.filter("fold = 1").select("text", "toxic").mapInArrow(told, "toxic long, e array<double>").toArrow()
    x = np.array([[*e, 1.0] for e in t.column("e").to_pylist()]).reshape(-1, EVIDENCE + 1)
    y = t.column("toxic").to_numpy().astype(float)
    if len(set(y)) < 2:
        return shared, np.array([1.0, 1.0, 0, 0, 0, -3.0])
    weight = np.array([all_of[k] / min(all_of[k], max_per_class) for k in (0, 1)])[y.astype(int)]
    return shared, _logistic(x, y, weight)


def score(docs: DataFrame, fitted, text: str = "text", doc_id: str = "doc_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, held_out, score, predicted, and with ``keep`` a struct
    kept_columns of the columns named."""
    shared, b = fitted if fitted else (None, None)

    def run(batches):
        buckets = _Buckets()
        for batch in batches:
            out = []
            for t in batch.column(0).to_pylist():
                x = np.array([*shared.value.evidence(words_of(t, buckets)), 1.0]) if shared else None
                out.append(0.0 if x is None else float(1 / (1 + np.exp(-np.clip(x @ b, -500, 500)))))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(out, pa.float64())], [*batch.schema.names[1:], "score"])

    src = docs.select(F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"), F.col(doc_id).alias("doc_id"),
                      (fold(doc_id) == 0).alias("held_out"), *[F.struct(*keep).alias("kept_columns")] * bool(keep))
    scored = src.mapInArrow(run, src.drop("_text").schema.add("score", "double"))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
                         *["kept_columns"] * bool(keep))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return score(docs, fit(docs, labels(spark, sf_dir)))
