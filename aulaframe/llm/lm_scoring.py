r"""Language-model scores by a hashed maximum-entropy model.

P(word | history) = P(class | history) * P(word | class). The class factor is a
softmax over ``CLASSES`` classes with hashed indicator features: a bias, the
previous word (hashed to ``H1`` buckets), the class of the word before it (a
skip feature) and both together (an n-gram feature hashed to ``H12`` buckets).
The word factor has the word's own feature; its maximum-entropy optimum is the
relative frequency, discounted so that words without counts get the rest.
Classes: the most frequent words stand alone, all others share the class of
their shape (last letter and trailing punctuation), so unseen words have one.

Training is distributed: the word counts cover all training texts; every shard
of the corpus (about ``SHARD_TOKENS`` tokens, so shards grow with the input)
aggregates its contexts, makes preconditioned gradient updates on them, and
returns its weights, which are averaged by how often their feature was seen.
Scoring gathers class probabilities for whole batches of tokens with numpy. The
``TOP`` most frequent words travel to the tasks; the others meet their counts
in a shuffle join, so nothing that grows with the vocabulary is broadcast.

Words are keyed by 63-bit hashes. Defined results: null text is empty (its end
token only); a null id is a training row; repeated rows count and score each;
without training tokens the base and model scores use empty counts; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aulaframe.llm.common import Landed, cut, documents

SINGLES, SHAPES, H1, H12 = 40, 56, 768, 8192
CLASSES = SINGLES + SHAPES
TOP, SHARD_TOKENS, STEPS, BLOCK = 1 << 18, 4_000_000, 15, 256
FEATURES = H1 + CLASSES + H12 + 1
END = b""  # no word is empty
_UPPER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def shape_of(word: bytes) -> int:
    """Class of words by shape: last letter (the last byte that isn't ASCII
    punctuation) and whether punctuation follows."""
    core = word.rstrip(b".,;:!?*#$%&|)\"'")
    last = core[-1] if core else 0
    return (last * 2 + (len(core) < len(word))) * 2654435761 % (1 << 32) % SHAPES


def key_of(word: bytes) -> int:
    """63-bit key of a word; its low 6 bits are the shape."""
    return (xxhash.xxh64_intdigest(word) >> 1) & ~63 | shape_of(word)


def tokens_of(text: bytes) -> list[bytes]:
    return text.translate(_UPPER).split() + [END]


def _count_words(batches):
    """Word counts of training texts within a task, flushed at a bound."""
    counts, n = Counter(), 0

    def flush():
        keys = np.fromiter(map(key_of, counts), np.int64, len(counts))
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.fromiter(counts.values(), np.int64, len(counts)))], ["key", "c"])

    for b in batches:
        for t in b.column(0).cast(pa.binary()):
            counts.update(tokens_of(t.as_py()))
        if len(counts) > 500_000:
            yield flush()
            counts.clear()
    if counts:
        yield flush()


class Vocabulary:
    """The most frequent words by key: counts, classes and history buckets."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.keys, self.counts = keys, counts  # by falling count
        self.place = {int(k): i for i, k in enumerate(keys)}
        self.cls = np.where(np.arange(len(keys)) < SINGLES, np.arange(len(keys)), SINGLES + (keys & 63)).astype(np.int64)


class _Codes(dict):
    """Word -> place among the frequent words, or -1 - key."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.place = vocabulary.place

    def __missing__(self, word: bytes) -> int:
        key = key_of(word)
        code = self.place.get(key, -1 - key)
        if len(self) < 500_000:
            self[word] = code
        return code


_VOCABULARIES: dict[str, Vocabulary] = {}


def _vocabulary(shared) -> Vocabulary:
    """Built once in a worker from the broadcast arrays."""
    tag, keys, counts = shared.value
    if tag not in _VOCABULARIES:
        _VOCABULARIES.clear()
        _VOCABULARIES[tag] = Vocabulary(keys, counts)
    return _VOCABULARIES[tag]


def contexts_of(code: np.ndarray, voc: Vocabulary, starts: np.ndarray):
    """Per token its class and context (hashed previous word, class before).
    ``starts``: places of the first token of each text."""
    rare = code < 0
    cls = np.where(rare, SINGLES + ((-1 - code) & 63), voc.cls[np.where(rare, 0, code)] if len(voc.cls) else 0)
    h1 = np.where(rare, H1 // 2 + ((-1 - code) >> 6) % (H1 - H1 // 2 - 1), np.where(code < H1 // 2, code, H1 // 2 + code % (H1 - H1 // 2 - 1)))
    p1 = np.empty_like(h1)
    p1[1:] = h1[:-1]
    p2 = np.empty_like(cls)
    p2[2:] = cls[:-2]
    p1[starts] = H1 - 1  # the start of a text
    p2[starts] = 0
    second = starts + 1
    p2[second[second < len(p2)]] = 0
    return cls, p1 * CLASSES + p2


def _features(ctx: np.ndarray):
    h1, c2 = ctx // CLASSES, ctx % CLASSES
    return h1, H1 + c2, H1 + CLASSES + (ctx * 2654435761 >> 7) % H12


def log_softmax(w: np.ndarray, ctx: np.ndarray) -> np.ndarray:
    """Log class probabilities, one row a context."""
    a, b, c = _features(ctx)
    z = w[a] + w[b] + w[c] + w[FEATURES - 1]
    z -= z.max(1, keepdims=True)
    return z - np.log(np.exp(z).sum(1, keepdims=True))


def train(counts: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Weights and feature counts from a table contexts x classes. Each step
    moves every weight along its gradient, scaled by the expected count (a
    diagonal approximation of the curvature), with a prior towards zero."""
    ctx = np.flatnonzero(counts.any(1))
    n = counts[ctx].astype(np.float32)
    total = n.sum(1, keepdims=True)
    w = np.zeros((FEATURES, CLASSES), np.float32)
    parts = _features(ctx)
    orders = [(np.argsort(p, kind="stable"), *np.unique(p, return_index=False, return_counts=True)) for p in parts]
    seen = np.zeros(FEATURES)

    def gather(x):
        out = np.zeros((FEATURES, x.shape[1]), np.float32)
        for order, ids, have in orders:
            out[ids] = np.add.reduceat(x[order], np.concatenate([[0], np.cumsum(have)[:-1]]), axis=0)
        out[-1] = x.sum(0)
        return out

    seen = gather(total)[:, 0].astype(float)
    observed = gather(n)
    w[-1] = np.log((observed[-1] + 0.5) / (observed[-1].sum() + 0.5 * CLASSES))
    for _ in range(steps):
        expected = gather(np.exp(log_softmax(w, ctx)) * total)
        w += 0.4 * np.clip((observed - expected - 0.5 * w) / (expected + 0.5 * observed + 2.0), -2.5, 2.5)
    return w, seen


def _train_shard(shared):
    def run(batches):
        voc = _vocabulary(shared)
        codes = _Codes(voc)
        size = H1 * CLASSES * CLASSES
        counts, held, n = np.zeros(size, np.int32), [], 0

        def add():
            nonlocal counts
            counts += np.bincount(np.concatenate(held), minlength=size).astype(np.int32)

        for b in batches:
            code, starts = _batch_codes(b.column(0).cast(pa.binary()), codes)
            if not len(code):
                continue
            cls, ctx = contexts_of(code, voc, starts)
            held.append(ctx * CLASSES + cls)
            n += len(code)
            if sum(map(len, held)) > 2_000_000:
                add()
                held = []
        if held:
            add()
        if n:
            w, seen = train(counts.reshape(-1, CLASSES))
            for low in range(0, FEATURES, BLOCK):
                s = seen[low:low + BLOCK]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([low], pa.int32()), pa.array([(w[low:low + BLOCK] * s[:, None]).astype(np.float32).tobytes()]),
                     pa.array([s.tobytes()])], ["low", "w", "n"])

    return run


def _average(pdf: pd.DataFrame) -> pd.DataFrame:
    """Weights of one block of features, averaged by feature counts."""
    w = sum(np.frombuffer(x, np.float32).astype(float) for x in pdf["w"])
    n = sum(np.frombuffer(x, float) for x in pdf["n"])
    w = w.reshape(len(n), CLASSES) / np.maximum(n, 1)[:, None]
    return pd.DataFrame({"low": [pdf["low"].iloc[0]], "w": [w.astype(np.float32).tobytes()]})


def _batch_codes(texts, codes) -> tuple[np.ndarray, np.ndarray]:
    parts, starts, at = [], [], 0
    for t in texts:
        tokens = tokens_of(t.as_py())
        parts.append(np.fromiter(map(codes.__getitem__, tokens), np.int64, len(tokens)))
        starts.append(at)
        at += len(tokens)
    return (np.concatenate(parts) if parts else np.empty(0, np.int64)), np.array(starts, np.int64)


_TABLES: dict[str, np.ndarray] = {}


def _class_table(shared) -> np.ndarray:
    """log10 P(class | context) for every context, built once in a worker."""
    tag = shared.value["tag"]
    if tag not in _TABLES:
        _TABLES.clear()
        table = np.empty((H1 * CLASSES, CLASSES), np.float32)
        for low in range(0, len(table), 8192):
            table[low:low + 8192] = log_softmax(shared.value["w"], np.arange(low, min(low + 8192, len(table)))) / np.log(10)
        _TABLES[tag] = table
    return _TABLES[tag]


def _score(shared_voc, shared):
    def run(batches):
        voc, table, m = _vocabulary(shared_voc), _class_table(shared), shared.value
        codes = _Codes(voc)
        base_of = np.log10((voc.counts + 0.5) / m["base_total"]) if len(voc.counts) else np.zeros(1)
        word_of = np.log10((voc.counts - m["discount"]) / m["mass"][voc.cls]) if len(voc.counts) else np.zeros(1)
        for b in batches:
            code, starts = _batch_codes(b.column(0).cast(pa.binary()), codes)
            k = len(starts)
            cls, ctx = contexts_of(code, voc, starts) if k else (code, code)
            rare = code < 0
            place = np.where(rare, 0, code)
            logp = table[ctx, cls].astype(float) + np.where(rare, 0, word_of[place])
            add = lambda x: np.add.reduceat(x, starts) if k else np.empty(0)
            n = np.diff(np.append(starts, len(code)))
            rare_keys = -1 - code[rare]
            offsets = np.concatenate([[0], np.cumsum(add(rare.astype(np.int64)))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[1:], pa.array(n), pa.array(add((~rare).astype(np.int64)).astype(np.int64)),
                 pa.array(add(np.where(rare, 0, base_of[place])), pa.float64()), pa.array(add(logp), pa.float64()),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(rare_keys))],
                ["row", "doc_id", "held_out", "n_tokens", "n_top", "base_top", "score_top", "rare"])

    return run


def _most_frequent(words: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Keys and counts of at most TOP words, by falling count: those above the
    smallest step of a histogram of counts (a few hundred steps) that leaves
    so few."""
    step = F.when(F.col("c") < 64, F.col("c")).otherwise(F.floor(F.log2(F.col("c").cast("double")) * 32))  # 64: 192
    steps = sorted(((r.step, r.n) for r in words.groupBy(step.alias("step")).agg(F.count("*").alias("n")).collect()), reverse=True)
    left, least = TOP, None
    for s, n in steps:
        if n > left:
            break
        left, least = left - n, s
    some = words.filter(step >= least) if least is not None else words.limit(0)
    t = some.select("key", "c").toArrow()
    keys, counts = t.column("key").to_numpy(), t.column("c").to_numpy()
    order = np.lexsort((keys, -counts))
    return keys[order], counts[order]


def lm_scores(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    held_out = F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 1, F.lit(False))
    src = docs.select(F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"), F.monotonically_increasing_id().alias("row"),
                      F.col(doc_id).cast("long").alias("doc_id"), held_out.alias("held_out"))
    training = src.filter("not held_out").select("text")
    with Landed(training.mapInArrow(_count_words, "key long, c long").groupBy("key").agg(F.sum("c").alias("c")), "words") as words:
        keys, counts = _most_frequent(words)
        singles = set(keys[:SINGLES].tolist())
        # one row a class
        shape = F.when(F.col("key").isin(list(singles)), -1).otherwise(F.col("key").bitwiseAND(F.lit(63)))
        per = words.groupBy(shape.alias("shape")).agg(F.sum("c").alias("mass"), F.count("*").alias("types"),
                                                      F.count(F.when(F.col("c") == 1, 1)).alias("n1"), F.count(F.when(F.col("c") == 2, 1)).alias("n2")).collect()
        n_all, v = sum(r.mass for r in per), sum(r.types for r in per)
        n1, n2 = sum(r.n1 for r in per), sum(r.n2 for r in per)
        discount = min(0.95, max(0.1, n1 / (n1 + 2 * n2) if n1 else 0.5))
        mass, types = np.ones(CLASSES), np.ones(CLASSES)
        for r in per:
            if r.shape >= 0:
                mass[SINGLES + r.shape], types[SINGLES + r.shape] = r.mass, r.types
        alone = counts[:SINGLES].astype(float)
        mass[:len(alone)] = alone
        # a word that stands alone keeps the mass of its discount for nothing else
        mass[:len(alone)] -= discount

        shared_voc = spark.sparkContext.broadcast((uuid.uuid4().hex, keys, counts))
        shards = max(1, min(src.rdd.getNumPartitions(), int(n_all // SHARD_TOKENS)))
        trained = training.coalesce(shards).mapInArrow(_train_shard(shared_voc), "low int, w binary, n binary")
        blocks = trained.groupBy("low").applyInPandas(_average, "low int, w binary").collect()  # FEATURES / BLOCK rows
        w = np.zeros((FEATURES, CLASSES), np.float32)
        for r in blocks:
            got = np.frombuffer(r.w, np.float32).reshape(-1, CLASSES)
            w[r.low:r.low + len(got)] = got
        total = n_all + 0.5 * (v + 1)
        model = spark.sparkContext.broadcast({"tag": uuid.uuid4().hex, "w": w, "mass": mass, "discount": discount, "base_total": total})

        rows = src.mapInArrow(_score(shared_voc, model), "row long, doc_id long, held_out boolean, n_tokens long, n_top long, "
                                                        "base_top double, score_top double, rare array<long>")
        with Landed(rows, "scored") as scored:
            unknown = F.element_at(F.array(*[F.lit(float(x)) for x in np.log10(discount * np.maximum(types, 1) / np.maximum(mass, 1))[SINGLES:]]),
                                   (F.col("key").bitwiseAND(F.lit(63)) + 1).cast("int"))
            within = F.element_at(F.array(*[F.lit(float(x)) for x in np.log10(np.maximum(mass, 1))[SINGLES:]]),
                                  (F.col("key").bitwiseAND(F.lit(63)) + 1).cast("int"))
            rare = scored.select("row", F.explode("rare").alias("key")).groupBy("row", "key").agg(F.count("*").alias("tf"))
            known = F.col("c").isNotNull()
            told = rare.join(words.select("key", "c"), "key", "left").groupBy("row").agg(
                F.sum(F.when(known, F.col("tf")).otherwise(0)).alias("n_rare"),
                F.sum(F.col("tf") * F.log10((F.coalesce("c", F.lit(0)) + 0.5) / total)).alias("base_rare"),
                F.sum(F.col("tf") * F.when(known, F.log10(F.col("c") - discount) - within).otherwise(unknown)).alias("score_rare"))
            out = scored.drop("rare").join(told, "row", "left").select(
                "doc_id", "held_out", "n_tokens", (F.col("n_top") + F.coalesce("n_rare", F.lit(0))).alias("n_known"),
                F.lit(int(n_all)).cast("long").alias("train_tokens"),
                (F.col("base_top") + F.coalesce("base_rare", F.lit(0.0))).alias("base_score"),
                (F.col("score_top") + F.coalesce("score_rare", F.lit(0.0))).alias("score"))
            return cut(out)


def op6_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(documents(spark, sf_dir))
