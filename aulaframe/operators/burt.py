"""FAMD of variables with any number of levels, on the table of level pairs.

The encoded matrix X is that of ``factor``: z-scores of the numeric variables,
and for a level a with share p = n_a / n_i of the rows that have its variable
(1 - p) / sqrt(p) or -sqrt(p). A missing value stands at the mean, 0. One
feature is a level or a numeric variable; none gets a column.

How often two features meet (sums of products for numeric ones) is the matrix M.
Variables whose levels together have at most ``NARROW`` places are narrow, the
others wide. A task keeps the part of M among narrow features, numeric variables
and "has wide variable j" as a matrix of fixed size, so a row adds to it and isn't
exploded. For a wide variable the rows are dealt and sorted by its level, each level
leaves one row of M against those same features, and two wide variables are grouped
by their pairs of levels. With w_a = 1 / sqrt(p_a), s_a = sqrt(p_a) (numeric: 1 and
0), E_aj the rows of a that have variable j, and N_ij those that have i and j, the
covariance G = X'X / n acts on vectors V as

    n (G V)_a = w_a sum_b M_ab w_b V_b - w_a sum_j E_aj S_j + s_a (sum_j N_ij S_j - R_i)
    S_j = sum of s_b V_b over the levels of j,  R_i = sum_b E_bi w_b V_b

so no centred table of level pairs is made, and the data isn't read again. Block
subspace iteration finds the largest eigenvalues: V is a small matrix for the narrow
features and a table with one short array per wide level; each round is one pass over
that table (joined to the pairs of wide variables, where there are two or more), which
leaves the sums of its products (block width x narrow features) for the next. A round
is a written table, the one before is removed. Without wide variables the rounds need
no table.

Results: ``residual`` is |G v - eigenvalue v|, so an eigenvalue of G lies within
that distance; rounds end when the first ``k`` residuals are below ``tol`` times
their eigenvalue, or after ``max_rounds``. Directions are fixed up to the order
of equal eigenvalues; the loading of greatest magnitude is positive. A numeric
variable without variance and a categorical one without a value add nothing. A
table without rows raises.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aulaframe.operators.ranking import cut
from aulaframe.session import scratch_path

NARROW = 2048       # levels of all narrow variables together
CHUNK_ROWS = 1 << 16


@dataclass
class WideModel:
    num: list[str]
    cat: list[str]
    eigenvalues: list[float]
    residuals: list[float]
    total_inertia: float
    features: int
    rounds: int
    moments: dict[str, tuple[float, float]]  # numeric variable -> mean, population sd
    loadings: DataFrame                      # variable, level, weight, loading array<double>
    centres: dict[str, list[float]]          # categorical variable -> sum of s_a times loading


def _add(terms: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, terms, F.lit(0.0))


class _Rounds:
    """The table of each round, written in the shared folder. (A checkpoint would
    hand the constraints of all earlier rounds on to the next plan.) The folders
    are removed in the end."""

    def __init__(self, spark):
        self.spark, self.paths = spark, []

    def write(self, df: DataFrame) -> DataFrame:
        self.paths.append(scratch_path(self.spark, "famd-round"))
        df.write.parquet(self.paths[-1])
        return self.spark.read.schema(df.schema).parquet(self.paths[-1])

    def advance(self, df: DataFrame) -> DataFrame:
        """Writes a table that takes the place of the last one."""
        out = self.write(df)
        self._delete(self.paths.pop(-2))
        return out

    def _delete(self, p: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def __enter__(self):
        return self

    def __exit__(self, *_) -> None:
        for p in self.paths:
            self._delete(p)


def _combine(column: str, matrix: np.ndarray) -> Column:
    """The array ``column`` times a small matrix. The matrix is one array
    literal, so the rounds of an iteration share their generated code."""
    if not matrix.size:
        return F.lit([0.0] * matrix.shape[1]).cast("array<double>")
    product = lambda col: F.aggregate(F.zip_with(column, col, lambda x, y: x * y), F.lit(0.0), lambda x, y: x + y)
    return F.transform(F.lit(matrix.T.tolist()), product)


def _level_counts(df: DataFrame, cat: Sequence[str]) -> DataFrame:
    """v, l, own: rows of each level. Variables are named by their place in cat."""
    own = F.inline(F.array(*[F.struct(F.lit(i).alias("v"), F.col(c).cast("string").alias("l")) for i, c in enumerate(cat)]))
    return df.select(own).filter("l IS NOT NULL").groupBy("v", "l").agg(F.count(F.lit(1)).cast("double").alias("own"))


def _coded(df: DataFrame, num: Sequence[str], cat: Sequence[str], moments: dict[str, tuple[float, float]],
           places: dict[int, list[str]], wide: Sequence[int]) -> DataFrame:
    """c<i>: place of the row's level in a narrow variable's list (its length:
    missing); z<j>: z-scores, then 1.0 or 0.0 for each wide variable the row has;
    l<i>: levels of wide variables."""
    out = df.select(*[F.col(c).cast("string").alias(f"l{i}") for i, c in enumerate(cat)], *[
        (F.coalesce((F.col(c).cast("double") - F.lit(moments[c][0])) / F.lit(moments[c][1]), F.lit(0.0)) if moments[c][1] > 0 else F.lit(0.0)).alias(f"z{j}")
        for j, c in enumerate(num)])
    for i, own in places.items():
        look = df.sparkSession.createDataFrame(list(zip(own, range(len(own)))), f"l{i} string, p{i} int")
        out = out.join(F.broadcast(look), f"l{i}", "left")
    return out.select(*[f"l{i}" for i in wide], *[F.coalesce(f"p{i}", F.lit(len(own))).alias(f"c{i}") for i, own in places.items()],
                      *[f"z{j}" for j in range(len(num))], *[F.col(f"l{i}").isNotNull().cast("double").alias(f"z{len(num) + k}") for k, i in enumerate(wide)])


def _lists(at: np.ndarray, m: np.ndarray, lengths: np.ndarray) -> list[pa.Array]:
    ends = pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32())
    return [pa.ListArray.from_arrays(ends, pa.array(at, pa.int32())), pa.ListArray.from_arrays(ends, pa.array(m, pa.float64()))]


def _cells(key: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys below ``size`` and how often each comes."""
    if size > 64 * CHUNK_ROWS:
        return np.unique(key, return_counts=True)
    c = np.bincount(key, minlength=size)
    at = np.flatnonzero(c)
    return at, c[at]


def _count_features(sizes: Sequence[int], values: int, narrow_too: bool):
    """Rows l, c.., z.. -> l, f, at, m: a row of M for each level l (f = -1), and
    with ``narrow_too`` the rows f of this task's part of M among the narrow
    features (at >= f). A task holds a chunk of rows, that part, and the sums of the
    level its last chunk ended in, whose rows may go on."""
    first = np.concatenate([[0], np.cumsum(sizes)]).astype(int)
    width = int(first[-1]) + values
    out = pa.schema([("l", pa.string()), ("f", pa.int32()), ("at", pa.list_(pa.int32())), ("m", pa.list_(pa.float64()))])

    def of_levels(t: pa.Table, codes: list, z: np.ndarray, held):
        found = pc.dictionary_encode(t["l"].combine_chunks())
        names, lev = found.dictionary.to_pylist(), pc.fill_null(found.indices, -1).to_numpy().astype(np.int64)
        has = lev >= 0
        if not has.any():
            return None, held
        at, m, of = [], [], []
        for i, k in enumerate(sizes):
            use = has & (codes[i] < k)
            key, c = _cells(lev[use] * k + codes[i][use], len(names) * k)
            of.append(key // max(k, 1)), at.append(first[i] + key % max(k, 1)), m.append(c.astype(float))
        for j in range(values):
            c = np.bincount(lev[has], weights=z[j][has], minlength=len(names))
            own = np.flatnonzero(c)
            of.append(own), at.append(np.full(len(own), first[-1] + j)), m.append(c[own])
        last = int(lev[has][-1])
        if held:
            if held[0] not in names:
                names.append(held[0])
            own = np.flatnonzero(held[1])
            of.append(np.full(len(own), names.index(held[0]))), at.append(own), m.append(held[1][own])
        of, at, m = np.concatenate(of), np.concatenate(at), np.concatenate(m)
        held = (names[last], np.bincount(at[of == last], weights=m[of == last], minlength=width))
        of, at, m = of[of != last], at[of != last], m[of != last]
        order = np.argsort(of, kind="stable")
        lengths = np.bincount(of, minlength=len(names))
        done = np.flatnonzero(lengths)
        return pa.record_batch([pa.array([names[i] for i in done], pa.string()), pa.array(np.full(len(done), -1), pa.int32()),
                                *_lists(at[order], m[order], lengths[done])], schema=out), held

    def run(batches):
        pairs = {(i, j): np.zeros((a + 1) * (sizes[j] + 1)) for i, a in enumerate(sizes) for j in range(i, len(sizes)) if narrow_too}
        mixed, square, held = [np.zeros((a + 1, values)) for a in sizes], np.zeros((values, values)), None

        def chunks():
            kept, rows = [], 0
            for b in batches:
                kept, rows = [*kept, b], rows + b.num_rows
                if rows >= CHUNK_ROWS:
                    yield pa.Table.from_batches(kept)
                    kept, rows = [], 0
            if rows:
                yield pa.Table.from_batches(kept)

        for t in chunks():
            codes = [t[1 + i].to_numpy().astype(np.int64) for i in range(len(sizes))]
            z = [t[1 + len(sizes) + j].to_numpy() for j in range(values)]
            for (i, j), c in pairs.items():
                c += np.bincount(codes[i] * (sizes[j] + 1) + codes[j], minlength=len(c))
            if narrow_too:
                for i, a in enumerate(sizes):
                    for j in range(values):
                        mixed[i][:, j] += np.bincount(codes[i], weights=z[j], minlength=a + 1)
                if values:
                    rows = np.stack(z)
                    square += rows @ rows.T
            if t["l"].null_count < t.num_rows:
                done, held = of_levels(t, codes, z, held)
                if done is not None:
                    yield done
        if held:
            at = np.flatnonzero(held[1])
            yield pa.record_batch([pa.array([held[0]], pa.string()), pa.array([-1], pa.int32()), *_lists(at, held[1][at], np.array([len(at)]))], schema=out)
        if narrow_too:
            whole = np.zeros((width, width))
            for (i, j), c in pairs.items():
                whole[first[i]:first[i + 1], first[j]:first[j + 1]] = c.reshape(sizes[i] + 1, sizes[j] + 1)[:-1, :-1]
            for i in range(len(sizes)):
                whole[first[i]:first[i + 1], first[-1]:] = mixed[i][:-1]
            whole[first[-1]:, first[-1]:] = np.triu(square)
            f, at = np.nonzero(whole)
            yield pa.record_batch([pa.nulls(len(own := np.unique(f)), pa.string()), pa.array(own, pa.int32()),
                                   *_lists(at, whole[f, at], np.bincount(f, minlength=width)[own])], schema=out)

    return run


def _feature_rows(coded: DataFrame, sizes: Sequence[int], values: int, wide: Sequence[int], tables: _Rounds) -> tuple[np.ndarray, DataFrame | None]:
    """M among the narrow features (``NARROW`` and the variables bound its size), and
    v, l, at, m: its rows for wide levels."""
    kept = [c for c in coded.columns if not c.startswith("l")]
    pieces = []
    for k, i in enumerate(wide or [None]):
        rows = coded.select((F.lit(None).cast("string") if i is None else F.col(f"l{i}")).alias("l"), *kept)
        if i is not None:
            # rows without the level go anywhere; AQE splits the partition of a frequent one
            key = F.when(F.col("l").isNotNull(), F.xxhash64("l")).otherwise(F.xxhash64(*kept) if kept else F.lit(0))
            rows = rows.withColumn("deal", key).hint("rebalance", "deal").sortWithinPartitions("deal").drop("deal")
        counted = rows.mapInArrow(_count_features(sizes, values, k == 0), "l string, f int, at array<int>, m array<double>")
        pieces.append(counted.select(F.lit(-1 if i is None else i).alias("v"), "l", "f", "at", "m"))
    found = tables.write(reduce(lambda a, b: a.unionByName(b), pieces))
    size = sum(sizes) + values
    narrow = np.zeros((size, size))
    cells = found.filter("f >= 0").select("f", F.explode(F.arrays_zip("at", "m")).alias("c")).groupBy("f", "c.at").agg(F.sum("c.m").alias("m")).toArrow()
    narrow[cells["f"].to_numpy(), cells["at"].to_numpy()] = cells["m"].to_numpy()
    narrow = np.triu(narrow) + np.triu(narrow, 1).T
    # a level whose partition was split has several pieces; entries of one place add up
    levels = found.filter("f < 0").groupBy("v", "l").agg(F.collect_list(F.struct("at", "m")).alias("p")) \
        .select("v", "l", F.flatten("p.at").alias("at"), F.flatten("p.m").alias("m")) if wide else None
    return narrow, levels


def _level_pairs(coded: DataFrame, wide: Sequence[int]) -> DataFrame | None:
    """va, la, vb, lb, m, both ways round, for each two wide variables."""
    met = [coded.groupBy(F.col(f"l{i}").alias("la"), F.col(f"l{j}").alias("lb")).agg(F.count(F.lit(1)).cast("double").alias("m"))
           .filter("la IS NOT NULL AND lb IS NOT NULL").select(F.lit(i).alias("va"), "la", F.lit(j).alias("vb"), "lb", "m")
           for k, i in enumerate(wide) for j in wide[k + 1:]]
    if not met:
        return None
    half = reduce(lambda a, b: a.unionByName(b), met)
    return half.unionByName(half.select(F.col("vb").alias("va"), F.col("lb").alias("la"), F.col("va").alias("vb"), F.col("la").alias("lb"), "m"))


_STATE = "v int, l string, own double, at array<int>, m array<double>, x array<double>, y array<double>, part array<double>"


def _advance(rows_with: Sequence[float], has: dict[int, int], places: int, n: float, step):
    """A round for the rows of wide levels: ``step`` is (c, Q, H), x = y c and the
    new y = (G x) of the row, or None at the start, which leaves y as it is. The last
    row of a task (v = -1) has the sums Y'Y, X'Y, s y by variable, and M' w y by
    narrow feature of its rows."""
    rows_with, own_place = np.asarray(rows_with, float), np.array([has.get(v, -1) for v in range(len(rows_with))])

    def run(batches):
        sums, schema = None, None
        for whole in batches:
            for lo in range(0, whole.num_rows, 1000):
                b = whole.slice(lo, 1000)
                v = b["v"].to_numpy()
                lengths = pc.list_value_length(b["at"]).to_numpy().astype(int)
                start = np.concatenate([[0], np.cumsum(lengths)[:-1]])
                at, m = b["at"].flatten().to_numpy(), b["m"].flatten().to_numpy()
                row = np.repeat(np.arange(len(v)), lengths)
                own = np.bincount(row, weights=m * (at == own_place[v][row]), minlength=len(v))
                w = np.sqrt(rows_with[v] / own)[:, None]
                y = b["y"].flatten().to_numpy().reshape(len(v), -1)
                x = y
                if step:
                    c, q_, h = step
                    x = y @ c
                    y = np.stack([np.add.reduceat(m * q_[at, k], start) for k in range(c.shape[1])], axis=1) + own[:, None] * w * x / n
                    if "t" in b.schema.names:
                        t = pc.fill_null(pc.list_flatten(pc.coalesce(b["t"], pa.scalar([0.0] * len(c), b["t"].type))), 0.0).to_numpy().reshape(len(v), -1)
                        y = y + t @ c / n
                    y = w * y + h[v] / w
                k = y.shape[1]
                by_variable, by_place, wy = np.zeros((len(rows_with), k)), np.zeros((places, k)), w * y
                np.add.at(by_variable, v, y / w)
                for j in range(k):
                    by_place[:, j] = np.bincount(at, weights=m * wy[row, j], minlength=places)
                part = np.concatenate([(y.T @ y).ravel(), (x.T @ y).ravel(), by_variable.ravel(), by_place.ravel()])
                sums = part if sums is None else sums + part
                each = lambda z: pa.ListArray.from_arrays(pa.array(np.arange(len(z) + 1) * z.shape[1], pa.int32()), pa.array(np.ascontiguousarray(z).ravel()))
                done = pa.RecordBatch.from_arrays([pa.array(v, pa.int32()), b["l"], pa.array(own), b["at"], b["m"], each(x), each(y),
                                                   pa.nulls(len(v), pa.list_(pa.float64()))], names=["v", "l", "own", "at", "m", "x", "y", "part"])
                schema = done.schema
                yield done
        if sums is not None:
            yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), pa.nulls(1, pa.string()), pa.nulls(1, pa.float64()),
                                              *[pa.nulls(1, schema.field(f).type) for f in ("at", "m", "x", "y")], pa.array([sums.tolist()], pa.list_(pa.float64()))], schema=schema)

    return run


def _parts(state: DataFrame, width: int, q: int, places: int):
    """The summed last rows: as many numbers as the block width, the variables and
    the narrow features make."""
    got = np.zeros(2 * width * width + (q + places) * width)
    for r in state.filter("v < 0").select(F.posexplode("part")).groupBy("pos").agg(F.sum("col").alias("t")).collect():
        got[r["pos"]] = r["t"]
    square = width * width
    rest = got[2 * square:].reshape(q + places, width)
    return got[:square].reshape(width, width), got[square:2 * square].reshape(width, width), rest[:q], rest[q:]


def famd_wide(df: DataFrame, num: Sequence[str], cat: Sequence[str], k: int = 5, extra: int = 6,
              tol: float = 1e-6, max_rounds: int = 60, narrow: int = NARROW) -> WideModel:
    """The first ``k`` dimensions of a FAMD; ``extra`` more directions are
    carried along. ``narrow`` only says which variables are counted in which way."""
    with _Rounds(df.sparkSession) as tables:
        return _fit(df, list(num), list(cat), k, extra, tol, max_rounds, narrow, tables)


def _fit(df: DataFrame, num: list[str], cat: list[str], k: int, extra: int, tol: float, max_rounds: int, room: int, tables: _Rounds) -> WideModel:
    spark, q = df.sparkSession, len(cat)
    st = df.agg(F.count(F.lit(1)).alias("n"), *[f(c).alias(f"{t}{i}") for i, c in enumerate(num) for t, f in
                (("m", F.avg), ("s", F.stddev_pop), ("n", F.count))]).first()
    n = st["n"]
    if not n:
        raise ValueError("a table without rows has no factors")
    moments = {c: (float(st[f"m{i}"] or 0.0), float(st[f"s{i}"] or 0.0)) for i, c in enumerate(num)}
    counts = tables.write(_level_counts(df, cat)) if cat else spark.createDataFrame([], "v int, l string, own double")
    # one row a variable
    sizes = {r["v"]: (r["rows"], r["levels"]) for r in counts.groupBy("v").agg(F.sum("own").alias("rows"), F.count(F.lit(1)).alias("levels")).collect()}
    rows_with = [sizes.get(i, (0.0, 0))[0] for i in range(q)]
    levels = [sizes.get(i, (0.0, 0))[1] for i in range(q)]
    narrow = []
    for i in sorted(range(q), key=lambda i: levels[i]):
        if levels[i] <= room:
            narrow.append(i)
            room -= levels[i]
    wide = [i for i in range(q) if i not in narrow]
    # at most NARROW rows
    known = sorted((r["v"], r["l"], r["own"]) for r in counts.filter(F.col("v").isin(narrow)).collect())
    places = {i: [x[1] for x in known if x[0] == i] for i in sorted(narrow)}
    values = len(num) + len(wide)
    coded = _coded(df, num, cat, moments, places, wide)
    m, rows = _feature_rows(coded, [len(x) for x in places.values()], values, wide, tables)
    pairs = _level_pairs(coded, wide)
    pairs = None if pairs is None else tables.write(pairs)

    # places: levels of narrow variables, numeric variables, the rows that have a wide variable
    here = np.array([True] * len(known) + [moments[c][1] > 0 for c in num] + [False] * len(wide), bool)
    of = np.array([x[0] for x in known] + list(range(q, q + len(num))) + wide, int)
    member = np.zeros((len(of), q))
    for p in range(len(of)):
        if of[p] < q:
            member[p, of[p]] = 1.0
    w, s = here.astype(float), np.zeros(len(of))
    for p, (v, _, own) in enumerate(known):
        w[p], s[p] = np.sqrt(rows_with[v] / own), np.sqrt(own / rows_with[v])
    numeric = slice(len(known), len(known) + len(num))
    inertia = (sum(max(0, levels[i] - 1) * rows_with[i] for i in range(q)) + float(np.diag(m)[numeric].sum())) / n
    common = member.T @ m @ member
    levels += here[numeric].astype(int).tolist()
    has = {i: len(known) + len(num) + j for j, i in enumerate(wide)}

    # the rank of G: a variable's levels add one less than their number
    rank = sum(max(0, levels[i] - 1) for i in range(q)) + sum(levels[q:])
    width = int(max(1, min(k + extra, rank)))
    start = F.array(*[F.xxhash64("v", "l", F.lit(c)) / F.lit(float(1 << 63)) for c in range(width)])
    feats = spark.createDataFrame([(p, int(of[p]), known[p][1] if p < len(known) else "") for p in np.flatnonzero(here).tolist()], "p int, v int, l string")
    x, y = np.zeros((len(of), width)), np.zeros((len(of), width))
    for r in feats.select("p", start.alias("y")).collect():
        y[r["p"]] = r["y"]
    none = [np.zeros((width, width)), np.zeros((width, width)), np.zeros((q, width)), np.zeros((len(of), width))]
    state, far = None, none
    if wide:
        state = tables.write(rows.withColumn("y", start).mapInArrow(_advance(rows_with, has, len(of), n, None), _STATE))
        far = _parts(state, width, q, len(of))
    theta, turn, residual, rounds = np.zeros(width), np.eye(width), np.full(width, np.inf), 0
    yy = y.T @ y + far[0]
    while rank and rounds < max_rounds:
        rounds += 1
        beta, u = np.linalg.eigh(yy)
        good = beta > beta.max() * 1e-13
        c = u[:, good] / np.sqrt(beta[good])
        width = c.shape[1]
        x, s_, met = y @ c, (member.T @ (s[:, None] * y) + far[2]) @ c, far[3] @ c
        r_ = member.T @ (m @ (w[:, None] * x) + met)
        centred, back = w[:, None] * x - member @ s_, (common @ s_ - r_) / n
        y = w[:, None] * (m @ centred + met) / n + s[:, None] * np.vstack([back, np.zeros((len(num), width))])[of]
        far = [np.zeros((width, width))] * 2 + [np.zeros((q, width)), np.zeros((len(of), width))]
        if wide:
            now = state.filter("v >= 0")
            if pairs is not None:
                share = F.get(F.array(*[F.lit(float(z)) for z in rows_with]), F.col("v")) / F.col("own")
                sums = pairs.join(now.select(F.col("v").alias("vb"), F.col("l").alias("lb"), F.sqrt(share).alias("wb"), F.col("y").alias("yb")), ["vb", "lb"]) \
                    .groupBy("va", "la").agg(F.array(*[F.sum(F.col("m") * F.col("wb") * F.get("yb", F.lit(i))) for i in range(len(beta))]).alias("t")) \
                    .select(F.col("va").alias("v"), F.col("la").alias("l"), "t")
                now = now.join(sums, ["v", "l"], "left")
            state = tables.advance(now.mapInArrow(_advance(rows_with, has, len(of), n, (c, centred / n, back)), _STATE))
            far = _parts(state, width, q, len(of))
        yy, xy = y.T @ y + far[0], x.T @ y + far[1]
        theta, turn = np.linalg.eigh((xy + xy.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        residual = np.sqrt(np.maximum(np.einsum("ij,ik,kj->j", turn, yy, turn) - theta ** 2, 0))
        first = min(k, width)
        if (residual[:first] <= tol * np.maximum(theta[:first], 1e-12)).all():
            break
    k = min(k, width) if rank else 0
    own = (x @ turn)[:, :k]
    load = spark.createDataFrame([(int(of[p]), known[p][1] if p < len(known) else "", float(w[p]), float(s[p]), own[p].tolist())
                                  for p in np.flatnonzero(here)], "v int, l string, w double, s double, u array<double>")
    if wide:
        share = F.col("own") / F.get(F.array(*[F.lit(float(z)) for z in rows_with]), F.col("v"))
        loading = _combine("x", turn[:, :k]) if k else F.array().cast("array<double>")
        load = load.unionByName(state.filter("v >= 0").select("v", "l", (1 / F.sqrt(share)).alias("w"), F.sqrt(share).alias("s"), loading.alias("u")))
    load = cut(load)
    is_cat = F.col("v") < q
    ends = load.agg(*[F.max_by(F.get("u", F.lit(j)), F.struct(F.abs(F.get("u", F.lit(j))), F.col("v"), F.col("l"))).alias(f"d{j}") for j in range(k)]).first() if k else []
    sign = [-1.0 if x is not None and x < 0 else 1.0 for x in ends]
    load = load.withColumn("u", F.array(*[F.get("u", F.lit(j)) * sign[j] for j in range(k)]).cast("array<double>"))
    centres = {c: [0.0] * k for c in cat}
    if k and q:
        for r in load.filter(is_cat).groupBy("v").agg(F.array(*[F.sum(F.col("s") * F.get("u", F.lit(j))) for j in range(k)]).alias("t")).collect():
            centres[cat[r["v"]]] = list(r["t"])
    names = F.get(F.array(*[F.lit(c) for c in [*cat, *num]]), F.col("v"))
    table = load.select(names.alias("variable"), F.when(is_cat, F.col("l")).alias("level"), F.col("w").alias("weight"), F.col("u").alias("loading"))
    return WideModel(num, cat, [float(x) for x in theta[:k]], [float(x) for x in residual[:k]], float(inertia),
                     int(sum(levels)), rounds, moments, table, centres)


def wide_explained(model: WideModel, spark) -> DataFrame:
    """dimension, eigenvalue, explained, residual."""
    rows = [(i + 1, e, e / model.total_inertia, r) for i, (e, r) in enumerate(zip(model.eigenvalues, model.residuals))]
    return spark.createDataFrame(rows, "dimension int, eigenvalue double, explained double, residual double")


def wide_scores(df: DataFrame, model: WideModel, keys: Sequence[str], dims: int = 2) -> DataFrame:
    """Row coordinates on the first ``dims`` dimensions: each categorical
    variable's level looks up its loading (a table of levels a variable, which
    Spark broadcasts or shuffles by its size); missing values add 0."""
    out, terms = df, [[] for _ in range(dims)]
    for i, c in enumerate(model.cat):
        own = model.loadings.filter(F.col("variable") == c).select(
            F.col("level").alias(f"_l{i}"), F.transform("loading", lambda x: x * F.col("weight")).alias(f"_u{i}"))
        out = out.join(own, F.col(c).cast("string") == F.col(f"_l{i}"), "left")
        for j in range(dims):
            terms[j].append(F.coalesce(F.get(f"_u{i}", F.lit(j)) - F.lit(model.centres[c][j]), F.lit(0.0)))
    # one row a numeric variable
    numeric = {r["variable"]: r["loading"] for r in model.loadings.filter(F.col("variable").isin(model.num)).collect()}
    for c in model.num:
        mean, sd = model.moments[c]
        for j in range(dims if c in numeric else 0):
            terms[j].append(F.coalesce((F.col(c).cast("double") - mean) / (sd or 1.0) * float(numeric[c][j]), F.lit(0.0)))
    return out.select(*keys, *[_add(t).alias(f"dim{j + 1}") for j, t in enumerate(terms)])
