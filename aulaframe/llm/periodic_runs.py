r"""Periodic runs of words: maximal stretches that repeat a smallest period q
over at least max(6, 4 q) words.

Periods are taken by octave, q in [B, 2B) for B = 1, 2, 4, ... Each document is
exploded into tile rows, one set for the octaves up to ``BASE`` and one for each
larger octave that it is long enough for; a tile owns ``STRIDE`` B words and
reads ``REACH`` B more, so any 4 q words in a row lie within one. Tiles are
solved alone: around each multiple b of B, words b - B to b + 8B are looked at
(4 q words that begin in the B words before b, or at b, lie within). A period is
a candidate where the words at b recur q later; for a boundary with candidates,
Z-functions of what follows and (reversed) of what precedes tell for every q how
far the stretch goes to either side. Their cost is linear in the
tile, whatever the number of candidates. Stretches whose period is a power of a
shorter one are dropped there. Fragments are then shuffled by document and
period, and those that share at least q words are stitched: two such pieces of
one period are one stretch of it.

Words are compared as words (dictionary codes of a batch), not as hashes. A
document is known by its id and the SHA-256 of its words, so repeated rows share
their runs and need no number.

Defined results: a null text has no words; a document without runs has 0 runs
and nulls, its words are all kept; a null id is an id like others (its CRC is
that of the empty text); rows that repeat an id are documents of their own; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aulaframe.llm.common import WORD, crc32_sql, documents, let

BASE = 8  # log2 of the largest octave that shares the first set of tiles
STRIDE, REACH = 32, 8  # words that a tile owns, and reads beyond, in units of B
LEAST, POWER = 6, 4  # a run has at least LEAST words and POWER periods
NEAR = 128  # words looked at ahead of a boundary, at least
PROBES = 8  # words that must recur before a boundary is solved
WORDS_AT_ONCE = 1 << 20  # of tiles looked at together

_FRAGMENT = "doc_id long, digest binary, period long, lo long, hi long"


def z_function(s: list, upto: int) -> list[int]:
    """For each place up to ``upto``: how many items from there on equal those
    from the first on."""
    n = len(s)
    z = [0] * (upto + 1)
    z[0] = n
    left = right = 0
    for i in range(1, upto + 1):
        k = 0
        if i < right:
            k = z[i - left]
            if k < right - i:
                z[i] = k
                continue
            k = right - i
        while i + k + 32 <= n and s[k:k + 32] == s[i + k:i + k + 32]:
            k += 32
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        left, right = i, i + k
    return z


def _primes(q: int) -> list[int]:
    out, p = [], 2
    while p * p <= q:
        if q % p == 0:
            out.append(p)
            while q % p == 0:
                q //= p
        p += 1
    return out + [q] * (q > 1)


def _is_power(x: np.ndarray) -> bool:
    """Whether a period is a shorter one repeated."""
    return any(np.array_equal(x[len(x) // r:], x[:-(len(x) // r)]) for r in _primes(len(x)))


def boundary_stretches(w: np.ndarray, lo: int, b: int, hi: int, periods) -> list[tuple[int, int, int]]:
    """(q, first, end) of the stretches of each period around ``b`` within
    w[lo:hi], by the Z-functions of what follows and of what precedes."""
    periods = [q for q in periods if b + q < hi]
    if not periods:
        return []
    ahead = z_function(w[b:hi].tolist(), max(periods))
    top, m = b + max(periods), b - lo
    back = z_function(w[lo:b][::-1].tolist() + [-1] + w[lo:top][::-1].tolist(), m + 1 + top - b - min(periods)) if m else None
    return [(q, b - (back[m + 1 + top - b - q] if m else 0), b + q + ahead[q]) for q in periods]


def _candidates(w: np.ndarray, b0: int):
    """Boundaries (multiples of b0, ascending) and periods of the octave for which the
    first words at the boundary recur one period on. (A run that begins less
    than b0 words earlier has at least 3 q - b0 + 1 more words that do; for
    periods of one and two words that is LEAST - 1.)"""
    bounds = np.arange(0, len(w), b0)
    padded = np.concatenate([w, -np.arange(2, 2 + 2 * b0 + PROBES)])
    at, step = np.nonzero(padded[bounds[:, None] + np.arange(b0, 2 * b0)] == w[bounds][:, None])
    at, q = bounds[at], step + b0
    for j in range(1, min(max(LEAST - 1, 2 * b0), PROBES)):
        same = padded[at + j] == padded[at + q + j]
        at, q = at[same], q[same]
    return at, q


def tile_runs(w: np.ndarray, starts: np.ndarray, octaves) -> list[tuple[int, int, int, int]]:
    """(tile, q, first, end) of the stretches within tiles that lie one behind
    the other in ``w``; overlapping ones of a tile and period are merged."""
    found: dict[tuple[int, int], list] = {}
    for b0 in octaves:
        at, q = _candidates(w, b0)
        tiles = np.searchsorted(starts, at, "right") - 1
        inside = at + q < starts[tiles + 1]
        at, q, tiles = at[inside], q[inside], tiles[inside]
        cuts = np.flatnonzero(np.diff(at, prepend=-1, append=-1))
        reach, known = max(REACH * b0, NEAR), {}
        for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            b, tile = int(at[i]), int(tiles[i])
            # of a stretch that is known to go on from here, a later boundary
            # sees more: one is a candidate still before the known end
            periods = [p for p in q[i:j].tolist() if known.get((tile, p), (0, False))[0] < b + p + b0 + PROBES]
            if not periods:
                continue
            lo, hi = max(int(starts[tile]), b - b0), min(int(starts[tile + 1]), b + reach)
            for period, first, end in boundary_stretches(w, lo, b, hi, periods):
                reached, run = known.get((tile, period), (0, False))
                run = end - first >= max(LEAST, POWER * period) or run and first + period <= reached
                known[tile, period] = end, run
                if run and not _is_power(w[first:first + period]):
                    found.setdefault((tile, period), []).append((first, end))
    out = []
    for (tile, period), pieces in found.items():
        pieces.sort()
        first, end = pieces[0]
        for a, z in pieces[1:]:
            if a <= end - period:
                end = max(end, z)
            else:
                out.append((tile, period, first, end))
                first, end = a, z
        out.append((tile, period, first, end))
    return out


def _solve(batches):
    for batch in batches:
        ids, digests, scale, lo = batch.column(0), batch.column(1), batch.column(2).to_numpy(), batch.column(3).to_numpy()
        words = pc.split_pattern(batch.column(4), " ")
        ends = words.offsets.to_numpy().astype(np.int64)
        codes = words.flatten().dictionary_encode().indices.to_numpy().astype(np.int64)
        ends = ends - ends[0]
        sizes = np.diff(ends)
        rows = []
        for s in np.unique(scale):
            octaves = [1 << s] if s > BASE else [1 << k for k in range(BASE + 1)]
            mine = np.flatnonzero(scale == s)
            for part in np.split(mine, np.flatnonzero(np.diff(np.cumsum(sizes[mine]) // WORDS_AT_ONCE)) + 1):
                w = np.concatenate([codes[ends[t]:ends[t + 1]] for t in part])
                starts = np.concatenate([[0], np.cumsum(sizes[part])])
                rows += [(int(part[t]), q, int(lo[part[t]] + a - starts[t]), int(lo[part[t]] + z - starts[t]))
                         for t, q, a, z in tile_runs(w, starts, octaves)]
        if rows:
            tile, q, a, z = (pa.array(c, pa.int64()) for c in zip(*rows))
            yield pa.RecordBatch.from_arrays([ids.take(tile), digests.take(tile), q, a, z], ["doc_id", "digest", "period", "lo", "hi"])


def tiles(docs: DataFrame) -> DataFrame:
    """Tile rows of documents (doc_id, digest, line: words one space apart). A
    document that one tile holds needs no cutting."""
    n = "length(line) - length(replace(line, ' ')) + 1"
    # sets of tiles: octaves up to BASE together, then each octave that POWER periods fit into
    sets = f"sequence({BASE}, greatest({BASE}, cast(floor(log2(n / {POWER})) as int)))"
    each = (f"flatten(transform({sets}, k -> transform(sequence(0, (n - 1) div shiftleft({STRIDE}, k)), "
            f"j -> struct(k as scale, cast(j * shiftleft({STRIDE}, k) as int) as lo))))")
    own = f"slice(split(line, ' '), tile.lo + 1, shiftleft({STRIDE + REACH}, tile.scale))"
    return docs.withColumn("n", F.expr(n)).select("doc_id", "digest", "line", "n", F.explode_outer(F.expr(each)).alias("tile")) \
        .select("doc_id", "digest", F.col("tile.scale").alias("scale"), F.col("tile.lo").cast("long").alias("lo"),
                F.when(F.col("n") <= STRIDE << BASE, F.col("line")).otherwise(F.array_join(F.expr(own), " ")).alias("words"))


def periodic_runs(docs: DataFrame) -> DataFrame:
    """Runs of documents given as (doc_id, digest, line): doc_id, digest,
    start, length, period, one row for each."""
    pieces = tiles(docs).mapInArrow(_solve, _FRAGMENT).distinct()
    one = Window.partitionBy("doc_id", "digest", "period").orderBy("lo", "hi")
    reached = F.max("hi").over(one.rowsBetween(Window.unboundedPreceding, -1))
    stretch = F.sum(F.coalesce((F.col("lo") > F.col("reached") - F.col("period")).cast("int"), F.lit(1))).over(one)
    return pieces.withColumn("reached", reached).withColumn("stretch", stretch) \
        .groupBy("doc_id", "digest", "period", "stretch").agg(F.min("lo").alias("start"), F.max("hi").alias("end")) \
        .select("doc_id", "digest", "start", (F.col("end") - F.col("start")).alias("length"), "period")


def collapse(words, runs):
    """The words outside of what runs repeat (all but each run's first period),
    one space apart. ``runs``: array of struct(start, period, length)."""
    gone = F.array_sort(F.transform(runs, lambda r: F.struct((r.start + r.period).alias("a"), (r.start + r.length).alias("z"))))
    none = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("kept"))

    def piece(a, z):
        return F.array_join(F.slice(words, (a + 1).cast("int"), (z - a).cast("int")), " ")

    def add(acc, g):
        kept = F.when(g.a > acc["at"], F.concat(acc["kept"], F.array(piece(acc["at"], g.a)))).otherwise(acc["kept"])
        return F.struct(F.greatest(acc["at"], g.z).alias("at"), kept.alias("kept"))

    def whole(acc):
        tail = F.when(acc["at"] < F.size(words), F.array(piece(acc["at"], F.size(words)))).otherwise(F.array().cast("array<string>"))
        return F.array_join(F.concat(acc["kept"], tail), " ")

    return F.aggregate(gone, none, add, whole)


def _planted(docs: DataFrame) -> DataFrame:
    """The query's texts: doc_id and the words one space apart, in documents
    whose CRC ends in 0 repeated with period p from word a on."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    blank = F.coalesce("text", F.lit(""))
    for c in "\t\n\x0b\x0c\r":  # plain replacements: several times faster than a pattern
        blank = F.replace(blank, F.lit(c), F.lit(" "))
    plain = let(blank, lambda x: F.trim(F.when(F.contains(x, F.lit("  ")), F.regexp_replace(x, "  +", " ")).otherwise(x)))

    def repeated(w):
        n, g = F.size(w), F.floor(h / 10)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        return let(F.struct(a.alias("a"), p.alias("p")), lambda x: F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(
            w, F.when(i < x.a, i).otherwise(x.a + (i - x.a) % x.p).cast("int"))))

    line = let(plain, lambda x: F.when((h % 10 == 0) & (x != ""), let(F.split(x, " "), lambda w: F.array_join(repeated(w), " "))).otherwise(x))
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), line.alias("line"))
    return src.withColumn("digest", F.unhex(F.sha2("line", 256)))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _planted(documents(spark, sf_dir))
    of = periodic_runs(docs).groupBy(F.col("doc_id").alias("of"), F.col("digest").alias("of_digest")) \
        .agg(F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))
    # texts are shuffled once at every size
    out = docs.hint("merge").join(of, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("digest") == F.col("of_digest")), "left")
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("s"), (-r.period).alias("p"))))
    out = out.withColumn("best", longest)
    line = F.concat_ws("", F.transform("runs", lambda r: F.concat(r.start.cast("string"), F.lit(","), r.length.cast("string"), F.lit(","), r.period.cast("string"), F.lit("\n"))))
    return out.select(
        "doc_id", F.when(F.col("runs").isNull(), 0).otherwise(F.size("runs")).cast("long").alias("n_runs"),
        (-F.col("best.s")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.p")).alias("period"),
        F.expr("1000 * best.length div -best.p").alias("exponent_milli"),
        F.sha2(F.coalesce(line, F.lit("")), 256).alias("runs_sha256"),
        F.when(F.col("runs").isNull(), F.lower(F.hex("digest"))).otherwise(F.sha2(let(F.split("line", " "), lambda w: collapse(w, F.col("runs"))), 256)).alias("collapsed_sha256"))


#: independent of the tiles: equal word triples of a document, joined at their
#: distance, give the stretches of each period
OP13_SQL = f"""
WITH src AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w,
                    {crc32_sql("coalesce(doc_id::VARCHAR, '')")} AS h FROM documents),
s AS (SELECT *, len(w) AS n, h // 10 AS g, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a FROM src),
p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM s),
d AS (SELECT r, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
             THEN list_transform(range(n), lambda i: CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % p + 1] END) ELSE w END AS w FROM p),
x AS (SELECT r, n, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS i FROM d),
t AS (SELECT r, n, i, hash(word, lead(word, 1) OVER o, lead(word, 2) OVER o) AS t FROM x WINDOW o AS (PARTITION BY r ORDER BY i) QUALIFY i < n - 2),
m AS (SELECT u.r, u.i, v.i - u.i AS q FROM t u JOIN t v ON u.r = v.r AND u.t = v.t AND v.i > u.i AND 4 * (v.i - u.i) <= u.n),
k AS (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM m),
f AS (SELECT r, q, min(i) AS start, max(i) - min(i) + 3 + q AS length FROM k GROUP BY r, q, island),
e AS (SELECT r, start, length, min(q) AS period FROM f WHERE length >= greatest(6, 4 * q) GROUP BY r, start, length),
b AS (SELECT r, count(*) AS n_runs, arg_max({{'start': start, 'length': length, 'period': period}}, {{'l': length, 's': -start, 'p': -period}}) AS best,
             sha256(string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period)) AS runs_sha256 FROM e GROUP BY r),
kept AS (SELECT r, sha256(string_agg(word, ' ' ORDER BY i)) AS collapsed
         FROM x WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.r = x.r AND x.i >= e.start + e.period AND x.i < e.start + e.length) GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.start AS start, best.length AS length, best.period AS period,
       1000 * best.length // best.period AS exponent_milli, coalesce(runs_sha256, sha256('')) AS runs_sha256,
       coalesce(collapsed, sha256('')) AS collapsed_sha256
FROM d LEFT JOIN b USING (r) LEFT JOIN kept USING (r)
"""
