r"""Document fingerprints as invertible Bloom lookup sketches, in DataFrame
functions only.

A document's paragraphs (lines, cut after ``WORDS`` words, so that a change
leaves what stands before it alone) are hashed to 60-bit digests. A sketch has
three tables of cells; a digest is added to one cell of each: its number of
digests, their exclusive or, and that of their checks. Sketches of two versions
subtract cell by cell, equal paragraphs vanish, and peeling recovers the
differing digests: a cell that holds one alone gives it away, it is taken out of
its other cells, and so on.

``fingerprint`` is the sketch with ``CELLS`` cells a table, whatever the length
of the document: it recovers a few differing paragraphs. Where peeling gets stuck,
``difference`` retries larger: digests are dealt by their low bits to about one
group for every four, each group has tables of its own, and a group that gets
stuck again is retried with tables of twice the size. Cost is linear in the
digests but for that dealing. (Digests that share all bits that choose cells
would never part; such a group is compared as it is, so results are exact.)

``likeness`` is the share of paragraphs that two documents have in common (of
those that either has), from the recovered differences and the counts.

Next documents are found without a global window: splitters from a bounded
sample deal rows by range, a bucket also gets a copy of the row that opens the
following one, and ``lead`` looks within the buckets. Texts are shuffled once.

Defined results: null text is empty; a text without words has no paragraphs and
is like (1.0) others without, unlike (0.0) any other; null ids come last, rows
that repeat an id are ordered by the MD5 of their text, and rows equal in both
follow one another; a single document is its own next one; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aulaframe.llm.common import documents, hash_sample, let

WORDS = 32  # words of a paragraph piece
CELLS = 8  # cells in each of a fingerprint's three tables
A_GROUP = 8  # digests that a group of a larger sketch has, about
LARGEST = 4096  # cells a table of the last retry
BUCKETS_A_PARTITION, SAMPLE_A_BUCKET = 4, 10

BLANKS = " \t\n\x0b\x0c\r"
PIECE = r"(?:[^\x20\x09-\x0D]+[\x20\x09\x0B-\x0D]*){1,%d}" % WORDS
_CELL = "array<struct<c:int,k:bigint,h:bigint>>"


def _check(k):
    """31-bit check of a digest."""
    low, high = k.bitwiseAND(F.lit((1 << 30) - 1)), F.shiftright(k, 30)
    return (low * F.lit(1640531527) + high * F.lit(1540483477)) % F.lit(2147483647)


def digests(text):
    """Distinct digests of a text's paragraphs."""
    found = F.regexp_extract_all(text, F.lit(PIECE), F.lit(0))
    return F.array_distinct(F.transform(found, lambda p: F.conv(F.substring(F.md5(F.rtrim(p, F.lit(BLANKS))), 1, 15), 16, 10).cast("bigint")))


def _cell_of(k, table: int, size):
    """Place of a digest in a table of ``size`` (a power of two) cells."""
    return F.shiftright(k, 16 + 12 * table).bitwiseAND(size - 1)


def _xor(keys, of=lambda k: k):
    return F.aggregate(keys, F.lit(0).cast("bigint"), lambda x, k: x.bitwiseXOR(of(k)))


def _table(keys, table: int, size):
    """One table of the sketch of ``keys``: for each cell the number of its
    digests, their exclusive or and that of their checks."""
    return F.transform(F.sequence(F.lit(0).cast("bigint"), size - 1), lambda j: let(
        F.filter(keys, lambda k: _cell_of(k, table, size) == j),
        lambda own: F.struct(F.size(own).alias("c"), _xor(own).alias("k"), _xor(own, _check).alias("h"))))


def _subtract(x, y):
    return F.struct((x["c"] - y["c"]).alias("c"), x["k"].bitwiseXOR(y["k"]).alias("k"), x["h"].bitwiseXOR(y["h"]).alias("h"))


def _minus(a, b):
    return F.zip_with(a, b, _subtract)


def _peel(tables, size):
    """Recovers a subtracted sketch: struct(a, b, done), the digests that only
    the first or only the second document has, and whether nothing is left.
    Each round takes all digests that stand alone in a cell out of the tables."""
    none = F.array().cast("array<bigint>")
    start = F.struct(*[t.cast(_CELL).alias(f"t{i}") for i, t in enumerate(tables)], none.alias("a"), none.alias("b"), F.lit(False).alias("stuck"))

    def alone(cells):
        return F.filter(cells, lambda x: (F.abs(x["c"]) == 1) & (x["h"] == _check(x["k"])))

    def without(cells, table, found):
        return F.transform(cells, lambda cell, j: F.aggregate(F.filter(found, lambda p: _cell_of(p["k"], table, size) == j), cell, _subtract))

    def take(state, found):
        mine = lambda s: F.transform(F.filter(found, lambda p: p["c"] == s), lambda p: p["k"])
        return F.struct(*[without(state[f"t{i}"], i, found).cast(_CELL).alias(f"t{i}") for i in range(3)],
                        F.concat(state["a"], mine(1)).alias("a"), F.concat(state["b"], mine(-1)).alias("b"), (F.size(found) == 0).alias("stuck"))

    def step(state, _):
        found = F.array_distinct(F.concat(*[alone(state[f"t{i}"]) for i in range(3)]))
        return F.when(state["stuck"], state).otherwise(let(found, lambda p: take(state, p)))

    # every round but the last takes out a digest, and the tables give no more than they have cells
    return F.aggregate(F.sequence(F.lit(0).cast("bigint"), 3 * size), start, step, lambda s: F.struct(
        s["a"].alias("a"), s["b"].alias("b"), F.forall(s["t0"], lambda x: (x["c"] == 0) & (x["k"] == 0) & (x["h"] == 0)).alias("done")))


def _attempt(a, b, size):
    """Sketches of two sets of digests, subtracted and peeled."""
    return _peel([_minus(_table(a, i, size), _table(b, i, size)) for i in range(3)], size)


def fingerprint(keys):
    """The sketch of fixed size as a text: ``count,digests,checks;`` for each cell."""
    size = F.lit(CELLS).cast("bigint")
    cells = F.concat(*[_table(keys, i, size) for i in range(3)])
    return F.concat_ws(";", F.transform(cells, lambda x: F.concat_ws(",", *[x[f].cast("string") for f in "ckh"])))


def difference(a, b):
    """struct(a, b): digests that only the first, only the second set has."""
    size = F.greatest(F.size(a), F.size(b))
    bits = F.ceil(F.log2(F.greatest(size / A_GROUP, F.lit(1.0))))
    power = lambda b: F.least(F.pow(F.lit(2.0), b), F.lit(256.0)).cast("bigint")
    groups = let(F.floor(bits / 2), lambda half: F.struct(power(half).alias("outer"), power(bits - half).alias("inner")))
    sizes = F.array(*[F.lit(CELLS << i).cast("bigint") for i in range((LARGEST // CELLS).bit_length())])
    none = F.array().cast("array<bigint>")
    nothing = F.struct(none.alias("a"), none.alias("b"), F.lit(False).alias("done"))

    def larger(x, y):
        tried = F.aggregate(sizes, nothing, lambda acc, s: F.when(acc["done"], acc).otherwise(_attempt(x, y, s)))
        plain = F.struct(F.array_except(x, y).alias("a"), F.array_except(y, x).alias("b"), F.lit(True).alias("done"))
        return let(tried, lambda t: F.when(t["done"], t).otherwise(plain))

    def deal(x, y, shift, n, then):
        """``then`` for each of ``n`` groups by the bits from ``shift`` on."""
        own = lambda xs, g: F.filter(xs, lambda k: F.shiftright(k, shift).bitwiseAND(n - 1) == g)
        each = F.transform(F.sequence(F.lit(0).cast("bigint"), n - 1), lambda g: let(
            F.struct(own(x, g).alias("x"), own(y, g).alias("y")), lambda p: then(p["x"], p["y"])))
        return let(each, lambda gs: F.struct(F.flatten(F.transform(gs, lambda g: g["a"])).alias("a"),
                                             F.flatten(F.transform(gs, lambda g: g["b"])).alias("b"), F.lit(True).alias("done")))

    def dealt(n):  # in two steps, so that a digest is looked at about twice the root of the groups' number
        return deal(a, b, 0, n["outer"], lambda x, y: deal(x, y, 8, n["inner"], larger))

    first = _attempt(a, b, F.lit(CELLS).cast("bigint"))
    return let(first, lambda t: F.when(t["done"], t).otherwise(let(groups, dealt)))


def likeness(a, b):
    """Share of common digests among those of either set; 1 if both are empty."""
    both = F.size(a) + F.size(b)
    return let(difference(a, b), lambda d: F.when(both == 0, 1.0).otherwise(
        (both - F.size(d["a"]) - F.size(d["b"])) / (both + F.size(d["a"]) + F.size(d["b"]))))


def with_next(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, t, next: every row's text and that of the row that follows in
    descending order of ids (the first row follows the last)."""
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t")) \
        .withColumn("key", F.struct(F.col("doc_id").isNull().alias("last"), F.bitwise_not(F.coalesce("doc_id", F.lit(0).cast("long"))).alias("place"),
                                    F.md5("t").alias("tie")))
    buckets = BUCKETS_A_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = rows.select("key.*")
    first = keys.agg(F.min(F.struct("last", "place", "tie")).alias("k"), F.count("*").alias("n")).first()
    if not first.n:
        return rows.select("doc_id", "t", F.col("t").alias("next"))
    # a bounded sample opens the buckets; which rows do decides nothing but their sizes
    picked = sorted({tuple(r) for r in hash_sample(keys, SAMPLE_A_BUCKET * buckets, "last", "place", "tie", total=first.n).collect()})
    opening = sorted({tuple(first.k), *picked[SAMPLE_A_BUCKET::SAMPLE_A_BUCKET]})
    openers = spark.createDataFrame([(opening,)], "openers array<struct<last:boolean,place:bigint,tie:string>>")
    n = len(opening)
    # binary search: the last bucket that opens at or before the row
    halve = F.aggregate(F.sequence(F.lit(1), F.lit(n.bit_length())), F.struct(F.lit(0).alias("a"), F.lit(n).alias("z")), lambda s, _: let(
        F.floor((s["a"] + s["z"]) / 2).cast("int"), lambda m: F.when(F.get("openers", m) <= F.col("key"), F.struct(m.alias("a"), s["z"].alias("z")))
        .otherwise(F.struct(s["a"].alias("a"), m.alias("z")))), lambda s: s["a"])
    placed = rows.join(F.broadcast(openers)).withColumn("bucket", halve)
    opens = F.get("openers", F.col("bucket")) == F.col("key")
    before = F.when(F.col("bucket") == 0, n - 1).otherwise(F.col("bucket") - 1)
    homes = F.when(opens, F.array(F.struct(F.col("bucket").alias("b"), F.lit(False).alias("guest")), F.struct(before.alias("b"), F.lit(True).alias("guest")))) \
        .otherwise(F.array(F.struct(F.col("bucket").alias("b"), F.lit(False).alias("guest"))))
    one = Window.partitionBy("b").orderBy("guest", "key")
    return placed.select("doc_id", "t", "key", F.inline(homes)).withColumn("next", F.lead("t").over(one)).filter(~F.col("guest")) \
        .select("doc_id", "t", "next")


def op12_bloom_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_next(documents(spark, sf_dir)).withColumn("n_chars", F.length("t").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    docs = docs.withColumn("edited", F.concat(F.substring("t", F.lit(1), (F.col("n_chars") - half).cast("int")), F.substring("next", F.lit(1), half)))
    sets = F.struct(digests(F.col("t")).alias("own"), digests(F.col("edited")).alias("edited"), digests(F.col("next")).alias("next"))
    out = let(sets, lambda s: F.struct(
        fingerprint(s["own"]).alias("fingerprint"), fingerprint(s["edited"]).alias("edited_fingerprint"),
        likeness(s["own"], s["edited"]).alias("near_edited"), likeness(s["own"], s["next"]).alias("near_next")))
    return docs.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), out.alias("out")) \
        .select("doc_id", "n_chars", "edited_sha256", "out.*")


def _oracle() -> str:
    """Sketch cells and likeness from the sets of digests themselves."""
    keys = lambda t: (f"list_distinct(list_transform(regexp_extract_all({t}, '{PIECE}'), "  # noqa: E731
                      "lambda p: ('0x' || substr(md5(rtrim(p, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))), 1, 15))::BIGINT))")
    check = "((x & 1073741823) * 1640531527 + (x >> 30) * 1540483477) % 2147483647"

    def sketch(keys: str) -> str:
        cells = []
        for i in range(3):
            cells.append(f"list_transform(range({CELLS}), lambda j: list_transform([list_filter({keys}, lambda x: (x >> {16 + 12 * i}) & {CELLS - 1} = j)], "
                         f"lambda c: len(c) || ',' || coalesce(list_aggregate(c, 'bit_xor'), 0) || ',' || "
                         f"coalesce(list_aggregate(list_transform(c, lambda x: {check}), 'bit_xor'), 0))[1])")
        return f"array_to_string(list_concat(list_concat({cells[0]}, {cells[1]}), {cells[2]}), ';')"

    like = lambda a, b: f"CASE WHEN len({a}) + len({b}) = 0 THEN 1.0::DOUBLE ELSE len(list_intersect({a}, {b}))::DOUBLE / len(list_distinct(list_concat({a}, {b}))) END"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
n AS (SELECT doc_id, t, coalesce(lead(t) OVER w, first_value(t) OVER w) AS nx FROM d WINDOW w AS (ORDER BY doc_id DESC NULLS LAST, md5(t) ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
e AS (SELECT *, length(t) AS n_chars, left(t, length(t) - length(t) // 2) || left(nx, length(t) // 2) AS ed FROM n),
k AS (SELECT *, {keys('t')} AS a, {keys('ed')} AS b, {keys('nx')} AS c FROM e)
SELECT doc_id, n_chars::BIGINT AS n_chars, sha256(ed) AS edited_sha256, {sketch('a')} AS fingerprint, {sketch('b')} AS edited_fingerprint,
       {like('a', 'b')} AS near_edited, {like('a', 'c')} AS near_next FROM k
"""


OP12_SQL = _oracle()
