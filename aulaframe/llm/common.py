"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import os
from contextlib import ExitStack

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aulaframe.session import checkpoint_dir, scratch_path

#: a word: a run of bytes that are not ASCII white space
WORD = r"[^\x20\x09-\x0D]+"
#: narrow rows (a few numbers) that one partition of an intermediate table holds
ROWS_A_PARTITION = 200_000


def ship(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver has it.
    (On a cluster without a shared installation, pass it with --py-files.)"""
    env, root = spark.sparkContext.environment, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels")


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder: survives lost executors, ends
    the lineage and is computed once. The context cleaner removes it when it
    is no longer referenced."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


class Landed:
    """A large intermediate table, written once as Parquet in the shared folder
    and dropped when its reader is done."""

    def __init__(self, df: DataFrame, name: str):
        self.spark, self.path = df.sparkSession, scratch_path(df.sparkSession, name)
        df.write.parquet(self.path)

    def __enter__(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def __exit__(self, *_) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def hash_sample(df: DataFrame, n: int, *by: str, total: int | None = None) -> DataFrame:
    """The ``n`` rows that come first in the order of a hash of ``by``. Rows
    with a hash far behind the n-th are dropped where they are read, so about
    2 n rows are sent at any input size (not n from every task)."""
    total = df.count() if total is None else total
    h = F.xxhash64(*by)
    if total > 4 * n:
        df = df.filter(F.pmod(h, F.lit(1 << 40)) < int((1 << 40) * (2 * n + 100) / total))
    return df.orderBy(F.pmod(h, F.lit(1 << 40)), *by).limit(n)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder (URI) under the shared folder of ``spark.checkpoint.dir``."""
    path = scratch_path(spark, name)
    return path if "://" in path or path.startswith("file:") else f"file://{path}"


def shared_fs(uri: str):
    """File system and path of a shared URI, usable from executors
    (file, hdfs, s3 and gs through Arrow's file systems)."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def crc32_sql(text: str) -> str:
    """DuckDB expression: CRC-32 (reflected, polynomial EDB88320) of an ASCII text."""
    bit = "list_reduce(list_concat([xor(a, b)], repeat([0::BIGINT], 8)), lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)"
    codes = f"list_transform(range(1, length({text}) + 1), lambda j: ascii(({text})[j])::BIGINT)"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {codes}), lambda a, b: {bit}), 4294967295)"


def let(value, body):
    """``body`` of a value that is computed once for a row, wherever the body
    uses it (a plain column would be put in, and computed, at each place)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def lower_ascii(col):
    """Lower-cases A-Z only."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def input_partitions(df: DataFrame) -> int:
    """Splits that a scan has under the session's settings."""
    return max(1, df.rdd.getNumPartitions())


def _even(df: DataFrame) -> tuple[DataFrame, int]:
    n = df.count()
    return df.coalesce(max(1, -(-n // ROWS_A_PARTITION))), n


def cut_even(df: DataFrame) -> tuple[DataFrame, int]:
    """``cut`` and the number of rows, in partitions of ``ROWS_A_PARTITION``
    rows: a table of narrow rows that has shrunk isn't spread over many empty
    tasks. A partition's rows are bounded at every size."""
    return _even(cut(df))


def spread(df: DataFrame) -> DataFrame:
    """A table that grows with the input, to be joined where it lies: it is
    shuffled at every size, and never gathered by the driver for a broadcast."""
    return df.hint("merge")


def _stars(batches):
    """Smallest node reachable within one partition's edges, for the others."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = root[up]
            x = root[x]
        return x

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    nodes = [x for x in root if root[x] != x]
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([find(x) for x in nodes], pa.int64())], ["a", "m"])


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns a, b): the
    smallest node reachable.

    Random contraction: in each round a node joins the neighbour (or itself)
    that comes first in an order drawn for the round, labels are replaced by
    their own labels once, and the graph is contracted to the labels. The order
    is random, so a constant share of the nodes goes in each round, on long
    paths as well. A node with very many edges costs one row per task (partial
    aggregation). Each round's labels are kept and put together backwards, from
    the smallest graph to the largest, so all rounds together cost a few times
    the first. What is left when the edges fit one partition
    (``ROWS_A_PARTITION``) is labelled there at once. Rounds are written tables (a checkpoint would hand the constraints
    of each round's plan on to the next); nothing is collected but counts.
    """
    with ExitStack() as tables:
        def even(df: DataFrame) -> tuple[DataFrame, int]:
            return _even(tables.enter_context(Landed(df, "components")))

        nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        cur, n = even(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        rounds: list[DataFrame] = []
        while n:
            if n <= ROWS_A_PARTITION:
                rounds.append(even(cur.mapInArrow(_stars, "a long, m long"))[0])
                break
            at = lambda c, k=len(rounds): F.struct(F.xxhash64(c, F.lit(k)).alias("h"), F.col(c).alias("n"))
            ends = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
            first = cur.select(F.inline(ends)).groupBy("a").agg(F.min(at("b")).alias("m"))
            lab, _ = even(first.select("a", F.when(F.col("m") < at("a"), F.col("m.n")).otherwise(F.col("a")).alias("m")))
            jump, _ = even(lab.join(spread(lab.select(F.col("a").alias("m"), F.col("m").alias("m2"))), "m").select("a", F.col("m2").alias("m")))
            rounds.append(jump)
            ma, mb = jump.select("a", F.col("m").alias("na")), jump.select(F.col("a").alias("b"), F.col("m").alias("nb"))
            cur, n = even(cur.join(spread(ma), "a").join(spread(mb), "b").filter("na <> nb")
                              .select(F.least("na", "nb").alias("a"), F.greatest("na", "nb").alias("b")).distinct())
        whole = None
        for jump in reversed(rounds):
            if whole is not None:
                later = whole.select(F.col("node").alias("m"), F.col("label").alias("r"))
                jump, _ = even(jump.join(spread(later), "m", "left").select("a", F.coalesce("r", "m").alias("m")))
            whole = jump.select(F.col("a").alias("node"), F.col("m").alias("label"))
        if whole is None:
            return cut(nodes.withColumn("component", F.col("node")))
        labelled, _ = even(nodes.join(spread(whole), "node", "left").select("node", F.coalesce("label", "node").alias("label")))
        smallest = labelled.groupBy("label").agg(F.min("node").alias("component"))
        return cut_even(labelled.join(spread(smallest), "label").select("node", "component"))[0]
