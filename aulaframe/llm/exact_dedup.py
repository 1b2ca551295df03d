"""Exact de-duplication by content sort.

Sampled splitters range-partition the normalised bytes: ``repartitionByRange``
on their first ``LEAD`` characters, then their digest and the id, so what is
sampled is short, and a text with very many copies, or a beginning that very
many texts share, is split over several partitions. Spark's external sort
places equal texts next to each other, and each task compares neighbouring
texts in full. Runs of equal texts that touch
the edge of a partition are stitched by the summary of the partition's first
and last run (at most two rows for a partition).

Defined results: null text is the empty text; null ids are kept as rows and
never survive while the run has another id (all ids null: the run's keep id is
null and one row stays); rows that repeat an id are rows of the group, and
exactly one of them stays; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aulaframe.llm.common import cut, documents, input_partitions

LEAD = 32  # characters of a text that lead its place in the order

_RUNS = ("doc_id long, row long, pid int, run long, keep_run long, size_run long, last_of_run boolean, "
         "edge boolean, text_sha256 string")


def _label_runs(batches):
    """Number the runs of equal neighbours in a sorted partition. Only the ids
    of the open run are held. A run is written when it ends, so the partition's
    first and last runs are known as edges."""
    pid = TaskContext.get().partitionId()
    run, prev, digest, ids, marks = 0, None, "", [], []

    def flush(edge):
        known = [i for i in ids if i is not None]
        keep = known[-1] if known else None  # ids ascend within a run, nulls first
        n = len(ids)
        return pa.RecordBatch.from_arrays([
            pa.array(ids, pa.int64()), pa.array(marks, pa.int64()), pa.array([pid] * n, pa.int32()), pa.array([run] * n, pa.int64()),
            pa.array([keep] * n, pa.int64()), pa.array([n] * n, pa.int64()),
            pa.array([False] * (n - 1) + [True]), pa.array([edge] * n),
            pa.array([digest] * n)],
            ["doc_id", "row", "pid", "run", "keep_run", "size_run", "last_of_run", "edge", "text_sha256"])

    out, rows = [], 0
    for b in batches:
        if not b.num_rows:
            continue
        text, doc, mark = b.column(0).cast(pa.binary()), b.column(1).to_pylist(), b.column(2).to_pylist()
        differs = [True] + pc.not_equal(text[1:], text[:-1]).to_pylist()
        if prev is not None:
            differs[0] = text[0].as_py() != prev
        for i, new in enumerate(differs):
            if new:
                if ids:
                    out.append(flush(run == 0))
                    rows += len(ids)
                    run += 1
                prev, digest, ids, marks = text[i].as_py(), b.column(3)[i].as_py().hex(), [], []
                if rows >= 5000:
                    yield from pa.Table.from_batches(out).combine_chunks().to_batches()
                    out, rows = [], 0
            ids.append(doc[i])
            marks.append(mark[i])
    if ids:
        out.append(flush(True))
    if out:
        yield from pa.Table.from_batches(out).combine_chunks().to_batches()


def exact_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", keep: str = "max",
                 normalise=lambda c: c, partitions: int | None = None, row: str | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept,
    text_sha256, and the column named by ``row`` (a number of the row, if its
    id isn't unique) as row. ``keep``: which id of equal texts stays ("min" or "max");
    ``normalise``: column expression applied to the text before it is compared
    (none by default)."""
    sign = 1 if keep == "max" else -1
    src = docs.select(normalise(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("t"),
                      (F.col(doc_id).cast("long") * sign).alias("i"),
                      (F.col(row) if row else F.lit(None).cast("long")).alias("r"))
    n = partitions or max(input_partitions(docs), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    src = src.withColumn("d", F.unhex(F.sha2("t", 256))).withColumn("lead", F.substring("t", 1, LEAD))
    ordered = src.repartitionByRange(n, "lead", "d", "i").sortWithinPartitions("lead", "d", "t", "i")
    runs = cut(ordered.select("t", "i", "r", "d").mapInArrow(_label_runs, _RUNS))
    # at most two edge runs a partition: the whole table has two rows for each
    # shuffle partition, whatever the number of documents
    edges = runs.filter("edge and last_of_run").select("pid", "run", "text_sha256", "keep_run", "size_run")
    whole = Window.partitionBy("text_sha256")
    stitched = edges.select("pid", "run", F.max("keep_run").over(whole).alias("keep_all"),
                            F.sum("size_run").over(whole).alias("size_all"),
                            (F.struct("pid", "run") == F.max(F.struct("pid", "run")).over(whole)).alias("last_part"),
                            F.max(F.struct(F.col("keep_run").isNotNull(), F.col("keep_run"), F.col("pid"))).over(whole)
                            .getField("pid").alias("home"))
    out = runs.join(F.broadcast(stitched), ["pid", "run"], "left")
    return out.select(
        (F.col("doc_id") * sign).alias("doc_id"),
        (F.coalesce("keep_all", "keep_run") * sign).alias("keep_id"),
        F.coalesce("size_all", "size_run").alias("group_size"),
        (F.col("last_of_run") & F.coalesce(F.col("home") == F.col("pid"), F.lit(True))).alias("kept"),
        "text_sha256", *["row"] * bool(row))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(documents(spark, sf_dir), keep="max")


OP4_SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""
