"""Training-corpus pipeline over ``documents``: toxicity filter, exact
de-duplication, n-gram Jaccard join, mixing sources to target weights, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows of its
predecessor. All but the last return the columns of their input; rows are told
apart by their place, so repeated and null ids are handled. An empty table
passes through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aulaframe.llm import exact_dedup, mixing, ngram_join, packing, toxicity
from aulaframe.llm.common import documents, labels, scratch_path, ship

#: the stages can't be written in SQL (trained model, near-duplicate links, packing)
ORACLE_SQL = None


def _numbered(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` with a number for each row, written in the shared folder and
    read again. The number is data: computed anew in each scan it would follow
    the splits, and these follow the cores registered at that moment. The table
    stays, as those of the stages do: a stage's result is read after it returns."""
    path = scratch_path(spark, "pipeline-numbered")
    docs.withColumn("__row", F.monotonically_increasing_id()).write.parquet(path)
    return spark.read.parquet(path)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the toxicity model doesn't reject."""
    scored = toxicity.score(docs, toxicity.fit(docs, labels(spark, sf_dir)), keep=tuple(docs.columns))
    return scored.filter("predicted = 0").select("kept_columns.*")


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays."""
    ship(spark)
    rows = _numbered(spark, docs)
    kept = exact_dedup.exact_groups(rows, keep="max", row="__row").filter("kept").select(F.col("row").alias("__row"))
    return rows.join(kept, "__row", "left_semi").drop("__row")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of the documents that links connect, the one with the smallest id stays.
    Five-word shingles, Jaccard similarity of 0.8 or more."""
    ship(spark)
    rows = _numbered(spark, docs)
    groups = ngram_join.jaccard_components(rows, n=5, percent=80, doc_id="__row")
    ids = rows.select(F.col("__row").alias("doc_id"), F.col("doc_id").alias("id"))
    first = groups.join(ids, "doc_id").groupBy("component_id") \
        .agg(F.min(F.struct(F.col("id").isNull(), "id", "doc_id")).alias("first")).select(F.col("first.doc_id").alias("__row"))
    return rows.join(first, "__row", "left_semi").drop("__row")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document appears as often as the mix takes it; what it doesn't take goes."""
    ship(spark)
    mixed = mixing.mix(docs, keep=tuple(docs.columns))
    return mixed.filter("copies > 0").select(F.explode(F.sequence(F.lit(1).cast("long"), "copies")), "kept_columns").select("kept_columns.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in windows of 2048 tokens."""
    ship(spark)
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("ngram_join", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet in the shared
    folder and read again."""
    docs = documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            path = scratch_path(spark, f"pipeline-{name}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
