"""Queries of aulaframe.llm against their oracle SQL, and the pipeline's invariants."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from aulaframe.llm.registry import ORACLES, QUERIES
from conftest import SF_SMALL


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, duck_small, name):
    got, want = QUERIES[name](spark, SF_SMALL).toArrow(), duck_small.sql(ORACLES[name]).to_arrow_table()
    cols = sorted(want.column_names)
    assert sorted(got.column_names) == cols
    rows = lambda t: Counter(zip(*[t.column(c).to_pylist() for c in cols]))
    assert rows(got) == rows(want)


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[1:4]:
        out = stage(spark, docs, SF_SMALL)
        assert out.columns == docs.columns, name
    texts = docs.select("text").distinct().count()
    assert corpus_pipeline.drop_exact_copies(spark, docs, SF_SMALL).count() == texts


@pytest.mark.parametrize("stage", [corpus_pipeline.drop_exact_copies, corpus_pipeline.drop_near_copies])
def test_row_numbers_do_not_follow_the_splits(spark, tmp_path, stage):
    base = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(1)
    texts = [" ".join(f"w{i // 2}x{j}" for j in range(30)) for i in range(40)]  # each twice
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8, "doc_id")
    rows.select(*[c if c in rows.columns else F.lit(None).cast(base.schema[c].dataType).alias(c) for c in base.columns]) \
        .write.parquet(f"{tmp_path}/documents.parquet")
    key = "spark.sql.leafNodeDefaultParallelism"
    try:
        spark.conf.set(key, 1)
        out = stage(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path))
        spark.conf.set(key, 64)  # a split for each file
        assert Counter(r.text for r in out.collect()) == Counter(set(texts))
    finally:
        spark.conf.unset(key)
