"""Sources, sinks, catalog and incremental-refresh analyses (#1-10).

Scratch files are written under the shared folder named by
``spark.checkpoint.dir`` (never a machine-local temporary folder).
"""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from aulaframe.functions.columns import money, pad_code
from aulaframe.operators.clean import extract_block
from aulaframe.plans.bind_clean import BLOCK_LABEL, BLOCK_SQL
from aulaframe.plans.bind_star import STAR, fact_df
from aulaframe.plans.registry import grid, register
from aulaframe.plans.views import CATALOG_SQL, budget_cells, catalog, token_map
from aulaframe.session import scratch_path
from aulaframe.sources import files as IO
from aulaframe.sources.tables import Tables
from aulaframe.streaming.refresh import read_sink, refresh
from aulaframe.streaming.states import growth, summarise, value_states

CUSTOMER_TEXT_SCHEMA = IO.schema_of({"c_custkey": "string", "c_name": "string", "c_nationkey": "string",
                                     "c_acctbal": "double", "c_mktsegment": "string"})


@register("scan_text_roundtrip", sql="""
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS nation_code,
       c_acctbal, c_mktsegment FROM customer""")
def scan_text_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "landing-customer-txt")
    IO.write_text(Tables(spark, sf_dir).customer, path, sep="|")
    df = IO.read_microdata(spark, path, CUSTOMER_TEXT_SCHEMA, sep="|")
    return df.select("c_custkey", "c_name", pad_code("c_nationkey", 2).alias("nation_code"),
                     "c_acctbal", "c_mktsegment")


NATION_CSV_SCHEMA = IO.schema_of({"code": "string", "n_name": "string", "region_code": "string"})


@register("code_preserving_scan", sql="""
SELECT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS code, n_name,
       lpad(CAST(n_regionkey AS VARCHAR), 2, '0') AS region_code, 2 AS code_len FROM nation""")
def code_preserving_scan(spark, sf_dir):
    path = scratch_path(spark, "landing-nation-csv")
    n = Tables(spark, sf_dir).nation.select(pad_code("n_nationkey", 2).alias("code"), "n_name",
                                            pad_code("n_regionkey", 2).alias("region_code"))
    IO.write_text(n, path, sep=",")
    back = IO.read_counts(spark, path, NATION_CSV_SCHEMA)
    return back.select("code", "n_name", "region_code", F.length("code").alias("code_len"))


@register("block_extract_files", sql=BLOCK_SQL)
def block_extract_files(spark, sf_dir):
    """Same extraction as ``block_extract`` but through landed CSV cell
    grids read back with the declared cell schema."""
    path = scratch_path(spark, "landing-cells")
    IO.write_text(budget_cells(spark, sf_dir), path, sep=",")
    cells = IO.read_cells(spark, path)
    b = extract_block(cells, "^EJECUCION$", 1, BLOCK_LABEL, 3)
    return b.select("file", "sheet", "row", F.col("c1").alias("name"),
                    F.col("c2").try_cast("decimal(18,2)").cast("double").alias("amount"),
                    F.col("c3").try_cast("bigint").alias("n"))


@register("file_catalog")
def file_catalog(spark, sf_dir):
    """Listing of the data directory (names, extension, size); no oracle
    (the SQL engine cannot list files of an unknown directory)."""
    return IO.file_catalog(spark, sf_dir, [".parquet"]).select("name", "ext", "length")


@register("manifest", ctes=(CATALOG_SQL,), sql="""
SELECT c.origin AS link, coalesce(t.category, c.token) AS category, c.year, c.path,
       CASE WHEN t.category IS NULL THEN 'unmapped' ELSE 'ok' END AS outcome
FROM catalog c LEFT JOIN token_map t USING (token)""")
def manifest(spark, sf_dir):
    path = scratch_path(spark, "manifest")
    IO.append_manifest(IO.manifest_rows(catalog(spark, sf_dir), token_map(spark, sf_dir)), path)
    return spark.read.parquet(path)


@register("rename_plan", ctes=(CATALOG_SQL,), sql="""
SELECT origin, token, category, year, path,
       CASE WHEN k = 1 THEN base || ext ELSE base || ' (' || CAST(k AS VARCHAR) || ')' || ext END AS final_name,
       CAST(k AS BIGINT) AS clash_ordinal
FROM (SELECT c.origin, c.token, t.category, c.year, c.path, c.ext, t.category || '_' || CAST(c.year AS VARCHAR) AS base,
             row_number() OVER (PARTITION BY t.category, c.year, c.ext ORDER BY c.origin) AS k
      FROM catalog c JOIN token_map t USING (token)) x""")
def rename_plan(spark, sf_dir):
    return IO.plan_renames(catalog(spark, sf_dir), token_map(spark, sf_dir))


@register("rename_unmapped", ctes=(CATALOG_SQL,), sql="""
SELECT c.token, c.origin, c.year, c.ext, c.path FROM catalog c
WHERE NOT EXISTS (SELECT 1 FROM token_map t WHERE t.token = c.token)""")
def rename_unmapped(spark, sf_dir):
    return IO.unmapped(catalog(spark, sf_dir), token_map(spark, sf_dir))


EXPECTED_YEARS = [2021, 2022, 2023, 2024]


@register("missing_category_year", ctes=(CATALOG_SQL,), sql="""
SELECT t.category, CAST(y.year AS BIGINT) AS year
FROM (SELECT DISTINCT category FROM token_map) t, (VALUES """ + ", ".join(f"({y})" for y in EXPECTED_YEARS) + """) y(year)
WHERE NOT EXISTS (SELECT 1 FROM catalog c JOIN token_map m USING (token)
                  WHERE m.category = t.category AND c.year = y.year)""")
def missing_category_year(spark, sf_dir):
    tm = token_map(spark, sf_dir)
    found = catalog(spark, sf_dir).join(tm, "token").select("category", "year")
    return IO.missing_combinations(found, "category", "year", tm, EXPECTED_YEARS)


@register("gold_fact_written", ctes=STAR, sql="""
SELECT year, count(*) AS n, CAST(sum(CAST(module2 AS DECIMAL(18,2))) AS DOUBLE) AS module2_total
FROM fact_scores GROUP BY year""")
def gold_fact_written(spark, sf_dir):
    path = scratch_path(spark, "gold-fact")
    IO.write_gold(fact_df(spark, sf_dir), path, "year")
    back = spark.read.parquet(path)
    return back.groupBy(F.col("year").cast("bigint").alias("year")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(money("module2")).cast("double").alias("module2_total"))


ORDERS_SCHEMA = IO.schema_of({"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string",
                              "o_totalprice": "double", "o_orderdate": "timestamp_ntz",
                              "o_orderpriority": "string"})
FIRST_LOAD_LAST_YEAR = 1999


def run_refresh(spark, sf_dir) -> tuple[str, str, list[int], int]:
    """Land orders up to 1999, refresh; land all others, refresh; refresh
    again with nothing new. Returns (sink, dimension, rows per run, last
    epoch of the first load)."""
    landing = scratch_path(spark, "landing-orders")
    sink = scratch_path(spark, "orders-sink")
    dim = scratch_path(spark, "household-dim")
    ckpt = scratch_path(spark, "orders-refresh-ckpt")
    o = Tables(spark, sf_dir).orders
    counts = []

    def run():
        refresh(spark, landing, sink, ckpt, ORDERS_SCHEMA, dim_path=dim,
                dim_cols=["o_custkey"], dim_key="o_custkey")
        counts.append(read_sink(spark, sink).count())

    # the second load is the complement of the first, so every row is landed
    # (without a date as well)
    early = F.coalesce(F.col("o_orderdate") < F.to_timestamp_ntz(F.lit(f"{FIRST_LOAD_LAST_YEAR + 1}-01-01 00:00:00")), F.lit(False))
    o.filter(early).write.mode("append").parquet(landing)
    run()
    first_epoch_max = spark.read.parquet(sink).agg(F.max("epoch")).first()[0]
    o.filter(~early).write.mode("append").parquet(landing)
    run()
    run()  # nothing new landed: must add no rows
    return sink, dim, counts, first_epoch_max


@register("incremental_refresh", sql="""
SELECT CAST(year(o_orderdate) AS BIGINT) AS year, count(*) AS n,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM orders GROUP BY 1""")
def incremental_refresh(spark, sf_dir):
    sink, _, counts, _ = run_refresh(spark, sf_dir)
    if counts[2] != counts[1]:
        raise RuntimeError(f"refresh without new files changed the sink: {counts}")
    s = read_sink(spark, sink)
    return s.groupBy(F.year("o_orderdate").cast("bigint").alias("year")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(money("o_totalprice")).cast("double").alias("total"))


@register("incremental_dimension", sql=f"""
SELECT CASE WHEN min(year(o_orderdate)) <= {FIRST_LOAD_LAST_YEAR} THEN 'first_load' ELSE 'second_load' END AS load,
       o_custkey
FROM orders GROUP BY o_custkey""")
def incremental_dimension(spark, sf_dir):
    """Household members added by each load (left anti join per epoch)."""
    _, dim, _, first_epoch_max = run_refresh(spark, sf_dir)
    d = spark.read.parquet(dim)
    return d.select(F.when(F.col("epoch") <= first_epoch_max, F.lit("first_load"))
                    .otherwise(F.lit("second_load")).alias("load"), "o_custkey")


STATE_PROBS = {"q1": 0.25, "median": 0.5, "q3": 0.75}
_G = growth()
_PICK = ",\n       ".join(
    f"max(CASE WHEN upto > floor({p} * (total - 1)) AND upto - n <= floor({p} * (total - 1)) THEN shown END) AS {name}" for name, p in STATE_PROBS.items())


def run_statistics(spark, sf_dir) -> tuple[str, str]:
    """Two loads of the orders, each leaving the states of its own rows.
    Returns (sink, states)."""
    landing, sink = scratch_path(spark, "landing-states"), scratch_path(spark, "states-sink")
    states, ckpt = scratch_path(spark, "states"), scratch_path(spark, "states-ckpt")
    o = Tables(spark, sf_dir).orders
    early = F.coalesce(F.year("o_orderdate") <= FIRST_LOAD_LAST_YEAR, F.lit(False))
    for load in (early, ~early):
        o.filter(load).write.mode("append").parquet(landing)
        refresh(spark, landing, sink, ckpt, ORDERS_SCHEMA, state_path=states,
                states=lambda df: value_states(df, ["o_orderpriority"], "o_totalprice"))
    return sink, states


@register("refreshed_statistics", floats=("mean", "sd", *grid("min", "max"), *STATE_PROBS), sql=f"""
SELECT s.o_orderpriority, s.rows, s.n, s.mean, s.sd, s.min, s.max, p.q1, p.median, p.q3 FROM (
SELECT o_orderpriority,
       {_PICK}
FROM (SELECT *, least(greatest(sign * pow({_G!r}, bucket) * {2 / (1 + _G)!r}, lo), hi) AS shown,
             sum(n) OVER (PARTITION BY o_orderpriority ORDER BY sign, sign * bucket) AS upto,
             sum(n) OVER (PARTITION BY o_orderpriority) AS total
      FROM (SELECT o_orderpriority, sign(o_totalprice) AS sign, CASE WHEN o_totalprice <> 0 THEN ceil(ln(abs(o_totalprice)) / {math.log(_G)!r}) ELSE 0 END AS bucket,
                   count(*) AS n, min(o_totalprice) AS lo, max(o_totalprice) AS hi
            FROM orders WHERE o_totalprice IS NOT NULL GROUP BY 1, 2, 3))
GROUP BY 1) p RIGHT JOIN (
SELECT o_orderpriority, count(*) AS rows, count(o_totalprice) AS n, avg(o_totalprice) AS mean, stddev_samp(o_totalprice) AS sd,
       min(o_totalprice) AS min, max(o_totalprice) AS max FROM orders GROUP BY 1) s ON p.o_orderpriority IS NOT DISTINCT FROM s.o_orderpriority""")
def refreshed_statistics(spark, sf_dir):
    """Statistics of all loads from their states alone."""
    _, states = run_statistics(spark, sf_dir)
    return summarise(spark.read.parquet(states), ["o_orderpriority"], STATE_PROBS)
