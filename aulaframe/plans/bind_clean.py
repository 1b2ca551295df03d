"""Cleaning and conformance analyses (#11-23)."""

from __future__ import annotations

from pyspark.sql import functions as F

from aulaframe.functions.columns import (ACCENTED, PLAIN, money, normalise_text, pad_code, parse_period)
from aulaframe.operators import clean as C
from aulaframe.plans.registry import register
from aulaframe.plans.views import (BLOCK_HEADER_ROW, BLOCK_SHEET, PARTIAL_LABELS_SQL, SCORE_FACT_SQL,
                                   STRATUM_LEVELS, budget_cells, partial_labels, score_fact)
from aulaframe.sources.tables import Tables


@register("territory_code_pad", sql="""
SELECT n_nationkey, lpad(trim(CAST(n_nationkey AS VARCHAR)), 2, '0') AS code,
       lpad(trim(CAST(n_regionkey AS VARCHAR)), 2, '0') AS region_code, n_name FROM nation""")
def territory_code_pad(spark, sf_dir):
    n = Tables(spark, sf_dir).nation
    return n.select("n_nationkey", pad_code("n_nationkey", 2).alias("code"),
                    pad_code("n_regionkey", 2).alias("region_code"), "n_name")


@register("sector_filter", sql="""
SELECT c_nationkey, count(*) AS n, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS acctbal
FROM customer WHERE c_mktsegment = 'BUILDING' GROUP BY c_nationkey""")
def sector_filter(spark, sf_dir):
    c = C.filter_sector(Tables(spark, sf_dir).customer, "c_mktsegment", "BUILDING")
    return c.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"),
                                        F.sum(money("c_acctbal")).cast("double").alias("acctbal"))


BLOCK_LABEL = "NATION_7"


BLOCK_SQL = f"""
SELECT strftime(o_orderdate, '%Y-%m') AS file, '{BLOCK_SHEET}' AS sheet, {BLOCK_HEADER_ROW + 1} + n_nationkey AS row,
       n_name AS name, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS amount, count(*) AS n
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
WHERE n_name = '{BLOCK_LABEL}' GROUP BY 1, 2, 3, 4"""


@register("block_extract", sql=BLOCK_SQL)
def block_extract(spark, sf_dir):
    b = C.extract_block(budget_cells(spark, sf_dir), "^EJECUCION$", 1, BLOCK_LABEL, 3)
    return b.select("file", "sheet", "row", F.col("c1").alias("name"),
                    F.col("c2").try_cast("decimal(18,2)").cast("double").alias("amount"),
                    F.col("c3").try_cast("bigint").alias("n"))


@register("normalise_names", sql=f"""
SELECT upper(translate(regexp_replace(trim(p_name), '\\s+', ' ', 'g'), '{ACCENTED}', '{PLAIN}')) AS name_norm,
       count(*) AS n
FROM part GROUP BY 1""")
def normalise_names(spark, sf_dir):
    p = Tables(spark, sf_dir).part
    return p.groupBy(normalise_text("p_name").alias("name_norm")).agg(F.count(F.lit(1)).alias("n"))


# Recode dictionary for the programme character.
RECODE = [("ECONOMY", "BASIC"), ("STANDARD", "BASIC"), ("SMALL", "COMPACT")]


@register("recode_categories", sql="""
SELECT coalesce(m.dst, p.p_type) AS character, count(*) AS n
FROM part p LEFT JOIN (VALUES """ + ", ".join(f"('{a}', '{b}')" for a, b in RECODE) + """) AS m(src, dst)
  ON p.p_type = m.src GROUP BY 1""")
def recode_categories(spark, sf_dir):
    m = spark.createDataFrame(RECODE, "src string, dst string")
    p = C.recode(Tables(spark, sf_dir).part, "p_type", m, out="character")
    return p.groupBy("character").agg(F.count(F.lit(1)).alias("n"))


# Source codes that stand for "not known" / "not applicable".
MISSING_TOKENS = {"src0": "unknown", "src1": "not_applicable"}


@register("missing_tokens", sql="""
SELECT doc_id, CASE WHEN source IN ('src0', 'src1') THEN NULL ELSE source END AS source,
       CASE WHEN source IS NULL THEN 'null' WHEN source = 'src0' THEN 'unknown'
            WHEN source = 'src1' THEN 'not_applicable' END AS source_missing
FROM documents""")
def missing_tokens(spark, sf_dir):
    d = Tables(spark, sf_dir).documents.select("doc_id", "source")
    return C.normalise_missing(d, "source", MISSING_TOKENS)


@register("incomplete_exclude", ctes=(PARTIAL_LABELS_SQL,), sql="""
SELECT lang, count(*) AS n FROM partial_labels WHERE quality IS NOT NULL AND toxic IS NOT NULL GROUP BY lang""")
def incomplete_exclude(spark, sf_dir):
    d = C.drop_incomplete(partial_labels(spark, sf_dir), ["quality", "toxic"])
    return d.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))


@register("impute_mean", floats=("quality_imputed", "toxic_imputed"), ctes=(PARTIAL_LABELS_SQL,), sql="""
SELECT doc_id, coalesce(CAST(quality AS DOUBLE), avg(quality) OVER ()) AS quality_imputed,
       coalesce(CAST(toxic AS DOUBLE), avg(toxic) OVER ()) AS toxic_imputed
FROM partial_labels""")
def impute_mean(spark, sf_dir):
    d = C.impute(partial_labels(spark, sf_dir), ["quality", "toxic"], "mean")
    return d.select("doc_id", "quality_imputed", "toxic_imputed")


@register("impute_median", floats=("quality_imputed",), ctes=(PARTIAL_LABELS_SQL,), sql="""
SELECT doc_id, coalesce(CAST(quality AS DOUBLE), (SELECT quantile_cont(quality, 0.5) FROM partial_labels))
       AS quality_imputed
FROM partial_labels""")
def impute_median(spark, sf_dir):
    d = C.impute(partial_labels(spark, sf_dir), ["quality"], "median")
    return d.select("doc_id", "quality_imputed")


def _orders_landed(spark, sf_dir, odd):
    """The landed files of the odd years, or all others (even years, rows
    without a date). Odd years lack the priority column, carry the status under
    an old name and the amount as text (schema drift)."""
    year = F.year("o_orderdate").cast("bigint")
    is_odd = F.coalesce(year % 2 == 1, F.lit(False))
    o = Tables(spark, sf_dir).orders.filter(is_odd if odd else ~is_odd).withColumn("year", year)
    if odd:
        o = (o.drop("o_orderpriority").withColumnRenamed("o_orderstatus", "status_code")
             .withColumn("o_totalprice", F.col("o_totalprice").cast("string")))
    return o


@register("union_by_name_years", sql="""
SELECT CAST(year(o_orderdate) AS BIGINT) AS year, count(*) AS n,
       CAST(count_if(o_orderpriority IS NULL OR coalesce(year(o_orderdate) % 2 = 1, false)) AS BIGINT) AS n_null_priority,
       CAST(count_if(o_orderstatus IS NULL) AS BIGINT) AS n_null_status,
       CAST(count_if(o_orderstatus = 'F') AS BIGINT) AS n_status_f,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM orders GROUP BY 1""")
def union_by_name_years(spark, sf_dir):
    parts = [C.conform(_orders_landed(spark, sf_dir, odd), renames={"status_code": "o_orderstatus"},
                       casts={"o_totalprice": "double"})
             for odd in (True, False)]
    u = C.consolidate(parts)
    return u.groupBy("year").agg(F.count(F.lit(1)).alias("n"),
                                 F.count_if(F.col("o_orderpriority").isNull()).alias("n_null_priority"),
                                 F.count_if(F.col("o_orderstatus").isNull()).alias("n_null_status"),
                                 F.count_if(F.col("o_orderstatus") == "F").alias("n_status_f"),
                                 F.sum(money("o_totalprice")).cast("double").alias("total"))


# Declared layout of the orders reports.
ORDERS_LAYOUT = {"o_orderkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double", "o_orderpriority": "string"}


@register("schema_drift", sql="""
WITH p AS (SELECT *, coalesce(year(o_orderdate) % 2 = 1, false) AS odd FROM orders),
c AS (SELECT odd, count(*) AS n, count(o_orderkey) AS k, count(o_orderstatus) AS s, count(o_totalprice) AS t, count(o_orderpriority) AS q FROM p GROUP BY odd)
SELECT 'odd_years' AS file, l.col0 AS "column", l.col1 AS found, l.col2 AS declared, l.col3 AS status, n AS n_rows,
       CASE l.col0 WHEN 'o_orderkey' THEN n - k WHEN 'o_orderstatus' THEN n - s WHEN 'o_totalprice' THEN n - t ELSE n END AS n_null, 0::BIGINT AS n_rejected
FROM c, (VALUES ('o_orderkey', 'bigint', 'bigint', 'ok'), ('o_orderstatus', 'string', 'string', 'renamed'),
                ('o_totalprice', 'string', 'double', 'type_differs'), ('o_orderpriority', NULL, 'string', 'missing')) l WHERE odd
UNION ALL
SELECT 'even_years', l.col0, l.col1, l.col1, 'ok', n,
       CASE l.col0 WHEN 'o_orderkey' THEN n - k WHEN 'o_orderstatus' THEN n - s WHEN 'o_totalprice' THEN n - t ELSE n - q END, 0::BIGINT
FROM c, (VALUES ('o_orderkey', 'bigint'), ('o_orderstatus', 'string'), ('o_totalprice', 'double'), ('o_orderpriority', 'string')) l WHERE NOT odd""")
def schema_drift(spark, sf_dir):
    parts = {name: _orders_landed(spark, sf_dir, odd).drop("year", "o_custkey", "o_orderdate")
             for name, odd in (("odd_years", True), ("even_years", False))}
    return C.schema_inventory(parts, ORDERS_LAYOUT, {"status_code": "o_orderstatus"})


# The orders as text reports: some amounts, dates and codes are written as no
# cast reads them.
REPORT_TYPES = {"o_totalprice": "double", "o_orderdate": "date", "o_custkey": "int"}


def orders_report(spark, sf_dir):
    k, amount = F.col("o_orderkey"), money("o_totalprice").cast("string")
    every = lambda n: k % n == 0
    return Tables(spark, sf_dir).orders.select(
        F.concat(F.lit("orders_"), F.year("o_orderdate").cast("string")).alias("file"), "o_orderkey",
        F.when(every(97), "s/d").when(every(89), " ").when(every(83), F.replace(amount, F.lit("."), F.lit(","))).otherwise(amount).alias("o_totalprice"),
        F.when(every(79), F.date_format("o_orderdate", "dd/MM/yyyy")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("o_orderdate"),
        F.when(every(73), F.concat(F.col("o_custkey").cast("string"), F.lit("00000000000"))).otherwise(F.col("o_custkey").cast("string")).alias("o_custkey"))


@register("quarantine_values", sql="""
WITH r AS (SELECT 'orders_' || year(o_orderdate) AS file, o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS amount, o_orderdate, o_custkey FROM orders)
SELECT file, o_orderkey, 'o_totalprice' AS "column",
       CASE WHEN o_orderkey % 97 = 0 THEN 's/d' WHEN o_orderkey % 89 = 0 THEN ' ' ELSE replace(amount, '.', ',') END AS raw,
       CASE WHEN o_orderkey % 97 <> 0 AND o_orderkey % 89 = 0 THEN 'blank' ELSE 'not_double' END AS reason
FROM r WHERE o_orderkey % 97 = 0 OR o_orderkey % 89 = 0 OR (o_orderkey % 83 = 0 AND amount IS NOT NULL)
UNION ALL SELECT file, o_orderkey, 'o_orderdate', strftime(o_orderdate, '%d/%m/%Y'), 'not_date' FROM r WHERE o_orderkey % 79 = 0 AND o_orderdate IS NOT NULL
UNION ALL SELECT file, o_orderkey, 'o_custkey', o_custkey || '00000000000', 'out_of_range' FROM r WHERE o_orderkey % 73 = 0 AND o_custkey > 0""")
def quarantine_values(spark, sf_dir):
    return C.rejected_values(orders_report(spark, sf_dir), REPORT_TYPES, ["file", "o_orderkey"])


@register("consolidate_months", sql="""
SELECT CAST(year(o_orderdate) AS BIGINT) AS year, CAST(month(o_orderdate) AS BIGINT) AS month, count(*) AS n,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM orders GROUP BY 1, 2""")
def consolidate_months(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    months = [o.filter(F.month("o_orderdate") == m) for m in range(1, 13)]  # 12 monthly files
    months.append(o.filter(F.col("o_orderdate").isNull()))  # and the undated rows
    u = C.consolidate(months)
    return (u.groupBy(F.year("o_orderdate").cast("bigint").alias("year"),
                      F.month("o_orderdate").cast("bigint").alias("month"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum(money("o_totalprice")).cast("double").alias("total")))


@register("period_parse", ctes=(SCORE_FACT_SQL,), sql="""
SELECT period, try_cast(substring(trim(period), 1, 4) AS BIGINT) AS year,
       try_cast(substring(trim(period), 5, 8) AS BIGINT) AS sitting, count(*) AS n
FROM score_fact GROUP BY period""")
def period_parse(spark, sf_dir):
    sf = score_fact(spark, sf_dir)
    g = sf.groupBy("period").agg(F.count(F.lit(1)).alias("n"))
    y, s = parse_period("period")
    return g.select("period", y.alias("year"), s.alias("sitting"), "n")


@register("ordinal_levels", sql="""
SELECT o_orderpriority, lv.r AS level_rank, count(*) AS n
FROM orders LEFT JOIN (VALUES """ + ", ".join(f"('{lv}', {i})" for i, lv in enumerate(STRATUM_LEVELS, 1)) + """) AS lv(l, r)
  ON o_orderpriority = lv.l GROUP BY 1, 2""")
def ordinal_levels(spark, sf_dir):
    o = C.with_level(Tables(spark, sf_dir).orders, "o_orderpriority", STRATUM_LEVELS)
    return o.groupBy("o_orderpriority", "level_rank").agg(F.count(F.lit(1)).alias("n"))
