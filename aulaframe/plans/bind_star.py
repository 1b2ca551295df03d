"""Star schema (#26-27, #30-34): staging = line items (one per 'student'),
de-duplicated on (l_orderkey, l_linenumber); dimensions keyed naturally."""

from __future__ import annotations

from pyspark.sql import functions as F

from aulaframe.operators import star as S
from aulaframe.operators.clean import small_side
from aulaframe.operators.ranking import join_on_keys
from aulaframe.plans.registry import register
from aulaframe.plans.views import MODULES, gold
from aulaframe.sources.tables import Tables

STUDENT_KEY = ["l_orderkey", "l_linenumber"]
# survivor order: latest ship date, then every remaining column (descending)
SURVIVOR_ORDER = ["l_shipdate"]
_REST = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
         "l_tax", "l_returnflag", "l_linestatus"]


def stage(spark, sf_dir):
    return S.dedup(Tables(spark, sf_dir).lineitem, STUDENT_KEY, SURVIVOR_ORDER)


STAGE_SQL = f"""
stage AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                 ORDER BY l_shipdate DESC, {', '.join(c + ' DESC' for c in _REST)}) AS rn
    FROM lineitem) t WHERE rn = 1
)"""


def dim_student_df(spark, sf_dir, st=None):
    st = st if st is not None else stage(spark, sf_dir)
    return S.build_dim(st.select(*STUDENT_KEY, F.col("l_linestatus").alias("sex"),
                                 F.nullif("l_returnflag", F.lit("N")).alias("ethnicity")),
                       STUDENT_KEY + ["sex", "ethnicity"], natural=STUDENT_KEY)


def dim_institution_df(spark, sf_dir):
    t = Tables(spark, sf_dir)
    s = t.supplier.join(small_side(t.nation), F.col("s_nationkey") == F.col("n_nationkey"))
    return s.select(F.col("s_suppkey").alias("institution_key"), F.col("s_name").alias("institution"),
                    F.col("n_name").alias("department"))


def dim_programme_df(spark, sf_dir):
    p = Tables(spark, sf_dir).part
    return p.select(F.col("p_partkey").alias("programme_key"), F.col("p_name").alias("programme"),
                    F.col("p_type").alias("character"), F.col("p_brand").alias("core"))


def dim_household_df(spark, sf_dir):
    t = Tables(spark, sf_dir)
    c = t.customer.join(small_side(t.nation), F.col("c_nationkey") == F.col("n_nationkey"))
    return c.select(F.col("c_custkey").alias("household_key"),
                    (F.col("c_mktsegment") == "BUILDING").alias("internet"),
                    F.col("c_mktsegment").alias("segment"), F.col("n_name").alias("department"))


def dim_year_df(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return (o.groupBy(F.year("o_orderdate").cast("bigint").alias("year"))
            .agg(F.to_date(F.min("o_orderdate")).alias("first_date"),
                 F.to_date(F.max("o_orderdate")).alias("last_date")))


STAR_INPUTS = ["lineitem", "orders", "customer", "nation", "part", "supplier"]


def staged(spark, sf_dir):
    """The staging rows, written once for the queries that share them."""
    return gold(spark, sf_dir, "stage", ["lineitem"], stage)


def fact_df(spark, sf_dir, st=None):
    """Staging rows with the keys of their dimension members. Orders look their
    household up, staging rows the other members, before the two meet: by a merge
    join at every size, so its shuffle deals the written table."""
    st = st if st is not None else stage(spark, sf_dir)
    placed = S.build_fact(Tables(spark, sf_dir).orders, {"household_key": (dim_household_df(spark, sf_dir), {"o_custkey": "household_key"}, "household_key")},
                          ["o_orderkey", "o_orderdate", "o_totalprice", "household_key"])
    dims = {"institution_key": (dim_institution_df(spark, sf_dir), {"l_suppkey": "institution_key"}, "institution_key"),
            "programme_key": (dim_programme_df(spark, sf_dir), {"l_partkey": "programme_key"}, "programme_key")}
    f = S.build_fact(st, dims, [*STUDENT_KEY, "l_quantity", "l_extendedprice", "l_discount", "l_tax", *dims]) \
        .join(placed.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
    return f.select(*STUDENT_KEY, *dims, "household_key", F.year("o_orderdate").cast("bigint").alias("year"),
                    F.col("l_quantity").alias("module1"), F.col("l_extendedprice").alias("module2"),
                    (F.col("l_discount") + F.lit(0.0)).alias("module3"),
                    (F.col("l_tax") + F.lit(0.0)).alias("module4"),
                    F.col("o_totalprice").alias("module5"))


def written_fact(spark, sf_dir):
    """The fact table, written once for the queries that share it."""
    return gold(spark, sf_dir, "fact", STAR_INPUTS, lambda s, d: fact_df(s, d, staged(s, d)))


DIMS_SQL = """
dim_student AS (
  SELECT l_orderkey, l_linenumber, l_linestatus AS sex, nullif(l_returnflag, 'N') AS ethnicity FROM stage
),
dim_institution AS (
  SELECT s_suppkey AS institution_key, s_name AS institution, n_name AS department
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
),
dim_programme AS (
  SELECT p_partkey AS programme_key, p_name AS programme, p_type AS character, p_brand AS core FROM part
),
dim_household AS (
  SELECT c_custkey AS household_key, c_mktsegment = 'BUILDING' AS internet, c_mktsegment AS segment,
         n_name AS department
  FROM customer JOIN nation ON c_nationkey = n_nationkey
),
dim_year AS (
  SELECT CAST(year(o_orderdate) AS BIGINT) AS year, CAST(min(o_orderdate) AS DATE) AS first_date,
         CAST(max(o_orderdate) AS DATE) AS last_date
  FROM orders GROUP BY 1
),
fact_scores AS (
  SELECT s.l_orderkey, s.l_linenumber, coalesce(di.institution_key, -1) AS institution_key,
         coalesce(dp.programme_key, -1) AS programme_key, coalesce(dh.household_key, -1) AS household_key, CAST(year(o.o_orderdate) AS BIGINT) AS year,
         s.l_quantity AS module1, s.l_extendedprice AS module2, s.l_discount + 0.0 AS module3,
         s.l_tax + 0.0 AS module4, o.o_totalprice AS module5
  FROM stage s JOIN orders o ON s.l_orderkey = o.o_orderkey
  LEFT JOIN dim_institution di ON di.institution_key = s.l_suppkey
  LEFT JOIN dim_programme dp ON dp.programme_key = s.l_partkey
  LEFT JOIN dim_household dh ON dh.household_key = o.o_custkey
)"""

STAR = (STAGE_SQL, DIMS_SQL)


@register("dedup_latest", ctes=(STAGE_SQL,), sql="SELECT * FROM stage")
def dedup_latest(spark, sf_dir):
    return stage(spark, sf_dir)


@register("duplicate_keys", ctes=(), sql="""
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def duplicate_keys(spark, sf_dir):
    return S.duplicates(Tables(spark, sf_dir).lineitem, STUDENT_KEY)


@register("dim_student", ctes=STAR, sql="SELECT * FROM dim_student")
def dim_student(spark, sf_dir):
    return dim_student_df(spark, sf_dir)


@register("dim_institution", ctes=STAR, sql="SELECT * FROM dim_institution")
def dim_institution(spark, sf_dir):
    return dim_institution_df(spark, sf_dir)


@register("dim_programme", ctes=STAR, sql="SELECT * FROM dim_programme")
def dim_programme(spark, sf_dir):
    return dim_programme_df(spark, sf_dir)


@register("dim_household", ctes=STAR, sql="SELECT * FROM dim_household")
def dim_household(spark, sf_dir):
    return dim_household_df(spark, sf_dir)


@register("dim_year", ctes=STAR, sql="SELECT * FROM dim_year")
def dim_year(spark, sf_dir):
    return dim_year_df(spark, sf_dir)


@register("fact_scores", ctes=STAR, sql="SELECT * FROM fact_scores")
def fact_scores(spark, sf_dir):
    return fact_df(spark, sf_dir)


@register("star_rollup", floats=("mean_module1", "mean_module5"), ctes=STAR, sql="""
SELECT h.department, p.character, y.year, count(*) AS n,
       avg(f.module1) AS mean_module1, avg(f.module5) AS mean_module5
FROM fact_scores f
JOIN dim_household h ON f.household_key = h.household_key
JOIN dim_programme p ON f.programme_key = p.programme_key
JOIN dim_year y ON f.year = y.year
GROUP BY h.department, p.character, y.year""")
def star_rollup(spark, sf_dir):
    dims = {"household": (dim_household_df(spark, sf_dir).select("household_key", "department"), "household_key"),
            "programme": (dim_programme_df(spark, sf_dir).select("programme_key", "character"), "programme_key"),
            "year": (dim_year_df(spark, sf_dir).select("year"), "year")}
    return S.star_query(written_fact(spark, sf_dir), dims, ["department", "character", "year"],
                        [F.count(F.lit(1)).alias("n"), F.avg("module1").alias("mean_module1"),
                         F.avg("module5").alias("mean_module5")])


@register("star_integrity", ctes=STAR, sql="""
SELECT 'staging_rows' AS "check", count(*) AS value FROM stage
UNION ALL SELECT 'fact_rows', count(*) FROM fact_scores
UNION ALL SELECT 'orphans_student', count(*) FROM fact_scores f WHERE NOT EXISTS
  (SELECT 1 FROM dim_student d WHERE d.l_orderkey IS NOT DISTINCT FROM f.l_orderkey AND d.l_linenumber IS NOT DISTINCT FROM f.l_linenumber)
UNION ALL SELECT 'duplicate_keys_student', count(*) FROM
  (SELECT l_orderkey, l_linenumber FROM dim_student GROUP BY ALL HAVING count(*) > 1)
UNION ALL SELECT 'orphans_institution', count(*) FROM fact_scores f WHERE NOT EXISTS (SELECT 1 FROM dim_institution d WHERE d.institution_key IS NOT DISTINCT FROM f.institution_key)
UNION ALL SELECT 'duplicate_keys_institution', count(*) FROM (SELECT institution_key FROM dim_institution GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'orphans_programme', count(*) FROM fact_scores f WHERE NOT EXISTS (SELECT 1 FROM dim_programme d WHERE d.programme_key IS NOT DISTINCT FROM f.programme_key)
UNION ALL SELECT 'duplicate_keys_programme', count(*) FROM (SELECT programme_key FROM dim_programme GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'orphans_household', count(*) FROM fact_scores f WHERE NOT EXISTS (SELECT 1 FROM dim_household d WHERE d.household_key IS NOT DISTINCT FROM f.household_key)
UNION ALL SELECT 'duplicate_keys_household', count(*) FROM (SELECT household_key FROM dim_household GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'orphans_year', count(*) FROM fact_scores f WHERE NOT EXISTS (SELECT 1 FROM dim_year d WHERE d.year IS NOT DISTINCT FROM f.year)
UNION ALL SELECT 'duplicate_keys_year', count(*) FROM (SELECT year FROM dim_year GROUP BY 1 HAVING count(*) > 1)""")
def star_integrity(spark, sf_dir):
    # staging and fact are written tables: neither is computed again here
    st = staged(spark, sf_dir)
    fact = written_fact(spark, sf_dir).withColumn("student_key", F.struct(*STUDENT_KEY))
    ds = dim_student_df(spark, sf_dir, st).withColumn("student_key", F.struct(*STUDENT_KEY))
    dims = {"student": (ds, "student_key"),
            "institution": (dim_institution_df(spark, sf_dir), "institution_key"),
            "programme": (dim_programme_df(spark, sf_dir), "programme_key"),
            "household": (dim_household_df(spark, sf_dir), "household_key"),
            "year": (dim_year_df(spark, sf_dir), "year")}
    return S.check_star(st, fact, dims)


EXTEND_YEAR = 2000


@register("dim_extend", ctes=(), sql=f"""
SELECT o_custkey AS household_key,
       CASE WHEN min(year(o_orderdate)) < {EXTEND_YEAR} THEN 'base' ELSE 'increment' END AS added
FROM orders GROUP BY o_custkey""")
def dim_extend(spark, sf_dir):
    """Household dimension built from the years before 2000, then extended
    with the households of all other orders, undated ones too."""
    o = Tables(spark, sf_dir).orders.select("o_custkey", F.year("o_orderdate").alias("y"))
    early = F.coalesce(F.col("y") < EXTEND_YEAR, F.lit(False))
    key = F.col("o_custkey").alias("household_key")
    base = o.filter(early).select(key).distinct().withColumn("added", F.lit("base"))
    new = o.filter(~early).select(key).distinct().withColumn("added", F.lit("increment"))
    return S.extend_dim(base, new, "household_key")


@register("star_profile_rollup", floats=("mean_module1",), ctes=STAR, sql="""
SELECT h.internet, h.segment, h.department, count(*) AS n, avg(f.module1) AS mean_module1
FROM fact_scores f LEFT JOIN dim_household h ON f.household_key = h.household_key GROUP BY ALL""")
def star_profile_rollup(spark, sf_dir):
    """Households by profile: a dimension of distinct attribute rows under a
    hashed surrogate key (collisions are looked for), looked up by the fact;
    households without a row count under the unknown member."""
    homes = dim_household_df(spark, sf_dir)
    cols = ["internet", "segment", "department"]
    profiles = S.build_dim(homes, cols, key="profile_key")
    if not S.key_collisions(profiles, "profile_key").isEmpty():
        raise ValueError("two household profiles share a surrogate key")
    wide = join_on_keys(written_fact(spark, sf_dir).select("household_key", "module1"), homes, ["household_key"], "left")
    fact = S.build_fact(wide, {"profile_key": (profiles, {c: c for c in cols}, "profile_key")}, ["profile_key", "module1"])
    return S.star_query(fact, {"profile": (S.with_unknown(profiles, "profile_key"), "profile_key")}, cols,
                        [F.count(F.lit(1)).alias("n"), F.avg("module1").alias("mean_module1")])
