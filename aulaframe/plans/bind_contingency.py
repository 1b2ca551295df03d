"""Contingency analyses (#64-69) bound to the score view."""

from __future__ import annotations

from itertools import combinations

from aulaframe.functions.columns import chi_square_sf
from aulaframe.operators import contingency as C
from aulaframe.plans.registry import register
from aulaframe.plans.views import SCORE_FACT_SQL, score_fact

SF = (SCORE_FACT_SQL,)
# The programme "character" levels of the fixture (part types).
CHARACTER_LEVELS = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@register("crosstab_long", ctes=SF, sql="""
SELECT sex, character, count(*) AS n FROM score_fact GROUP BY sex, character""")
def crosstab_long(spark, sf_dir):
    return C.crosstab(score_fact(spark, sf_dir), "sex", "character")


@register("crosstab_wide", ctes=SF, sql="SELECT stratum, " + ", ".join(
    f"CAST(count_if(character = '{v}') AS BIGINT) AS \"{v}\"" for v in CHARACTER_LEVELS) + """
FROM score_fact GROUP BY stratum""")
def crosstab_wide(spark, sf_dir):
    # levels are discovered from the data (bounded, checked distinct list)
    return C.crosstab_wide(score_fact(spark, sf_dir), "stratum", "character")


@register("crosstab_pct", floats=("row_pct", "col_pct", "total_pct"), ctes=SF, sql="""
SELECT sex, character, n, n / sum(n) OVER (PARTITION BY sex) AS row_pct,
       n / sum(n) OVER (PARTITION BY character) AS col_pct, n / sum(n) OVER () AS total_pct
FROM (SELECT sex, character, count(*) AS n FROM score_fact GROUP BY sex, character) c""")
def crosstab_pct(spark, sf_dir):
    ct = C.crosstab(score_fact(spark, sf_dir), "sex", "character")
    return C.crosstab_pct(ct, "sex", "character")


@register("crosstab_margins", floats=("pct_of_total",), ctes=SF, sql="""
SELECT stratum, method, n, margin, n / max(CASE WHEN margin = 3 THEN n END) OVER () AS pct_of_total
FROM (SELECT stratum, method, count(*) AS n, CAST(grouping(stratum, method) AS BIGINT) AS margin
      FROM score_fact GROUP BY CUBE (stratum, method)) c""")
def crosstab_margins(spark, sf_dir):
    return C.crosstab_margins(score_fact(spark, sf_dir), "stratum", "method")


# Oracle: textbook formula over the FULL grid of levels (zero cells included).
CHI_SQL = """
chi AS (
  SELECT sum((coalesce(o.n, 0) - g.e) * (coalesce(o.n, 0) - g.e) / g.e) AS chi2,
         any_value(g.n_all) AS n, any_value(g.r) AS rows, any_value(g.c) AS cols,
         (any_value(g.r) - 1) * (any_value(g.c) - 1) AS dof
  FROM (
    SELECT ra.stratum, cb.character, ra.ra * cb.cb / t.n_all AS e, t.n_all, t.r, t.c
    FROM (SELECT stratum, count(*) AS ra FROM score_fact WHERE stratum IS NOT NULL AND character IS NOT NULL GROUP BY stratum) ra
    CROSS JOIN (SELECT character, count(*) AS cb FROM score_fact WHERE stratum IS NOT NULL AND character IS NOT NULL GROUP BY character) cb
    CROSS JOIN (SELECT count(*) AS n_all, count(DISTINCT stratum) AS r, count(DISTINCT character) AS c
                FROM score_fact WHERE stratum IS NOT NULL AND character IS NOT NULL) t
  ) g
  LEFT JOIN (SELECT stratum, character, count(*) AS n FROM score_fact GROUP BY stratum, character) o
    ON g.stratum = o.stratum AND g.character = o.character
)"""


@register("chi_square_stat", floats=("chi2",), ctes=SF + (CHI_SQL,), sql="SELECT * FROM chi")
def chi_square_stat(spark, sf_dir):
    return C.chi_square(score_fact(spark, sf_dir), "stratum", "character")


def p_sql(chi2: str, dof: str) -> str:
    """DuckDB's own p-value: the finite sums for whole and half degrees; the
    tail of one degree by the series of erf below 1, else by the trapezoid rule
    on Craig's form of erfc."""
    y = f"({chi2} / 2)"
    term = lambda h: f"list_transform(range(0, ({dof}) // 2), lambda i: exp((i + {h}) * ln({y}) - {y} - lgamma(i + {h} + 1)))"
    craig = f"(list_sum(list_transform(range(1, 2000), lambda j: exp(-{y} / pow(sin(pi() * j / 4000), 2)))) + exp(-{y}) / 2) / 2000"
    series = f"1 - 2 / sqrt(pi()) * list_sum(list_transform(range(0, 30), lambda j: pow(-1, j) * pow({y}, j + 0.5) / gamma(j + 1) / (2 * j + 1)))"
    erfc = f"CASE WHEN {y} < 1 THEN {series} ELSE {craig} END"
    return (f"CASE WHEN {dof} <= 0 THEN NULL WHEN {chi2} <= 0 THEN 1.0 WHEN {dof} % 2 = 0 THEN list_sum({term(0)}) "
            f"ELSE {erfc} + coalesce(list_sum({term(0.5)}), 0) END")


@register("chi_square_p", floats=("chi2", "p_value"), ctes=SF + (CHI_SQL,),
          sql=f"SELECT chi2, dof, {p_sql('chi2', 'dof')} AS p_value FROM chi")
def chi_square_p(spark, sf_dir):
    t = C.chi_square(score_fact(spark, sf_dir), "stratum", "character")
    return t.select("chi2", "dof", chi_square_sf("chi2", "dof").alias("p_value"))


PAIRED = ["sex", "ethnicity", "stratum", "character", "method", "segment"]
# every pair on its own, over the full grid of levels
PAIRS_SQL = "\nUNION ALL ".join(f"""
SELECT '{a}' AS var_a, '{b}' AS var_b, sum((coalesce(o.n, 0) - g.e) * (coalesce(o.n, 0) - g.e) / g.e) AS chi2,
       any_value(g.n_all) AS n, any_value(g.r) AS rows, any_value(g.c) AS cols, (any_value(g.r) - 1) * (any_value(g.c) - 1) AS dof
FROM (SELECT ra.{a} AS a, cb.{b} AS b, ra.n * cb.n / t.n_all AS e, t.*
      FROM (SELECT {a}, count(*) AS n FROM score_fact WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY 1) ra,
           (SELECT {b}, count(*) AS n FROM score_fact WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY 1) cb,
           (SELECT count(*) AS n_all, count(DISTINCT {a}) AS r, count(DISTINCT {b}) AS c FROM score_fact
            WHERE {a} IS NOT NULL AND {b} IS NOT NULL) t) g
LEFT JOIN (SELECT {a} AS a, {b} AS b, count(*) AS n FROM score_fact GROUP BY 1, 2) o ON o.a = g.a AND o.b = g.b
HAVING count(*) > 0""" for a, b in combinations(PAIRED, 2))


@register("chi_square_pairs", floats=("chi2", "p_value", "cramers_v"), ctes=SF, sql=f"""
SELECT *, {p_sql('chi2', 'dof')} AS p_value, CASE WHEN least(rows, cols) > 1 THEN sqrt(chi2 / (n * least(rows - 1, cols - 1))) END AS cramers_v
FROM ({PAIRS_SQL}) x""")
def chi_square_pairs(spark, sf_dir):
    return C.chi_square_pairs(score_fact(spark, sf_dir).select(*PAIRED), PAIRED)


@register("cramers_v", floats=("chi2", "cramers_v"), ctes=SF + (CHI_SQL,), sql="""
SELECT *, sqrt(chi2 / (n * least(rows - 1, cols - 1))) AS cramers_v FROM chi""")
def cramers_v(spark, sf_dir):
    return C.cramers_v(C.chi_square(score_fact(spark, sf_dir), "stratum", "character"))


@register("share_by_level", floats=("share", "change"), ctes=SF, sql="""
SELECT stratum, stratum_rank, n, n_value, share, share - lag(share) OVER (ORDER BY stratum_rank) AS change
FROM (SELECT stratum, stratum_rank, count(*) AS n, CAST(count_if(method = 'F') AS BIGINT) AS n_value,
             count_if(method = 'F') / count(*) AS share
      FROM score_fact WHERE stratum_rank IS NOT NULL GROUP BY stratum, stratum_rank) g""")
def share_by_level(spark, sf_dir):
    return C.share_by_level(score_fact(spark, sf_dir), "stratum", "stratum_rank", "method", "F")


@register("mix_over_time", floats=("share", "change", "min_share", "max_share"), ctes=SF, sql="""
SELECT period, method, n, share,
       share - lag(share) OVER (PARTITION BY method ORDER BY period) AS change,
       min(share) OVER (PARTITION BY method) AS min_share,
       first_value(period) OVER (PARTITION BY method ORDER BY share, period) AS min_period,
       max(share) OVER (PARTITION BY method) AS max_share,
       first_value(period) OVER (PARTITION BY method ORDER BY share DESC, period) AS max_period
FROM (SELECT period, method, count(*) AS n, count(*) / sum(count(*)) OVER (PARTITION BY period) AS share
      FROM score_fact GROUP BY period, method) c""")
def mix_over_time(spark, sf_dir):
    return C.mix_over_time(score_fact(spark, sf_dir), "period", "method")
