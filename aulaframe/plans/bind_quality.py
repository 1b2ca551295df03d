"""Data-quality analyses (#24-25, #28-29)."""

from __future__ import annotations

from aulaframe.operators import quality as Q
from aulaframe.plans.registry import register
from aulaframe.plans.views import (PARTIAL_LABELS_SQL, SCORE_FACT_SQL, SCORE_LONG_SQL,
                                   partial_labels, score_long)
from aulaframe.sources.tables import Tables

# Descriptions of the labelled-document variables.
DESCRIPTIONS = {
    "doc_id": "document identifier",
    "lang": "language code",
    "source": "origin of the document",
    "n_chars": "length in characters",
    "quality": "quality label (0/1), missing when unlabelled",
    "toxic": "toxicity label (0/1), missing when unlabelled",
}
PL_TYPES = {"doc_id": "bigint", "lang": "string", "source": "string", "n_chars": "bigint",
            "quality": "int", "toxic": "int"}


def _dict_sql() -> str:
    parts = []
    for c, t in PL_TYPES.items():
        parts.append(f"SELECT '{c}' AS variable, '{t}' AS dtype, count(*) AS n_rows, "
                     f"count(*) - count({c}) AS n_null, count(DISTINCT {c}) AS n_distinct, "
                     f"'{DESCRIPTIONS[c]}' AS description FROM partial_labels")
    return "\nUNION ALL ".join(parts)


@register("variable_dictionary", ctes=(PARTIAL_LABELS_SQL,), sql=_dict_sql())
def variable_dictionary(spark, sf_dir):
    meta = spark.createDataFrame(list(DESCRIPTIONS.items()), "variable string, description string")
    # exact distinct counts: the profiled table is narrow (6 columns)
    return Q.variable_dictionary(partial_labels(spark, sf_dir), meta, exact=True)


def _codes_sql() -> str:
    return "\nUNION ALL ".join(f"""SELECT '{c}' AS variable, (SELECT count(*) FROM partial_labels) AS n_rows,
  (SELECT count(*) - count({c}) FROM partial_labels) AS n_null,
  CASE WHEN count(*) <= 20 THEN coalesce(string_agg(v || '=' || n, '; ' ORDER BY v), '') END AS coding,
  coalesce(string_agg(CASE WHEN n >= 0.05 * (SELECT count(*) FROM partial_labels) THEN v END, '; ' ORDER BY v), '') AS frequent,
  (SELECT CAST(min({c}) AS VARCHAR) FROM partial_labels) AS example_least,
  (SELECT CAST(max({c}) AS VARCHAR) FROM partial_labels) AS example_greatest
FROM (SELECT CAST({c} AS VARCHAR) AS v, count(*) AS n FROM partial_labels WHERE {c} IS NOT NULL GROUP BY 1)""" for c in PL_TYPES)


@register("variable_codes", ctes=(PARTIAL_LABELS_SQL,), sql=_codes_sql())
def variable_codes(spark, sf_dir):
    return Q.variable_codes(partial_labels(spark, sf_dir))


@register("missing_profile", floats=("null_share",), ctes=(PARTIAL_LABELS_SQL,), sql="\nUNION ALL ".join(
    f"SELECT lang, count(*) AS n, '{c}' AS variable, CAST(count_if({c} IS NULL) AS BIGINT) AS nulls, "
    f"count_if({c} IS NULL) / count(*) AS null_share FROM partial_labels GROUP BY lang"
    for c in ["doc_id", "source", "n_chars", "quality", "toxic"]))
def missing_profile(spark, sf_dir):
    return Q.missing_profile(partial_labels(spark, sf_dir), "lang")


# Validation rules (SQL predicates TRUE for a violation).
RULES = {
    "quantity_out_of_range": "l_quantity < 1 OR l_quantity > 50",
    "discount_out_of_range": "l_discount < 0 OR l_discount > 0.1",
    "tax_out_of_range": "l_tax < 0 OR l_tax > 0.08",
    "returnflag_outside_domain": "l_returnflag NOT IN ('A', 'N', 'R')",
    "price_not_positive": "l_extendedprice <= 0",
    "linestatus_not_numeric": "try_cast(l_linestatus AS INT) IS NULL AND l_linestatus IS NOT NULL",
}


@register("rule_violations", sql="\nUNION ALL ".join(
    f"SELECT '{r}' AS rule, count(*) AS n_rows, CAST(count_if(coalesce({p}, false)) AS BIGINT) AS n_violations "
    f"FROM lineitem" for r, p in RULES.items()))
def rule_violations(spark, sf_dir):
    return Q.rule_violations(Tables(spark, sf_dir).lineitem, RULES)


# Scale limits of each module (special records at or beyond).
LIMITS = [("module1", 1.0, 50.0), ("module2", 0.0, 100000.0), ("module3", 0.0, 0.1),
          ("module4", 0.0, 0.08), ("module5", 0.0, 500000.0)]


@register("extreme_counts", ctes=(SCORE_FACT_SQL, SCORE_LONG_SQL), sql="""
SELECT module, count(score) AS n, CAST(count_if(score <= lo) AS BIGINT) AS n_at_low,
       CAST(count_if(score >= hi) AS BIGINT) AS n_at_high, CAST(count_if(score = 0) AS BIGINT) AS n_zero
FROM score_long JOIN (VALUES """ + ", ".join(f"('{m}', {lo}, {hi})" for m, lo, hi in LIMITS) + """) AS l(module, lo, hi)
USING (module) GROUP BY module""")
def extreme_counts(spark, sf_dir):
    limits = spark.createDataFrame(LIMITS, "module string, lo double, hi double")
    return Q.flag_extremes(score_long(spark, sf_dir), limits)
