"""Column-level helpers: pure Spark SQL expressions, no UDFs.

Each helper returns a ``Column`` so it stays inside whole-stage codegen.
A few also expose their SQL text so the same expression can be written in
an external SQL engine (the DuckDB oracle) without re-deriving it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Accented letters folded by ``normalise_text`` and their
# plain counterparts, position by position.
ACCENTED = "ÁÉÍÓÚÀÈÌÒÙÄËÏÖÜÂÊÎÔÛáéíóúàèìòùäëïöüâêîôûÑñÇç"
PLAIN = "AEIOUAEIOUAEIOUAEIOUaeiouaeiouaeiouaeiouNnCc"


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --------------------------------------------------------------------------
# Stable rounding of floating results
# --------------------------------------------------------------------------

def sig_sql(x: str, digits: int = 8) -> str:
    """SQL text rounding ``x`` to ``digits`` significant digits.

    Aggregates of doubles differ in their last bits between engines and
    partitionings; rounding to a fixed number of significant digits (and
    folding |x| < 1e-9 and -0.0 to 0.0) makes results comparable. ``round``
    needs a constant scale, hence one branch per decade.
    """
    # Exact decimal ties (e.g. the mean of a few 2-decimal amounts ending in
    # ...5) would be decided by last-bit noise; a relative nudge of 1e-12,
    # larger than that noise and far below the rounding step, makes both
    # engines resolve them the same way.
    y = f"({x} * CAST(1.000000000001 AS DOUBLE))" if digits <= 9 else x
    parts = [f"WHEN abs({y}) < 1e-9 THEN CAST(0 AS DOUBLE)"]
    for k in range(-9, 17):
        parts.append(f"WHEN abs({y}) < 1e{k + 1} THEN round({y}, {digits - 1 - k})")
    return f"((CASE {' '.join(parts)} ELSE {x} END) + CAST(0 AS DOUBLE))"


def round_sig(df: DataFrame, cols: Sequence[str | tuple[str, int]], digits: int = 8) -> DataFrame:
    """Apply :func:`sig_sql` to the named double columns; an entry may be
    ``(name, digits)`` to override the precision for that column."""
    if not cols:
        return df
    spec = dict(c if isinstance(c, tuple) else (c, digits) for c in cols)
    return df.withColumns({c: F.expr(sig_sql(f"`{c}`", d)) for c, d in spec.items()})


# --------------------------------------------------------------------------
# Codes, names and categories
# --------------------------------------------------------------------------

def pad_code(c: str | Column, width: int) -> Column:
    """Territorial code kept as text with its leading zeros ("5" -> "05")."""
    return F.lpad(F.trim(col_of(c).cast("string")), width, "0")


def normalise_text(c: str | Column) -> Column:
    """Trim, collapse inner whitespace, upper-case and fold accents."""
    s = F.regexp_replace(F.trim(col_of(c)), r"\s+", " ")
    return F.upper(F.translate(s, ACCENTED, PLAIN))


def parse_period(c: str | Column) -> tuple[Column, Column]:
    """Period code ``YYYYN`` -> (year, sitting); invalid text -> NULLs.
    (Definition chosen here: first four characters = year, the rest =
    sitting, inferred from the published codes.)"""
    s = F.trim(col_of(c).cast("string"))
    year = F.substring(s, 1, 4).try_cast("bigint")
    sitting = F.substring(s, 5, 8).try_cast("bigint")
    return year, sitting


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """Division that yields NULL on a zero or NULL denominator (ANSI-safe)."""
    return F.try_divide(col_of(num).cast("double"), col_of(den).cast("double"))


def safe_corr(a: str | Column, b: str | Column) -> Column:
    """Pearson r as an aggregate; NULL (not an ANSI division error) when a
    variable is constant. Rows that lack either value don't count."""
    x, y = F.when(col_of(b).isNotNull(), col_of(a)), F.when(col_of(a).isNotNull(), col_of(b))
    return F.try_divide(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y))


def level_of(c: str | Column, cuts: Sequence[float], labels: Sequence[str]) -> Column:
    """Map a score to a level: ``labels[i]`` for ``cuts[i-1] <= x < cuts[i]``."""
    if len(labels) != len(cuts) + 1:
        raise ValueError("need one more label than cut points")
    x = col_of(c)
    expr = F.when(x.isNull(), F.lit(None).cast("string"))
    for cut, lab in zip(cuts, labels[:-1]):
        expr = expr.when(x < F.lit(cut), F.lit(lab))
    return expr.otherwise(F.lit(labels[-1]))


def level_rank(c: str | Column, levels: Sequence[str]) -> Column:
    """Rank (1-based) of an ordinal label in ``levels``; NULL when outside.

    The levels list is a handful of labels, so it is inlined as a map
    literal: no join, no shuffle.
    """
    kv = []
    for i, lev in enumerate(levels, start=1):
        kv += [F.lit(lev), F.lit(i)]
    return F.try_element_at(F.create_map(*kv), col_of(c))


def years_between(c: str | Column, first: int, last: int) -> Column:
    """``first <= year(c) <= last`` written as a timestamp range, so that
    the predicate reaches the Parquet scan (``year(c) = y`` cannot)."""
    lo = F.to_timestamp_ntz(F.lit(f"{first:04d}-01-01 00:00:00"))
    hi = F.to_timestamp_ntz(F.lit(f"{last + 1:04d}-01-01 00:00:00"))
    return (col_of(c) >= lo) & (col_of(c) < hi)


def money(c: str | Column) -> Column:
    """Money as an exact two-decimal value so that sums do not drift."""
    return col_of(c).cast("decimal(18,2)")


def chi_square_sf(x: str | Column, dof: str | Column) -> Column:
    """P(X >= x) for a chi-square variable: the regularised upper incomplete
    gamma function Q(dof / 2, x / 2), by its power series below dof / 2 + 1 and
    its continued fraction above. NULL without degrees of freedom. The number of
    steps grows with the root of ``dof``; each stops once it changes nothing."""
    a, y = col_of(dof) / F.lit(2.0), col_of(x) / F.lit(2.0)
    half = col_of(dof) % 2 == 1
    first = F.when(half, F.lit(0.5)).otherwise(F.lit(1.0))
    # ln gamma(a): whole steps up from gamma(1/2) or gamma(1)
    steps = F.transform(F.sequence(F.lit(1), F.greatest(F.floor(a - first), F.lit(1)).cast("int")), lambda i: F.when(
        i <= a - first, F.ln(first + i - 1)).otherwise(F.lit(0.0)))
    ln_gamma = F.aggregate(steps, F.when(half, F.ln(F.lit(math.pi)) / 2).otherwise(F.lit(0.0)), lambda s, t: s + t)
    front = F.exp(a * F.ln(y) - y - ln_gamma)
    turns = F.sequence(F.lit(1), (F.lit(60) + F.ceil(F.sqrt(a) * 12)).cast("int"))

    def series(s, n):
        term = s["t"] * y / (a + n)
        return F.when(s["t"] < s["s"] * 1e-17, s).otherwise(F.struct(term.alias("t"), (s["s"] + term).alias("s")))

    lower = F.aggregate(turns, F.struct((F.lit(1.0) / a).alias("t"), (F.lit(1.0) / a).alias("s")), series, lambda s: s["s"])

    def fraction(s, i):  # modified Lentz; for y >= a + 1 no denominator vanishes
        part = (a - i) * i
        b = s["b"] + 2
        d, c = F.lit(1.0) / (b + part * s["d"]), b + part / s["c"]
        return F.when(F.abs(s["e"] - 1) < 1e-16, s).otherwise(
            F.struct(b.alias("b"), c.alias("c"), d.alias("d"), (s["h"] * d * c).alias("h"), (d * c).alias("e")))

    b0 = y + 1 - a
    upper = F.aggregate(turns, F.struct(b0.alias("b"), F.lit(1e300).alias("c"), (F.lit(1.0) / b0).alias("d"), (F.lit(1.0) / b0).alias("h"), F.lit(0.0).alias("e")),
                        fraction, lambda s: s["h"])
    return F.when(col_of(dof) <= 0, F.lit(None).cast("double")).when(y <= 0, F.lit(1.0)) \
        .when(y < a + 1, F.lit(1.0) - front * lower).otherwise(front * upper)
