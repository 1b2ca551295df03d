"""Projection, cleaning and conformance operators (#11-23)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aulaframe.functions.columns import level_rank
from aulaframe.operators.ranking import exact_quantiles, fit

MAX_LOOKUP_ROWS = 1_000_000  # lookup tables are measured up to so many rows


def filter_sector(df: DataFrame, col: str, sector: str) -> DataFrame:
    """Keep one sector's rows; a plain equality, pushed into the scan."""
    return df.filter(F.col(col) == F.lit(sector))


def small_side(lookup: DataFrame, max_rows: int = MAX_LOOKUP_ROWS) -> DataFrame:
    """Broadcast a lookup table only after measuring that it is small, in rows
    and in bytes."""
    return fit(lookup, max_rows)


def recode(df: DataFrame, col: str, mapping: DataFrame, src: str = "src", dst: str = "dst",
           out: str | None = None) -> DataFrame:
    """Map labels through a dictionary table; unmapped labels are kept."""
    out = out or col
    m = small_side(mapping.select(F.col(src).alias("_src"), F.col(dst).alias("_dst")))
    j = df.join(m, df[col] == m["_src"], "left")
    return j.withColumn(out, F.coalesce(F.col("_dst"), F.col(col))).drop("_src", "_dst")


def normalise_missing(df: DataFrame, col: str, tokens: Mapping[str, str],
                      null_reason: str = "null") -> DataFrame:
    """Missing-value tokens -> NULL plus a ``{col}_missing`` reason column."""
    kv = []
    for k, v in tokens.items():
        kv += [F.lit(k), F.lit(v)]
    reason = F.try_element_at(F.create_map(*kv), F.col(col))
    return df.withColumns({
        f"{col}_missing": F.when(F.col(col).isNull(), F.lit(null_reason)).otherwise(reason),
        col: F.when(reason.isNull(), F.col(col)),
    })


def drop_incomplete(df: DataFrame, cols: Sequence[str], how: str = "any") -> DataFrame:
    """Exclude incomplete records (``how`` = any / all of ``cols`` NULL)."""
    return df.na.drop(how=how, subset=list(cols))


def impute(df: DataFrame, cols: Sequence[str], strategy: str = "mean",
           suffix: str = "_imputed") -> DataFrame:
    """Replace NULLs by the column mean or median. The statistics are one
    aggregation (a single row of scalars) inlined as literals: no window
    over all rows, no join."""
    if strategy == "mean":
        stats = df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in cols]).first().asDict()
    elif strategy == "median":
        # one selection over all columns (no single task holds a column)
        long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot([], list(cols), "_column", "_value")
        rows = exact_quantiles(long, "_value", [0.5], ["_column"], ["_median"]).collect()  # one row a column
        stats = dict.fromkeys(cols) | {r["_column"]: r["_median"] for r in rows}
    else:
        raise ValueError(strategy)
    return df.withColumns({f"{c}{suffix}": F.coalesce(F.col(c).cast("double"), F.lit(stats[c]).cast("double"))
                           for c in cols})


def conform(df: DataFrame, renames: Mapping[str, str] | None = None,
            casts: Mapping[str, str] | None = None) -> DataFrame:
    """Harmonise one year's layout: rename, then ``try_cast`` to the
    declared types (bad text -> NULL, never an error)."""
    if renames:
        df = df.withColumnsRenamed(dict(renames))
    if casts:
        df = df.withColumns({c: F.col(c).try_cast(t) for c, t in casts.items() if c in df.columns})
    return df


NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


def reject_reason(c: str, to: str) -> Column:
    """Why a value doesn't cast to its declared type: ``blank``,
    ``out_of_range`` (a number that the type doesn't hold), ``not_<type>``;
    NULL for a value that casts and for a missing one."""
    raw = F.col(c)
    number = F.lit(to.startswith(NUMERIC)) & raw.cast("string").try_cast("double").isNotNull()
    return F.when(raw.isNull() | raw.try_cast(to).isNotNull(), F.lit(None).cast("string")) \
        .when(F.trim(raw.cast("string")) == "", "blank").when(number, "out_of_range").otherwise(f"not_{to}")


def rejected_values(df: DataFrame, casts: Mapping[str, str], keep: Sequence[str],
                    renames: Mapping[str, str] | None = None) -> DataFrame:
    """What ``conform`` turns into NULL: one row for each value that doesn't
    cast, with the columns ``keep`` (file, keys), column, raw, reason. It is
    found where the file is read; nothing is shuffled."""
    df = df.withColumnsRenamed(dict(renames or {}))
    bad = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("raw"), reject_reason(c, t).alias("reason"))
           for c, t in casts.items() if c in df.columns]
    if not bad:
        bad = [F.struct(F.lit("").alias("column"), F.lit("").alias("raw"), F.lit(None).cast("string").alias("reason"))]
    return df.select(*keep, F.explode(F.filter(F.array(*bad), lambda x: x["reason"].isNotNull())).alias("_bad")).select(*keep, "_bad.*")


def schema_inventory(parts: Mapping[str, DataFrame], declared: Mapping[str, str],
                     renames: Mapping[str, str] | None = None) -> DataFrame:
    """Each file set's layout against the declared one: file, column, found,
    declared, status (``ok``, ``renamed``, ``type_differs``, ``missing``,
    ``undeclared``), n_rows, n_null, n_rejected (values that don't cast). One
    aggregation per file set."""
    old = {new: name for name, new in (renames or {}).items()}
    tables = []
    for file, df in parts.items():
        found = dict(df.dtypes)
        known, aggs = {}, [F.count(F.lit(1)).alias("_n")]
        for c, t in declared.items():
            name = c if c in found else old.get(c)
            if name not in found:
                known[c] = (None, t, "missing", F.lit(0).cast("bigint"), F.lit(0).cast("bigint"))
                continue
            status = "type_differs" if found[name] != t else "ok" if name == c else "renamed"
            known[c] = (found[name], t, status, F.count(name), F.count(reject_reason(name, t)))
        for c in found:
            if c not in declared and (renames or {}).get(c) not in declared:
                known[c] = (found[c], None, "undeclared", F.count(c), F.lit(0).cast("bigint"))
        for i, (_, _, _, present, rejected) in enumerate(known.values()):
            aggs += [present.alias(f"p{i}"), rejected.alias(f"r{i}")]
        rows = [F.struct(F.lit(file).alias("file"), F.lit(c).alias("column"), F.lit(f).cast("string").alias("found"),
                         F.lit(t).cast("string").alias("declared"), F.lit(s).alias("status"), F.col("_n").alias("n_rows"),
                         (F.col("_n") - F.col(f"p{i}")).alias("n_null"), F.col(f"r{i}").alias("n_rejected"))
                for i, (c, (f, t, s, _, _)) in enumerate(known.items())]
        tables.append(df.agg(*aggs).select(F.inline(F.array(*rows))))
    return consolidate(tables)


def consolidate(dfs: Sequence[DataFrame], allow_missing: bool = True) -> DataFrame:
    """UNION ALL by column name; columns absent from a part become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), dfs)


def with_level(df: DataFrame, col: str, levels: Sequence[str] | DataFrame,
               out: str = "level_rank") -> DataFrame:
    """Attach the rank of an ordinal label: a list of levels is inlined as
    a map literal; a levels table (label, rank) is joined after a size
    check."""
    if isinstance(levels, DataFrame):
        lv = small_side(levels.toDF("_label", out))
        return df.join(lv, df[col] == lv["_label"], "left").drop("_label")
    return df.withColumn(out, level_rank(col, levels))


def extract_block(cells: DataFrame, header_pattern: str, label_col: int, label: str,
                  ncols: int) -> DataFrame:
    """From a long cell grid (file, sheet, row, col, value): find, per file,
    the sheet whose header row matches ``header_pattern``; take the rows
    below it as columns c1..``ncols``, and keep those labelled ``label``.

    One scan: an aggregate assembles each row and notes whether it is a header;
    only headers and labelled rows go on to the window that finds the first
    header of their sheet. Of several values in a cell the least counts; cells
    without a file (or sheet) are a file (or sheet) of their own.
    """
    cell = lambda i: F.min(F.when(F.col("col") == i, F.col("value")))
    rows = cells.groupBy("file", "sheet", "row").agg(
        F.max(F.col("value").rlike(header_pattern)).alias("_header"), *[cell(i).alias(f"c{i}") for i in range(1, ncols + 1)])
    labelled = F.col(f"c{label_col}") == F.lit(label)
    first = F.min(F.when(F.col("_header"), F.col("row"))).over(Window.partitionBy("file", "sheet"))
    return rows.filter(F.col("_header") | labelled).withColumn("_first", first) \
        .filter((F.col("row") > F.col("_first")) & labelled).drop("_header", "_first")
