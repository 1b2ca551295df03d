"""Landed-file sources and sinks (#1-9).

Readers always take a declared schema (no inference): territorial codes
stay text with their leading zeros. Sinks write Parquet to shared storage.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from aulaframe.operators.ranking import with_row_number


# The sheet-grid layout of exported budget workbooks.
CELL_SCHEMA = StructType([
    StructField("file", StringType()), StructField("sheet", StringType()),
    StructField("row", IntegerType()), StructField("col", IntegerType()),
    StructField("value", StringType())])


def read_microdata(spark: SparkSession, path: str, schema: StructType, sep: str = "|",
                   encoding: str = "UTF-8", header: bool = True) -> DataFrame:
    """Delimited-text microdata (one file set per year) with a declared
    schema; malformed values become NULL (PERMISSIVE) instead of failing."""
    return (spark.read.schema(schema).option("sep", sep).option("encoding", encoding)
            .option("header", str(header).lower()).option("mode", "PERMISSIVE").csv(path))


def read_counts(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV count tables; code columns are declared ``StringType``."""
    return spark.read.schema(schema).option("header", "true").csv(path)


def read_cells(spark: SparkSession, path: str) -> DataFrame:
    """Exported sheet cell grids (file, sheet, row, col, value) plus the
    physical file each cell came from."""
    return (spark.read.schema(CELL_SCHEMA).option("header", "true").csv(path)
            .withColumn("source_file", F.col("_metadata.file_path")))


def file_catalog(spark: SparkSession, root: str, allowed_ext: Sequence[str]) -> DataFrame:
    """Discover landed files (recursively) and keep the valid formats.
    Only the listing columns are selected, so file contents are not read."""
    df = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
          .select("path", "length"))
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    ext = F.lower(F.regexp_extract(name, r"(\.[^.]+)$", 1))
    return (df.select("path", name.alias("name"), ext.alias("ext"), "length")
            .filter(F.col("ext").isin([e.lower() for e in allowed_ext])))


def append_manifest(df: DataFrame, path: str) -> None:
    """Append rows (link, category, year, path, outcome) to the manifest."""
    df.write.mode("append").parquet(path)


def write_gold(df: DataFrame, path: str, by: str | Sequence[str] = "year") -> None:
    """Processed sink partitioned by year. With dynamic partition overwrite
    only the partitions present in ``df`` are replaced, so one year can be
    refreshed without touching the others."""
    by = [by] if isinstance(by, str) else list(by)
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*by).parquet(path))


def plan_renames(catalog: DataFrame, token_map: DataFrame, token: str = "token",
                 order: str = "origin") -> DataFrame:
    """Canonical names: '<CATEGORY>_<year><ext>', and ' (2)', ' (3)', ...
    for later files (by ``order``, NULL last, then ``path``) that would get the
    same name. The clash ordinal is a distributed row number (see
    :func:`~aulaframe.operators.ranking.with_row_number`): files of one name,
    with or without ``order``, are dealt over tasks. A file without a year is
    numbered among those of its category and extension, but has no name."""
    j = catalog.join(token_map, token, "inner")
    base = F.concat(F.col("category"), F.lit("_"), F.col("year").cast("string"))
    j = with_row_number(j.withColumn("_base", F.concat(base, F.col("ext"))), ["category", "year", "ext"],
                        [F.col(order).isNull(), F.col(order), F.col("path")], "_k")
    k = F.col("_k")
    final = F.when(k == 1, F.col("_base")).otherwise(
        F.concat(base, F.lit(" ("), k.cast("string"), F.lit(")"), F.col("ext")))
    return j.select(order, token, "category", "year", "path", final.alias("final_name"),
                    k.cast("bigint").alias("clash_ordinal"))


def unmapped(catalog: DataFrame, token_map: DataFrame, token: str = "token") -> DataFrame:
    """Catalog rows whose token has no mapping."""
    return catalog.join(token_map.select(token), token, "left_anti")


def missing_combinations(found: DataFrame, cat: str, year: str, categories: DataFrame,
                         years: Sequence[int]) -> DataFrame:
    """Expected category x year combinations with no file: each expected
    category is expanded to its years (explode of a short literal array),
    then anti-joined with what was found."""
    exp = categories.select(cat).distinct().withColumn(
        year, F.explode(F.array(*[F.lit(int(y)).cast("bigint") for y in years])))
    return exp.join(found.select(cat, year).distinct(), [cat, year], "left_anti")


def manifest_rows(catalog: DataFrame, token_map: DataFrame, token: str = "token") -> DataFrame:
    """Manifest rows: link, category, year, path and the outcome."""
    j = catalog.join(token_map, token, "left")
    return j.select(F.col("origin").alias("link"), F.coalesce("category", token).alias("category"),
                    "year", "path",
                    F.when(F.col("category").isNull(), F.lit("unmapped")).otherwise(F.lit("ok")).alias("outcome"))


def write_text(df: DataFrame, path: str, sep: str = "|", header: bool = True) -> None:
    """Write a table as delimited text (used to land test inputs)."""
    df.write.mode("overwrite").option("sep", sep).option("header", str(header).lower()).csv(path)


def schema_of(fields: Mapping[str, str]) -> str:
    """Declared schema as a DDL string from name -> SQL type."""
    return ", ".join(f"`{k}` {v}" for k, v in fields.items())
