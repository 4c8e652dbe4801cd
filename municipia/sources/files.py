"""Delimited files: facts, the category lookup, raw slices."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from municipia import fixed_values as fixed
from municipia import schemas
from municipia.operators.filters import resolve_column
from municipia.operators.rollup import pivot_variables


def _read_text_columns(spark: SparkSession, path: str | list[str], sep: str) -> DataFrame:
    """All columns as text under the names of the header; files with another header are an error."""
    return spark.read.option("sep", sep).option("header", True).option("enforceSchema", False).csv(path)


def as_kind(column: Column, kind: str) -> Column:
    """Text as ``kind``, null if it is none. A whole number may be written as 2020 or 2020.0."""
    if kind != "int":
        return column.try_cast(kind)
    number = column.try_cast("double")
    return F.when(number == F.floor(number), number).try_cast("int")


def _canonical(df: DataFrame, columns: Mapping[str, tuple[str, str]]) -> list:
    """Columns by name, in any order; an absent one is null."""
    return [
        (as_kind(F.col(f"`{source}`"), kind) if source in df.columns else F.lit(None).cast(kind)).alias(name)
        for source, (name, kind) in columns.items()
    ]


def read_crop_fact(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Crop fact: codes as text, measures as double, the municipality name from whichever column has it."""
    raw = _read_text_columns(spark, path, ";")
    name = resolve_column(raw, fixed.MUNICIPALITY_NAME_COLUMNS, "Cod_Municipio")
    return raw.select(*_canonical(raw, schemas.CROP_COLUMNS), F.col(name).alias("mun_name"))


def read_livestock_fact(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Livestock fact, wide. Measure columns absent from the file stay absent; so do unknown ones."""
    raw = _read_text_columns(spark, path, ";")
    present = {k: v for k, v in schemas.LIVESTOCK_WIDE.items() if k in raw.columns or k in schemas.LIVESTOCK_INDEX}
    return raw.select(*_canonical(raw, present))


def read_category_groups(spark: SparkSession, path: str) -> DataFrame:
    """Category lookup ``category, kind`` and any number of integer flag columns, null flags 0."""
    return parse_category_groups(_read_text_columns(spark, path, ","))


def parse_category_groups(raw: DataFrame) -> DataFrame:
    """The lookup from text columns ``cultura``, ``tipo`` and flags."""
    flags = [c for c in raw.columns if c not in ("cultura", "tipo")]
    # A flag may be written "1" or, where some are missing, "1.0".
    as_flag = [F.coalesce(F.col(f"`{c}`").try_cast("double").cast("int"), F.lit(0)).alias(c) for c in flags]
    return raw.select(F.col("cultura").alias("category"), F.col("tipo").alias("kind"), *as_flag)


def slice_identity(name: str) -> list:
    """Survey table and year from a file name such as ``ppm_3939_2020.csv``."""
    return [
        F.regexp_extract(F.col(name), r"_(\d+)_\d{4}", 1).try_cast("int").alias("survey_table"),
        F.regexp_extract(F.col(name), r"_\d+_(\d{4})", 1).try_cast("int").alias("slice_year"),
    ]


def _raw_slices(spark: SparkSession, folder: str, table: int) -> DataFrame:
    """Rows of all raw slices of a table, those that don't fit kept in ``_bad``. A file whose header differs from the schema stops the job."""
    columns = T.StructType([*schemas.RAW_SLICE_SCHEMA.fields, T.StructField("_bad", T.StringType())])
    return (
        spark.read.schema(columns)
        .option("sep", ";").option("header", True).option("enforceSchema", False)
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad").option("columnPruning", False).option("pathGlobFilter", f"ppm_{table}_*.csv")
        .csv(folder)
        .select("*", F.col("_metadata.file_name").alias("_file"))
        # Spark refuses plans that need no column but the bad row's text, such as a count; this test, true of all text files, needs one.
        .where(F.coalesce(F.col(schemas.RAW_SLICE_SCHEMA[0].name), F.lit("")) != "\u0001")
    )


def read_raw_slices(spark: SparkSession, folder: str, table: int, last_year: int | None = None, first_year: int | None = None) -> DataFrame:
    """All raw slices of one survey table, long; empty files add nothing, and rows that do not fit go to ``rejected_slice_rows``.

    All landed years unless the caller names bounds.
    """
    raw = _raw_slices(spark, folder, table)
    year = F.regexp_extract("_file", r"_(\d{4})[^_]*\.csv$", 1).try_cast("int")
    kept = raw.where(F.col("_bad").isNull())
    for bound in ([year >= first_year] if first_year is not None else []) + ([year <= last_year] if last_year is not None else []):
        kept = kept.where(bound)
    return kept.select(*_canonical(kept, schemas.LIVESTOCK_LONG))


def rejected_slice_rows(spark: SparkSession, folder: str, table: int) -> DataFrame:
    """File and text of the rows that have too few or too many fields, and what was read as their first column."""
    raw = _raw_slices(spark, folder, table)
    return raw.where(F.col("_bad").isNotNull()).select(F.col("_file").alias("file"), F.col("_bad").alias("row"), F.col(raw.columns[0]).alias("mun"))


def consolidate_table(spark: SparkSession, folder: str, table: int, last_year: int | None = None) -> DataFrame:
    """One survey table, wide: raw slices, then one row per municipality, category and year."""
    variables = list(fixed.SURVEY_TABLES[table]["variables"].values())
    keys = [name for name, _ in schemas.LIVESTOCK_INDEX.values()]
    return pivot_variables(read_raw_slices(spark, folder, table, last_year), keys, variables)
