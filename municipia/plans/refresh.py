"""Roll-up tables kept up to date: only what a load touched is computed again.

A load replaces whole slices (a year of a state). The base holds a partition for every slice; the roll-ups hold one for every year, as each of their keys has
a year. A refresh overwrites the touched partitions of the base, then the touched years of the roll-ups, read from the base alone.
So it may run again after a failure, and gives the rows that a full build would.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from municipia import fixed_values as fixed
from municipia import schemas
from municipia.operators.rollup import pivot_variables
from municipia.plans import crop, livestock
from municipia.streaming.ingest import SLICE

Rollups = Mapping[str, Callable[[DataFrame], DataFrame]]


def overwrite_slices(rows: DataFrame, touched: DataFrame, path: str, by: Sequence[str]) -> None:
    """Replace the partitions of ``path`` that ``touched`` names by ``rows``. A partition that has no rows any more keeps an empty marker, else its old rows would stay."""
    marked = touched.select(*by).distinct().withColumn("is_marker", F.lit(True))
    every = rows.withColumn("is_marker", F.lit(False)).unionByName(marked, allowMissingColumns=True)
    every.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def read_slices(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).where(~F.col("is_marker")).drop("is_marker")


def refresh(rows: DataFrame, touched: DataFrame, folder: str, rollups: Rollups) -> list[int]:
    """``rows`` are the base rows of the ``touched`` slices (year, uf), complete. Returns the years that were computed again."""
    spark = rows.sparkSession
    slices = touched.select("year", "uf").dropna().distinct()
    named = slices.collect()  # at most a row for each year and state; found once, as the load may be a pass over delimited files
    years = sorted({r["year"] for r in named})
    if not years:
        return []
    touched = spark.createDataFrame(named, slices.schema)
    overwrite_slices(rows, touched, f"{folder}/base", ["year", "uf"])
    base = read_slices(spark, f"{folder}/base").where(F.col("year").isin(*years))
    calendar = spark.createDataFrame([(y,) for y in years], "year int")
    for name, made in rollups.items():
        overwrite_slices(made(base), calendar, f"{folder}/{name}", ["year"])
    return years


def crop_rollups(groups: DataFrame) -> Rollups:
    return {
        "state_category": crop.state_category, "micro_groups": lambda base: crop.micro_groups(base, groups),
        "municipality": crop.municipality, "municipality_groups": lambda base: crop.municipality_groups(base, groups),
    }


LIVESTOCK_ROLLUPS: Rollups = {"levels": livestock.levels}


def refresh_crop(fact: DataFrame, groups: DataFrame, folder: str) -> list[int]:
    """Take new and corrected crop slices in. ``fact`` holds each slice it names completely; slices it does not name stay."""
    cleaned = crop.clean_crop_fact(fact)
    return refresh(crop.base_rows(cleaned.where(F.col("rejected") == 0)), cleaned, folder, crop_rollups(groups))


def refresh_livestock(wide: DataFrame, mapping: DataFrame, folder: str) -> list[int]:
    """Take new and corrected livestock slices in, like the crop's."""
    return refresh(livestock.base_rows(livestock.clean_livestock(wide, mapping)), wide, folder, LIVESTOCK_ROLLUPS)


def refresh_from_slices(spark: SparkSession, table_path: str, touched_path: str, mapping: DataFrame, folder: str) -> list[int]:
    """Bring the livestock roll-ups up to what ``ingest_new_slices`` has loaded into ``table_path`` since the last refresh.

    The batches taken in are logged at the end, so a refresh that was cut off begins anew. A slice counts with all survey tables it is in.
    """
    try:
        logged = spark.read.parquet(touched_path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return []
    last = f"{folder}/last_batch"
    try:
        done = spark.read.schema("batch long").parquet(last).agg(F.max("batch")).first()[0]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        done = None
    fresh = logged if done is None else logged.where(F.col("batch") > done)
    newest = fresh.agg(F.max("batch")).first()[0]
    if newest is None:
        return []
    # At most a row for each year and state: plain filters on the partitions of the table.
    slices = fresh.select("slice_year", "uf").distinct()
    wanted = [(r["slice_year"], r["uf"]) for r in slices.collect()]
    rows = spark.read.parquet(table_path).where(F.col("slice_year").isin(*{y for y, _ in wanted}) & F.col("uf").isin(*{u for _, u in wanted}))
    rows = rows.join(slices, ["slice_year", "uf"], "left_semi")
    keys = [name for name, _ in schemas.LIVESTOCK_INDEX.values()]
    variables = [v for t in fixed.SURVEY_TABLES.values() for v in t["variables"].values()]
    wide = pivot_variables(rows, keys, variables)
    touched = slices.withColumnRenamed("slice_year", "year")
    years = refresh(livestock.base_rows(livestock.clean_livestock(wide, mapping)), touched, folder, LIVESTOCK_ROLLUPS)
    spark.createDataFrame([(newest,)], "batch long").write.mode("append").parquet(last)
    return years
