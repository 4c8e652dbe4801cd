"""Packages: one folder per section, one JSON line per key.

A section is never one document, as municipality sections grow with the data. Each line is
``{"key": ..., "value": ...}``; nested values hold categories or groups, which are short lists.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from municipia.operators.series import nest_package, pack_series
from municipia.sinks.files import round_measures, sanitize_measures


def write_section(section: DataFrame, path: str) -> None:
    section.select("key", "value").write.mode("overwrite").json(path)


def nested_section(rollup: DataFrame, key: str, member: str, measures: Sequence[str], years: Sequence[int]) -> DataFrame:
    """key -> member -> measure -> array of yearly values, rounded for publication."""
    packed = pack_series(round_measures(sanitize_measures(rollup)), [key, member], measures, years)
    return nest_package(packed, key, member, measures).select(F.col(key).cast("string").alias("key"), F.col("package").alias("value"))


def flat_section(rollup: DataFrame, keys: Sequence[str], measures: Sequence[str], years: Sequence[int]) -> DataFrame:
    """Key columns -> measure -> array. Several key columns make the key a structure."""
    # A roll-up has a narrow row for every key and year; packed before the shuffle, each would travel as a row of all years.
    packed = pack_series(round_measures(sanitize_measures(rollup)).repartition(*keys), keys, measures, years)
    key = F.col(keys[0]).cast("string") if len(keys) == 1 else F.struct(*keys)
    return packed.select(key.alias("key"), F.struct(*measures).alias("value"))


def info_section(dim: DataFrame, key: str, fields: dict[str, str]) -> DataFrame:
    """key -> short names; ``fields`` maps a dimension column to its name in the package."""
    return dim.select(
        F.col(key).cast("string").alias("key"),
        F.struct(*[F.col(column).alias(name) for column, name in fields.items()]).alias("value"),
    )


def list_section(values: DataFrame, column: str) -> DataFrame:
    """A sorted list as lines ``key`` = position, ``value`` = entry. For short lists: years, categories."""
    listed = values.agg(F.array_sort(F.collect_set(column)).alias("_all"))
    return listed.select(F.posexplode("_all").alias("key", "value"))


def years_section(spark: SparkSession, years: Sequence[int]) -> DataFrame:
    return spark.createDataFrame(list(enumerate(years)), "key int, value int")
