"""Small tables and the joins that use them.

Only tables made from fixed values in code are hinted for broadcast. Everything else joins without a hint, so that Spark
compares sizes with its own threshold, re-plans at run time, and splits hot keys of a shuffled join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from municipia import fixed_values as fixed
from municipia.functions.cleaning import code_prefix


def states(spark: SparkSession) -> DataFrame:
    """The 27 states: ``uf_code, uf, uf_name, region, region_name``."""
    return spark.createDataFrame(fixed.STATES, "uf_code string, uf string, uf_name string, region string, region_name string")


def category_units(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(fixed.CATEGORY_UNITS.items()), "category string, unit string")


def default_category_groups(spark: SparkSession) -> DataFrame:
    """The category lookup as shipped: ``category, kind, COL``."""
    combine = set(fixed.COMBINE_CROPS)
    kinds = [(name, fixed.PER) for name in fixed.PERMANENT_CROPS] + [(name, fixed.TEM) for name in fixed.TEMPORARY_CROPS]
    rows = [(name, kind, int(name in combine)) for name, kind in kinds]
    return spark.createDataFrame(rows, "category string, kind string, COL int")


def derive_parent_code(df: DataFrame, parents: DataFrame, code: str = "mun", length: int = 2,
                       parent_code: str = "uf_code", parent: str = "uf", out: str | None = None) -> DataFrame:
    """Parent of each row from the first characters of its code; null where the prefix is unknown."""
    lookup = parents.select(F.col(parent_code).alias("_prefix"), F.col(parent).alias("_parent"))
    joined = df.withColumn("_prefix", code_prefix(F.col(code), length)).join(lookup, "_prefix", "left")
    out = out or parent
    kept = [c for c in df.columns if c != out]
    return joined.select(*kept, F.col("_parent").alias(out))


def attach(df: DataFrame, lookup: DataFrame, key: str, columns: Sequence[str], defaults: dict[str, Column] | None = None,
           lookup_key: str | None = None) -> DataFrame:
    """Left join of ``columns`` from ``lookup``; ``defaults`` fill what found no match or was null."""
    defaults = defaults or {}
    side = lookup.where(F.col(lookup_key or key).isNotNull()).select(F.col(lookup_key or key).alias("_key"), *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = df.join(side, F.col(key) == F.col("_key"), "left")
    kept = [F.col(c) for c in df.columns if c not in columns]
    added = [
        (F.coalesce(F.col(f"_new_{c}"), defaults[c]) if c in defaults else F.col(f"_new_{c}")).alias(c)
        for c in columns
    ]
    return joined.select(*kept, *added)


def attach_region(df: DataFrame, regions: DataFrame, key: str = "uf", region: str = "region", unknown: str = "??") -> DataFrame:
    return attach(df, regions, key, [region], {region: F.lit(unknown)})


def attach_names(df: DataFrame, dim: DataFrame, key: str, name: str, default: Column | None = None) -> DataFrame:
    """Name of each code; the code itself, or ``default``, where the dimension has none."""
    return attach(df, dim, key, [name], {name: F.col(key).cast("string") if default is None else default})


def attach_unit(df: DataFrame, units: DataFrame, key: str = "category") -> DataFrame:
    return attach(df, units, key, ["unit"], {"unit": F.lit("")})


def attach_microregion(df: DataFrame, mapping: DataFrame, mun: str = "mun", mic: str = "mic") -> tuple[DataFrame, DataFrame]:
    """Rows with their micro-region, and apart from them the rows whose municipality has none."""
    side = mapping.select(F.col(mun), F.col(mic)).where(F.col(mic).isNotNull())
    base = df.drop(mic)
    return base.join(side, mun, "inner"), base.join(side, mun, "left_anti")


def feature_state(features: DataFrame, parents: DataFrame, code: str = "area_code") -> DataFrame:
    """State of each polygon; the code itself where it is unknown."""
    side = parents.select(F.col("uf_code").alias(code), "uf")
    return attach(features, side, code, ["uf"], {"uf": F.col(code)})
