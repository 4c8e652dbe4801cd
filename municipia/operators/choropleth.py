"""Values and colour classes of map features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from municipia import fixed_values as fixed
from municipia.functions.classes import class_colour, legend_linear, legend_log, log_class
from municipia.operators.rank import value_over_scope_max
from municipia.operators.rollup import scope_max


def attach_values_to_features(features: DataFrame, values: DataFrame, key: str, value: str = "value") -> DataFrame:
    """Each polygon gets its value, 0 if it has none."""
    joined = features.drop(value).join(values.select(key, value), key, "left")
    return joined.withColumn(value, F.coalesce(F.col(value).cast("double"), F.lit(0.0)))


def features_in_scope(features: DataFrame, dim: DataFrame, key: str, uf: str | None = None) -> DataFrame:
    """Polygons of the dimension's regions, or of one state's."""
    inside = dim if uf is None else dim.where(F.col("uf") == uf)
    return features.join(inside.select(key), key, "left_semi")


def colour_classes(values: DataFrame, scope: Sequence[str] = (), value: str = "value",
                   palette: Sequence[str] = tuple(fixed.PALETTE_COUNTRY)) -> DataFrame:
    """Scope maximum, class and colour per row."""
    scaled = value_over_scope_max(values, scope, value)
    classed = scaled.withColumn("class_index", log_class(F.col(value), F.col("scope_max"), len(palette)))
    return classed.withColumn("colour", class_colour(F.col("class_index"), palette))


def legend(values: DataFrame, by: Sequence[str] = (), value: str = "value",
           palette: Sequence[str] = tuple(fixed.PALETTE_COUNTRY)) -> DataFrame:
    """One row per step: its colour, the linear value printed beside it, and the log bound it stands for."""
    top = scope_max(values, value, by)
    n = len(palette)
    steps = F.arrays_zip(
        legend_linear(F.col("scope_max"), n).alias("linear"), legend_log(F.col("scope_max"), n).alias("log"),
    )
    exploded = top.select(*by, "scope_max", F.posexplode(steps).alias("step", "_s"))
    return exploded.select(
        *by, "step", class_colour(F.col("step"), palette).alias("colour"),
        F.col("_s.linear").alias("linear_value"), F.col("_s.log").alias("log_value"),
    )
