"""Map features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from municipia import schemas
from municipia.functions.cleaning import normalise_area_code
from municipia.operators.lookups import feature_state, states


def read_geo_features(spark: SparkSession, path: str, level: str = "uf") -> DataFrame:
    """One row per polygon: ``area_code``, its key ``uf`` or ``mid``, and the geometry as text."""
    return features_of(spark.read.schema(schemas.GEO_SCHEMA).option("multiLine", True).json(path), level)


def features_of(raw: DataFrame, level: str = "uf") -> DataFrame:
    """The same from parsed collections, a column ``features`` as in GEO_SCHEMA."""
    if level not in ("uf", "mid"):
        raise ValueError(f"level must be 'uf' or 'mid', not {level!r}")
    feature = raw.select(F.explode("features").alias("f"))
    code = F.coalesce(F.col("f.properties.codarea"), F.lit(""))
    width = 2 if level == "uf" else 1
    features = feature.select(
        code.alias("codarea"),
        normalise_area_code(code, width).alias("area_code"),
        F.col("f.geometry").alias("geometry"),
    )
    if level == "mid":
        return features.withColumn("mid", F.col("area_code"))
    return feature_state(features, F.broadcast(states(raw.sparkSession)))  # 27 rows
