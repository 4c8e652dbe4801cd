"""CSV, JSON-lines, GeoJSON and lookup files."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from municipia.functions.cleaning import round_half_even, sanitize_float

# Decimals of each measure in published output.
MEASURE_DECIMALS = {"a": 1, "p": 1, "v": 1, "q": 1, "r": 2, "r_mean": 2, "r_weighted": 2}


def round_measures(df: DataFrame, decimals: Mapping[str, int] | None = None) -> DataFrame:
    """Published rounding; to be used last, since rounded values do not add up."""
    decimals = MEASURE_DECIMALS if decimals is None else decimals
    return df.withColumns({c: round_half_even(F.col(c), n) for c, n in decimals.items() if c in df.columns})


def sanitize_measures(df: DataFrame) -> DataFrame:
    doubles = [name for name, kind in df.dtypes if kind in ("double", "float")]
    return df.withColumns({c: sanitize_float(F.col(c)) for c in doubles}) if doubles else df


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", compression: str = "none") -> None:
    df.write.mode(mode).option("sep", ";").option("header", True).option("compression", compression).csv(path)


def save_category_groups(groups: DataFrame, path: str) -> None:
    """Write the lookup to a new folder; never the one it was read from."""
    named = groups.withColumnsRenamed({"category": "cultura", "kind": "tipo"})
    named.coalesce(1).sortWithinPartitions("cultura").write.mode("errorifexists").option("header", True).csv(path)


def geo_feature_json(features: DataFrame, key: str) -> DataFrame:
    """One GeoJSON feature per row; the geometry text goes out as it came in."""
    properties = F.to_json(F.struct(F.col("codarea"), F.col(key)))
    geometry = F.coalesce(F.col("geometry"), F.lit("null"))
    return features.select(
        F.concat(F.lit('{"type":"Feature","properties":'), properties, F.lit(',"geometry":'), geometry, F.lit("}")).alias("value")
    )


def write_geo_features(features: DataFrame, path: str, key: str, mode: str = "errorifexists") -> None:
    geo_feature_json(features, key).write.mode(mode).text(path)
