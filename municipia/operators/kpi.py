"""Headline numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from municipia.functions.units import total


def kpi_crop(cells: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Totals over (state, category) cells, for all or per ``by``; the count of cells with data and of distinct categories with data."""
    has_data = F.coalesce("a", F.lit(0)) + F.coalesce("p", F.lit(0)) + F.coalesce("v", F.lit(0)) > 0
    return cells.groupBy(*by).agg(
        *[F.coalesce(total(cells, c), F.lit(0)).cast("double").alias(c) for c in ("a", "p", "v")],
        F.count_if(has_data).alias("pair_count"),
        F.count_distinct(F.when(has_data, F.col("category"))).alias("crop_count"),
    )


def kpi_livestock(rows: DataFrame, mun: str = "mun", by: Sequence[str] = (), known: DataFrame | None = None) -> DataFrame:
    """Totals and the number of municipalities with a positive quantity, in one pass.

    With ``known`` only municipalities of that dimension are counted; the totals stay complete.
    """
    by_mun = rows.groupBy(*by, mun).agg(total(rows, "q"), total(rows, "v"))
    counted = (F.col("q") > 0) & F.col(mun).isNotNull()
    if known is not None:
        by_mun = by_mun.join(known.select(mun).distinct().withColumn("_known", F.lit(True)), mun, "left")
        counted = counted & F.col("_known").isNotNull()
    return by_mun.groupBy(*by).agg(
        F.coalesce(total(by_mun, "q"), F.lit(0)).cast("double").alias("q"),
        F.coalesce(total(by_mun, "v"), F.lit(0)).cast("double").alias("v"),
        F.count_if(counted).alias("municipalities"),
    )


def scope_counts(micros: DataFrame, mun_values: DataFrame, uf: str = "uf") -> DataFrame:
    """Per state: its micro-regions, and its municipalities with data (``value`` > 0)."""
    mics = micros.where(F.col(uf).isNotNull()).groupBy(uf).agg(F.count(F.lit(1)).alias("micro_regions"))
    muns = mun_values.where(F.col(uf).isNotNull()).groupBy(uf).agg(F.count_if(F.col("value") > 0).alias("municipalities"))
    return mics.join(muns, uf, "left").withColumn("municipalities", F.coalesce("municipalities", F.lit(0).cast("bigint")))
