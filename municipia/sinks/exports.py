"""Exports of one selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def export_slice_rows(cells: DataFrame, state_names: DataFrame) -> DataFrame:
    """Rows (uf, state name, category, year, value) of the cells with a non-zero value."""
    named = state_names.select("uf", "uf_name")
    kept = cells.where((F.col("value") != 0) & ~F.isnan(F.col("value").cast("double")))
    return kept.join(named, "uf", "left").select("uf", F.coalesce("uf_name", "uf").alias("uf_name"), "category", "year", "value")


def export_state_maps(cells: DataFrame, keep_empty: bool, by: Sequence[str] = ("uf",)) -> DataFrame:
    """Per state (or ``by``) a map category -> value of its non-zero cells; ``keep_empty`` keeps states without any."""
    entry = F.when(F.coalesce(F.col("value"), F.lit(0)) != 0, F.struct(F.col("category").alias("k"), F.col("value").alias("v")))
    sorted_entries = F.array_sort(F.collect_list(entry), lambda x, y: F.when(x.k < y.k, -1).when(x.k > y.k, 1).otherwise(0))
    maps = cells.groupBy(*by).agg(F.map_from_entries(sorted_entries).alias("data"))
    return maps if keep_empty else maps.where(F.size("data") > 0)


def export_document(state_maps: DataFrame, year: Column, metric: str, uf: str | None) -> DataFrame:
    """The whole export as one JSON text, for the dashboard: states x categories of one year, a short document in one row."""
    entries = F.array_sort(F.collect_list(F.struct(F.col("uf").alias("k"), F.col("data").alias("v"))), lambda x, y: F.when(x.k < y.k, -1).when(x.k > y.k, 1).otherwise(0))
    fields = F.struct(year.cast("int").alias("ano"), F.lit(metric).alias("metrica"), F.lit(uf or "BR").alias("uf"), F.map_from_entries(entries).alias("data"))
    return state_maps.agg(F.to_json(fields).alias("document"))
