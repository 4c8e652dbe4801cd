"""Geography dimensions built from the fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from municipia.operators.rank import PER_RANGE, rank_position


def state_dim(fact: DataFrame, names: DataFrame, uf: str = "uf") -> DataFrame:
    """States that occur, with name (code if unknown) and macro-region (blank if unknown)."""
    seen = fact.select(uf).where(F.col(uf).isNotNull()).distinct()
    side = names.select(F.col("uf").alias(uf), F.col("uf_name").alias("_n"), F.col("region").alias("_r"))
    return seen.join(side, uf, "left").select(
        uf, F.coalesce("_n", F.col(uf)).alias("uf_name"), F.coalesce("_r", F.lit("")).alias("region")
    )


def micro_dim(fact: DataFrame, order: str = "year", mic: str = "mic", name: str = "mic_name", uf: str = "uf", meso: str = "meso_name") -> DataFrame:
    """One row per micro-region: of its (name, state, meso) tuples the one that first appears last.

    ``order`` must be numeric, so that the pass over the fact is a hash aggregate; ties go to the
    greatest tuple. Without a row number the year is the stated order.
    """
    first_seen = (
        fact.where(F.col(mic).isNotNull())
        .groupBy(mic, name, uf, meso)
        .agg(F.min(order).alias("_seen"))
    )
    tuples = F.struct(name, uf, meso)
    return (
        first_seen.groupBy(mic)
        .agg(F.max_by(tuples, F.struct("_seen", name, uf, meso)).alias("_t"))
        .select(mic, f"_t.{name}", f"_t.{uf}", f"_t.{meso}")
    )


def municipality_dim(fact: DataFrame, order: str = "year", mun: str = "mun", name: str = "mun_name", uf: str = "uf", mic: str = "mic") -> DataFrame:
    """One row per municipality: its first (name, state, micro-region); ties go to the smallest tuple."""
    first_seen = (
        fact.where(F.col(mun).isNotNull())
        .groupBy(mun, name, uf, mic)
        .agg(F.min(order).alias("_seen"))
    )
    tuples = F.struct(name, uf, mic)
    return (
        first_seen.groupBy(mun)
        .agg(F.min_by(tuples, F.struct("_seen", name, uf, mic)).alias("_t"))
        .select(mun, f"_t.{name}", f"_t.{uf}", f"_t.{mic}")
    )


def locale_sorted(dim: DataFrame, name: str, key: str, collation: str = "pt") -> DataFrame:
    """Portuguese order of names, code as tie-break."""
    return dim.orderBy(locale_key(name, collation), F.col(key))


def locale_positions(dim: DataFrame, name: str, key: str, collation: str = "pt", per_range: int = PER_RANGE) -> DataFrame:
    """``locale_sorted`` with the 0-based place of each row, for lists of any length. The key must tell rows apart.

    The order is cut into ranges by places in it, and rows are numbered inside their range; no task sees more than a range and no driver any name.
    """
    placed = rank_position(dim.withColumn("_name", locale_key(name, collation)), [], "_name", key, ascending=True, per_range=per_range)
    return placed.withColumn("position", (F.col("position") - 1).cast("int")).drop("_name")


def locale_key(column: str, collation: str = "pt") -> Column:
    return F.collate(F.col(column), collation)
