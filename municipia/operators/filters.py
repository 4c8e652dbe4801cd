"""Row filters and column choices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from municipia import fixed_values as fixed
from municipia.params import Selection


def resolve_column(df: DataFrame, candidates: Sequence[str], fallback: str) -> str:
    """First candidate that the frame has, else ``fallback``."""
    return next((name for name in candidates if name in df.columns), fallback)


def drop_unmapped(df: DataFrame, column: str = "uf") -> DataFrame:
    return df.where(F.col(column).isNotNull())


def exclude_categories(df: DataFrame, values: Sequence[str], column: str = "category") -> DataFrame:
    """Drop the named categories; rows with no category stay."""
    return df.where(F.col(column).isNull() | ~F.col(column).isin(*values)) if values else df


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(keys))


def normalise_measures(df: DataFrame, head: str = "Efetivo_Cabecas", quantity: str = "Quantidade", value: str = "Valor_mil_reais") -> DataFrame:
    """One pair (q, v) per row: head-count, else quantity; value, else 0. Any of the columns may be absent."""
    present = [F.col(c) for c in (head, quantity) if c in df.columns]
    q = F.coalesce(*present) if present else F.lit(None).cast("double")
    v = F.coalesce(F.col(value), F.lit(0.0)) if value in df.columns else F.lit(0.0)
    rest = [c for c in df.columns if c not in (head, quantity, value)]
    return df.select(*rest, q.alias("q"), v.alias("v"))


def rename_to_group(df: DataFrame, category: str = "category", group: str = "grp") -> DataFrame:
    """Categories that stand beside groups in one table."""
    return df.withColumnRenamed(category, group)


def latest_period(df: DataFrame, year: str = "year", value: str = "value", fallback: int = fixed.LAST_YEAR - 1) -> DataFrame:
    """Newest year that has a real value, as one row."""
    text = F.trim(F.col(value).cast("string"))
    filled = df.where(text.isNotNull() & ~text.isin(*fixed.PERIOD_SENTINELS))
    return filled.agg(F.coalesce(F.max(F.col(year)), F.lit(fallback)).cast("int").alias(year))


def group_predicate(group: str) -> Column | None:
    """Condition on ``kind`` and ``grp`` for one group code; None for all categories."""
    if group == fixed.ALL:
        return None
    if group in (fixed.TEM, fixed.PER):
        return F.col("kind") == group
    if group in (fixed.COL, fixed.TRA):
        return F.col("grp") == group
    raise ValueError(f"unknown group {group!r}")


def active_categories(df: DataFrame, selection: Selection) -> DataFrame:
    """Rows of the categories the selection makes active: a chosen one, a livestock kind, or a group."""
    if selection.category is not None:
        return df.where(F.col("category") == selection.category)
    if selection.domain == "livestock":
        return df.where(F.col("kind") == selection.kind)
    condition = group_predicate(selection.group)
    return df if condition is None else df.where(condition)


def scope_filter(df: DataFrame, selection: Selection, year: bool = True) -> DataFrame:
    """Plain predicates on year, state, micro-region and municipality; they reach the scan."""
    for column, wanted in (("uf", selection.uf), ("mic", selection.mic), ("mun", selection.mun)):
        if wanted is not None:
            df = df.where(F.col(column) == wanted)
    if year and selection.year is not None:
        df = df.where(F.col("year") == selection.year)
    return df
