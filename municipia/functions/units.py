"""Sums that do not depend on row order, exact at any size.

Amounts with a fixed number of decimals are counted in whole units (cents) as 64-bit integers. A sum adds up the units' upper and
lower parts apart, so that neither overflows before 2**43 rows, and puts them together as a decimal: two integer sums a row, where
a decimal sum costs an order of magnitude more. Sums of sums are rows of decimals, which are few. Results become doubles once, after the last sum.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOW_BITS = 20


# Why an amount is no whole number of units. Beyond MOST_UNITS a double no longer tells units apart.
NAN, INFINITE, TOO_LARGE, FINER = "nan", "infinite", "too_large", "finer_than_unit"
MOST_UNITS = float(1 << 53)


def whole_units(column: Column, per_one: int = 100) -> Column:
    """Amount as a whole number of units, ``per_one`` of them making 1; null where there is none that fits a long. Finer decimals are rounded away, to even."""
    return F.rint(column * F.lit(float(per_one))).try_cast("bigint")


def fits_units(amount: Column, per_one: int = 100) -> Column:
    """A finite amount of at most MOST_UNITS units."""
    return ~F.isnan(amount) & (F.abs(amount * F.lit(float(per_one))) <= MOST_UNITS)


def unit_problem(amount: Column, per_one: int = 100) -> Column:
    """What keeps a double from being a whole number of units, null if nothing does."""
    nearest = F.rint(amount * F.lit(float(per_one))) / F.lit(float(per_one))
    return (
        F.when(F.isnan(amount), NAN).when(F.abs(amount) == F.lit(float("inf")), INFINITE)
        .when(~fits_units(amount, per_one), TOO_LARGE).when(nearest != amount, FINER)
    )


def total_sql(kind: str, name: str, condition: str = "") -> str:
    """SQL for the sum of a column of type ``kind``, over the rows that meet ``condition``; decimal for whole units, null without values."""
    where = f" FILTER (WHERE {condition})" if condition else ""
    if kind not in ("bigint", "int"):
        return f"sum(`{name}`){where}"
    high, low = f"sum(shiftright(`{name}`, {LOW_BITS})){where}", f"sum(`{name}` & {(1 << LOW_BITS) - 1}L){where}"
    return f"CAST({high} AS DECIMAL(31,0)) * {1 << LOW_BITS} + {low}"


def total(df: DataFrame, name: str) -> Column:
    """Sum of a column of ``df``, under its own name."""
    return F.expr(total_sql(dict(df.dtypes)[name], name)).alias(name)


def scaled(df: DataFrame, per_one: Mapping[str, int]) -> DataFrame:
    """Counts of units back to amounts, for those of the columns that the frame has."""
    amounts = {c: F.col(c) / F.lit(float(n)) for c, n in per_one.items() if c in df.columns}
    return df.withColumns(amounts) if amounts else df
