"""Measure cells that can't be counted in whole units, kept out of sums and reported.

The surveys' publication writes 0 where a sum is not a finite number. Sums here are whole numbers, which know no infinity, so infinite and
too large cells travel beside the measures as counts (``<measure>_bad``), are added up along every roll-up, and make the published sum infinite at its end.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from municipia.functions.units import INFINITE, TOO_LARGE, fits_units, unit_problem

SUFFIX = "_bad"


def bad_counts(measures: Sequence[str]) -> list[str]:
    return [f"{m}{SUFFIX}" for m in measures]


def fit_cells(df: DataFrame, per_one: Mapping[str, int], report: str = "bad_cells") -> DataFrame:
    """Measures that whole units can hold, the others null; ``<measure>_bad`` is 1 where an infinite or too large one was, and ``report`` lists
    (measure, problem, value) of every cell that is NaN, infinite, too large, or finer than a unit. NaN counts as missing; finer cells stay and are rounded when counted.
    """
    cells = [(m, F.col(m).cast("double"), unit_problem(F.col(m).cast("double"), n)) for m, n in per_one.items()]
    found = [F.when(p.isNotNull(), F.struct(F.lit(m).alias("measure"), p.alias("problem"), v.cast("string").alias("value"))) for m, v, p in cells]
    columns = {m: F.when(fits_units(v, per_one[m]), v) for m, v, _ in cells}
    columns |= {f"{m}{SUFFIX}": F.when(p.isin(INFINITE, TOO_LARGE), 1).otherwise(0).cast("bigint") for m, _, p in cells}
    listed = F.array_compact(F.array(*found))
    return df.withColumns({**columns, report: F.when(F.size(listed) > 0, listed)})


def unfit_cells(df: DataFrame, keys: Sequence[str], report: str = "bad_cells") -> DataFrame:
    """One row per reported cell: ``keys``, measure, problem, value."""
    return df.where(F.col(report).isNotNull()).select(*keys, F.expr(f"inline(`{report}`)"))


def cell_report(unfit: DataFrame) -> DataFrame:
    """(name, rows) per problem and measure."""
    name = F.concat(F.lit("cell "), "problem", F.lit(": "), "measure")
    return unfit.groupBy("measure", "problem").agg(F.count(F.lit(1)).alias("rows")).select(name.alias("name"), "rows")


def poisoned(df: DataFrame, measures: Mapping[str, Sequence[str]]) -> DataFrame:
    """Sums over an infinite or too large cell become infinite; the counts go. ``measures``: what each measure is made of."""
    def made(measure: str, parts: Sequence[str]):
        bad = sum((F.coalesce(F.col(f"{p}{SUFFIX}"), F.lit(0)) for p in parts), F.lit(0))
        return F.when(bad > 0, F.lit(float("inf"))).otherwise(F.col(measure))

    counts = {f"{p}{SUFFIX}" for parts in measures.values() for p in parts}
    return df.withColumns({m: made(m, parts) for m, parts in measures.items()}).drop(*counts)
