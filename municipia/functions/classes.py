"""Colour classes and legends."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def log_class(value: Column, scope_max: Column, classes: int = 7) -> Column:
    """0-based class on a log scale; only the scope's maximum reaches the top class."""
    share = F.least(F.log1p(value) / F.log1p(scope_max), F.lit(1.0))
    empty = F.coalesce(value == 0, F.lit(True)) | F.coalesce(scope_max == 0, F.lit(True))
    return F.when(empty, F.lit(0)).otherwise(F.floor(share * (classes - 1)).cast("int"))


def class_colour(cls: Column, palette: Sequence[str]) -> Column:
    return F.element_at(F.array(*[F.lit(colour) for colour in palette]), cls + 1)


def legend_linear(scope_max: Column, classes: int = 7) -> Column:
    """Steps as printed on the map: evenly spaced from 0 to the maximum."""
    return F.transform(F.sequence(F.lit(0), F.lit(classes - 1)), lambda i: scope_max * i / F.lit(classes - 1))


def legend_log(scope_max: Column, classes: int = 7) -> Column:
    """Lower bounds of the classes that ``log_class`` really uses."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(classes - 1)),
        lambda i: F.expm1(F.log1p(scope_max) * i / F.lit(classes - 1)),
    )
