"""Cleaning of text, codes and numbers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from municipia.fixed_values import NUMERIC_SENTINELS

_BLANKS = " \t\n\r\f\v"


def clean_numeric(col: Column, sentinels: Sequence[str] = NUMERIC_SENTINELS) -> Column:
    """Survey text to double: sentinels and anything unreadable become null, thousands commas go."""
    text = F.btrim(col.cast("string"), F.lit(_BLANKS))
    # A trailing type letter ("1d", "2f") is a number to the cast but not to the survey.
    typed = text.rlike(r"[0-9.][dDfF]$")
    return F.when(text.isin(*sentinels) | typed, F.lit(None)).otherwise(F.regexp_replace(text, ",", "")).try_cast("double")


def decode_variable(col: Column, mapping: Mapping[str, str]) -> Column:
    """Variable code to its name; unknown codes pass through."""
    pairs = [F.lit(part) for pair in mapping.items() for part in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), col), col)


def normalise_area_code(col: Column, width: int = 2) -> Column:
    """``"011"`` to ``"11"``, left-padded to ``width``; text that is no integer stays as it is."""
    digits = col.try_cast("long").cast("string")
    padded = F.when(F.length(digits) < width, F.lpad(digits, width, "0")).otherwise(digits)
    return F.coalesce(padded, col)


def sanitize_float(col: Column) -> Column:
    """NaN and both infinities become 0; null stays null."""
    bad = F.isnan(col) | (F.abs(col) == F.lit(float("inf")))
    return F.when(bad, F.lit(0.0)).otherwise(col)


def round_half_even(col: Column, digits: int) -> Column:
    """Round on the exact binary value, ties to even.

    ``F.round`` and ``F.bround`` work on the shortest decimal text instead, and differ on values such as 0.35.
    """
    pattern = "0" if digits == 0 else "0." + "0" * digits
    return F.call_function("format_number", sanitize_float(col.cast("double")), F.lit(pattern)).cast("double")


def zero_if_null(col: Column) -> Column:
    return F.coalesce(col, F.lit(0.0))


def plain_name(col: Column) -> Column:
    """Lower case, no parentheses, no outer blanks: the form in which names are compared."""
    return F.btrim(F.translate(F.lower(col), "()", ""), F.lit(_BLANKS))


def contains_either_way(left: Column, right: Column) -> Column:
    return left.contains(right) | right.contains(left)


def code_prefix(col: Column, length: int = 2) -> Column:
    return F.substring(col, 1, length)


def value_at(series: Column, year_index: int) -> Column:
    """Element of a packed series by 0-based year index, 0 where anything is missing."""
    return zero_if_null(F.try_element_at(series, F.lit(year_index + 1)))
