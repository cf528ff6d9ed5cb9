"""Expressions for scores, flags and labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lotwise import schema as S


def deviation_score(
    value: Column, center: Column, spread: Column, *, lone_row_scores: bool
) -> Column:
    """Distance from ``center`` in units of ``spread``.

    A zero spread counts as one unit. A segment of one row has no spread: its
    score is null, or measured in units of one where ``lone_row_scores``.
    """
    if lone_row_scores:
        unit = F.coalesce(F.nullif(spread, F.lit(0.0)), F.lit(1.0))
    else:
        unit = F.when(spread == 0, 1.0).otherwise(spread)
    return (value - center) / unit


def vin_year_letter(vin: Column) -> Column:
    return F.substring(vin, S.VIN_YEAR_POSITION, 1)


def vin_year(letter: Column) -> Column:
    """The model year a letter stands for, 0 where it stands for none."""
    years = [
        F.lit(part)
        for year, known in enumerate(S.VIN_YEAR_LETTERS, start=S.VIN_FIRST_YEAR)
        for part in (known, year)
    ]
    return F.coalesce(F.try_element_at(F.create_map(*years), letter), F.lit(0))


def holds(condition: Column) -> Column:
    """A flag that reads an undecidable condition as false."""
    return F.coalesce(condition, F.lit(False))


def first_match(rules: Sequence[tuple[Column, Column | str]], otherwise: str) -> Column:
    """The label of the first rule whose condition is true.

    One CASE, so that a filter on the label is simplified to the conditions.
    """
    (condition, label), *rest = rules
    case = F.when(condition, label)
    for condition, label in rest:
        case = case.when(condition, label)
    return case.otherwise(otherwise)


def spread_ratio(spread: Column, center: Column) -> Column:
    return F.try_divide(spread, center)
