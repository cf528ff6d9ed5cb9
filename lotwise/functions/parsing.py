"""Expressions that read loosely typed feed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: how a bare NaN reads once a JSON text field has taken it in.
NAN_TEXT = '"NaN"'


def integer_from_text(text: Column) -> Column:
    """``2011`` and ``2011.0`` give 2011; text that is no number gives null."""
    return text.try_cast("double").try_cast("int")


def integer_from_double(number: Column) -> Column:
    """Whole numbers in int range; anything else is null."""
    return F.when(number == F.floor(number), number.try_cast("int"))


def known_number(number: Column) -> Column:
    """NaN becomes null."""
    return F.when(~F.isnan(number), number)


def known_text(text: Column) -> Column:
    """The text form of a bare NaN becomes null."""
    return F.nullif(text, F.lit(NAN_TEXT))
