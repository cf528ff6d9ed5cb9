"""Cleaning: spelling, completeness, price range, fillers and casts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotwise import schema as S
from lotwise.functions.parsing import integer_from_text, known_number


def standardize(listings: DataFrame) -> DataFrame:
    """Upper-case keys and VIN, lower-case title status, and name the VIN ``vin``."""
    return listings.withColumnRenamed("VIN", "vin").withColumns(
        {
            "manufacturer": F.upper("manufacturer"),
            "model": F.upper("model"),
            "vin": F.upper("vin"),
            "title_status": F.lower("title_status"),
        }
    )


def require_complete(listings: DataFrame) -> DataFrame:
    return listings.na.drop(subset=S.REQUIRED_COLUMNS)


def keep_price_range(
    listings: DataFrame, low: int = S.MIN_PRICE, high: int = S.MAX_PRICE
) -> DataFrame:
    """Both ends are exclusive."""
    return listings.filter((F.col("price") > low) & (F.col("price") < high))


def fill_defaults(listings: DataFrame) -> DataFrame:
    return listings.na.fill(
        {"odometer": S.ODOMETER_FILLER, "title_status": S.TITLE_STATUS_FILLER}
    )


def cast_measures(listings: DataFrame) -> DataFrame:
    """Text years to integers (null where unreadable), odometer to double."""
    return listings.withColumns(
        {
            "year": integer_from_text(F.col("year").cast("string")),
            "odometer": F.col("odometer").cast("double"),
        }
    )


def fill_year(listings: DataFrame, filler: int = S.YEAR_FILLER) -> DataFrame:
    """Years that are missing, unreadable or zero become the filler."""
    year = integer_from_text(F.col("year").cast("string"))
    return listings.withColumn("year", F.coalesce(F.nullif(year, F.lit(0)), F.lit(filler)))


def nan_to_null(records: DataFrame) -> DataFrame:
    """NaN becomes null in every floating-point field, also inside structs."""
    changed = {
        field.name: _without_nan(F.col(f"`{field.name}`"), field.dataType)
        for field in records.schema.fields
        if _may_hold_nan(field.dataType)
    }
    return records.withColumns(changed) if changed else records


def _may_hold_nan(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_may_hold_nan(field.dataType) for field in kind.fields)
    return isinstance(kind, (T.FloatType, T.DoubleType))


def _without_nan(value: Column, kind: T.DataType) -> Column:
    if not isinstance(kind, T.StructType):
        return known_number(value)
    for field in kind.fields:
        if _may_hold_nan(field.dataType):
            inner = _without_nan(value.getField(field.name), field.dataType)
            value = value.withField(f"`{field.name}`", inner)
    return value
