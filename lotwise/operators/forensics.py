"""VIN year, fraud flags and trust."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise import schema as S
from lotwise.functions.scoring import holds, vin_year, vin_year_letter


def with_vin_year(listings: DataFrame) -> DataFrame:
    return listings.withColumn("vin_year_code", vin_year_letter(F.col("vin"))).withColumn(
        "decoded_vin_year", vin_year(F.col("vin_year_code"))
    )


def with_fraud_flags(listings: DataFrame, current_year: int = S.CURRENT_YEAR) -> DataFrame:
    """A VIN year too far from the listed one; an old car with hardly any miles."""
    decoded, year, miles = F.col("decoded_vin_year"), F.col("year"), F.col("odometer")
    mismatch = (decoded > 0) & (F.abs(decoded - year) > S.YEAR_TOLERANCE)
    aged = year < current_year - S.AGED_AFTER_YEARS
    return listings.withColumns(
        {
            "is_year_mismatch": holds(mismatch),
            "is_suspicious_mileage": holds(aged & (miles > 0) & (miles < S.LOW_MILEAGE)),
        }
    )


def with_trust_score(listings: DataFrame) -> DataFrame:
    penalty = F.col("is_year_mismatch").cast("int") * S.YEAR_MISMATCH_PENALTY + F.col(
        "is_suspicious_mileage"
    ).cast("int") * S.LOW_MILEAGE_PENALTY
    return listings.withColumn("trust_score", S.FULL_TRUST - penalty)


def low_trust(listings: DataFrame) -> DataFrame:
    return listings.filter(F.col("trust_score") < S.FULL_TRUST)
