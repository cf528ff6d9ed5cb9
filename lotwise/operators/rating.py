"""Deal ratings. Rules are tried in order; closed intervals include both ends."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise import schema as S
from lotwise.functions.scoring import first_match, spread_ratio


def _too_few():
    return F.col("group_count") < S.MIN_SEGMENT_SIZE


def _untrusted():
    return F.col("trust_score") < S.TRUST_FLOOR


def _score_below(limit: float):
    return F.col("price_z_score") < limit


def _score_up_to(limit: float):
    """Closes the interval that the rule before it left open."""
    return F.col("price_z_score") <= limit


def rate_basic(listings: DataFrame) -> DataFrame:
    """Price only; its labels are spelled with spaces."""
    rules = [
        (_too_few(), "INSUFFICIENT_DATA"),
        (_score_below(S.DEEP_DISCOUNT_Z), "GREAT DEAL"),
        (_score_up_to(S.DISCOUNT_Z), "GOOD PRICE"),
        (_score_up_to(S.PREMIUM_Z), "FAIR MARKET"),
        (F.col("price_z_score") > S.HIGH_PREMIUM_Z, "OVERPRICED"),
    ]
    return listings.withColumn("deal_rating", first_match(rules, "SLIGHTLY HIGH"))


def rate_trusted(listings: DataFrame) -> DataFrame:
    """Price, but only for listings that can be trusted."""
    rules = [
        (_untrusted(), "RISKY_BUY"),
        (_too_few(), "INSUFFICIENT_DATA"),
        (_score_below(S.DEEP_DISCOUNT_Z), "GREAT_DEAL"),
        (_score_up_to(S.DISCOUNT_Z), "GOOD_PRICE"),
        (_score_up_to(S.PREMIUM_Z), "FAIR_MARKET"),
    ]
    return listings.withColumn("deal_rating", first_match(rules, "OVERPRICED"))


def rate_live(listings: DataFrame) -> DataFrame:
    """Trust, market volatility, price, and mileage that holds a great deal back."""
    ratio = spread_ratio(F.col("market_std_dev_price"), F.col("market_avg_price"))
    worn = F.col("odometer_z_score") > S.HIGH_ODOMETER_Z
    rules = [
        (_untrusted(), "RISKY_BUY"),
        (_too_few(), "INSUFFICIENT_DATA"),
        (ratio > S.VOLATILE_RATIO, "VOLATILE_MARKET"),
        (_score_below(S.DEEP_DISCOUNT_Z) & worn, "GOOD_PRICE"),
        (_score_below(S.DEEP_DISCOUNT_Z), "GREAT_DEAL"),
        (_score_up_to(S.DISCOUNT_Z), "GOOD_PRICE"),
        (_score_up_to(S.PREMIUM_Z), "FAIR_MARKET"),
        (F.col("price_z_score") >= S.EXTREME_PREMIUM_Z, "EXTREME_OVERPRICE"),
    ]
    return listings.withColumn("deal_rating", first_match(rules, "OVERPRICED"))
