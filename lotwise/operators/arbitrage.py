"""Price gap to the national average of the segment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise import schema as S
from lotwise.functions.scoring import holds


def with_arbitrage(listings: DataFrame) -> DataFrame:
    """The national average is the segment average, so no second pass is made."""
    gain = F.col("market_avg_price") - F.col("price")
    return listings.withColumns(
        {
            "national_avg_price": F.col("market_avg_price"),
            "arbitrage_opportunity": gain,
            "is_sourcing_hub": holds(gain > S.SOURCING_HUB_GAIN),
        }
    )


def sourcing_hubs(listings: DataFrame) -> DataFrame:
    return listings.filter("is_sourcing_hub")
