"""Record layout and the fixed business values shared by every operator."""

from __future__ import annotations

from pyspark.sql import types as T

# The listing record, in file order. `id` is wider than 32 bits in
# real feeds, and `year` arrives as text ("2011" or "2011.0").
LISTING_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("region_url", T.StringType()),
        T.StructField("price", T.IntegerType()),
        T.StructField("year", T.StringType()),
        T.StructField("manufacturer", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("condition", T.StringType()),
        T.StructField("cylinders", T.StringType()),
        T.StructField("fuel", T.StringType()),
        T.StructField("odometer", T.DoubleType()),
        T.StructField("title_status", T.StringType()),
        T.StructField("transmission", T.StringType()),
        T.StructField("VIN", T.StringType()),
        T.StructField("drive", T.StringType()),
        T.StructField("size", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("paint_color", T.StringType()),
        T.StructField("image_url", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("county", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("long", T.DoubleType()),
        T.StructField("posting_date", T.StringType()),
    ]
)

# The columns of a message-bus record.
MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

# Columns of the published table, in order (a load timestamp follows).
PUBLISHED_COLUMNS = [
    "id",
    "manufacturer",
    "model",
    "year",
    "price",
    "odometer",
    "region",
    "lat",
    "long",
    "vin",
    "trust_score",
    "is_year_mismatch",
    "national_avg_price",
    "arbitrage_opportunity",
    "is_sourcing_hub",
    "deal_rating",
]

# Keys of a market segment and of the coarser summary segment.
SEGMENT_KEYS = ["manufacturer", "model", "year"]
SUMMARY_KEYS = ["manufacturer", "model"]

# Columns a complete listing must carry.
REQUIRED_COLUMNS = ["manufacturer", "model", "year", "price"]

# Cleaning bounds and fillers. Both price bounds are exclusive.
MIN_PRICE = 500
MAX_PRICE = 200000
ODOMETER_FILLER = -1.0
TITLE_STATUS_FILLER = "clean"
YEAR_FILLER = 1900

# Model-year letters of VIN position 10. The first letter stands
# for 2010 and each next one for the following year; I and O are never used.
VIN_YEAR_LETTERS = "ABCDEFGHJKLMNP"
VIN_FIRST_YEAR = 2010
VIN_YEAR_POSITION = 10

# Fraud and trust.
CURRENT_YEAR = 2025
YEAR_TOLERANCE = 1
AGED_AFTER_YEARS = 5
LOW_MILEAGE = 2000
FULL_TRUST = 100
YEAR_MISMATCH_PENALTY = 50
LOW_MILEAGE_PENALTY = 30

# Arbitrage and rating thresholds.
SOURCING_HUB_GAIN = 2000
TRUST_FLOOR = 70
MIN_SEGMENT_SIZE = 5
VOLATILE_RATIO = 0.20
DEEP_DISCOUNT_Z = -1.5
DISCOUNT_Z = -0.5
PREMIUM_Z = 0.5
HIGH_PREMIUM_Z = 1.5
EXTREME_PREMIUM_Z = 3.0
HIGH_ODOMETER_Z = 1.5

# Report sizes.
SUMMARY_TOP = 20
BOUNDED_READ_ROWS = 10000
