"""Statistics per market segment, and each listing placed against its segment.

The statistics are a plain aggregation, which combines rows before it shuffles,
so a segment that holds a third of all rows costs no more than any other. The
statistics are then joined back to the listings:

* where they are measured to be small they are broadcast, and the listings are
  not shuffled at all;
* otherwise both sides are shuffled by segment, and segments too large for one
  task are cut into slices, each with its own copy of the segment's one row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise import schema as S
from lotwise.functions.scoring import deviation_score
from lotwise.operators.tables import stored

BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024
HASHED_SHARE_BYTES = 64 * 1024 * 1024
# Listings of one segment that one task is meant to hold.
SLICE_ROWS = 1_000_000
ROW_OVERHEAD_BYTES = 96


def segment_statistics(
    listings: DataFrame, keys: list[str] = S.SEGMENT_KEYS, *, odometer: bool = False
) -> DataFrame:
    """One row per segment. Null keys form segments of their own."""
    price, miles = F.col("price"), F.col("odometer")
    measures = [
        F.round(F.avg(price), 2).alias("market_avg_price"),
        F.round(F.stddev_samp(price), 2).alias("market_std_dev_price"),
        F.count("id").alias("group_count"),
    ]
    if odometer:
        measures += [
            F.round(F.avg(miles), 0).alias("market_avg_odometer"),
            F.round(F.stddev_samp(miles), 0).alias("market_std_dev_odometer"),
        ]
    return listings.groupBy(*keys).agg(*measures, F.count(F.lit(1)).alias("segment_rows"))


def with_segment_statistics(
    listings: DataFrame,
    keys: list[str] = S.SEGMENT_KEYS,
    *,
    odometer: bool = False,
    table_path: str | None = None,
    broadcast_limit: int = BROADCAST_LIMIT_BYTES,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Add the statistics of its segment to every listing.

    Runs one job at once: it writes the statistics to ``table_path`` (a new
    folder in the shared working folder by default) and measures them.
    """
    statistics = stored(segment_statistics(listings, keys, odometer=odometer), table_path)
    named = _own_names(statistics, keys)
    size = _measure(statistics, keys)
    if size["bytes"] <= broadcast_limit:
        joined = listings.join(F.broadcast(named), _same_segment(keys), "left")
    else:
        joined = _sliced_join(listings, named, keys, size, slice_rows)
    return joined.drop("segment_rows", *[_own(key) for key in keys])


def _measure(statistics: DataFrame, keys: list[str]) -> dict[str, int]:
    """Bytes of the statistics in memory, and the listings they stand for."""
    text = [F.coalesce(F.octet_length(F.col(key).cast("string")), F.lit(0)) for key in keys]
    width = reduce(Column.__add__, text) + (8 * len(statistics.columns) + ROW_OVERHEAD_BYTES)
    measured = statistics.agg(
        F.coalesce(F.sum(width), F.lit(0)).alias("bytes"),
        F.coalesce(F.sum("segment_rows"), F.lit(0)).alias("rows"),
    )
    return measured.collect()[0].asDict()


def _sliced_join(
    listings: DataFrame,
    statistics: DataFrame,
    keys: list[str],
    size: dict[str, int],
    slice_rows: int,
) -> DataFrame:
    """Shuffled join in which no segment outgrows one task.

    A segment above ``slice_rows`` is cut into slices of about that many rows. Such
    segments are fewer than one in ``slice_rows`` listings, so their list (one hash
    and one number each) stays fit to broadcast.

    The statistics spread evenly, one row per segment and slice. Where a task's
    share of them is small it is hashed, which saves sorting the listings.
    """
    number = listings.sparkSession.conf.get("spark.sql.shuffle.partitions")
    partitions = int(number) if number.isdigit() else 1
    large = (
        statistics.filter(F.col("segment_rows") > slice_rows)
        .groupBy(F.xxhash64(*[_own(key) for key in keys]).alias("_large_segment"))
        .agg(F.max(F.ceil(F.col("segment_rows") / slice_rows)).cast("int").alias("_slices"))
    )
    large = F.broadcast(large)
    slices = F.coalesce("_slices", F.lit(1))

    # The slice of a listing mixes its id with its input partition: copies of one
    # listing spread too, and a task that runs again makes the same choice.
    chosen = F.pmod(F.xxhash64("id", F.spark_partition_id()), slices).cast("int")
    left = (
        listings.join(large, F.xxhash64(*keys) == F.col("_large_segment"), "left")
        .withColumn("_slice", F.when(slices > 1, chosen).otherwise(0))
        .drop("_large_segment", "_slices")
    )
    right = (
        statistics.join(
            large, F.xxhash64(*[_own(key) for key in keys]) == F.col("_large_segment"), "left"
        )
        .withColumn("_own_slice", F.explode(F.sequence(F.lit(0), slices - 1)))
        .drop("_large_segment", "_slices")
    )
    if size["bytes"] <= HASHED_SHARE_BYTES * partitions:
        right = right.hint("shuffle_hash")
    same = _same_segment(keys) & (F.col("_slice") == F.col("_own_slice"))
    return left.join(right, same, "left").drop("_slice", "_own_slice")


def _own(key: str) -> str:
    return f"_segment_{key}"


def _own_names(statistics: DataFrame, keys: list[str]) -> DataFrame:
    return statistics.withColumnsRenamed({key: _own(key) for key in keys})


def _same_segment(keys: list[str]) -> Column:
    return reduce(Column.__and__, [F.col(key).eqNullSafe(F.col(_own(key))) for key in keys])


def with_price_score(listings: DataFrame, *, lone_row_scores: bool) -> DataFrame:
    score = deviation_score(
        F.col("price"),
        F.col("market_avg_price"),
        F.col("market_std_dev_price"),
        lone_row_scores=lone_row_scores,
    )
    return listings.withColumn("price_z_score", score)


def with_odometer_score(listings: DataFrame) -> DataFrame:
    score = deviation_score(
        F.col("odometer"),
        F.col("market_avg_odometer"),
        F.col("market_std_dev_odometer"),
        lone_row_scores=True,
    )
    return listings.withColumn("odometer_z_score", score)
