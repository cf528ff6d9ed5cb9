"""Every operator as a named query over the tables of one folder."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise import schema as S
from lotwise.operators import arbitrage, forensics, prepare, rating, reports, segments
from lotwise.operators.commits import (
    Commits,
    append_once,
    compact,
    publish,
    read_appended,
    read_published,
    remove_old_versions,
    remove_unread,
)
from lotwise.operators.tables import overwrite_table, stored
from lotwise.plans import scoring
from lotwise.session import new_folder
from lotwise.sources import files, messages
from lotwise.sources.standin import standin_listings
from lotwise.streaming import jobs
from lotwise.streaming.sinks import read_table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

LISTING = [
    "id",
    "region",
    "state",
    "price",
    "year",
    "manufacturer",
    "model",
    "odometer",
    "title_status",
    "lat",
    "long",
]
AVAILABLE_NOW = {"availableNow": True}
ARRIVAL = "2001-08-02 00:00:00"
RESTARTED = "1998-01-01 00:00:00"


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


# Common starting points.


def _cleaned_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.clean_batch(standin_listings(spark, sf_dir))


def _placed_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = stored(_cleaned_batch(spark, sf_dir).select(*scoring.BATCH_COLUMNS))
    placed = segments.with_segment_statistics(cleaned)
    return segments.with_price_score(placed, lone_row_scores=False)


def _scored_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score_batch(_cleaned_batch(spark, sf_dir))


def _cleaned_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = scoring.clean_live(standin_listings(spark, sf_dir))
    return stored(cleaned.select(*scoring.LIVE_COLUMNS))


def _placed_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = segments.with_segment_statistics(_cleaned_live(spark, sf_dir), odometer=True)
    return segments.with_odometer_score(segments.with_price_score(placed, lone_row_scores=True))


def _scored_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score_live(_cleaned_live(spark, sf_dir))


def _stamped(listings: DataFrame) -> DataFrame:
    """The listings as messages that arrived at their event time."""
    return messages.stamp_messages(listings, F.col("event_time"))


def _message_folder(spark: SparkSession, listings: DataFrame) -> str:
    folder = new_folder(spark, "messages")
    messages.write_message_files(_stamped(listings), folder)
    return folder


# Sources.


@query
def src_csv_roundtrip(spark, sf_dir):
    path = new_folder(spark, "csv")
    files.write_listings_csv(standin_listings(spark, sf_dir), path)
    return files.read_listings_csv(spark, path).select(*LISTING, "VIN")


@query
def src_csv_breaks(spark, sf_dir):
    """One file whose descriptions hold line breaks, quotes and commas."""
    path = new_folder(spark, "csv")
    listings = standin_listings(spark, sf_dir)
    line = F.concat_ws("\n", "region", F.concat(F.lit('"'), "model", F.lit('", sold')), F.lit(""))
    # A shuffle: coalesce(1) would also join all tables in the one task that writes.
    files.write_listings_csv(listings.withColumn("description", line).repartition(1), path)
    return files.read_listings_csv(spark, path).select("id", "price", "description", "state")


@query
def src_json_encode(spark, sf_dir):
    listings = standin_listings(spark, sf_dir)
    value = messages.message_value(listings)
    return listings.select("id", value.cast("string").alias("message"))


@query
def src_json_decode(spark, sf_dir):
    """Messages in which missing values were sent as bare NaN."""
    listings = _stamped(standin_listings(spark, sf_dir))
    text = F.col("value").cast("string")
    gap = F.when(F.instr(text, '"lat":') == 0, ',"lat":NaN').otherwise("")
    sent = F.concat(
        F.substring(text, F.lit(1), F.length(text) - 1), gap, F.lit(',"condition":NaN}')
    )
    decoded = messages.decode_messages(listings.withColumn("value", sent.cast("binary")))
    return decoded.select(
        *LISTING, "VIN", "condition", F.col("event_time").cast("timestamp_ntz").alias("event_time")
    )


@query
def src_first_n(spark, sf_dir):
    return files.first_rows(standin_listings(spark, sf_dir).select(*LISTING))


@query
def src_first_n_small(spark, sf_dir):
    """So few rows that the id range is narrowed at every scale."""
    return files.first_rows(standin_listings(spark, sf_dir).select(*LISTING), 100)


# Preparation.


@query
def prj_standardize(spark, sf_dir):
    standard = prepare.standardize(standin_listings(spark, sf_dir))
    return standard.select("id", "manufacturer", "model", "vin", "title_status")


@query
def prj_cast(spark, sf_dir):
    cast = prepare.cast_measures(standin_listings(spark, sf_dir))
    return cast.select("id", "year", "odometer")


@query
def flt_required(spark, sf_dir):
    return prepare.require_complete(standin_listings(spark, sf_dir)).select(*LISTING)


@query
def flt_price_range(spark, sf_dir):
    return prepare.keep_price_range(standin_listings(spark, sf_dir)).select(*LISTING)


@query
def imp_constants(spark, sf_dir):
    filled = prepare.fill_defaults(standin_listings(spark, sf_dir))
    return filled.select("id", "odometer", "title_status")


@query
def imp_year(spark, sf_dir):
    return prepare.fill_year(standin_listings(spark, sf_dir)).select("id", "year")


@query
def imp_nan_null(spark, sf_dir):
    """NaN for every missing number, on the top level and inside a struct."""
    nan = F.lit(float("nan"))
    place = F.struct(F.coalesce("lat", nan).alias("lat"), F.col("long"))
    records = standin_listings(spark, sf_dir).select(
        "id", F.coalesce("odometer", nan).alias("odometer"), place.alias("place")
    )
    return prepare.nan_to_null(records).select("id", "odometer", "place.lat", "place.long")


# Statistics and scores.


@query
def win_price_stats(spark, sf_dir):
    return _placed_batch(spark, sf_dir).select(
        "id", *S.SEGMENT_KEYS, "market_avg_price", "market_std_dev_price", "group_count"
    )


@query
def win_price_stats_sliced(spark, sf_dir):
    """The shuffled join, with segments cut into slices, as for statistics that are
    too large to broadcast."""
    cleaned = stored(_cleaned_batch(spark, sf_dir).select(*scoring.BATCH_COLUMNS))
    placed = segments.with_segment_statistics(cleaned, broadcast_limit=-1, slice_rows=100)
    return placed.select(
        "id", *S.SEGMENT_KEYS, "market_avg_price", "market_std_dev_price", "group_count"
    )


@query
def win_odometer_stats(spark, sf_dir):
    return _placed_live(spark, sf_dir).select(
        "id", *S.SEGMENT_KEYS, "market_avg_odometer", "market_std_dev_odometer", "group_count"
    )


@query
def scr_price_z(spark, sf_dir):
    return _placed_batch(spark, sf_dir).select("id", "price", "price_z_score")


@query
def scr_price_z_stream(spark, sf_dir):
    return _placed_live(spark, sf_dir).select("id", "price", "price_z_score")


@query
def scr_odometer_z(spark, sf_dir):
    return _placed_live(spark, sf_dir).select("id", "odometer", "odometer_z_score")


# Forensics.


@query
def vin_decode(spark, sf_dir):
    decoded = forensics.with_vin_year(prepare.standardize(standin_listings(spark, sf_dir)))
    return decoded.select("id", "vin", "vin_year_code", "decoded_vin_year")


@query
def frd_flags(spark, sf_dir):
    flagged = scoring.with_trust(_cleaned_batch(spark, sf_dir))
    return flagged.select("id", "year", "is_year_mismatch", "is_suspicious_mileage")


@query
def frd_trust(spark, sf_dir):
    return scoring.with_trust(_cleaned_batch(spark, sf_dir)).select("id", "trust_score")


@query
def flt_low_trust(spark, sf_dir):
    suspects = forensics.low_trust(scoring.with_trust(_cleaned_batch(spark, sf_dir)))
    return suspects.select("id", "vin", "year", "decoded_vin_year", "odometer", "trust_score")


# Arbitrage.


@query
def geo_arbitrage(spark, sf_dir):
    return arbitrage.with_arbitrage(_placed_batch(spark, sf_dir)).select(
        "id", "region", "price", "national_avg_price", "arbitrage_opportunity", "is_sourcing_hub"
    )


@query
def flt_sourcing_hub(spark, sf_dir):
    hubs = arbitrage.sourcing_hubs(arbitrage.with_arbitrage(_placed_batch(spark, sf_dir)))
    return hubs.select(
        "id",
        "region",
        *S.SUMMARY_KEYS,
        "price",
        "national_avg_price",
        "arbitrage_opportunity",
    )


# Rating.


@query
def rate_basic(spark, sf_dir):
    return rating.rate_basic(_placed_batch(spark, sf_dir)).select(
        "id", *S.SUMMARY_KEYS, "price", "market_avg_price", "deal_rating"
    )


@query
def rate_batch(spark, sf_dir):
    return _scored_batch(spark, sf_dir).select(
        "id", *S.SUMMARY_KEYS, "price", "trust_score", "arbitrage_opportunity", "deal_rating"
    )


@query
def rate_stream(spark, sf_dir):
    return _scored_live(spark, sf_dir).select(
        "id",
        *S.SEGMENT_KEYS,
        "price",
        "group_count",
        "trust_score",
        "price_z_score",
        "odometer_z_score",
        "deal_rating",
    )


@query
def agg_rating_counts(spark, sf_dir):
    return reports.rating_counts(_scored_live(spark, sf_dir))


# Summaries and alerts.


@query
def agg_clean_counts(spark, sf_dir):
    return reports.cleaning_counts(standin_listings(spark, sf_dir))


@query
def agg_segment_summary(spark, sf_dir):
    return reports.segment_summary(prepare.standardize(standin_listings(spark, sf_dir)))


@query
def top_segments(spark, sf_dir):
    return reports.top_segments(agg_segment_summary(spark, sf_dir))


@query
def alr_great_deals(spark, sf_dir):
    deals = stored(reports.great_deals(_scored_live(spark, sf_dir)))
    return reports.in_alert_order(deals, "great_deals")


@query
def alr_risky(spark, sf_dir):
    return reports.risky_buys(_scored_live(spark, sf_dir))


@query
def alr_volatile(spark, sf_dir):
    volatile = reports.volatile_segments(_scored_live(spark, sf_dir))
    return reports.in_alert_order(volatile, "volatile_segments")


@query
def alr_overprice(spark, sf_dir):
    overprices = stored(reports.extreme_overprices(_scored_live(spark, sf_dir)))
    return reports.in_alert_order(overprices, "extreme_overprices")


# Stage previews: the first rows of a stage are the feature.


@query
def preview_clean(spark, sf_dir):
    shown = [*S.REQUIRED_COLUMNS, "odometer", "title_status"]
    return reports.preview(_cleaned_batch(spark, sf_dir), ["id", *shown], 5)


@query
def preview_basic_rating(spark, sf_dir):
    shown = ["id", *S.SUMMARY_KEYS, "price", "market_avg_price", "deal_rating"]
    return reports.preview(rating.rate_basic(_placed_batch(spark, sf_dir)), shown, 10)


@query
def preview_low_trust(spark, sf_dir):
    suspects = forensics.low_trust(scoring.with_trust(_cleaned_batch(spark, sf_dir)))
    shown = ["id", "vin", "year", "decoded_vin_year", "odometer", "trust_score"]
    return reports.preview(suspects, shown, 5)


@query
def preview_sourcing_hubs(spark, sf_dir):
    hubs = arbitrage.sourcing_hubs(arbitrage.with_arbitrage(_placed_batch(spark, sf_dir)))
    shown = ["id", "region", *S.SUMMARY_KEYS, "price"]
    return reports.preview(hubs, [*shown, "national_avg_price", "arbitrage_opportunity"], 5)


@query
def preview_final(spark, sf_dir):
    shown = ["id", *S.SUMMARY_KEYS, "price", "trust_score", "arbitrage_opportunity", "deal_rating"]
    return reports.preview(_scored_batch(spark, sf_dir), shown, 5)


# Publishing.


@query
def batch_publish(spark, sf_dir):
    loaded = F.lit(ARRIVAL).cast("timestamp")
    table = scoring.published(_scored_batch(spark, sf_dir), loaded)
    return table.withColumn("processed_at", F.col("processed_at").cast("timestamp_ntz"))


@query
def snk_overwrite(spark, sf_dir):
    """The published table as readers find it after it was replaced."""
    path = new_folder(spark, "published")
    table = scoring.published(_scored_batch(spark, sf_dir))
    overwrite_table(table, path)
    overwrite_table(table, path)
    return spark.read.schema(table.schema).parquet(path).drop("processed_at")


@query
def snk_publish_version(spark, sf_dir):
    """The published table through its pointer, after a version before it and a write
    that failed half way."""
    path = new_folder(spark, "published")
    table = stored(scoring.published(_scored_batch(spark, sf_dir)).drop("processed_at"))
    publish(table.filter(F.col("id") % 10 == 0), path)
    publish(table, path)
    broken = F.when(F.col("id") % 7 == 0, F.raise_error(F.lit("lost"))).otherwise(F.col("model"))
    try:
        publish(table.withColumn("model", broken.cast("string")), path)
    except PySparkException:
        pass
    remove_old_versions(spark, path)
    return read_published(spark, path)


# Streams: run to the end of their input, then read what they wrote.


def _run_scoring(spark: SparkSession, sf_dir: str) -> str:
    folder = _message_folder(spark, standin_listings(spark, sf_dir))
    output = new_folder(spark, "scored")
    stream = messages.read_message_files(spark, folder)
    jobs.start_scoring(stream, output, trigger=AVAILABLE_NOW).awaitTermination()
    return output


def _load(spark: SparkSession, folder: str, output: str, **reading) -> None:
    stream = messages.read_message_files(spark, folder, **reading)
    arrival = F.lit(ARRIVAL).cast("timestamp")
    query = jobs.start_loading(stream, output, trigger=AVAILABLE_NOW, clock=lambda: arrival)
    query.awaitTermination()


@query
def str_score_alerts(spark, sf_dir):
    output = _run_scoring(spark, sf_dir)
    volatile = read_table(spark, output, "volatile_segments").withColumn("alert", F.lit("volatile_segments"))
    listed = read_table(spark, output, reports.ROW_ALERTS)
    return listed.unionByName(volatile, allowMissingColumns=True).drop("batch_id")


@query
def str_segment_summary(spark, sf_dir):
    summary = read_table(spark, _run_scoring(spark, sf_dir), "segment_summary")
    return summary.withColumn(
        "last_data_received", F.col("last_data_received").cast("timestamp_ntz")
    )


@query
def str_batch_metrics(spark, sf_dir):
    return read_table(spark, _run_scoring(spark, sf_dir), "batch_metrics")


@query
def snk_stream_append(spark, sf_dir):
    """Loaded file by file, one micro-batch each."""
    folder = _message_folder(spark, standin_listings(spark, sf_dir))
    output = new_folder(spark, "loaded")
    _load(spark, folder, output, max_files_per_trigger=1)
    return read_table(spark, output, "listings").select(*LISTING, "VIN")


@query
def snk_batches_by_bytes(spark, sf_dir):
    """A burst of unequal files, loaded in micro-batches of a bounded size."""
    sent = stored(_stamped(standin_listings(spark, sf_dir)))
    folder, output = new_folder(spark, "messages"), new_folder(spark, "loaded")
    crumbs = F.pmod(F.xxhash64("value"), F.lit(50)) == 0
    messages.write_message_files(sent.filter(crumbs).repartition(6), folder)
    messages.write_message_files(sent.filter(~crumbs).repartition(3), folder)
    _load(spark, folder, output, max_bytes_per_trigger=64 << 20)
    return read_table(spark, output, "listings").select(*LISTING, "VIN")


@query
def snk_append_once(spark, sf_dir):
    """Ten batches; every third is lost after its write, before its commit, and all of
    them run again. Then the small folders are compacted, and one batch comes once more."""
    table = f"{new_folder(spark, 'appended')}/listings"
    listings = stored(standin_listings(spark, sf_dir).select(*LISTING, "VIN"))
    batches = [listings.filter(F.pmod(F.col("id"), F.lit(10)) == i) for i in range(10)]
    for i, batch in enumerate(batches):
        if i % 3 == 0:
            batch.write.parquet(f"{table}/{Commits(spark, table).new_folder()}")
        append_once(batch, table, "run", i)
        append_once(batch, table, "run", i)
    compact(spark, table)
    append_once(batches[4], table, "run", 4)
    remove_unread(spark, table)
    return read_appended(spark, table)


@query
def str_dead_letters(spark, sf_dir):
    """Every seventh message is cut short, every eleventh is ill-typed, every thirteenth
    is empty: good and bad ones are loaded apart, together as many as sent."""
    text = F.col("value").cast("string")
    number = F.get_json_object(text, "$.id").cast("long")
    sent = _stamped(standin_listings(spark, sf_dir)).withColumn("offset", number)
    spoilt = (
        F.when(F.col("offset") % 7 == 0, F.substring(text, F.lit(1), F.length(text) - 1))
        .when(F.col("offset") % 11 == 0, F.regexp_replace(text, '"id":(\\d+)', '"id":"x$1"'))
        .when(F.col("offset") % 13 == 0, F.lit(""))
        .otherwise(text)
    )
    folder, output = new_folder(spark, "messages"), new_folder(spark, "loaded")
    messages.write_message_files(sent.withColumn("value", spoilt.cast("binary")), folder)
    stream = messages.read_message_files(spark, folder)
    jobs.start_loading_examined(stream, output, trigger=AVAILABLE_NOW).awaitTermination()
    good = read_appended(spark, f"{output}/listings").select(
        "offset", F.lit(None).cast("string").alias("reason"), "id", "price", "model"
    )
    dead = read_appended(spark, f"{output}/dead_letters").select("offset", "reason")
    return good.unionByName(dead, allowMissingColumns=True)


@query
def str_latency(spark, sf_dir):
    folder = _message_folder(spark, standin_listings(spark, sf_dir))
    output = new_folder(spark, "loaded")
    _load(spark, folder, output)
    latency = read_table(spark, output, "load_latency")
    return latency.withColumn("newest_message", F.col("newest_message").cast("timestamp_ntz"))


@query
def str_restart(spark, sf_dir):
    """Load the earlier listings, stop, and start again once the later ones are there."""
    listings = standin_listings(spark, sf_dir)
    early = F.col("event_time") < F.lit(RESTARTED).cast("timestamp_ntz")
    folder, output = new_folder(spark, "messages"), new_folder(spark, "loaded")
    for arriving in (listings.filter(early), listings.filter(~early)):
        messages.write_message_files(_stamped(arriving), folder)
        _load(spark, folder, output)
    return read_table(spark, output, "listings").select(*LISTING, "VIN", "batch_id")


def _load_parts(spark: SparkSession, sf_dir: str, output: str, checkpoint: str | None) -> None:
    """Load the earlier listings, then the later ones from another folder of messages."""
    listings = standin_listings(spark, sf_dir)
    early = F.col("event_time") < F.lit(RESTARTED).cast("timestamp_ntz")
    arrival = F.lit(ARRIVAL).cast("timestamp")
    for number, arriving in enumerate((listings.filter(early), listings.filter(~early))):
        stream = messages.read_message_files(spark, _message_folder(spark, arriving))
        place = checkpoint and f"{checkpoint}/{number}"
        jobs.start_loading(
            stream, output, trigger=AVAILABLE_NOW, clock=lambda: arrival, checkpoint=place
        ).awaitTermination()


@query
def snk_new_checkpoint(spark, sf_dir):
    """Two loads into one output, each with a checkpoint of its own: no row is lost."""
    output = new_folder(spark, "loaded")
    _load_parts(spark, sf_dir, output, new_folder(spark, "checkpoints"))
    return read_table(spark, output, "listings").select(*LISTING, "VIN", "batch_id")


@query
def str_empty_batch(spark, sf_dir):
    """Of three files the middle one holds no message; its batch writes nothing."""
    listings = standin_listings(spark, sf_dir)
    early = F.col("event_time") < F.lit(RESTARTED).cast("timestamp_ntz")
    folder, output = new_folder(spark, "messages"), new_folder(spark, "loaded")
    for arriving in (listings.filter(early), listings.filter("false"), listings.filter(~early)):
        # A shuffle: coalesce(1) would also join all tables in the one task that writes.
        messages.write_message_files(_stamped(arriving).repartition(1), folder)
    _load(spark, folder, output, max_files_per_trigger=1)
    return read_table(spark, output, "listings").select(*LISTING, "VIN")


@query
def str_idle_stop(spark, sf_dir):
    """A stream on a clock, stopped once it has had nothing to read for a while."""
    folder = _message_folder(spark, standin_listings(spark, sf_dir))
    output = new_folder(spark, "loaded")
    stream = messages.read_message_files(spark, folder)
    arrival = F.lit(ARRIVAL).cast("timestamp")
    running = jobs.start_loading(
        stream, output, trigger={"processingTime": "1 second"}, clock=lambda: arrival
    )
    jobs.await_idle(running, idle_seconds=3)
    return read_table(spark, output, "listings").select(*LISTING, "VIN")
