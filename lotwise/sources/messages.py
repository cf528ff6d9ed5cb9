"""Listings as JSON messages, one object per message."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotwise import schema as S
from lotwise.functions.parsing import integer_from_double, known_number, known_text
from lotwise.sources.files import loose_schema

# The topic listings travel on, unless another is named.
TOPIC = "listings"


def message_value(listings: DataFrame) -> Column:
    """The JSON object of a listing, as bytes.

    Missing values are left out of the object. Columns outside the listing
    record are not sent.
    """
    spelling = {f.name.lower(): f.name for f in S.LISTING_SCHEMA.fields}
    sent = [
        F.col(name).alias(spelling[name.lower()])
        for name in listings.columns
        if name.lower() in spelling
    ]
    return F.to_json(F.struct(*sent)).cast("binary")


def encode_messages(listings: DataFrame) -> DataFrame:
    """One message per listing, without a key so that no partition runs hot."""
    return listings.select(
        F.lit(None).cast("binary").alias("key"), message_value(listings).alias("value")
    )


def stamp_messages(listings: DataFrame, timestamp: Column) -> DataFrame:
    """Messages in the shape a message bus delivers, sent at ``timestamp``."""
    return listings.select(
        F.lit(None).cast("binary").alias("key"),
        message_value(listings).alias("value"),
        F.lit(TOPIC).alias("topic"),
        F.lit(0).alias("partition"),
        F.lit(0).cast("long").alias("offset"),
        timestamp.cast("timestamp").alias("timestamp"),
    )


def decode_messages(messages: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Listings with the message timestamp as ``event_time``.

    Unreadable messages give a listing of nulls. The feed writes missing values
    as bare NaN, whatever the column's type; they become null. Name the needed
    ``columns`` where there is a micro-batch ahead: the optimizer cannot look
    past it, and the parser skips what is not asked for.
    """
    fields = [f for f in loose_schema().fields if columns is None or f.name in columns]
    parsed = messages.select(
        F.from_json(F.col("value").cast("string"), T.StructType(fields)).alias("data"),
        F.col("timestamp").alias("event_time"),
    ).select("data.*", "event_time")
    return parsed.select(*[_received(f) for f in fields], "event_time")


# Where a message's text goes if it cannot be read.
UNREAD = "_unread"


def examine_messages(messages: DataFrame) -> DataFrame:
    """Every message, decoded, with its place and its value as it came, and ``reason``:
    why it cannot be loaded, or null.

    A message without content, one that is no JSON object, and one whose JSON is broken
    or holds values of other types are kept from the listings."""
    fields = loose_schema().fields
    schema = T.StructType([*fields, T.StructField(UNREAD, T.StringType())])
    text = F.col("value").cast("string")
    parsed = messages.select(
        "value",
        "topic",
        "partition",
        "offset",
        F.col("timestamp").alias("event_time"),
        F.trim(F.coalesce(text, F.lit("")), F.lit(" \t\r\n")).alias("text"),
        F.from_json(text, schema, {"columnNameOfCorruptRecord": UNREAD}).alias("data"),
    )
    reason = (
        F.when(F.col("text") == "", "empty")
        .when(~F.col("text").startswith("{"), "no JSON object")
        .when(F.col("data").isNull() | F.col(f"data.{UNREAD}").isNotNull(), "broken or ill-typed JSON")
    )
    place = ["value", "topic", "partition", "offset", "event_time"]
    decoded = parsed.withColumn("reason", reason).select(*place, "reason", "data.*").drop(UNREAD)
    return decoded.select(*place, "reason", *[_received(f) for f in fields])


def _received(field: T.StructField):
    value = F.col(field.name)
    if field.name == "price":
        value = integer_from_double(value)
    elif isinstance(field.dataType, T.DoubleType):
        value = known_number(value)
    elif isinstance(field.dataType, T.StringType):
        value = known_text(value)
    return value.alias(field.name)


def read_bus(
    spark: SparkSession,
    servers: str,
    topic: str = TOPIC,
    *,
    starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
    format: str = "kafka",
    **options: str,
) -> DataFrame:
    """A stream of messages. ``max_offsets_per_trigger`` bounds a micro-batch;
    ``min_partitions`` cuts topic partitions that hold more than their share."""
    reader = (
        spark.readStream.format(format)
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .options(**options)
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    if min_partitions:
        reader = reader.option("minPartitions", min_partitions)
    return reader.load()


def write_bus(messages: DataFrame, servers: str, topic: str = TOPIC, format: str = "kafka") -> None:
    bus = messages.select("key", "value").write.format(format).mode("append")
    bus.option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def read_message_files(
    spark: SparkSession,
    path: str,
    *,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: int | None = None,
) -> DataFrame:
    """A stream of stamped messages kept in parquet files.

    ``max_files_per_trigger`` or ``max_bytes_per_trigger`` bounds a micro-batch, by the
    number of files or by their size together; a larger file is a batch of its own."""
    if max_files_per_trigger and max_bytes_per_trigger:
        raise ValueError("a micro-batch is bounded by files or by bytes, not by both")
    reader = spark.readStream.schema(S.MESSAGE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return reader.parquet(path)


# A row group is what one task reads at the least. In one of Spark's usual size lie
# some million messages, which one task would decode while the others wait: a file is
# cut into more.
ROW_GROUP_BYTES = 2 << 20


def write_message_files(messages: DataFrame, path: str, mode: str = "append") -> None:
    messages.write.mode(mode).option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
