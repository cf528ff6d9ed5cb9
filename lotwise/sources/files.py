"""Listings in CSV files, on any file system Spark can reach."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotwise import schema as S
from lotwise.functions.parsing import integer_from_double
from lotwise.operators.tables import stored
from lotwise.sources.records import parsed_records, quoted_records

# Quotes inside quoted fields are doubled.
QUOTING = {"quote": '"', "escape": '"'}


def loose_schema() -> T.StructType:
    """The listing record with price as double, since feeds write 6000 and 6000.0."""
    return T.StructType(
        [
            T.StructField(f.name, T.DoubleType() if f.name == "price" else f.dataType)
            for f in S.LISTING_SCHEMA.fields
        ]
    )


# A listing without one of these columns is of no use.
NEEDED_COLUMNS = ["id", *S.REQUIRED_COLUMNS]


def read_listings_csv(
    spark: SparkSession,
    path: str | list[str],
    *,
    line_breaks_in_fields: bool = True,
) -> DataFrame:
    """Listings from CSV, columns taken by the names in the header row.

    Columns may come in any order; further ones are ignored, absent ones are null,
    but the needed ones must be there. All files must have the same header.

    Descriptions hold line breaks inside quotes. Files are cut into records in
    parallel all the same, which reads them once more to count quotes. Feeds known to
    hold no breaks can pass ``line_breaks_in_fields=False`` to spare that.
    """
    options = {"header": True, "multiLine": line_breaks_in_fields, **QUOTING}
    named = spark.read.csv(path, **options)
    present = {name.lower() for name in named.columns}
    absent = [name for name in NEEDED_COLUMNS if name.lower() not in present]
    if absent:
        raise ValueError(f"the CSV header has no column {', '.join(absent)}")
    if not line_breaks_in_fields:
        text = spark.read.schema(named.schema).csv(path, enforceSchema=False, **options)
        return typed_listings(text)
    first = spark.read.csv(path, multiLine=True, **QUOTING).first()
    records = quoted_records(spark, path, [name or "" for name in first])
    return typed_listings(parsed_records(records, named.columns, QUOTING))


def read_listings_table(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    """Listings from a columnar table, brought to the same types as from CSV."""
    return typed_listings(spark.read.format(format).load(path))


def typed_listings(listings: DataFrame) -> DataFrame:
    """The listing record by column name; values that do not fit a type are null."""
    present = {name.lower() for name in listings.columns}
    columns = [
        (F.col(f.name).try_cast(f.dataType) if f.name.lower() in present else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in loose_schema().fields
    ]
    return listings.select(*columns).withColumn("price", integer_from_double(F.col("price")))


def write_listings_csv(listings: DataFrame, path: str) -> None:
    record = listings.select(*record_columns(listings))
    record.write.mode("overwrite").csv(
        path, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, **QUOTING
    )


def record_columns(listings: DataFrame) -> list:
    """All columns of the listing record, null where the frame lacks one."""
    present = {name.lower() for name in listings.columns}
    return [
        (F.col(f.name) if f.name.lower() in present else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in S.LISTING_SCHEMA.fields
    ]


# Into how many parts a bounded read splits the id range per look, and how many rows
# beyond the wanted ones it leaves to the final sort.
RANGE_PARTS = 1000
SPARE_FACTOR = 2


def first_rows(
    listings: DataFrame,
    n: int = S.BOUNDED_READ_ROWS,
    *,
    spare_factor: int = SPARE_FACTOR,
) -> DataFrame:
    """A bounded read: the first ``n`` listings by id.

    Each task of a plain sort-and-limit hands ``n`` rows to one last task, too
    many where there are many tasks. The table is therefore first cut at an id
    that at least ``n`` rows do not exceed, a filter that scans can use. The ids
    are stored once, so the source is read twice in all.
    """
    cut = _cut_off(stored(listings.select("id")), n, n * max(1, spare_factor))
    kept = listings if cut is None else listings.filter(F.col("id") <= cut)
    return kept.orderBy(F.asc_nulls_last("id")).limit(n)


def _cut_off(ids: DataFrame, n: int, enough: int) -> int | None:
    """Narrow the range that holds the n-th id, by counting rows per part of it."""
    column = F.col("id")
    low, high, inside = ids.agg(F.min(column), F.max(column), F.count(column)).first()
    if inside < n:
        return None
    below = 0
    while below + inside > enough and low < high:
        width = (high - low) // RANGE_PARTS + 1
        # Ids lie anywhere in 64 bits, so their distance may need more.
        part = F.expr(f"(cast(id as decimal(20,0)) - ({low}BD)) div {width}BD").cast("int")
        counted = ids.filter(column.between(low, high)).groupBy(part.alias("part")).count()
        for row in counted.orderBy("part").collect():
            inside = row["count"]
            if below + inside >= n:
                low += row["part"] * width
                high = min(high, low + width - 1)
                break
            below += inside
    return high
