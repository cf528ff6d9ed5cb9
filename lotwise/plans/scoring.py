"""The two scoring plans, and the published table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise import schema as S
from lotwise.operators import arbitrage, forensics, prepare, rating, segments
from lotwise.operators.tables import stored

# Columns the plans use; everything else is left behind at the scan.
BATCH_COLUMNS = S.PUBLISHED_COLUMNS[: S.PUBLISHED_COLUMNS.index("vin") + 1]
LIVE_COLUMNS = ["id", "manufacturer", "model", "year", "price", "odometer", "vin"]


def clean_batch(listings: DataFrame) -> DataFrame:
    """Complete listings in the price range; an unreadable year stays as null."""
    complete = prepare.require_complete(prepare.standardize(listings))
    priced = prepare.keep_price_range(complete)
    return prepare.cast_measures(prepare.fill_defaults(priced))


def clean_live(listings: DataFrame) -> DataFrame:
    """Listings in the price range; years that tell nothing get a filler."""
    filled = prepare.fill_defaults(prepare.fill_year(prepare.standardize(listings)))
    return prepare.keep_price_range(filled)


def score_batch(
    cleaned: DataFrame,
    *,
    current_year: int = S.CURRENT_YEAR,
    scan_twice: bool = False,
    work_path: str | None = None,
    **join_options,
) -> DataFrame:
    """Segment statistics, fraud, trust, arbitrage and rating of cleaned listings.

    Listings are passed over twice: for the statistics and for the scores. They
    are therefore stored first, unless ``scan_twice`` says that reading their
    source again is the cheaper way, as it is for columnar tables. Intermediate
    tables go below ``work_path``, where the next run replaces them, or into new
    folders.
    """
    source = cleaned.select(*BATCH_COLUMNS)
    if not scan_twice:
        source = stored(source, _below(work_path, "listings"))
    placed = segments.with_segment_statistics(
        source, table_path=_below(work_path, "statistics"), **join_options
    )
    scored = segments.with_price_score(placed, lone_row_scores=False)
    trusted = with_trust(scored, current_year)
    return rating.rate_trusted(arbitrage.with_arbitrage(trusted))


def _below(work_path: str | None, table: str) -> str | None:
    return f"{work_path}/{table}" if work_path else None


def score_live(
    cleaned: DataFrame, *, current_year: int = S.CURRENT_YEAR, **join_options
) -> DataFrame:
    """As the batch plan, with mileage and volatility. ``cleaned`` is read twice,
    so callers persist or store it."""
    needed = cleaned.select(*LIVE_COLUMNS)
    placed = segments.with_segment_statistics(needed, odometer=True, **join_options)
    scored = segments.with_odometer_score(segments.with_price_score(placed, lone_row_scores=True))
    trusted = with_trust(scored, current_year)
    return rating.rate_live(arbitrage.with_arbitrage(trusted))


def with_trust(listings: DataFrame, current_year: int = S.CURRENT_YEAR) -> DataFrame:
    flagged = forensics.with_fraud_flags(forensics.with_vin_year(listings), current_year)
    return forensics.with_trust_score(flagged)


def published(scored: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """The table for consumers, with its load time (now, if none is given)."""
    loaded = F.current_timestamp() if processed_at is None else processed_at
    return scored.select(*S.PUBLISHED_COLUMNS, loaded.alias("processed_at"))
