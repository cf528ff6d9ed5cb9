"""Summaries, alert lists and counts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise import schema as S
from lotwise.functions.scoring import spread_ratio

# Fixed value: the label of the one fraud flag that makes a buy risky.
YEAR_MISMATCH_LABEL = "Year Mismatch"


def segment_summary(listings: DataFrame) -> DataFrame:
    """Price summary per manufacturer and model, of listings before any cleaning."""
    return listings.groupBy(*S.SUMMARY_KEYS).agg(
        F.round(F.avg("price"), 2).alias("avg_price"),
        F.round(F.stddev_samp("price"), 2).alias("price_std_dev"),
        F.count(F.lit(1)).alias("listings_count"),
        F.max("event_time").alias("last_data_received"),
    )


def in_summary_order(summary: DataFrame) -> DataFrame:
    """Segments with most listings first; ties go by name."""
    return summary.orderBy(F.desc("listings_count"), *S.SUMMARY_KEYS)


def top_segments(summary: DataFrame, n: int = S.SUMMARY_TOP) -> DataFrame:
    return in_summary_order(summary).limit(n)


# What a list of single listings is: which listings belong to it, and its columns.
RowList = tuple[Column, dict[str, Column]]


def _listing() -> dict[str, Column]:
    return {name: F.col(name) for name in ("id", *S.SUMMARY_KEYS, "price")}


def _great_deals() -> RowList:
    """Both ratings need a deep discount here, so that cheap test comes first."""
    rating = F.col("deal_rating")
    rated = (rating == "GREAT_DEAL") | (rating == "GOOD_PRICE")
    return (F.col("price_z_score") < S.DEEP_DISCOUNT_Z) & rated, _listing() | {
        "Price_Z_Score": F.round("price_z_score", 2),
        "Odometer_Z_Score": F.round("odometer_z_score", 2),
        "Arbitrage_Value": F.round("arbitrage_opportunity", 2),
        "deal_rating": rating,
    }


def _risky_buys() -> RowList:
    return F.col("deal_rating") == "RISKY_BUY", _listing() | {
        "trust_score": F.col("trust_score"),
        "Fraud_Flag": F.when(F.col("is_year_mismatch"), YEAR_MISMATCH_LABEL).otherwise(""),
    }


def _extreme_overprices() -> RowList:
    return F.col("deal_rating") == "EXTREME_OVERPRICE", _listing() | {
        "Price_Z_Score": F.round("price_z_score", 2),
        "Avg_Price": F.col("market_avg_price"),
    }


# Lists of single listings. A listing has one rating, so it is in one of them at most.
ROW_LISTS = {
    "great_deals": _great_deals,
    "risky_buys": _risky_buys,
    "extreme_overprices": _extreme_overprices,
}
# The table that holds all of them, told apart by the column ``alert``.
ROW_ALERTS = "row_alerts"


def _listed(scored: DataFrame, name: str) -> DataFrame:
    belongs, columns = ROW_LISTS[name]()
    return scored.filter(belongs).select(*[c.alias(n) for n, c in columns.items()])


def great_deals(scored: DataFrame) -> DataFrame:
    """Great deals, and deep discounts that high mileage held back."""
    return _listed(scored, "great_deals")


def risky_buys(scored: DataFrame) -> DataFrame:
    return _listed(scored, "risky_buys")


def row_alerts(scored: DataFrame) -> DataFrame:
    """All lists of single listings in one pass: the list's name in ``alert``, and the
    columns of every list, null where a list lacks one."""
    lists = {name: parts() for name, parts in ROW_LISTS.items()}
    alert = F.coalesce(*[F.when(belongs, F.lit(name)) for name, (belongs, _) in lists.items()])

    def value(column: str) -> Column:
        having = [(n, columns[column]) for n, (_, columns) in lists.items() if column in columns]
        return F.coalesce(*[F.when(F.col("alert") == n, of) for n, of in having]).alias(column)

    names = dict.fromkeys(name for _, columns in lists.values() for name in columns)
    labelled = scored.withColumn("alert", alert).filter(F.col("alert").isNotNull())
    return labelled.select("alert", *[value(name) for name in names])


def row_list(alerts: DataFrame, name: str, *more: str) -> DataFrame:
    """One list, and further columns, from the table of all."""
    return alerts.filter(F.col("alert") == name).select(*ROW_LISTS[name]()[1], *more)


def volatile_segments(scored: DataFrame) -> DataFrame:
    """Segments in which a listing was rated volatile."""
    percent = spread_ratio(F.col("Std_Dev_Price"), F.col("Avg_Price")) * 100
    return (
        scored.filter(F.col("deal_rating") == "VOLATILE_MARKET")
        .select(
            *S.SEGMENT_KEYS,
            F.col("market_avg_price").alias("Avg_Price"),
            F.col("market_std_dev_price").alias("Std_Dev_Price"),
        )
        .distinct()
        .withColumn("StdDev_as_Pct_of_Avg", F.round(percent, 1))
    )


def extreme_overprices(scored: DataFrame) -> DataFrame:
    return _listed(scored, "extreme_overprices")


ALERTS = {
    "great_deals": great_deals,
    "risky_buys": risky_buys,
    "volatile_segments": volatile_segments,
    "extreme_overprices": extreme_overprices,
}


def in_alert_order(alerts: DataFrame, name: str) -> DataFrame:
    """Best deals, widest spreads and highest prices first; risky buys unsorted (by id
    in the table of all lists, where the lists follow one another).

    Scores are rounded and repeat, so ties go by a unique column: the sort stays
    the same on every run and can cut a crowd of equal scores into ranges. A sort
    without a shuffle before it evaluates its input twice, so sort alerts that
    are stored or cached. Unsorted alerts are rebalanced, as the few alerts of
    each scoring task would make as many small files.
    """
    score = F.col("Price_Z_Score")
    highest_first = F.when(F.col("alert") == "extreme_overprices", -score).otherwise(score)
    orders = {
        ROW_ALERTS: [F.asc("alert"), highest_first, F.asc("id")],
        "great_deals": [F.asc("Price_Z_Score"), F.asc("id")],
        "volatile_segments": [F.desc("Std_Dev_Price"), *S.SEGMENT_KEYS],
        "extreme_overprices": [F.desc("Price_Z_Score"), F.asc("id")],
    }
    return alerts.orderBy(*orders[name]) if name in orders else alerts.hint("rebalance")


def rating_counts(scored: DataFrame) -> DataFrame:
    return scored.groupBy("deal_rating").agg(F.count(F.lit(1)).alias("listings"))


def cleaning_counts(listings: DataFrame) -> DataFrame:
    """Rows before and after each cleaning step, in one pass."""
    complete = F.lit(True)
    for name in S.REQUIRED_COLUMNS:
        complete = complete & F.col(name).isNotNull()
    in_range = (F.col("price") > S.MIN_PRICE) & (F.col("price") < S.MAX_PRICE)
    return listings.agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(complete).alias("complete_rows"),
        F.count_if(in_range).alias("priced_rows"),
        F.count_if(complete & in_range).alias("clean_rows"),
    )


def batch_metrics(summary: DataFrame, scored: DataFrame) -> DataFrame:
    """Name and value of each count of one batch.

    Received rows and segments come from the summary, which already counts every
    row; the alert counts come from one pass over the scored rows. A stream that
    writes these tables anyway observes the same counts while it does.
    """
    alerts = row_alerts(scored).agg(*alert_counts())
    wide = volatile_segments(scored).agg(*volatile_counts())
    received = summary.agg(*received_counts())
    return _as_rows(received).union(_as_rows(alerts)).union(_as_rows(wide)).coalesce(1)


def received_counts() -> list[Column]:
    """Counts over a segment summary."""
    rows = F.coalesce(F.sum("listings_count"), F.lit(0))
    return [rows.alias("received_rows"), F.count(F.lit(1)).alias("segments")]


def alert_counts() -> list[Column]:
    """Counts over the table of all lists of listings."""
    return [F.count_if(F.col("alert") == name).alias(name) for name in ROW_LISTS]


def volatile_counts() -> list[Column]:
    return [F.count(F.lit(1)).alias("volatile_segments")]


def _as_rows(counts: DataFrame) -> DataFrame:
    return counts.unpivot([], counts.columns, "metric", "value")


def load_latency(loaded: DataFrame, arrival: datetime | Column) -> DataFrame:
    """Rows, newest message, and its age in seconds when the rows were loaded."""
    newest = loaded.agg(
        F.count(F.lit(1)).alias("loaded_rows"), F.max("event_time").alias("newest_message")
    )
    return with_latency(newest, arrival)


def with_latency(newest: DataFrame, arrival: datetime | Column) -> DataFrame:
    age = F.unix_millis(F.lit(arrival)) - F.unix_millis("newest_message")
    return newest.withColumn("latency_seconds", age / 1000)


def preview(frame: DataFrame, columns: list[str], n: int, by: str = "id") -> DataFrame:
    """The first ``n`` rows by ``by``: a look at a stage, the same on every run."""
    return frame.orderBy(by).select(*columns).limit(n)
