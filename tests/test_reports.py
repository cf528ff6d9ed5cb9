from __future__ import annotations

from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lotwise.operators import reports

T1, T2 = datetime(2024, 1, 1), datetime(2024, 1, 2)


@pytest.fixture(scope="module")
def scored(spark):
    schema = (
        "id long, manufacturer string, model string, year int, price int, price_z_score double,"
        " odometer_z_score double, arbitrage_opportunity double, deal_rating string,"
        " trust_score int, is_year_mismatch boolean, market_avg_price double,"
        " market_std_dev_price double"
    )

    def row(id, rating, z, year=2011, trust=100, mismatch=False, average=9000.0, spread=2000.0):
        gain = average - 1000
        return (id, "A", "B", year, 1000, z, 0.126, gain, rating, trust, mismatch, average, spread)

    return spark.createDataFrame(
        [
            row(1, "GREAT_DEAL", -1.604),
            row(2, "GREAT_DEAL", -1.601),
            row(3, "GREAT_DEAL", -2.0),
            row(4, "GOOD_PRICE", -1.7),
            row(5, "GOOD_PRICE", -1.5),
            row(6, "RISKY_BUY", -9.0, trust=50, mismatch=True),
            row(7, "RISKY_BUY", 9.0, trust=20, mismatch=False),
            row(8, "VOLATILE_MARKET", 0.0, average=3000.0, spread=1000.0),
            row(9, "VOLATILE_MARKET", 1.0, average=3000.0, spread=1000.0),
            row(10, "VOLATILE_MARKET", 1.0, year=2012, average=3000.0, spread=1500.0),
            row(11, "EXTREME_OVERPRICE", 3.0),
            row(12, "EXTREME_OVERPRICE", 4.0),
            row(13, "FAIR_MARKET", 0.0),
        ],
        schema,
    )


def ordered(scored, name):
    return reports.in_alert_order(reports.ALERTS[name](scored), name)


def test_great_deals_sort_by_the_rounded_score(scored):
    found = ordered(scored, "great_deals")
    assert found.columns == [
        "id", "manufacturer", "model", "price", "Price_Z_Score", "Odometer_Z_Score",
        "Arbitrage_Value", "deal_rating",
    ]
    assert rows(found, "id", "Price_Z_Score") == [(3, -2.0), (4, -1.7), (1, -1.6), (2, -1.6)]
    assert found.first().Odometer_Z_Score == 0.13


def test_risky_buys(scored):
    found = ordered(scored, "risky_buys")
    assert sorted(rows(found, "id", "trust_score", "Fraud_Flag")) == [
        (6, 50, "Year Mismatch"),
        (7, 20, ""),
    ]


def test_volatile_segments_are_listed_once(scored):
    found = ordered(scored, "volatile_segments")
    assert rows(found, "year", "Std_Dev_Price", "StdDev_as_Pct_of_Avg") == [
        (2012, 1500.0, 50.0),
        (2011, 1000.0, 33.3),
    ]


def test_extreme_overprices(scored):
    assert rows(ordered(scored, "extreme_overprices"), "id", "Avg_Price") == [
        (12, 9000.0),
        (11, 9000.0),
    ]


def test_rating_counts(scored):
    assert dict(rows(reports.rating_counts(scored)))["VOLATILE_MARKET"] == 3


def test_segment_summary_and_metrics(spark, scored):
    listings = spark.createDataFrame(
        [("A", "B", 1, T1), ("A", "B", 4, T2), ("A", "C", None, T1), (None, None, 7, None)],
        "manufacturer string, model string, price int, event_time timestamp",
    )
    summary = reports.segment_summary(listings)
    assert summary.columns == [
        "manufacturer", "model", "avg_price", "price_std_dev", "listings_count",
        "last_data_received",
    ]
    assert sorted(rows(summary), key=str) == [
        ("A", "B", 2.5, 2.12, 2, T2),
        ("A", "C", None, None, 1, T1),
        (None, None, 7.0, None, 1, None),
    ]
    assert dict(rows(reports.batch_metrics(summary, scored))) == {
        "received_rows": 4,
        "segments": 3,
        "great_deals": 4,
        "risky_buys": 2,
        "extreme_overprices": 2,
        "volatile_segments": 2,
    }


def test_top_segments(spark):
    summary = spark.createDataFrame(
        [("b", "x", 3), ("a", "y", 3), (None, None, 3), ("c", "z", 9), ("d", "w", 1)],
        "manufacturer string, model string, listings_count long",
    )
    assert rows(reports.top_segments(summary, 4), "manufacturer") == [
        ("c",), (None,), ("a",), ("b",),
    ]


def test_cleaning_counts(spark):
    data = [("a", "b", "1", 501), ("a", "b", None, 501), ("a", "b", "1", 500), (None,) * 4]
    frame = spark.createDataFrame(data, "manufacturer string, model string, year string, price int")
    assert rows(reports.cleaning_counts(frame)) == [(4, 2, 2, 1)]
    none = frame.filter("false")
    assert rows(reports.cleaning_counts(none)) == [(0, 0, 0, 0)]


def test_load_latency(spark):
    loaded = spark.createDataFrame([(T1,), (T2,), (None,)], "event_time timestamp")
    arrival = datetime(2024, 1, 2, 0, 0, 1, 234000)
    assert rows(reports.load_latency(loaded, arrival)) == [(3, T2, 1.234)]
    arrival_column = F.lit("2024-01-02 00:01:00").cast("timestamp")
    assert rows(reports.load_latency(loaded, arrival_column), "latency_seconds") == [(60.0,)]


def test_preview(spark):
    frame = spark.range(50).withColumn("twice", F.col("id") * 2)
    assert rows(reports.preview(frame, ["twice"], 3)) == [(0,), (2,), (4,)]
