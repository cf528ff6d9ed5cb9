from __future__ import annotations

import pytest
from conftest import rows

from lotwise.operators import arbitrage, forensics, rating


@pytest.mark.parametrize(
    ("vin", "code", "year"),
    [
        ("123456789A", "A", 2010),
        ("123456789H7", "H", 2017),
        ("123456789I", "I", 0),
        ("123456789J", "J", 2018),
        ("123456789N", "N", 2022),
        ("123456789O", "O", 0),
        ("123456789P", "P", 2023),
        ("123456789R", "R", 0),
        ("123456789a", "a", 0),
        ("123456789", "", 0),
        ("", "", 0),
        (None, None, 0),
    ],
)
def test_vin_year(spark, vin, code, year):
    frame = spark.createDataFrame([(vin,)], "vin string")
    decoded = forensics.with_vin_year(frame)
    assert rows(decoded, "vin_year_code", "decoded_vin_year") == [(code, year)]


@pytest.mark.parametrize(
    ("decoded", "year", "mismatch"),
    [(2011, 2011, False), (2011, 2012, False), (2011, 2010, False), (2011, 2013, True),
     (2011, 2009, True), (0, 2013, False), (2011, None, False), (2011, 1900, True)],
)
def test_year_mismatch(spark, decoded, year, mismatch):
    frame = spark.createDataFrame(
        [(decoded, year, 50000.0)], "decoded_vin_year int, year int, odometer double"
    )
    flagged = forensics.with_fraud_flags(frame)
    assert rows(flagged, "is_year_mismatch") == [(mismatch,)]


@pytest.mark.parametrize(
    ("year", "odometer", "suspicious"),
    [(2019, 1.0, True), (2019, 1999.0, True), (2019, 2000.0, False), (2019, 0.0, False),
     (2019, -1.0, False), (2020, 1.0, False), (None, 1.0, False), (2019, None, False)],
)
def test_suspicious_mileage(spark, year, odometer, suspicious):
    frame = spark.createDataFrame(
        [(0, year, odometer)], "decoded_vin_year int, year int, odometer double"
    )
    flagged = forensics.with_fraud_flags(frame)
    assert rows(flagged, "is_suspicious_mileage") == [(suspicious,)]


def test_current_year_is_a_parameter(spark):
    frame = spark.createDataFrame(
        [(0, 2020, 5.0)], "decoded_vin_year int, year int, odometer double"
    )
    later = forensics.with_fraud_flags(frame, current_year=2026)
    assert rows(later, "is_suspicious_mileage") == [(True,)]


def test_trust(spark):
    frame = spark.createDataFrame(
        [(False, False), (False, True), (True, False), (True, True)],
        "is_year_mismatch boolean, is_suspicious_mileage boolean",
    )
    trusted = forensics.with_trust_score(frame)
    assert rows(trusted, "trust_score") == [(100,), (70,), (50,), (20,)]
    assert rows(forensics.low_trust(trusted), "trust_score") == [(70,), (50,), (20,)]
    assert dict(trusted.dtypes)["trust_score"] == "int"


def test_arbitrage(spark):
    frame = spark.createDataFrame(
        [(1000, 3000.0), (1000, 3000.01), (5000, 4000.0), (1000, None)],
        "price int, market_avg_price double",
    )
    placed = arbitrage.with_arbitrage(frame)
    flags = [flag for (flag,) in rows(placed, "is_sourcing_hub")]
    assert flags == [False, True, False, False]
    assert rows(arbitrage.sourcing_hubs(placed), "national_avg_price") == [(3000.01,)]
    gains = [gain for (gain,) in rows(placed, "arbitrage_opportunity")]
    assert gains == [2000.0, pytest.approx(2000.01), -1000.0, None]


RATED = (
    "trust_score int, group_count long, price_z_score double, odometer_z_score double,"
    " market_avg_price double, market_std_dev_price double"
)


def rated(spark, rate, z, *, trust=100, count=5, odometer_z=0.0, spread=1000.0):
    frame = spark.createDataFrame([(trust, count, z, odometer_z, 10000.0, spread)], RATED)
    return rate(frame).first().deal_rating


@pytest.mark.parametrize(
    ("z", "basic", "trusted", "live"),
    [
        (-1.51, "GREAT DEAL", "GREAT_DEAL", "GREAT_DEAL"),
        (-1.5, "GOOD PRICE", "GOOD_PRICE", "GOOD_PRICE"),
        (-0.5, "GOOD PRICE", "GOOD_PRICE", "GOOD_PRICE"),
        (-0.49, "FAIR MARKET", "FAIR_MARKET", "FAIR_MARKET"),
        (0.5, "FAIR MARKET", "FAIR_MARKET", "FAIR_MARKET"),
        (0.51, "SLIGHTLY HIGH", "OVERPRICED", "OVERPRICED"),
        (1.5, "SLIGHTLY HIGH", "OVERPRICED", "OVERPRICED"),
        (1.51, "OVERPRICED", "OVERPRICED", "OVERPRICED"),
        (2.99, "OVERPRICED", "OVERPRICED", "OVERPRICED"),
        (3.0, "OVERPRICED", "OVERPRICED", "EXTREME_OVERPRICE"),
        (None, "SLIGHTLY HIGH", "OVERPRICED", "OVERPRICED"),
    ],
)
def test_price_steps(spark, z, basic, trusted, live):
    assert rated(spark, rating.rate_basic, z) == basic
    assert rated(spark, rating.rate_trusted, z) == trusted
    assert rated(spark, rating.rate_live, z) == live


@pytest.mark.parametrize("rate", [rating.rate_trusted, rating.rate_live])
def test_trust_comes_first_and_seventy_is_enough(spark, rate):
    assert rated(spark, rate, -2.0, trust=69, count=1) == "RISKY_BUY"
    assert rated(spark, rate, -2.0, trust=70) == "GREAT_DEAL"
    assert rated(spark, rate, -2.0, trust=70, count=4) == "INSUFFICIENT_DATA"


def test_basic_rating_ignores_trust(spark):
    assert rated(spark, rating.rate_basic, -2.0, trust=20) == "GREAT DEAL"
    assert rated(spark, rating.rate_basic, -2.0, count=4) == "INSUFFICIENT_DATA"


def test_volatility_and_mileage(spark):
    live = rating.rate_live
    assert rated(spark, live, -2.0, spread=2000.0) == "GREAT_DEAL"
    assert rated(spark, live, -2.0, spread=2000.01) == "VOLATILE_MARKET"
    assert rated(spark, live, 5.0, spread=None) == "EXTREME_OVERPRICE"
    assert rated(spark, live, -2.0, odometer_z=1.5) == "GREAT_DEAL"
    assert rated(spark, live, -2.0, odometer_z=1.51) == "GOOD_PRICE"
    assert rated(spark, live, -2.0, odometer_z=None) == "GREAT_DEAL"
    assert rated(spark, live, 0.0, odometer_z=9.0) == "FAIR_MARKET"
