"""Both scoring plans against a plain loop over a few hundred awkward listings."""

from __future__ import annotations

import math
import random
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal
from statistics import fmean, stdev

import pytest

from lotwise.operators.segments import BROADCAST_LIMIT_BYTES
from lotwise.plans import scoring

SCHEMA = (
    "id long, manufacturer string, model string, year string, price int, odometer double,"
    " VIN string, title_status string, region string, lat double, long double"
)
YEARS = ["2010", "2011.0", "2019", "2020", "2022.0", "abc", "0", None]


def random_listings(seed: int, count: int) -> list[tuple]:
    draw = random.Random(seed)
    listings = []
    for number in range(count):
        hot = draw.random() < 0.35
        letter = draw.choice("BBBBBA" if hot else "ABHIJKNPRx")
        calm = draw.choice([int(draw.gauss(20000, 1500))] * 30 + [28000])
        wild = draw.choice([draw.randrange(400, 30000), 500, 501, 199999, 200000, None, 90000])
        listings.append(
            (
                draw.choice([number, number, number, None]),
                "hot" if hot else draw.choice(["ford", "Ford", "kia", None]),
                "one" if hot else draw.choice(["a", "b", "c", None]),
                "2011" if hot else draw.choice(YEARS),
                calm if hot else wild,
                draw.choice([draw.randrange(200000) * 1.0, 1999.0, 2000.0, 0.0, None, math.nan]),
                draw.choice([f"1hgcm8263{letter}0000001", "short", None]),
                draw.choice(["Clean", None]),
                "r",
                1.0,
                2.0,
            )
        )
    return listings + listings[:25]


def rounded(value: float | None, digits: int) -> float | None:
    if value is None:
        return None
    step = Decimal(1).scaleb(-digits)
    return float(Decimal(repr(value)).quantize(step, rounding=ROUND_HALF_UP))


def spread(values: list[float]) -> float | None:
    return stdev(values) if len(values) > 1 else None


def whole_year(text: str | None) -> int | None:
    try:
        return int(float(text))
    except (TypeError, ValueError):
        return None


def upper(text: str | None) -> str | None:
    return None if text is None else text.upper()


def cleaned(listings: list[tuple], live: bool) -> list[dict]:
    kept = []
    for id, maker, model, year, price, miles, vin, *_ in listings:
        if price is None or not 500 < price < 200000:
            continue
        if not live and None in (maker, model, year):
            continue
        number = whole_year(year)
        if live and not number:
            number = 1900
        if miles is None or math.isnan(miles):
            miles = -1.0
        kept.append(
            {
                "id": id,
                "manufacturer": upper(maker),
                "model": upper(model),
                "year": number,
                "price": price,
                "odometer": miles,
                "vin": upper(vin),
            }
        )
    return kept


def trust(row: dict) -> int:
    years = {letter: 2010 + i for i, letter in enumerate("ABCDEFGHJKLMNP")}
    decoded = years.get((row["vin"] or "")[9:10])
    year = row["year"]
    score = 100
    if decoded and year is not None and abs(decoded - year) > 1:
        score -= 50
    if year is not None and year < 2020 and 0 < row["odometer"] < 2000:
        score -= 30
    return score


def score(value, center, unit, lone):
    if unit is None and not lone:
        return None
    return (value - center) / (unit or 1.0)


def batch_rating(row: dict) -> str:
    z = row["price_z_score"]
    if row["trust_score"] < 70:
        return "RISKY_BUY"
    if row["group_count"] < 5:
        return "INSUFFICIENT_DATA"
    for limit, label in ((-1.5, "GREAT_DEAL"), (-0.5, "GOOD_PRICE"), (0.5, "FAIR_MARKET")):
        if z < limit or (z == limit and label != "GREAT_DEAL"):
            return label
    return "OVERPRICED"


def live_rating(row: dict) -> str:
    label, z = batch_rating(row), row["price_z_score"]
    if label in ("RISKY_BUY", "INSUFFICIENT_DATA"):
        return label
    if row["market_std_dev_price"] / row["market_avg_price"] > 0.2:
        return "VOLATILE_MARKET"
    if label == "GREAT_DEAL" and row["odometer_z_score"] > 1.5:
        return "GOOD_PRICE"
    return "EXTREME_OVERPRICE" if z >= 3.0 else label


def expected(listings: list[tuple], live: bool) -> list[dict]:
    rows = cleaned(listings, live)
    groups = defaultdict(list)
    for row in rows:
        groups[row["manufacturer"], row["model"], row["year"]].append(row)
    for group in groups.values():
        prices, miles = [r["price"] for r in group], [r["odometer"] for r in group]
        average, deviation = rounded(fmean(prices), 2), rounded(spread(prices), 2)
        far, wide = rounded(fmean(miles), 0), rounded(spread(miles), 0)
        for row in group:
            row["market_avg_price"], row["market_std_dev_price"] = average, deviation
            row["group_count"] = sum(r["id"] is not None for r in group)
            row["price_z_score"] = score(row["price"], average, deviation, live)
            row["trust_score"] = trust(row)
            row["arbitrage_opportunity"] = average - row["price"]
            row["is_sourcing_hub"] = average - row["price"] > 2000
            if live:
                row["odometer_z_score"] = score(row["odometer"], far, wide, True)
            row["deal_rating"] = live_rating(row) if live else batch_rating(row)
    return rows


def in_order(rows: list[dict]) -> list[str]:
    return sorted(repr(sorted(row.items())) for row in rows)


@pytest.mark.parametrize("limit", [BROADCAST_LIMIT_BYTES, -1])
@pytest.mark.parametrize("live", [False, True])
def test_plan_matches_a_plain_loop(spark, live, limit):
    listings = random_listings(11, 900)
    frame = spark.createDataFrame(listings, SCHEMA).repartition(5)
    if live:
        scored = scoring.score_live(scoring.clean_live(frame), broadcast_limit=limit)
    else:
        scored = scoring.score_batch(scoring.clean_batch(frame), broadcast_limit=limit)
    wanted = expected(listings, live)
    found = scored.select(*wanted[0]).collect()
    assert in_order([row.asDict() for row in found]) == in_order(wanted)
    assert len({row["deal_rating"] for row in wanted}) >= 5
