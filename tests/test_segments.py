from __future__ import annotations

import random
from statistics import mean, stdev

import pytest
from conftest import physical_plan, rows
from pyspark.sql import functions as F

from lotwise.operators import segments

SCHEMA = "id long, manufacturer string, model string, year int, price int, odometer double"


def listing(id, price, *, maker="A", model="B", year=2011, odometer=10.0):
    return (id, maker, model, year, price, odometer)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows in one segment, a ninth in the all-null one, copies included."""
    draw = random.Random(7)
    data = []
    for number in range(9000):
        if number % 3 == 0:
            keys = ("HOT", "ONE", 2015)
        elif number % 9 == 1:
            keys = (None, None, None)
        else:
            keys = (draw.choice("ABC"), f"m{draw.randrange(40)}", draw.choice([None, 2011, 2012]))
        id = 5 if number % 3 == 0 and number % 2 == 0 else number
        data.append((id, *keys, draw.randrange(501, 199999), float(draw.randrange(90000))))
    return spark.createDataFrame(data, SCHEMA).repartition(6).cache()


def test_statistics(spark):
    frame = spark.createDataFrame(
        [
            listing(1, 1000, odometer=1.0),
            listing(2, 1001, odometer=4.0),
            listing(None, 1003, odometer=-1.0),
            listing(4, 700, year=None),
            listing(5, 800, maker=None, year=None),
        ],
        SCHEMA,
    )
    found = {
        (r.manufacturer, r.year): r
        for r in segments.segment_statistics(frame, odometer=True).collect()
    }
    full = found["A", 2011]
    prices = [1000, 1001, 1003]
    assert full.market_avg_price == round(mean(prices), 2)
    assert full.market_std_dev_price == round(stdev(prices), 2)
    assert full.market_avg_odometer == 1.0
    assert full.market_std_dev_odometer == 3.0
    assert (full.group_count, full.segment_rows) == (2, 3)
    assert found["A", None].market_std_dev_price is None
    assert found[None, None].group_count == 1


def expected_statistics(frame):
    groups = {}
    for row in frame.collect():
        groups.setdefault((row.manufacturer, row.model, row.year), []).append(row.price)
    return {keys: (round(mean(prices), 2), len(prices)) for keys, prices in groups.items()}


@pytest.mark.parametrize("limit", [segments.BROADCAST_LIMIT_BYTES, -1])
def test_placing_keeps_every_row(skewed, limit):
    placed = segments.with_segment_statistics(skewed, broadcast_limit=limit)
    assert placed.columns == [
        *skewed.columns, "market_avg_price", "market_std_dev_price", "group_count",
    ]
    assert skewed.exceptAll(placed.select(*skewed.columns)).count() == 0
    found = placed.collect()
    assert len(found) == 9000
    expected = expected_statistics(skewed)
    for row in found:
        average, count = expected[row.manufacturer, row.model, row.year]
        assert row.market_avg_price == pytest.approx(average, abs=0.011)
        assert row.group_count == count


def test_small_statistics_are_broadcast_and_listings_not_shuffled(skewed):
    plan = physical_plan(segments.with_segment_statistics(skewed))
    assert "BroadcastHashJoin" in plan
    assert "hashpartitioning" not in plan


@pytest.mark.parametrize(
    ("hashed_share", "join"), [(2**26, "ShuffledHashJoin"), (0, "SortMergeJoin")]
)
def test_large_statistics_are_shuffled_and_hot_segments_cut(
    skewed, settings, monkeypatch, hashed_share, join
):
    settings(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    monkeypatch.setattr(segments, "HASHED_SHARE_BYTES", hashed_share)
    placed = segments.with_segment_statistics(skewed, broadcast_limit=-1, slice_rows=500)
    assert join in physical_plan(placed)
    assert placed.count() == 9000
    tasks = (
        placed.filter("manufacturer = 'HOT'").groupBy(F.spark_partition_id().alias("task")).count()
    )
    counts = [count for _, count in rows(tasks)]
    assert sum(counts) == 3000
    assert max(counts) < 2250


def test_no_listings(spark):
    empty = spark.createDataFrame([], SCHEMA)
    for limit in (segments.BROADCAST_LIMIT_BYTES, -1):
        assert segments.with_segment_statistics(empty, broadcast_limit=limit).collect() == []


@pytest.mark.parametrize(
    ("spread", "batch", "live"),
    [(4.0, -2.5, -2.5), (0.0, -10.0, -10.0), (None, None, -10.0)],
)
def test_price_score(spark, spread, batch, live):
    frame = spark.createDataFrame(
        [(90, 100.0, spread)], "price int, market_avg_price double, market_std_dev_price double"
    )
    for lone, expected in ((False, batch), (True, live)):
        scored = segments.with_price_score(frame, lone_row_scores=lone)
        assert rows(scored, "price_z_score") == [(expected,)]


def test_odometer_score(spark):
    frame = spark.createDataFrame(
        [(90.0, 100.0, 4.0), (90.0, 100.0, 0.0), (90.0, 100.0, None), (-1.0, 0.0, 2.0)],
        "odometer double, market_avg_odometer double, market_std_dev_odometer double",
    )
    scored = segments.with_odometer_score(frame)
    assert rows(scored, "odometer_z_score") == [(-2.5,), (-10.0,), (-10.0,), (-0.5,)]
