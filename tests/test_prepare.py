from __future__ import annotations

import math

from conftest import rows

from lotwise.operators import prepare

NAN = float("nan")


def test_standardize(spark):
    frame = spark.createDataFrame(
        [(" ford ", "f-150", "1abc", "CLEAN"), (None, None, None, None)],
        "manufacturer string, model string, VIN string, title_status string",
    )
    standard = prepare.standardize(frame)
    assert standard.columns == ["manufacturer", "model", "vin", "title_status"]
    assert rows(standard) == [(" FORD ", "F-150", "1ABC", "clean"), (None,) * 4]


def test_standardize_takes_either_spelling_of_vin(spark):
    frame = spark.createDataFrame(
        [("a", "b", "c", "d")], "manufacturer string, model string, vin string, title_status string"
    )
    assert rows(prepare.standardize(frame), "vin") == [("C",)]


def test_require_complete(spark):
    whole = ("a", "b", "2011", 1000)
    frames = [tuple(None if i == gap else v for i, v in enumerate(whole)) for gap in range(4)]
    frame = spark.createDataFrame(
        [whole, *frames], "manufacturer string, model string, year string, price int"
    )
    assert rows(prepare.require_complete(frame)) == [whole]


def test_price_range_is_open_at_both_ends(spark):
    prices = [(p,) for p in (499, 500, 501, 199999, 200000, 200001, None)]
    frame = spark.createDataFrame(prices, "price int")
    assert rows(prepare.keep_price_range(frame)) == [(501,), (199999,)]
    assert rows(prepare.keep_price_range(frame, 498, 500)) == [(499,)]


def test_fill_defaults(spark):
    frame = spark.createDataFrame(
        [(None, None), (NAN, "salvage"), (0.0, "")], "odometer double, title_status string"
    )
    assert rows(prepare.fill_defaults(frame)) == [(-1.0, "clean"), (-1.0, "salvage"), (0.0, "")]


YEARS = ["2011", "2011.0", "2011.9", "0", "0.0", "abc", "", None, "NaN", "-5", "1e3", "99999999999"]


def test_cast_measures(spark):
    frame = spark.createDataFrame([(y, "12.5") for y in YEARS], "year string, odometer string")
    cast = prepare.cast_measures(frame)
    assert [y for y, _ in rows(cast)] == [
        2011, 2011, 2011, 0, 0, None, None, None, None, -5, 1000, None,
    ]
    assert {m for _, m in rows(cast)} == {12.5}


def test_cast_measures_of_numeric_years(spark):
    frame = spark.createDataFrame([(2011.0, 5), (None, None)], "year double, odometer int")
    assert rows(prepare.cast_measures(frame)) == [(2011, 5.0), (None, None)]


def test_fill_year(spark):
    frame = spark.createDataFrame([(y,) for y in YEARS], "year string")
    assert [y for (y,) in rows(prepare.fill_year(frame))] == [
        2011, 2011, 2011, 1900, 1900, 1900, 1900, 1900, 1900, -5, 1000, 1900,
    ]


def test_nan_to_null_reaches_structs_but_not_lists(spark):
    frame = spark.createDataFrame(
        [
            (1, NAN, "NaN", (NAN, (NAN, "x")), [NAN]),
            (2, 1.5, None, (2.5, (None, "y")), [1.0]),
            (3, None, None, None, None),
        ],
        "id int, a double, t string, s struct<b: double, n: struct<c: float, `d.e`: string>>,"
        " l array<double>",
    )
    clean = prepare.nan_to_null(frame)
    assert clean.schema.simpleString() == frame.schema.simpleString()
    first, second, third = clean.orderBy("id").collect()
    assert (first.a, first.t, first.s.b, first.s.n.c, first.s.n["d.e"]) == (
        None, "NaN", None, None, "x",
    )
    assert math.isnan(first.l[0])
    assert (second.a, second.s.b, second.s.n.c) == (1.5, 2.5, None)
    assert (third.a, third.s, third.l) == (None, None, None)


def test_nan_to_null_without_numbers_changes_nothing(spark):
    frame = spark.createDataFrame([("a",)], "t string")
    assert prepare.nan_to_null(frame) is frame
