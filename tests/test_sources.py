from __future__ import annotations

import random
from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lotwise import schema as S
from lotwise.sources import files, messages


def write(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8", newline="")
    return str(folder)


NAMES = [field.name for field in S.LISTING_SCHEMA.fields]


def csv_line(**fields):
    return ",".join(fields.get(name, "") for name in NAMES)


def csv_file(*lines):
    return "\n".join([",".join(NAMES), *lines, ""])


def test_csv_keeps_breaks_quotes_and_commas(spark, tmp_path):
    text = csv_file(
        csv_line(id="7222695916", price="6000", year="2011.0", description='"one\ntwo, ""2""\r\n"'),
        csv_line(id="2", price="6000.0", odometer="12", VIN="x"),
    )
    listings = files.read_listings_csv(spark, write(tmp_path / "in", "a.csv", text))
    assert listings.schema.simpleString() == S.LISTING_SCHEMA.simpleString()
    first, second = listings.orderBy(F.desc("id")).collect()
    assert (first.id, first.price, first.year) == (7222695916, 6000, "2011.0")
    # The CSV reader gives every line break inside a field as \n.
    assert first.description in ('one\ntwo, "2"\n', 'one\ntwo, "2"\r\n')
    assert (second.price, second.odometer, second.VIN, second.region) == (6000, 12.0, "x", None)


def test_csv_reads_a_folder_of_files_and_can_split_plain_ones(spark, tmp_path):
    for number in range(3):
        write(tmp_path / "in", f"{number}.csv", csv_file(csv_line(id=str(number), price="700")))
    for breaks in (True, False):
        listings = files.read_listings_csv(
            spark, str(tmp_path / "in"), line_breaks_in_fields=breaks
        )
        assert sorted(rows(listings, "id", "price")) == [(0, 700), (1, 700), (2, 700)]


def test_csv_with_other_columns_is_refused(spark, tmp_path):
    text = csv_file(csv_line(id="1")).replace("manufacturer", "maker", 1)
    path = write(tmp_path / "in", "a.csv", text)
    with pytest.raises(ValueError, match="no column manufacturer"):
        files.read_listings_csv(spark, path)


def test_csv_columns_are_taken_by_name(spark, tmp_path):
    text = "extra,price,model,id,year,manufacturer,ODOMETER\nx,700,m,3,2011,f,8\n"
    path = write(tmp_path / "in", "a.csv", text)
    listings = files.read_listings_csv(spark, path)
    assert listings.schema.simpleString() == S.LISTING_SCHEMA.simpleString()
    found = rows(listings, "id", "price", "model", "odometer", "cylinders")
    assert found == [(3, 700, "m", 8.0, None)]


def random_field(draw):
    signs = ["a", "b c", ",", "\n", "\r\n", '""', "é", "😀", " ", "\n\n"]
    return '"' + "".join(draw.choices(signs, k=draw.randint(1, 200))) + '"'


@pytest.mark.parametrize("end, block", [("\n", 64 << 10), ("\r\n", 64 << 10), ("\n", 700), ("\r\n", 701)])
def test_a_file_with_breaks_in_fields_is_read_by_many_tasks(spark, settings, tmp_path, end, block):
    """The same rows as one task finds that reads the whole file, at any place of the cuts."""
    draw = random.Random(block)
    lines = []
    for i in range(3000 if block > 1000 else 300):
        lines.append(csv_line(id=str(i), price="700", description=random_field(draw), county='""""'))
        if i % 50 == 0:
            lines.append("")
    lines.append(csv_line(id="9999999", description='"' + 'x ""y""\n' * 900 + '"', state='"last, one"'))
    text = end.join([",".join(NAMES), *lines])
    path = write(tmp_path / "in", "a.csv", text)
    write(tmp_path / "in", "b.csv", end.join([",".join(NAMES), csv_line(id="-1"), "", ""]))
    settings(spark__sql__files__maxPartitionBytes=str(block), spark__sql__files__openCostInBytes="0")
    listings = files.read_listings_csv(spark, path)
    tasks = spark.read.text(path).rdd.getNumPartitions()
    assert tasks > 5
    whole = spark.read.csv(path, header=True, multiLine=True, **files.QUOTING)
    if end == "\n":
        assert sorted(rows(listings), key=repr) == sorted(rows(files.typed_listings(whole)), key=repr)
    # That reader gives every line break as \n; here those inside a field stay as they are.
    plain = lambda text: text and text.replace("\r\n", "\n").replace("\r", "\n")
    found = sorted((i, plain(d), c, s) for i, d, c, s in rows(listings, "id", "description", "county", "state"))
    expected = rows(whole, "id", "description", "county", "state")
    assert found == sorted((int(i), plain(d), c, s) for i, d, c, s in expected)


def test_csv_that_cannot_be_cut_is_refused(spark, tmp_path):
    open_field = csv_file(csv_line(id="1", description='"never closed'), csv_line(id="2"))
    with pytest.raises(Exception, match="quotes are not closed"):
        files.read_listings_csv(spark, write(tmp_path / "open", "a.csv", open_field)).count()
    write(tmp_path / "two", "a.csv", csv_file(csv_line(id="1")))
    other = csv_file(csv_line(id="2")).replace("county,state", "state,county", 1)
    with pytest.raises(Exception, match="header"):
        files.read_listings_csv(spark, write(tmp_path / "two", "b.csv", other)).count()


@pytest.mark.parametrize(
    ("text", "price"),
    [("6000", 6000), ("6000.0", 6000), ("6000.5", None), ("3736928711", None), ("", None),
     ("NaN", None), ("-5", -5)],
)
def test_csv_price(spark, tmp_path, text, price):
    path = write(tmp_path / "in", "a.csv", csv_file(csv_line(id="1", price=text)))
    assert rows(files.read_listings_csv(spark, path), "price") == [(price,)]


def test_csv_round_trip(spark, tmp_path):
    record = dict.fromkeys(NAMES)
    record |= {"id": 9, "price": 700, "odometer": 0.1, "description": 'a "b"\n,c', "lat": -1e-7}
    listings = spark.createDataFrame([tuple(record.values())], S.LISTING_SCHEMA)
    files.write_listings_csv(listings, str(tmp_path / "out"))
    back = files.read_listings_csv(spark, str(tmp_path / "out"))
    assert rows(back) == rows(listings)


@pytest.mark.parametrize("factor", [0, 1, 100])
def test_first_rows(spark, factor):
    # Ids in clumps far apart, with gaps and a crowd of equal ids.
    far = [-(2**63), -(2**62), -5]
    ids = [*far, *range(0, 300, 3), *range(10**12, 10**12 + 50), *[10**12 + 60] * 20, 2**63 - 1]
    frame = spark.createDataFrame([(i,) for i in reversed(ids)], "id long").repartition(4)
    for n in (1, 100, 101, 160, 500):
        found = [i for (i,) in rows(files.first_rows(frame, n, spare_factor=factor))]
        assert found == ids[:n]


def test_first_rows_cut_reaches_the_scan(spark, tmp_path):
    spark.range(100_000).write.parquet(str(tmp_path / "ids"))
    frame = spark.read.parquet(str(tmp_path / "ids"))
    plan = files.first_rows(frame, 10)._jdf.queryExecution().executedPlan()
    assert "LessThanOrEqual(id," in plan.toString()


def test_first_rows_without_rows(spark):
    assert rows(files.first_rows(spark.createDataFrame([], "id long"), 5)) == []


SENT = datetime(2024, 5, 1, 12, 30, 0, 250000)


def decode(spark, *texts):
    frame = spark.createDataFrame(
        [(bytearray(text.encode()) if text is not None else None, SENT) for text in texts],
        "value binary, timestamp timestamp",
    )
    return messages.decode_messages(frame)


def test_decode_columns(spark):
    decoded = decode(spark, "{}")
    assert decoded.columns == [*NAMES, "event_time"]
    assert decoded.drop("event_time").schema.simpleString() == S.LISTING_SCHEMA.simpleString()
    assert rows(decoded, "event_time") == [(SENT,)]


@pytest.mark.parametrize(
    ("sent", "column", "value"),
    [
        ('{"id":7222695916}', "id", 7222695916),
        ('{"price":6000}', "price", 6000),
        ('{"price":6000.0}', "price", 6000),
        ('{"price":6000.5}', "price", None),
        ('{"price":NaN}', "price", None),
        ('{"price":3736928711}', "price", None),
        ('{"year":2011.0}', "year", "2011.0"),
        ('{"year":"2011"}', "year", "2011"),
        ('{"year":NaN}', "year", None),
        ('{"VIN":NaN}', "VIN", None),
        ('{"model":"NaN"}', "model", "NaN"),
        ('{"lat":NaN}', "lat", None),
        ('{"lat":31.5}', "lat", 31.5),
        ('{"description":"a\\nb \\u00e9"}', "description", "a\nb é"),
        ('{"unknown":1,"state":"az"}', "state", "az"),
    ],
)
def test_decode_values(spark, sent, column, value):
    assert rows(decode(spark, sent), column) == [(value,)]


def test_unreadable_messages_become_empty_listings(spark):
    decoded = decode(spark, "not json", '{"id":', "", None).drop("event_time")
    assert rows(decoded) == [(None,) * len(NAMES)] * 4


def test_decode_only_named_columns(spark):
    sent = '{"url":"u","id":5,"description":{"odd":[1]},"price":"x","VIN":NaN,"model":"m"}'
    frame = spark.createDataFrame(
        [(bytearray(sent.encode()), SENT)], "value binary, timestamp timestamp"
    )
    decoded = messages.decode_messages(frame, ["VIN", "id", "model"])
    assert rows(decoded) == [(5, "m", None, SENT)]
    assert decoded.columns == ["id", "model", "VIN", "event_time"]


def test_encode_and_decode(spark):
    record = dict.fromkeys(NAMES)
    record |= {"id": 7222695916, "price": 700, "year": "2011.0", "VIN": "1A", "odometer": 1e7}
    record |= {"description": 'line\n"quoted" \\ é', "lat": -12.25}
    listings = spark.createDataFrame([tuple(record.values())], S.LISTING_SCHEMA)
    encoded = messages.encode_messages(listings.withColumn("extra", F.lit(1)))
    assert rows(encoded, "key") == [(None,)]
    (value,) = rows(encoded.select(F.col("value").cast("string")))[0]
    assert "extra" not in value and "region" not in value
    back = messages.decode_messages(encoded.withColumn("timestamp", F.current_timestamp()))
    assert rows(back.drop("event_time")) == rows(listings)


def test_stamped_messages_have_the_bus_layout(spark):
    listings = spark.createDataFrame([(1, "x", SENT)], "id long, vin string, at timestamp")
    stamped = messages.stamp_messages(listings, F.col("at"))
    assert stamped.schema.simpleString() == S.MESSAGE_SCHEMA.simpleString()
    assert rows(stamped.select(F.col("value").cast("string"))) == [('{"id":1,"VIN":"x"}',)]
