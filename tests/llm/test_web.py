from __future__ import annotations

import hashlib
from collections import Counter

import duckdb
import pytest
from conftest import SMALL, rows
from pyspark.sql import functions as F

from lotwise.llm import queries, secrets, url_rules, warc


@pytest.mark.parametrize("name", queries.ORACLES)
def test_query_matches_sql(spark, name):
    database = duckdb.connect()
    for table in ("pages", "documents", "embeddings"):
        database.execute(f"create view {table} as select * from '{SMALL}/{table}.parquet'")
    frame = queries.QUERIES[name](spark, SMALL)
    result = database.execute(queries.ORACLES[name])
    order = [[c[0] for c in result.description].index(column) for column in frame.columns]
    expected = Counter(tuple(row[i] for i in order) for row in result.fetchall())
    assert Counter(map(tuple, frame.collect())) == expected


def judged(spark, urls, rules, **options):
    pages = spark.createDataFrame(enumerate(urls), "page_id long, url string")
    pages = pages.withColumns({"keys": F.lit(1), "rule": F.lit("x"), "found": F.lit(2), "row": F.lit(3)})
    listed = spark.createDataFrame(rules, "host string, path string, verdict string")
    found = url_rules.judge(pages, listed, **options).orderBy("page_id")
    assert found.columns == ["page_id", "url", "keys", "found", "row", "host", "path", "rule", "verdict"]
    return rows(found, "host", "path", "rule", "verdict")


URLS = [
    None, "", "no scheme/x", "http://A.Example.net/en/1?x#y", "http://example.net?en/", "x://net",
    "x://net/a", "x://a.net/en/", "x://notnet.com/", "ftp://b.org/fr/#/", "x://u:p@c.org:80/fr/",
    "x:///path", "x://a..net/q", "x://é.net/ü",
]


@pytest.mark.parametrize("limit", [url_rules.MAX_FILTER_BYTES, 1])
def test_rules(spark, limit):
    rules = [
        *queries.RULES, (None, "/", "block"), ("com", "x", "block"), ("net", "/a", "maybe"),
        ("org", None, "block"), ("org", "/fr/", "block"),
    ]
    assert judged(spark, URLS, rules, max_bytes=limit) == [
        ("", "", None, "allow"),
        ("", "", None, "allow"),
        ("", "", None, "allow"),
        ("a.example.net", "/en/1", "example.net/en/", "allow"),
        ("example.net", "", None, "allow"),
        ("net", "", None, "allow"),
        ("net", "/a", "net/", "block"),
        ("a.net", "/en/", "net/", "block"),
        ("notnet.com", "/", None, "allow"),
        ("b.org", "/fr/", "org/fr/", "block"),
        ("u:p@c.org:80", "/fr/", None, "allow"),
        ("", "/path", None, "allow"),
        ("a..net", "/q", "net/", "block"),
        ("é.net", "/ü", "net/", "block"),
    ]
    assert judged(spark, [], rules, max_bytes=limit) == []
    assert judged(spark, ["x://net/"], [], max_bytes=limit) == [("net", "/", None, "allow")]


def test_cascade_is_exact_over_its_universe(spark):
    keys = spark.range(30_000).select(F.concat(F.lit("k"), "id").alias("key"), "id")
    universe = keys.select("key", *url_rules.hashes(F.col("key")), "id")
    listed = universe.filter("id % 7 = 0").drop("id")
    levels = url_rules.build_cascade(listed, universe.drop("id"))
    assert len(levels) > 2
    table = universe.toPandas()
    found = url_rules.listed_in(levels, table["h1"].to_numpy(), table["h2"].to_numpy())
    assert (found == (table["id"] % 7 == 0).to_numpy()).all()


BIG = "x" * 1500
PAGES = [
    (1, "http://a/", BIG), (2, None, BIG), (3, "u\r\nv: é", BIG), (3, "u\r\nv: é", BIG),
    (None, "n", BIG), (4, "s", "short"), (5, "s", "short"), (6, "e", None), (7, "e", ""),
    (8, "m", "é" * 400_000), (None, "z", "y" * 1000),
]


def test_archives_round_trip(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    pages = pages.withColumns({"digest": F.lit(0), "key": F.lit("k"), "payload": F.lit(1)})
    found = warc.read_archives(warc.write_archives(pages)).collect()
    assert len(found) == len(PAGES)
    for page_id, url, html in PAGES:
        content = (html or "").encode()
        row = next(r for r in found if r.page_id == page_id and r.payload_bytes == len(content)
                   and (r.url is None) == (url is None))
        assert row.payload_digest == hashlib.sha1(content).hexdigest()
        if html == BIG and page_id != 3:
            assert (row.record_type, row.refers_to, row.payload) == ("revisit", 3, None)
        else:
            assert (row.record_type, row.refers_to) == ("response", None)
            assert bytes(row.payload) == content
    assert {r.url for r in found if r.page_id == 3} == {"u%0D%0Av: é"}
    empty = warc.write_archives(pages.filter("false"))
    assert warc.read_archives(empty).collect() == []


def archive(tmp_path, records, dictionary=b""):
    writer = warc.ArchiveWriter(str(tmp_path / "a.warc.zst"), dictionary)
    for record in records:
        writer.add(record)
    return writer.close()[0]


def test_broken_archives_are_refused(tmp_path):
    good = warc.record_bytes(1, "u", b"abc", hashlib.sha1(b"abc").hexdigest(), None, False)
    path = archive(tmp_path, [good, good])
    assert open(path, "rb").read(4) == b"\x5d\x2a\x4d\x18"
    assert [warc.parse_record(frame)[3] for frame in warc.frames(path)] == [3, 3]
    data = open(path, "rb").read()
    for changed in (data[:-4], data[:5], b"\0" * 8 + data[8:]):
        open(path, "wb").write(changed)
        with pytest.raises(ValueError):
            list(warc.frames(path))
    for old, new in ((b"WARC/1.1", b"WORC/1.1"), (b"abc", b"abd"), (b"abc", b"ab"),
                     (b"WARC-Date", b"WARC-Dote"), (b"response\r", b"unknown\r")):
        with pytest.raises(ValueError):
            warc.parse_record(good.replace(old, new, 1))


WORDS = {"password": 1.0, "dragon": 2.0, "summer": 2.0}


@pytest.mark.parametrize(
    ("easy", "hard"),
    [
        ("dragonsummer", "dxagonsuqmer"),
        ("20240131", "83719264"),
        ("aaaaaaaaaaaa", "akqjzmwpxncv"),
        ("qwertyuiop", "qpwoeirutx"),
        ("abcabcabcabc", "abdcaebfcagb"),
        ("Dragon", "DrAgxn"),
    ],
)
def test_guess_cost_orders_values(easy, hard):
    assert secrets.guess_cost(easy, WORDS) + 1 < secrets.guess_cost(hard, WORDS)


def test_guess_cost_is_the_least_over_all_cuts():
    cost = lambda text: secrets.guess_cost(text, WORDS)
    for text in ("dragon2024x", "zzzzqwerty", "password1!"):
        for cut in range(1, len(text)):
            assert cost(text) <= cost(text[:cut]) + cost(text[cut:]) + secrets.PIECE_COST + 1e-9
    assert secrets.guess_cost("", WORDS) == 0
    assert secrets.guess_cost("x" * 200_000, WORDS) < 8


def test_found_secrets(spark):
    texts = [
        None, "", "password=abcdef", "PassWord : 'abcde'", "token = \"0123456789abcdef01234567\"",
        "secret:token: abcdefgh", "AKIA" + "A" * 16, "AKIA" + "A" * 15, "a" * 24, "A" * 24,
        "ſecret=abcdefgh", "é password=abcdef", "passphrase is xK9$vQ2!mZ7", "passphrase is dragon",
    ]
    frame = spark.createDataFrame(enumerate(texts), "doc_id long, text string")
    frame = frame.withColumn("kind", F.lit("x"))
    found = secrets.find_secrets(frame, masked_into="m").withColumn("spans", secrets.spelled(F.col("secrets")))
    assert [s for _, s in rows(found.orderBy("doc_id"), "doc_id", "spans")] == [
        "", "", "assign:0:15", "", "assign:0:33,hex:9:33", "", "access:0:20", "", "hex:0:24", "",
        "", "assign:2:17", "guess:14:25", "",
    ]
    masked = found.select("doc_id", "m")
    clean = dict(rows(masked))
    assert clean[0] is None and clean[3] == texts[3]
    assert clean[4] == '[SECRET]"' and clean[11] == "é [SECRET]" and clean[12] == "passphrase is [SECRET]"
    assert secrets.find_secrets(frame.filter("false")).collect() == []


def test_a_value_that_a_pattern_covers_in_part_is_scored_whole():
    text = "password: Tr0ub4dor&3$kL9qzV!x end"
    spans = secrets.find(text, WORDS)
    assert spans == [("assign", 0, 19), ("guess", 10, 30)]
    assert secrets.masked(text, spans) == "[SECRET] end"
    # A span inside the value, one that ends with it, and one that covers it whole.
    inside = "passphrase=xK9$" + "0a" * 12 + "!mZ7vQ2"
    assert secrets.masked(inside, secrets.find(inside, WORDS)) == "passphrase=[SECRET]"
    within = [s for s in secrets.find("token=xK9vQ2mZ7pL4tR8w", WORDS) if s[0] == "guess"]
    assert within == [("guess", 6, 22)]


@pytest.mark.parametrize(
    "name",
    [
        "password", "passwd", "passphrase", "passcode", "pwd", "secret", "token", "apikey", "api_key",
        "api-key", "api key", "x-api-key", "credential", "credentials", "private_key", "private key",
        "private-key", "auth", "Authorization", "aws_secret_access_key", "secret_key", "auth_token",
    ],
)
def test_each_context_is_found_alone(name):
    for separator in ("=", ": ", " := ", " => ", " is "):
        text = f"x {name}{separator}9f$2mQ7xLp0Zr4TwBv y"
        spans = secrets.find(text, WORDS)
        assert ("guess", text.index("9f"), len(text) - 2) in spans
        assert "Zr4TwBv" not in secrets.masked(text, spans)


def test_a_context_needs_a_whole_name():
    for text in ("compass = 9f$2mQ7xLp0Zr4TwBv", "token count = 9f$2mQ7xLp0Zr4TwBv", "apiary: 9f$2mQ7xLp0Zr4TwBv"):
        assert secrets.find(text, WORDS) == []
