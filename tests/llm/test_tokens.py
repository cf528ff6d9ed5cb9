from __future__ import annotations

import random
import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from conftest import SMALL, rows
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lotwise.llm import bpe, planes, pretokens, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "", " ", "  a  b ", "a\n b", "a\n \nb", "abc\n ", " \n x\t y", " it's 'll we'RE can't",
    "x<|endoftext|> y<|endoftext|>", "<|endoftext|>", "a\x1c b \x85 d", "日本語 テキスト  🎉", "é" * 200,
    "ab" * 3000, "1234 ５６ ²³ Ⅷ", "_ __a _b", "\r\n\r\n a\r\n", "word " * 20000, "\ufeff\u200b x",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def letters():
    points = [p for p in range(0x30000) if not 0xD800 <= p < 0xE000]
    for start in range(0, len(points), 97):
        yield " ".join(f"{chr(p)}{chr(p)}1 {chr(p)} " for p in points[start : start + 97])


def test_both_encoders_equal_the_library(library):
    own, pieces = bpe.encoder(PATH, 1000), planes.library_encoder(PATH)
    for text in [*ODD, *letters()]:
        expected = library.encode(text, add_special_tokens=False).ids
        for encode in (own, pieces):
            assert np.frombuffer(encode(text), "<u4").tolist() == expected, text[:40]
        decoded = bpe.vocabulary(PATH).decode(own(text))
        assert decoded == library.decode(expected, skip_special_tokens=False)


def test_long_words_merge_as_short_ones(monkeypatch):
    words = bpe.vocabulary(PATH)
    draw = random.Random(1)
    for _ in range(300):
        word = bytes(draw.choice(b"abetnrs \xc3\xa9") for _ in range(draw.randrange(1, 90)))
        assert words.merge_word(word) == words._merge_long(word)


def test_a_full_memory_starts_anew():
    memory = pretokens.PieceMemory(str.encode, room=2)
    assert [memory[x] for x in "abcab"] == [b"a", b"b", b"c", b"a", b"b"]
    assert len(memory) <= 2


@pytest.mark.parametrize("bits", [False, True])
@pytest.mark.parametrize("count", [1, 7, 64, 1000])
def test_planes_round_trip(bits, count):
    ids = np.random.default_rng(count).integers(0, 2**32, count, dtype=np.uint32)
    found = planes.from_planes(planes.to_planes(ids, bits), count)
    assert found.tolist() == ids.tolist()


@pytest.mark.parametrize("bits", [False, True])
def test_shards_round_trip(spark, library, bits):
    texts = [(None, "no id"), (5, None), (3, ""), (9, "word " * 5000), (5, "again"), (5, "again")]
    frame = spark.createDataFrame(texts, "doc_id long, text string").withColumn("start", F.lit("x"))
    manifest = planes.write_shards(frame, PATH, end_id=2, block_ids=64, bits=bits)
    found = rows(planes.read_shards(manifest).orderBy("start"))
    assert [row[0] for row in found] == [None, 3, 5, 5, 5, 9]
    at = 0
    by_id: dict = {}
    for doc_id, text in texts:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        by_id.setdefault(doc_id, []).append(ids)
    for doc_id, start, n_tokens, ids in found:
        assert start == at and n_tokens * 4 == len(ids)
        assert np.frombuffer(ids, "<u4").tolist() in by_id[doc_id]
        at += n_tokens
    reader = planes.ShardReader(manifest.filter("ids > 64").first()["path"])
    whole = np.concatenate([np.frombuffer(ids, "<u4") for _, _, ids in reader.documents()])
    assert reader.ids(3, 200).tolist() == whole[3:203].tolist()
    assert reader.ids(5, 0).tolist() == []


def test_no_documents(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert planes.read_shards(planes.write_shards(empty, PATH, end_id=2)).collect() == []
    assert queries.token_digests(empty).collect() == []


def test_a_cut_shard_is_refused(spark, tmp_path):
    path = str(tmp_path / "cut.ids")
    writer = planes.ShardWriter(path)
    writer.add(1, b"\1\0\0\0")
    writer.close()
    data = open(path, "rb").read()
    open(path, "wb").write(data[:-3])
    with pytest.raises(ValueError, match="not a whole shard"):
        planes.ShardReader(path)


def test_encoding_keeps_other_columns(spark, library):
    frame = spark.createDataFrame([(1, None, "x"), (2, "a b", None)], "doc_id long, text string, decoded string")
    found = rows(bpe.decode_documents(bpe.encode_documents(frame, PATH), PATH))
    ids = np.array(library.encode("a b").ids, "<u4").tobytes()
    assert found == [(1, None, b"", ""), (2, "a b", ids, "a b")]


def test_queries_equal_the_library(spark, library):
    texts = dict(rows(spark.read.parquet(f"{SMALL}/documents.parquet"), "doc_id", "text"))
    expected = {i: library.encode(t, add_special_tokens=False).ids for i, t in texts.items()}
    at = 0
    crc = {}
    for doc_id in sorted(texts):
        ids = [*expected[doc_id], 2]
        crc[doc_id] = (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert {r[0]: tuple(r[1:]) for r in queries.op1_id_planes(spark, SMALL).collect()} == crc
    sha = lambda data: hashlib.sha256(data).hexdigest()
    digests = {}
    for i, ids in expected.items():
        back = library.decode(ids, skip_special_tokens=False).encode()
        digests[i] = (len(ids), sha(np.array(ids, "<u4").tobytes()), sha(back))
    assert {r[0]: tuple(r[1:]) for r in queries.op3_bpe(spark, SMALL).collect()} == digests


def test_a_memory_keeps_what_comes_back_and_stays_small():
    met = []
    memory = pretokens.PieceMemory(lambda piece: met.append(piece) or piece.encode(), room=8)
    for i in range(50):
        assert memory[f"p{i}"] == f"p{i}".encode() and memory["again"] == b"again"
        assert len(memory) + len(memory.older) <= 8
    assert met.count("again") == 1 and len(met) == 51
    assert memory["x" * 100] == b"x" * 100 and "x" * 100 not in memory
