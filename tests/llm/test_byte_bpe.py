import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from devmetrics.llm import byte_bpe

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
SCHEMA = "doc_id bigint, text string"


@pytest.fixture(scope="module")
def wanted():
    encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})
    return encoding.encode_ordinary


def encoded(df, **options):
    return byte_bpe.encode(df, RANKS, PATTERN, **options)


def odd_texts():
    rng = random.Random(5)
    out = [
        "", " ", "\n\n  x", "a", "I'll we're 'S 'll", "naïve café", "日本語のテキスト", "👩‍👩‍👧 family", "a\x00b\x85c d", "x  y   z ",
        "<|endoftext|> is text here", "1234567890" * 50, "aaaaaaa" * 40, "é" * 300, "word " * 3000, "nospaces" * 4000, " lead", "trail ",
        "́combining", "\U0010ffff", "tabs\tand\r\nlines\r\n",
    ]
    ranges = [(32, 127), (0xA0, 0x3000), (0x3000, 0xD800), (0x10000, 0x11000), (0, 32)]
    for _ in range(300):
        out.append("".join(chr(rng.randrange(*rng.choice(ranges))) for _ in range(rng.randrange(1, 60))))
    for alphabet in ("ab a\n\t'", "aeiou", "ሀ∑ß "):
        out += ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 80))) for _ in range(150)]
    return out


@pytest.mark.parametrize("portion", [byte_bpe.PORTION, 7])
def test_ids_are_those_of_the_ranks(spark, wanted, portion):
    texts = odd_texts()
    df = spark.createDataFrame(list(enumerate(texts)), SCHEMA).repartition(3)
    got = {r["doc_id"]: r for r in encoded(df, portion=portion).collect()}
    assert len(got) == len(texts)
    for k, text in enumerate(texts):
        assert np.frombuffer(got[k]["ids"], "<u4").tolist() == wanted(text)


def test_offsets_name_the_characters_of_each_token(spark):
    texts = odd_texts()
    table = byte_bpe.token_bytes(RANKS, PATTERN)
    df = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    for r in encoded(df, portion=50).collect():
        text, done, split = texts[r["doc_id"]], 0, 0
        bounds = np.concatenate([[0], np.cumsum([len(c.encode()) for c in text])])
        for i, start, end in zip(np.frombuffer(r["ids"], "<u4").tolist(), r["starts"], r["ends"]):
            data = table[i].as_py()
            assert start == np.searchsorted(bounds, done, "right") - 1
            split += int(bounds[start] != done)
            done += len(data)
            assert end == np.searchsorted(bounds, done)
            assert data in text[start:end].encode()
        assert done == bounds[-1] and split == r["n_split"]


def test_round_trip(spark):
    texts = odd_texts()
    df = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    out = byte_bpe.decode(encoded(df), RANKS, PATTERN).collect()
    assert {r["doc_id"]: r["text"] for r in out} == dict(enumerate(texts))
    assert all(bytes(r["bytes"]) == r["text"].encode() for r in out)


def test_ids_cut_within_a_character_keep_their_bytes(spark):
    df = encoded(spark.createDataFrame([(1, "\U0010fffe")], SCHEMA))
    ids = bytes(df.first()["ids"])
    assert len(ids) > 4
    halves = spark.createDataFrame([(1, ids[:4]), (2, ids[4:]), (3, None), (4, b"")], "doc_id bigint, ids binary")
    got = {r["doc_id"]: r for r in byte_bpe.decode(halves, RANKS, PATTERN).collect()}
    assert bytes(got[1]["bytes"]) + bytes(got[2]["bytes"]) == "\U0010fffe".encode()
    assert "�" in got[1]["text"] and got[3]["text"] is None and got[3]["bytes"] is None and got[4]["text"] == ""


def test_every_token_comes_back(spark):
    ranks = byte_bpe.read_ranks(RANKS)
    table = byte_bpe.token_bytes(RANKS, PATTERN).to_pylist()
    assert table == [t for t, _ in sorted(ranks.items(), key=lambda x: x[1])]
    assert len(set(byte_bpe.byte_characters())) == 256


def test_odd_rows(odd, nothing, wanted):
    got = byte_bpe.id_array(encoded(odd)).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(((r["doc_id"], r["ids"]) for r in got), key=key) == sorted(
        ((r["doc_id"], wanted(r["text"] or "")) for r in odd.collect()), key=key
    )
    assert encoded(nothing).count() == 0 and byte_bpe.decode(encoded(nothing), RANKS, PATTERN).count() == 0


def test_the_query(spark, wanted, tmp_path):
    from devmetrics.llm.queries import QUERIES

    rows = [*enumerate(odd_texts()), (None, None)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in QUERIES["op13_byte_bpe"](spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    for key, text in rows:
        ids = wanted(text or "")
        assert got[key]["n_tokens"] == len(ids)
        assert got[key]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[key]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()
