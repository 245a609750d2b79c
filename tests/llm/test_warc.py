import base64
import hashlib
import struct
from pathlib import Path

from devmetrics.llm import warc


def test_round_trip(spark, tmp_path):
    pages = [(i, f"http://h/{i}", f"<p>{'text %d ' % (i % 7) * 40}</p>") for i in range(200)]
    pages += [(None, "u", pages[0][2]), (500, None, None), (501, "a\r\nb: c", ""), (3, "twice", "é"), (3, "twice", "é")]
    df = spark.createDataFrame([(*p, "x") for p in pages], "page_id bigint, url string, html string, payload string")
    got = warc.archive(df.repartition(3), str(tmp_path / "w"), archive_bytes=2000).collect()
    assert len(got) == len(pages)
    first = {}
    for key, _, html in sorted(pages, key=lambda p: (p[0] is None, p[0] or 0)):
        first.setdefault((html or "").encode(), key)
    by_id = {}
    for r in got:
        by_id.setdefault(r["page_id"], []).append(r)
    for key, _, html in pages:
        body = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        assert any(r["payload_bytes"] == len(body) and r["payload_digest"] == digest for r in by_id[key])
    for body, key in first.items():
        same = [r for r in got if r["payload_digest"] == base64.b32encode(hashlib.sha1(body).digest()).decode()]
        (response,) = [r for r in same if r["record_type"] == "response"]
        assert response["page_id"] == key and response["payload"] == body and response["refers_to"] is None
        assert all(r["refers_to"] == key and r["payload"] is None for r in same if r is not response)


def test_archives_carry_their_dictionary(spark, tmp_path):
    rows = [(i, "u", f"<html>{i} " + "common words of every page " * 20) for i in range(300)]
    warc.archive(spark.createDataFrame(rows, "page_id bigint, url string, html string"), str(tmp_path / "w"), dictionary_bytes=4096).count()
    for path in Path(tmp_path / "w").glob("*.warc.zst"):
        data = path.read_bytes()
        magic, size = struct.unpack_from("<II", data)
        assert magic == warc.SKIPPABLE_MAGIC and size > 0
        assert all(x.startswith(b"WARC/1.1\r\n") for x in warc.records_of(data))


def test_small_payloads_are_all_responses(spark, tmp_path):
    rows = [(1, "u", "abc"), (2, "u", "abc"), (3, "u", "long enough"), (4, "u", "long enough")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r["page_id"]: r["record_type"] for r in warc.archive(df, str(tmp_path / "w"), min_bytes=5).collect()}
    assert got == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_empty_table(spark):
    assert warc.archive(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0
