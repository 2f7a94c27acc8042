import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from tablewright.llm import warc
from tablewright.session import fresh_path

SCHEMA = "page_id long, url string, html string"
FAKE = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:99>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
ROWS = [
    (1, "http://a", "x" * 4000),
    (2, None, ""),
    (3, "u\r\nWARC-Type: evil", "a" + FAKE + "é" + FAKE),
    (4, "b", None),
    (5, "c", "x" * 4000),
    (6, "c", FAKE * 60),
    (7, "d", FAKE[:-4]),
    (8, "d", "\r\n\r\n"),
    (None, "e", "x" * 4000),
    (9, "e", "WARC/1.1\r\n" * 900),
    (9, "e", "WARC/1.1\r\n" * 900),
    (None, "f", "never seen elsewhere"),
]
DERIVE = {"payload": lambda p: p, "payload_bytes": F.octet_length, "payload_digest": warc.base32_sha1}


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_round_trip_over_split_files(spark, small_splits):
    path = fresh_path(spark, "warc")
    extra = spark.createDataFrame(ROWS, SCHEMA).withColumn("digest", F.lit("clash")).withColumn("first", F.lit(0))
    warc.write_archives(extra.coalesce(2), path)
    records = warc.read_archives(spark, path, DERIVE)
    got = records.collect()
    assert len(got) == len(ROWS)
    texts = {i: h or "" for i, _, h in ROWS if i is not None}
    for r in got:
        page = r.record_id[len("<urn:page:") : -1]
        if r.record_type == "response":
            assert r.payload == (texts[int(page)] if page != "null" else "never seen elsewhere")
    first = {}
    for i, _, h in ROWS:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    want = []
    for i, _, h in ROWS:
        h = h or ""
        digest = base64.b32encode(hashlib.sha1(h.encode()).digest()).decode()
        original = first.get(h) in (i, None)
        want.append((i, len(h.encode()), digest, "response" if original else "revisit", None if original else first[h]))
    assert sorted(map(tuple, warc.page_digests(records).collect()), key=str) == sorted(want, key=str)


def test_least_bytes(spark):
    path = fresh_path(spark, "warc")
    warc.write_archives(spark.createDataFrame([(1, "a", "ab"), (2, "b", "ab"), (3, "c", "abc"), (4, "d", "abc")], SCHEMA), path, least_bytes=3)
    got = {r.record_id: r.record_type for r in warc.read_archives(spark, path, {}).collect()}
    assert [got[f"<urn:page:{i}>"] for i in (1, 2, 3, 4)] == ["response", "response", "response", "revisit"]


def test_broken_chain(spark, tmp_path):
    def record(n, body, length=None):
        return f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{n}>\r\nContent-Length: {len(body) if length is None else length}\r\n\r\n{body}\r\n\r\n"

    (tmp_path / "bad.warc").write_bytes((record(1, "one") + record(2, "two", 7) + record(3, "three")).encode())
    with pytest.raises(ValueError, match=r"bad\.warc"):
        warc.read_archives(spark, str(tmp_path), {})
    got = warc.read_archives(spark, str(tmp_path), {"payload": lambda p: p}, strict=False).collect()
    assert {r.record_id for r in got} <= {"<urn:page:1>", "<urn:page:2>"} and "one" in {r.payload for r in got}


def test_empty_table(spark):
    path = fresh_path(spark, "warc")
    warc.write_archives(spark.createDataFrame([], SCHEMA), path)
    assert warc.read_archives(spark, path, DERIVE).collect() == []
