import base64
import hashlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from talkmill.llm.common import shared_path
from talkmill.llm.warc import archive_and_read, read_records, rebuild, write_archive

PAGES = [(1, "u1", "<p>a</p>"), (2, "u2", "<p>a</p>"), (5, None, "<p>a</p>"), (3, "u3", None), (4, "u\r\n4", ""),
         (6, "u6", "é" * 50_000), (6, "u6", "é" * 50_000)]


def _pages(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string")


def _expected(rows):
    body = {i: (h or "").encode() for i, _, h in rows}
    out = {}
    for i, b in body.items():
        top = max(j for j, c in body.items() if c == b)
        out[i] = (len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(),
                  "response" if i == top else "revisit", None if i == top else top)
    return out


def test_roles_digests_and_lengths(spark):
    out = archive_and_read(_pages(spark), "page_id", "url", F.col("html").cast("binary")).collect()
    assert len(out) == len(PAGES)
    expected = _expected(PAGES)
    for r in out:
        assert (r["length"], r["digest"], r["record_type"], r["refers_to"]) == expected[r["record_id"]]


def test_payloads_are_stored_once_and_records_rebuild(spark):
    path = shared_path(spark, "warc-test")
    write_archive(_pages(spark), path, "page_id", "url", F.col("html").cast("binary"))
    assert spark.read.parquet(f"{path}/payloads").count() == 3
    records = {r["record_id"]: bytes(r["record"]) for r in rebuild(spark, path).collect()}
    assert records[5].startswith(b"WARC/1.1\r\n") and records[5].endswith(b"\r\n\r\n<p>a</p>\r\n\r\n")
    assert records[1].endswith(b"Content-Length: 0\r\n\r\n\r\n\r\n") and b"WARC-Refers-To: <urn:record:5>" in records[1]
    assert b"WARC-Target-URI: u 4\r\n" in records[4]


def test_short_payloads_are_responses_each(spark):
    out = archive_and_read(_pages(spark), "page_id", "url", F.col("html").cast("binary"), min_shared_bytes=100)
    assert {r["record_type"] for r in out.collect()} == {"response"}


def test_damage_is_found(spark):
    path = shared_path(spark, "warc-test")
    write_archive(_pages(spark), path, "page_id", "url", F.col("html").cast("binary"))
    bad = spark.read.parquet(f"{path}/payloads").withColumn(
        "payload", F.concat("payload", F.lit("!").cast("binary"))).collect()
    other = shared_path(spark, "warc-test")
    spark.createDataFrame(bad).write.parquet(f"{other}/payloads")
    spark.read.parquet(f"{path}/records").write.parquet(f"{other}/records")
    with pytest.raises(Exception, match="does not verify"):
        read_records(spark, other).collect()


def test_empty_table_and_null_ids(spark):
    body = F.col("html").cast("binary")
    assert archive_and_read(_pages(spark, []), "page_id", "url", body).count() == 0
    rows = archive_and_read(_pages(spark, [(None, "u", "x"), (7, "v", "x"), (None, "u", "y"), (None, "w", "y")]),
                            "page_id", "url", body).collect()
    assert sorted((r["uri"], r["record_id"] or 0, r["record_type"], r["refers_to"] or 0, bytes(r["payload"])) for r in rows) == [
        ("u", 0, "response", 0, b"y"), ("u", 0, "revisit", 7, b"x"), ("v", 7, "response", 0, b"x"), ("w", 0, "response", 0, b"y")]


def _parsed(data):
    """One record read by the standard's rules, without this package."""
    head, rest = data.split(b"\r\n\r\n", 1)
    first, *lines = head.decode().split("\r\n")
    assert first == "WARC/1.1"
    fields = dict(line.split(": ", 1) for line in lines)
    length = int(fields["Content-Length"])
    assert rest[length:] == b"\r\n\r\n"
    return fields, rest[:length]


def test_records_hold_the_mandatory_fields(spark):
    path = shared_path(spark, "warc-test")
    pages = _pages(spark).withColumn("seen", F.when(F.col("page_id") < 4, F.lit("2024-05-06 07:08:09").cast("timestamp")))
    write_archive(pages, path, "page_id", "url", F.col("html").cast("binary"), date=F.col("seen"))
    bodies = {i: (h or "").encode() for i, _, h in PAGES}
    for r in rebuild(spark, path).collect():
        fields, block = _parsed(bytes(r["record"]))
        assert {"WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length"} <= set(fields)
        when = datetime.strptime(fields["WARC-Date"], "%Y-%m-%dT%H:%M:%SZ")
        assert (when == datetime(2024, 5, 6, 7, 8, 9)) == (r["record_id"] < 4)
        revisit = fields["WARC-Type"] == "revisit"
        assert revisit == ("WARC-Profile" in fields) == ("WARC-Refers-To" in fields)
        assert block == (b"" if revisit else bodies[r["record_id"]])
