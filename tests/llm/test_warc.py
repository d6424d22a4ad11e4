from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from forumlens.llm import warc

PAGE = "page_id long, url string, html string"
LONG = "<p>" + "é" * 600 + "</p>"


def restored(spark, pages, path):
    warc.write_archive(pages, path)
    return warc.read_archive(spark, path)


def test_records(spark, tmp_path):
    rows = [
        (1, "http://a/1", LONG),
        (2, "http://a/2", LONG),
        (9, "http://a/9", LONG),
        (3, "http://a/3", "short"),
        (4, "http://a/4", "short"),
        (5, None, None),
        (6, "http://a/6\r\nX: y", ""),
        (7, "http://b", "x" * 1000),
        (7, "http://b", "x" * 1000),
        (None, "http://c", "x" * 1000),
        (8, "http://d", "z" * 500_000),
    ]
    pages = spark.createDataFrame(rows, PAGE).withColumn("block", F.lit("x")).withColumn("bytes", F.lit(1)).withColumn("payload", F.lit(1))
    field = warc.header_field
    found = restored(spark, pages, str(tmp_path / "a")).select(
        field("WARC-Page-ID").cast("long").alias("id"),
        field("WARC-Type").alias("kind"),
        field("WARC-Refers-To-Page-ID").cast("long").alias("to"),
        field("WARC-Payload-Digest").alias("digest"),
        field("Content-Length").alias("length"),
        "header",
        "payload",
        "record",
    ).collect()
    assert len(found) == len(rows)
    html = {i: (h or "").encode() for i, _, h in rows}
    for r in found:
        body = html[r.id]
        assert bytes(r.payload) == body and r.digest == "sha1:" + hashlib.sha1(body).hexdigest()
        head, _, rest = bytes(r.record).partition(b"\r\n\r\n")
        assert head + b"\r\n\r\n" == bytes(r.header) and head.startswith(b"WARC/1.1\r\n")
        assert rest == (b"" if r.kind == "revisit" else body) + b"\r\n\r\n" and int(r.length) == len(rest) - 4
        assert all(b": " in line for line in head.split(b"\r\n")[1:])
    kinds = sorted((r.id or 0, r.kind, r.to) for r in found)
    assert kinds == [
        (0, "revisit", 7),
        (1, "revisit", 9),
        (2, "revisit", 9),
        *[(i, "response", None) for i in (3, 4, 5, 6, 7, 7, 8, 9)],
    ]
    assert spark.read.parquet(str(tmp_path / "a/payloads")).count() == 5


def test_headers_come_back_exactly(spark, sample, tmp_path):
    pages = spark.read.parquet(f"{sample}/pages.parquet")
    found = restored(spark, pages, str(tmp_path / "a"))
    want = {(r.url, r.html) for r in pages.collect()}
    got = {(r[0], bytes(r[1]).decode()) for r in found.select(warc.header_field("WARC-Target-URI"), "payload").collect()}
    assert got == want


def test_no_rows(spark, tmp_path):
    assert restored(spark, spark.createDataFrame([], PAGE), str(tmp_path / "a")).collect() == []


def test_damage_is_an_error(spark, tmp_path):
    path = str(tmp_path / "a")
    warc.write_archive(spark.createDataFrame([(1, "u", "one"), (2, "u", "two")], PAGE), path)
    stored = spark.read.parquet(f"{path}/payloads")
    stored.withColumn("payload", F.encode(F.lit("two"), "UTF-8")).write.parquet(str(tmp_path / "b/payloads"))
    spark.read.parquet(f"{path}/records").write.parquet(str(tmp_path / "b/records"))
    with pytest.raises(Exception, match="damaged payload"):
        warc.read_archive(spark, str(tmp_path / "b")).collect()
    stored.limit(1).write.parquet(str(tmp_path / "c/payloads"))
    spark.read.parquet(f"{path}/records").write.parquet(str(tmp_path / "c/records"))
    with pytest.raises(Exception, match="missing payload"):
        warc.read_archive(spark, str(tmp_path / "c")).collect()
