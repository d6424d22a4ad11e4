"""A content-addressed web archive with SQL functions only.

An archive is two tables. ``payloads`` holds every payload once under its
SHA-256; ``records`` holds the exact WARC header bytes of every record and the
digest of its block. Original records come back by joining the two; reading
verifies each payload against its digest and size, and fails if one differs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Payloads below this size are stored in full each time, as records go.
MIN_REVISIT_BYTES = 1000
#: Fixed values of the WARC 1.1 format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
CRLF = "\r\n"


def record_id(page_id: Column) -> Column:
    """A record's name, from the page's id: the same in every run."""
    d = F.md5(F.coalesce(page_id.cast("string"), F.lit("")).cast("binary"))
    parts = F.concat_ws("-", *[F.substring(d, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    return F.concat(F.lit("<urn:uuid:"), parts, F.lit(">"))


def _header(name: str, value: Column) -> Column:
    """A header line; none for a null value."""
    return F.when(value.isNotNull(), F.concat(F.lit(name + ": "), value, F.lit(CRLF))).otherwise("")


def write_archive(pages: DataFrame, path: str, date: str = DATE) -> None:
    """Write a WARC record per row of ``pages`` (``page_id, url, html``).

    The payload is the html in UTF-8 (null: empty). Of the records with equal
    payloads of at least 1000 bytes the one with the largest page_id is the
    response and the others revisit it; smaller payloads are responses each.
    Rows that repeat the largest page_id are all responses; a null page_id is
    smaller than any other. A null url leaves out WARC-Target-URI; line breaks in
    a url become spaces. Equal payloads are those with equal SHA-256 and size.
    """
    spark = pages.sparkSession
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    hashed = pages.select("page_id", "url", payload.alias("payload")).select(
        "page_id", "url", "payload", F.sha2("payload", 256).alias("block"), F.octet_length("payload").cast("long").alias("bytes")
    )
    # One row per content, combined before the shuffle: copies never meet in one task
    stored = hashed.groupBy("block", "bytes").agg(F.max("page_id").alias("newest"), F.first("payload").alias("payload"))
    stored.write.option("compression", "zstd").parquet(f"{path}/payloads")
    newest = spark.read.parquet(f"{path}/payloads").select(F.col("block").alias("block2"), F.col("bytes").alias("bytes2"), "newest")
    light = hashed.select("page_id", "url", "block", "bytes", F.sha1("payload").alias("sha1"))
    told = light.join(newest, (F.col("block") == F.col("block2")) & (F.col("bytes") == F.col("bytes2")))
    revisit = (F.col("bytes") >= MIN_REVISIT_BYTES) & ~F.col("page_id").eqNullSafe(F.col("newest"))
    head = F.concat(
        F.lit(VERSION + CRLF),
        _header("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _header("WARC-Record-ID", record_id(F.col("page_id"))),
        _header("WARC-Date", F.lit(date)),
        _header("WARC-Target-URI", F.regexp_replace("url", r"[\r\n]+", " ")),
        _header("WARC-Page-ID", F.col("page_id").cast("string")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        _header("WARC-Block-Digest", F.when(~revisit, F.concat(F.lit("sha256:"), F.col("block")))),
        _header("WARC-Profile", F.when(revisit, F.lit(REVISIT_PROFILE))),
        _header("WARC-Refers-To", F.when(revisit, record_id(F.col("newest")))),
        _header("WARC-Refers-To-Page-ID", F.when(revisit, F.col("newest").cast("string"))),
        _header("Content-Type", F.lit("text/html; charset=utf-8")),
        _header("Content-Length", F.when(revisit, 0).otherwise(F.col("bytes")).cast("string")),
        F.lit(CRLF),
    )
    records = told.select(F.encode(head, "UTF-8").alias("header"), "block", revisit.alias("revisits"))
    records.write.option("compression", "zstd").parquet(f"{path}/records")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """``header, payload, record``: the records of an archive, restored.

    ``payload`` is the full payload, for a revisit that of the record it refers
    to; ``record`` is the exact record, whose block is empty for a revisit. A
    missing payload, or one that does not have its digest, is an error.
    """
    payloads = spark.read.parquet(f"{path}/payloads")
    sound = F.col("payload").isNotNull() & (F.sha2("payload", 256) == F.col("key")) & (F.octet_length("payload") == F.col("bytes"))
    verified = payloads.select(F.col("block").alias("key"), "bytes", "payload").withColumn(
        "payload", F.when(sound, F.col("payload")).otherwise(F.raise_error(F.concat(F.lit("damaged payload "), F.col("key"))).cast("binary"))
    )
    records = spark.read.parquet(f"{path}/records").join(verified, F.col("block") == F.col("key"), "left")
    found = F.coalesce("payload", F.raise_error(F.concat(F.lit("missing payload "), F.col("block"))).cast("binary"))
    block = F.when(F.col("revisits"), F.lit(b"")).otherwise(F.col("payload"))
    end = F.lit((CRLF * 2).encode())
    return records.withColumn("payload", found).select("header", "payload", F.concat("header", block, end).alias("record"))


def header_field(name: str) -> Column:
    """The value of a header line of ``header``; null if there is none."""
    text = F.decode("header", "UTF-8")
    return F.nullif(F.regexp_extract(text, rf"\n{name}: ([^\r]*)\r", 1), F.lit(""))
